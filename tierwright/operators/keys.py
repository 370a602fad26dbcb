"""Surrogate keys: dense 1..n in natural-key order, without a global window.

A plain ``row_number() over (order by key)`` sorts everything in one task.  Here
the key space is cut into buckets at fixed cut points, each bucket is numbered on
its own, and the number of keys in lower buckets is added.  The bucket is a
function of the key alone, so the result does not depend on where the cuts fell,
on retries or on partitioning.
"""

from __future__ import annotations

import json
import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwright.functions.values import hashed_key

SAMPLES_PER_BUCKET = 20
# Buckets and rows per bucket both grow with the rows: 8 buckets for 600 thousand rows, 1,112 for a billion,
# 24,000 of four million rows for a hundred billion.
BUCKET_SCALE = 900


# Whole rows are sorted several times in the buckets of a slice, so those have no more rows than fit into a task's memory;
# cut points are as many.
SLICE_BUCKET_ROWS = 100_000
MOST_SLICE_BUCKETS = 10_000

# Part of the message of a task that meets one natural key twice.
REPEATED_KEY = "natural key is repeated"


class KeyCollision(RuntimeError):
    """Two natural keys have one hashed key."""


def _choose_bucket_count(rows: int) -> int:
    return max(1, math.ceil(rows ** (2 / 3) / BUCKET_SCALE))


def _cut_points(df: DataFrame, key: str, buckets: int, rows: int) -> list:
    """At most ``buckets - 1`` increasing key values from a bounded sample.

    Only picks boundaries: no row is left out of the numbering because of it.
    """
    if buckets == 1 or rows == 0:
        return []
    target = buckets * SAMPLES_PER_BUCKET
    fraction = min(1.0, 1.2 * target / rows)
    sampled = df.select(key).where(F.col(key).isNotNull())
    if fraction < 1.0:
        sampled = sampled.sample(fraction=fraction, seed=17)
    # code-point order, in which Python sorts text, is Spark's byte order of UTF-8
    seen = sorted({r[0] for r in sampled.collect()})
    return sorted({seen[i * len(seen) // buckets] for i in range(1, buckets)}) if seen else []


def _literal_array(values: list, element: T.DataType) -> Column:
    """An array constant, folded once at planning time."""
    return F.from_json(F.lit(json.dumps(values)), T.ArrayType(element))


def bucket_of(key: Column, cuts: Column, n_cuts: int) -> Column:
    """How many cut points are <= key, by binary search inside the JVM."""
    if n_cuts == 0:
        return F.lit(0)
    top = 1 << (n_cuts.bit_length() - 1)
    steps = F.array(*[F.lit(top >> i) for i in range(top.bit_length())])

    def advance(low: Column, step: Column) -> Column:
        # past the end get() is NULL, and the search stays where it is
        return F.when(F.get(cuts, low + step - 1) <= key, low + step).otherwise(low)

    return F.aggregate(steps, F.lit(0), advance)


def dense_keys(
    df: DataFrame,
    natural_key: str,
    name: str,
    rows: int | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Prepend ``name``: 1..n in ``natural_key`` order.

    ``natural_key`` must be of text or integer type, and unique: equal keys fall into one bucket, where they
    are neighbours, so the task that numbers them fails with ``REPEATED_KEY``.  A bucket that has more rows than
    were counted, whose numbers would run into the next one's, fails likewise.  What comes out is therefore
    proved unique, both columns, by the sort that numbers it.  Runs two light
    jobs over that column alone (cut points, rows per bucket), so call it on a
    stored table; the driver sees some twenty sampled values per bucket.  ``rows`` saves
    counting when the number of rows is known, and ``buckets`` overrides what follows from it.
    """
    key_type = df.schema[natural_key].dataType
    if not isinstance(key_type, (T.StringType, T.LongType, T.IntegerType, T.ShortType)):
        raise TypeError(f"dense_keys needs a text or integer key, not {key_type.simpleString()}")

    rows = df.count() if rows is None else rows
    buckets = buckets or _choose_bucket_count(rows)
    cuts = _cut_points(df, natural_key, buckets, rows)
    bucket = bucket_of(F.col(natural_key), _literal_array(cuts, key_type), len(cuts))

    sizes = {}
    if cuts:
        per_bucket = df.select(bucket.alias("bucket")).groupBy("bucket").count()
        sizes = {r["bucket"]: r["count"] for r in per_bucket.collect()}
    counts = [sizes.get(b, 0) for b in range(len(cuts) + 1)]
    offsets = [0, *accumulate(counts)][:-1]

    ordered = W.partitionBy("_bucket").orderBy(natural_key)
    within = F.row_number().over(ordered).cast("bigint")
    offset = F.get(_literal_array(offsets, T.LongType()), F.col("_bucket"))
    refused = F.lag(natural_key).over(ordered) == F.col(natural_key)
    if cuts:
        refused = refused | (within > F.get(_literal_array(counts, T.LongType()), F.col("_bucket")))
    message = F.lit(f"{natural_key}: {REPEATED_KEY}, or its table has changed")
    number = F.when(refused, F.raise_error(message).cast("bigint")).otherwise(offset + within)
    # a partition of its own for every bucket, whatever the session's number of shuffle partitions
    placed = df.withColumn("_bucket", bucket).repartitionById(len(cuts) + 1, "_bucket")
    return placed.select(number.alias(name), *df.columns)


BUCKET, WITHIN = "_bucket", "_within"


def key_buckets(df: DataFrame, key: Column, buckets: int | None = None) -> DataFrame:
    """``df`` with ``_bucket``, rising ranges of ``key``, each in a partition of its own.

    For rows that are to be deduplicated by ``key`` and then numbered: both happen in the buckets, so one shuffle does,
    before anything is derived.  Rows of one key meet in one task, so not with a hot key.
    """
    keys = df.select(key.alias("_key"))
    key_type = keys.schema["_key"].dataType
    rows = df.count()
    cuts = _cut_points(keys, "_key", buckets or _choose_bucket_count(rows), rows)
    bucket = bucket_of(key, _literal_array(cuts, key_type), len(cuts))
    return df.withColumn(BUCKET, bucket).repartitionById(len(cuts) + 1, BUCKET)


def key_slices(df: DataFrame, key: Column, most_rows: int) -> list[tuple[int, DataFrame]]:
    """:func:`key_buckets` in slices of neighbouring buckets, some ``most_rows`` rows each: first bucket and rows.

    A slice is a frame of its own, so a table written slice by slice has the shuffle files of one slice beside it,
    however many rows there are.  Each slice reads ``df`` anew, so call it on a stored table.  ``key`` is not null.
    """
    keys = df.select(key.alias("_key"))
    key_type = keys.schema["_key"].dataType
    rows = df.count()
    buckets = max(_choose_bucket_count(rows), min(MOST_SLICE_BUCKETS, math.ceil(rows / SLICE_BUCKET_ROWS)))
    cuts = _cut_points(keys, "_key", buckets, rows)
    n = min(len(cuts) + 1, max(1, math.ceil(rows / most_rows)))
    edges = [i * (len(cuts) + 1) // n for i in range(n + 1)]
    slices = []
    for first, end in zip(edges, edges[1:]):
        part = df
        if first:
            part = part.where(key >= F.lit(cuts[first - 1]))
        if end <= len(cuts):
            part = part.where(key < F.lit(cuts[end - 1]))
        inner = cuts[first : end - 1]
        bucket = F.lit(first) + bucket_of(key, _literal_array(inner, key_type), len(inner))
        # ids are taken modulo the number of partitions, so neighbouring buckets get one each
        slices.append((first, part.withColumn(BUCKET, bucket).repartitionById(end - first, BUCKET)))
    return slices


def number_in_buckets(df: DataFrame, natural_key: str) -> DataFrame:
    """Add ``_within``: 1..n in ``natural_key`` order in each bucket of :func:`key_buckets`.

    A key that repeats fails its task, as in :func:`dense_keys`.
    """
    ordered = W.partitionBy(BUCKET).orderBy(natural_key)
    repeated = F.lag(natural_key).over(ordered) == F.col(natural_key)
    message = F.lit(f"{natural_key}: {REPEATED_KEY}")
    within = F.row_number().over(ordered).cast("bigint")
    return df.withColumn(WITHIN, F.when(repeated, F.raise_error(message).cast("bigint")).otherwise(within))


def dense_keys_of_buckets(numbered: DataFrame, name: str, keep_bucket: bool = False) -> DataFrame:
    """Prepend ``name``: what :func:`dense_keys` gives, from rows numbered in buckets, without moving them.

    Call it on a stored table: a light job over two columns finds the size of every bucket.  ``keep_bucket`` leaves
    ``_bucket`` behind it.
    """
    per_bucket = numbered.groupBy(BUCKET).agg(F.max(WITHIN).alias("n")).collect()
    sizes = {r[BUCKET]: r["n"] for r in per_bucket}
    offsets = [0, *accumulate(sizes.get(b, 0) for b in range(max(sizes, default=0)))]
    offset = F.get(_literal_array(offsets, T.LongType()), F.col(BUCKET))
    rest = [c for c in numbered.columns if c not in (BUCKET, WITHIN)]
    kept = [BUCKET] if keep_bucket else []
    return numbered.select((offset + F.col(WITHIN)).alias(name), *kept, *rest)


def hashed_keys(df: DataFrame, natural_key: str, name: str) -> DataFrame:
    """Prepend ``name``: 63 bits of a hash of the natural key, which other engines can reproduce.

    Raises :class:`KeyCollision` if two natural keys share one.  That costs one narrow aggregate, reduced
    map-side; ``natural_key`` itself may repeat.  A null key stays null.
    """
    keyed = df.select(hashed_key(natural_key).alias(name), *df.columns)
    range_of_key = [F.min(natural_key).alias("lo"), F.max(natural_key).alias("hi")]
    clash = keyed.where(F.col(name).isNotNull()).groupBy(name).agg(*range_of_key).where("lo <> hi").first()
    if clash:
        raise KeyCollision(f"{natural_key}: {clash['lo']} and {clash['hi']} have one key")
    return keyed
