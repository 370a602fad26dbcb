"""Deterministic deduplication and per-key selections.

All of these stay safe when one key holds a large share of the rows: each map
task keeps only its own best rows per key, or a partial aggregate, before the
shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DEFAULT_ORDER = ("_ingested_at", "_source_row_hash")

# A key with about this many rows is hot; it shows in a sample of every hundredth row.
HOT_ROWS = 100_000
HOT_SAMPLE = 0.01


def has_hot_key(df: DataFrame, keys: Sequence[Column | str]) -> bool:
    """Whether some key has so many rows that one task should not get them all.  Reads the keys alone."""
    names = [f"_k{i}" for i in range(len(keys))]
    columns = [(F.col(k) if isinstance(k, str) else k).alias(n) for k, n in zip(keys, names)]
    sampled = df.select(*columns).sample(fraction=HOT_SAMPLE, seed=17)
    counts = sampled.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    return not counts.where(F.col("_n") >= HOT_ROWS * HOT_SAMPLE).isEmpty()


def together(df: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """Rows shuffled by ``keys`` as they are, so that what follows per key sorts shuffle partitions only.

    Ranking before a shuffle sorts whole input splits, which spill, and moves rows with all columns derived by
    then.  With a hot key that is still the better way, and ``df`` is returned as it is: the decision changes the
    plan, never the result.  The selections below need no further shuffle, also if ``keys`` are named later on.
    """
    return df if has_hot_key(df, keys) else df.repartition(*keys)


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1
) -> DataFrame:
    """First ``n`` rows per key.  The rank filter prunes before the shuffle."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = DEFAULT_ORDER
) -> DataFrame:
    return top_per_key(df, keys, order, 1)


def keep_first_counted(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = DEFAULT_ORDER,
    copies: str = "_copies",
) -> DataFrame:
    """Like :func:`keep_first`, with the number of input rows of each key.

    One aggregation gives winner and count together, so the input is read once.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.min(F.struct(*order, *rest)).alias("_best")
    grouped = df.groupBy(*keys).agg(best, F.count(F.lit(1)).alias(copies))
    columns = [F.col(c) if c in keys else F.col(f"_best.`{c}`").alias(c) for c in df.columns]
    return grouped.select(*columns, copies)


def duplicate_losers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = DEFAULT_ORDER,
    copies: str = "copies",
    placed: bool | None = None,
) -> DataFrame:
    """Every row :func:`keep_first` leaves out, with equal rows folded into a count.

    Rows of a key come together once, where they are folded and ranked; ``placed`` says that they are, and None
    that it is to be found out (:func:`together`).  With a hot key, or ``placed=False``, equal copies collapse
    map-side, and what is left of the key meets its winner in a join, whose skewed partitions Spark can split.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    content = F.struct(*order, *rest)
    if placed is None:
        placed = not has_hot_key(df, keys)
        df = df.repartition(*keys) if placed else df
    folded = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies))
    if placed:
        rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order, *rest))
        beaten = F.col(copies) - (rank == 1).cast("long")
        return folded.withColumn(copies, beaten).where(F.col(copies) > 0).select(*df.columns, copies)
    key_names = [f"_key{i}" for i in range(len(keys))]
    best = keep_first(df, keys, [*order, *rest]).select(
        *[F.col(k).alias(n) for k, n in zip(keys, key_names)], content.alias("_best")
    )
    same_key = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, key_names)]
    is_winner = content.eqNullSafe(F.col("_best")).cast("long")
    return (
        folded.join(best, same_key)
        .withColumn(copies, F.col(copies) - is_winner)
        .where(F.col(copies) > 0)
        .select(*df.columns, copies)
    )


def dedup_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``rows_in``, ``rows_out``, ``duplicates_removed``."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_in"),
            F.count(F.lit(1)).alias("rows_out"),
        )
        .withColumn("duplicates_removed", F.col("rows_in") - F.col("rows_out"))
    )
