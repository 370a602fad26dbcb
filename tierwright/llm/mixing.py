"""Mixing sources to target weights with exact budgets."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, WORD_PATTERN, free_name, read_table, running_totals, store

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"


def source_budgets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of the sources, from a table (source, source_size) with one row per source.

    Sources by code point, null last, take the weights in turn and share the sum of all sizes.  Nobody gets
    more than ``max_epochs`` times its size; the excess goes to the others by weight until none is above.
    That fixed point is found at once: in the order of limit over weight the limited sources come first, and
    a source is limited if its limit is below its share of what the ones before leave.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    weighed = sizes.select(
        "source",
        "source_size",
        (F.col("source_size") * max_epochs).alias("limit"),
        F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).alias("w"),
    )
    ratio = Window.orderBy(F.expr("limit / w"), F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    ranked = weighed.select(
        "*",
        (F.sum("source_size").over(everyone) - F.coalesce(F.sum("limit").over(before), F.lit(0))).alias("left_size"),
        (F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(before), F.lit(0))).alias("left_w"),
    ).withColumn("limited", F.expr("limit * left_w <= left_size * w"))
    # what the limited ones leave: the first free source in that order sees it
    free = ranked.select(
        "*",
        F.min(F.when(~F.col("limited"), F.struct(F.expr("limit / w"), "left_size", "left_w"))).over(everyone).alias("free"),
    )
    return free.select(
        "source",
        "source_size",
        F.when(F.col("limited"), F.col("limit").cast("double"))
        .otherwise(F.expr("cast(free.left_size * w as double) / free.left_w"))
        .alias("target"),
        F.when(F.col("limited"), F.col("limit")).otherwise(F.expr("(free.left_size * w) div free.left_w")).alias("budget"),
    )


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def _placed(sized: DataFrame, order: Sequence[str], weights: Sequence[int], max_epochs: int) -> DataFrame:
    """``sized`` with its source's budget: ``whole`` epochs and ``rest`` words of one more, and ``size_before``."""
    summed = running_totals(sized, order, ("size",), by=("source",), label="mix")
    sizes = summed.groupBy("source").agg(F.max("size_total").alias("source_size"))
    budgets = source_budgets(sizes, weights, max_epochs).withColumnRenamed("source", "b_source")
    joined = summed.join(budgets, F.col("source").eqNullSafe(F.col("b_source")))
    rest = F.expr("coalesce(budget % nullif(source_size, 0), 0)")
    return joined.withColumn("rest", rest).withColumn(
        "whole", F.expr("coalesce(try_divide(budget - rest, source_size), 0)").cast("long")
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """How many words of each document the mix takes.

    A document's key is the md5 of seed and id; within its source, documents are range-sorted by key (then
    id, size: ties and repeated rows each have a place) and their word counts summed.  A source of size S
    with budget q * S + r is taken q times whole, and once more up to its r-th word: ``taken`` sums to the
    whole part of the target exactly, and the document on the cut is taken in part.  A null text has size 0
    and a null id a key of its own; a null source is a source.  Empty tables give no rows, and sources
    without words a target of 0.  No text is shuffled.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        _size(F.col(text_col)).alias("size"),
        _key(F.col(id_col), seed).alias("key"),
    )
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("size_before")))
    taken = (F.col("whole") * F.col("size") + part).cast("long").alias("taken")
    placed = _placed(sized, ("key", "doc_id", "size"), weights, max_epochs)
    return placed.select("doc_id", "source", "size", "source_size", "target", taken)


def materialise_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """The mix itself: rows of ``docs`` repeated whole, the document on a source's cut shortened.

    Returns the columns of ``docs``; ``n_chars``, if there is one, follows a shortened text.  A document
    that the mix does not take is absent, one without words stays once: it costs no budget.

    Texts are stored with their place in the order and not shuffled: all a document needs to know is whether
    it comes before the cut of its source, and there is one cut a source.
    """
    place, cut = free_name(docs.columns, "_place"), free_name(docs.columns, "_cut")
    fields = {"key": _key(F.col(id_col), seed), "size": _size(F.col(text_col)), "row": F.monotonically_increasing_id()}
    staged = store(docs.withColumn(place, F.struct(*[c.alias(n) for n, c in fields.items()])), "mix-docs")
    sized = staged.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), f"{place}.*")
    order = ("key", "doc_id", "size", "row")
    beyond = (F.col("size") > 0) & (F.col("size_before") + F.col("size") > F.col("rest"))
    first = F.struct(*order, (F.col("rest") - F.col("size_before")).alias("words"))
    per_source = _placed(sized, order, weights, max_epochs).groupBy("source").agg(
        F.max("whole").alias("whole"), F.min(F.when(beyond, first)).alias("first")
    )
    # stored, so that its size is known when the join with the texts is planned
    cuts = store(per_source.select(F.struct("source", "whole", "first.*").alias(cut)), "mix-cuts")
    both = staged.join(cuts, F.col(source_col).eqNullSafe(F.col(f"{cut}.source")))
    own = F.struct(F.col(f"{place}.key"), F.col(id_col), F.col(f"{place}.size"), F.col(f"{place}.row"))
    before_cut = F.col(f"{cut}.row").isNotNull() & (own < F.struct(*[F.col(f"{cut}.{c}") for c in order]))
    epochs = F.col(f"{cut}.whole") + F.when(before_cut, 1).otherwise(0)
    times = F.when(F.col(f"{place}.size") == 0, 1).otherwise(epochs).cast("int")
    whole = both.withColumn(cut, F.explode(F.array_repeat(F.lit(0), times))).select(*docs.columns)
    on_cut = (F.col(f"{place}.row") == F.col(f"{cut}.row")) & (F.col(f"{cut}.words") > 0)  # at most one a source
    shortened = both.filter(on_cut).withColumn(text_col, _head(F.col(text_col), F.col(f"{cut}.words")))
    if "n_chars" in docs.columns:
        shortened = shortened.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return whole.unionByName(shortened.select(*docs.columns))


def _head(text: Column, words: Column) -> Column:
    """The first ``words`` words with what stands before and between them."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, counts: pd.Series) -> pd.Series:
        ends = [next(islice(WORD.finditer(t), int(n) - 1, None)).end() for t, n in zip(texts, counts, strict=True)]
        return pd.Series([t[:end] for t, end in zip(texts, ends, strict=True)], dtype=object)

    return run(text, words)


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents")).drop("source")


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, 3 * source_size AS cap,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM sources
), ranked AS (
  SELECT *,
    sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0) AS left_size,
    sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS left_w
  FROM weighed
  WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (
  SELECT *, cap * left_w <= left_size * w AS capped FROM ranked
), free AS (
  SELECT *, first_value(CASE WHEN NOT capped THEN left_size END)
              OVER (ORDER BY capped, cap / w, source NULLS LAST) AS f_size,
            first_value(CASE WHEN NOT capped THEN left_w END)
              OVER (ORDER BY capped, cap / w, source NULLS LAST) AS f_w
  FROM marked
), budgets AS (
  SELECT source, source_size,
    CASE WHEN capped THEN cap::DOUBLE ELSE (f_size * w)::DOUBLE / f_w END AS target,
    CASE WHEN capped THEN cap ELSE (f_size * w) // f_w END AS budget
  FROM free
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized
)
SELECT p.doc_id, p.size, b.source_size, b.target,
  (CASE WHEN b.source_size = 0 THEN 0 ELSE
     (b.budget // b.source_size) * p.size
     + greatest(0, least(p.size, b.budget % b.source_size - p.before)) END)::BIGINT AS taken
FROM placed p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source
"""
