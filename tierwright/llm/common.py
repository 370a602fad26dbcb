"""Helpers that several operators share."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierwright.session import work_path

# A word is a run of code points other than space, tab, \n, \v, \f and \r.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)

# Spark's setting to drop the shuffle files of a query when it ends, rather than when the driver collects garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Bytes of the batches in which rows go to Python, and Spark's own choice: the text of its 10,000 rows, held by the
# executor and by each of its Python workers at once.
BATCH_BYTES, SPARKS_CHOICE = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
TEXT_BATCH = "8m"


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of ``TEXT_BATCH`` from now on, unless the session names another size."""
    if spark.conf.get(BATCH_BYTES, SPARKS_CHOICE) == SPARKS_CHOICE:
        spark.conf.set(BATCH_BYTES, TEXT_BATCH)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back.

    Cuts the lineage: a lost executor recomputes at most what follows the table.  Once it is written nothing
    needs the shuffle files behind it, and they go.
    """
    spark = df.sparkSession
    path = work_path(spark, f"llm-{label}")
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(columns: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores until it clashes with no column."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def crc_of_id(id_col: str) -> Column:
    """crc32 of the id written as text; null for a null id."""
    return F.crc32(F.col(id_col).cast("string"))


def running_totals(
    df: DataFrame, order: Sequence[str], values: Sequence[str], by: Sequence[str] = (), label: str = "prefix"
) -> DataFrame:
    """Distributed prefix sums: for each of ``values`` the sum over all rows before.

    Rows are numbered and stored, so that what leads to them runs once although ranging samples its input, then
    ranged by (``by``, ``order``) and that number and stored with the number of their range.  Each range is
    summed on its own and shifted by the totals of the ranges below, so a group that holds most rows, or
    rows of one content that do, are spread over many tasks.  Adds ``<v>_before`` and ``<v>_total``, both
    within the group ``by``.  Null values count as 0, null keys form a group of their own.  Rows that agree
    in every order column are interchangeable: they get consecutive places.
    """
    n = partitions(df.sparkSession)
    numbered = store(df.withColumn("_row", F.monotonically_increasing_id()), f"{label}-rows")
    order = (*order, "_row")
    ranged = numbered.repartitionByRange(n, *[F.col(c) for c in (*by, *order)])
    stored = store(ranged.withColumn("_part", F.spark_partition_id()), label)
    totals = stored.groupBy("_part", *by).agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(f"_t_{v}") for v in values])
    below = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    shifts = totals.select(
        F.col("_part").alias("_p"),
        *[F.col(c).alias(f"_by_{c}") for c in by],
        *[F.coalesce(F.sum(f"_t_{v}").over(below), F.lit(0)).alias(f"_s_{v}") for v in values],
        *[F.sum(f"_t_{v}").over(whole).alias(f"{v}_total") for v in values],
    )
    inside = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = stored.repartitionById(n, "_part").select(
        "*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_l_{v}") for v in values]
    )
    same = F.col("_part") == F.col("_p")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return local.join(shifts, same).select(
        *df.columns,
        *[(F.col(f"_l_{v}") + F.col(f"_s_{v}")).alias(f"{v}_before") for v in values],
        *[f"{v}_total" for v in values],
    )
