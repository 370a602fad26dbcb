"""Facts about a table's columns and values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwright.functions.literals import small_frame
from tierwright.operators.contracts import Contract, data_type, repeated_rows


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, nulls, row_count) from a single pass."""
    columns = list(columns or df.columns)
    counts = [F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)]
    totals = df.agg(F.count(F.lit(1)).alias("row_count"), *counts)
    lines = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"m{i}").alias("nulls"), F.col("row_count")
        )
        for i, c in enumerate(columns)
    ]
    return totals.select(F.explode(F.array(*lines)).alias("r")).select("r.*")


def is_unique(df: DataFrame, column: str) -> DataFrame:
    """One row: row count, distinct non-null values, and whether they agree."""
    sizes = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count(column).alias("distinct_values"),
    ).select(
        F.lit(column).alias("column_name"),
        "row_count",
        "distinct_values",
        (F.col("row_count") == F.col("distinct_values")).alias("is_unique"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def domain_difference(df: DataFrame, column: str, expected: Sequence[str]) -> DataFrame:
    """(column_name, value, status): ``missing`` and ``unexpected`` against a domain.

    NULL is reported as an unexpected value.  Distinct values are reduced before
    they meet the expected list, so a hot value costs one row per task.
    """
    spark = df.sparkSession
    actual = df.groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    wanted = small_frame(spark, [(v,) for v in expected], "wanted string")
    return (
        actual.join(wanted, F.col("value") == F.col("wanted"), "full_outer")
        .where(F.col("value").isNull() | F.col("wanted").isNull())
        .select(
            F.lit(column).alias("column_name"),
            F.coalesce("value", "wanted").alias("value"),
            F.when(F.col("rows").isNull(), "missing").otherwise("unexpected").alias("status"),
            F.coalesce("rows", F.lit(0)).cast("bigint").alias("row_count"),
        )
    )


def schema_difference(schema: T.StructType, contract: Contract) -> list[tuple]:
    """(column, expected type, actual type, status) rows; metadata only."""
    actual = {f.name: f.dataType.simpleString() for f in schema}
    expected = {c.name: data_type(c.type).simpleString() for c in contract.columns}
    lines = []
    for name, want in expected.items():
        have = actual.get(name)
        status = "missing" if have is None else ("ok" if have == want else "type")
        lines.append((name, want, have, status))
    lines += [(n, None, t, "unexpected") for n, t in actual.items() if n not in expected]
    return lines


def dense_key_report(df: DataFrame, key: str) -> DataFrame:
    """Surrogate-key facts: integer type, no NULL, unique, and the range 1..n."""
    is_long = isinstance(df.schema[key].dataType, T.LongType)
    totals = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(key).isNull()).alias("nulls"),
        F.min(key).alias("lowest"),
        F.max(key).alias("highest"),
    )
    repeats = repeated_rows(df, key).withColumnRenamed("n", "repeated")
    # two single-row results, matched on a constant
    both = totals.withColumn("one", F.lit(1)).join(repeats.withColumn("one", F.lit(1)), "one")
    whole = (
        (F.col("nulls") == 0)
        & (F.col("repeated") == 0)
        & (F.col("lowest") == 1)
        & (F.col("highest") == F.col("row_count"))
    )
    return both.select(
        F.lit(key).alias("key_name"),
        F.lit(is_long).alias("is_bigint"),
        "row_count",
        "nulls",
        "repeated",
        "lowest",
        "highest",
        (whole & F.lit(is_long)).alias("holds"),
    )


def first_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """A small ordered sample; Spark plans this as a distributed top-n."""
    return df.orderBy(*order).limit(n)
