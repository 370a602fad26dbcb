"""Referential integrity between tables.

Joins carry no broadcast hints: Spark broadcasts a side only while it is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, splitting skewed
partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows without a parent; a NULL foreign key counts as an orphan."""
    keys = parent.select(F.col(parent_key).alias("_parent_key"))
    return child.join(keys, F.col(foreign_key) == F.col("_parent_key"), "left_anti")


def count_orphans(
    child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str, relation: str
) -> DataFrame:
    """One row: relation, orphans, total, percentage (0 when the child is empty).

    Child keys are counted first, so a hot key crosses the shuffle once per task.
    """
    per_key = child.groupBy(F.col(foreign_key).alias("_fk")).agg(F.count(F.lit(1)).alias("n"))
    keys = parent.select(F.col(parent_key).alias("_parent_key")).distinct()
    return (
        per_key.join(keys, F.col("_fk") == F.col("_parent_key"), "left")
        .agg(
            F.coalesce(F.sum(F.when(F.col("_parent_key").isNull(), F.col("n"))), F.lit(0))
            .cast("bigint")
            .alias("orphans"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"),
        )
        .select(
            F.lit(relation).alias("relation"),
            "orphans",
            "total",
            orphan_percentage(F.col("orphans"), F.col("total")).alias("orphan_pct"),
        )
    )


def orphan_percentage(orphans: Column, total: Column) -> Column:
    return F.lit(100.0).cast("double") * orphans / F.greatest(total, F.lit(1))


def mark_orphans(
    child: DataFrame,
    foreign_key: str,
    parent: DataFrame,
    parent_key: str,
    name: str = "is_orphan",
) -> DataFrame:
    """Flag instead of filter.  ``parent_key`` must be unique in ``parent``."""
    keys = parent.select(F.col(parent_key).alias("_parent_key")).where("_parent_key is not null")
    return (
        child.join(keys, F.col(foreign_key) == F.col("_parent_key"), "left")
        .withColumn(name, F.col("_parent_key").isNull())
        .drop("_parent_key")
    )
