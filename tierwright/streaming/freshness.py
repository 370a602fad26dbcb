"""How quickly events reached the streaming tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds in seconds of full and partial credit
FULL_SECONDS = 300
PARTIAL_SECONDS = 600


def latency_seconds(updated_at: Column | str, event_time: Column | str) -> Column:
    updated = F.col(updated_at) if isinstance(updated_at, str) else updated_at
    event = F.col(event_time) if isinstance(event_time, str) else event_time
    return updated.cast("timestamp").cast("double") - event.cast("timestamp").cast("double")


def freshness_tier(seconds: Column) -> Column:
    return (
        F.when(seconds <= FULL_SECONDS, "full")
        .when(seconds <= PARTIAL_SECONDS, "partial")
        .otherwise("none")
    )


def freshness_report(
    rows: DataFrame, event_time: str = "transaction_timestamp", updated_at: str = "updated_at"
) -> DataFrame:
    """Rows per tier."""
    tier = freshness_tier(latency_seconds(updated_at, event_time))
    return rows.groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("rows"))
