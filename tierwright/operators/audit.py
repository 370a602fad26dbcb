"""Lineage columns added to every raw row."""

from __future__ import annotations

import datetime as dt
import secrets
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwright.functions.values import row_hash

AUDIT_COLUMNS = ("_ingested_at", "_source_system", "_batch_id", "_source_row_hash")


def new_batch_id(now: dt.datetime | None = None) -> str:
    """Sortable run id: UTC second plus six random hex digits."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return f"{now.astimezone(dt.timezone.utc):%Y%m%dT%H%M%SZ}-{secrets.token_hex(3)}"


def with_audit(
    df: DataFrame,
    source_columns: Sequence[str],
    source_system: str,
    batch_id: str,
    ingested_at: dt.datetime,
    algorithm: str = "xxhash64",
) -> DataFrame:
    """One narrow projection; the hash covers the source columns only."""
    stamp = ingested_at.astimezone(dt.timezone.utc).isoformat()
    return df.withColumns(
        {
            "_ingested_at": F.lit(stamp).cast("timestamp"),
            "_source_system": F.lit(source_system),
            "_batch_id": F.lit(batch_id),
            "_source_row_hash": row_hash(source_columns, algorithm),
        }
    )
