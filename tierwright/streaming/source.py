"""Micro-batches of JSON-lines files."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tierwright.functions.domains import DATE_FORMATS
from tierwright.functions.values import combine_timestamp, money, parse_date
from tierwright.sources.files import TRANSACTION_JSON

# A stream's state in RocksDB: on local disk rather than in memory, and a batch saves only what it changed.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
KEPT_SETTINGS = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.shuffle.partitions")

# Fixed values
POLL_SECONDS = 10
QUIET_SECONDS = 60


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TRANSACTION_JSON,
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def state_session(spark: SparkSession, stores: int | None = None) -> SparkSession:
    """A session whose streams keep their state in RocksDB; other sessions' settings stay as they are.

    A stream keeps the number of ``stores`` it was started with (by default the shuffle partitions), so plan
    it for the keys to come.
    """
    session = spark.newSession()
    settings = {key: spark.conf.get(key) for key in KEPT_SETTINGS} | STATE_SETTINGS
    if stores:
        settings["spark.sql.shuffle.partitions"] = str(stores)
    for key, value in settings.items():
        session.conf.set(key, value)
    return session


def ledger_rows(
    raw: DataFrame, formats: Sequence[str] = DATE_FORMATS, keep: Sequence[str] = ()
) -> DataFrame:
    """Raw transactions as rows for :class:`tierwright.streaming.tables.StreamTables`.

    A value that cannot be parsed becomes NULL, which keeps the row out of the
    tables but not out of the quarantine.  The columns ``keep`` go along.
    """
    event_time = combine_timestamp("parsed_date", "transaction_time").cast("timestamp")
    return raw.withColumn("parsed_date", parse_date("transaction_date", formats)).select(
        "account_id",
        "transaction_id",
        event_time.alias("transaction_timestamp"),
        money("amount", strict=False).alias("amount"),
        "transaction_type",
        "channel",
        *keep,
    )


def start_polling(
    writer: DataStreamWriter, checkpoint: str, poll_seconds: int = POLL_SECONDS
) -> StreamingQuery:
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{poll_seconds} seconds")
        .start()
    )


def run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything present, in as many micro-batches as the source makes."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def stop_when_quiet(query: StreamingQuery, quiet_seconds: float = QUIET_SECONDS) -> None:
    """Wait until no rows have arrived for ``quiet_seconds``, then stop the query."""
    last_batch, quiet_since = None, time.monotonic()
    while query.isActive:
        progress = query.lastProgress
        if progress and progress["numInputRows"] > 0 and progress["batchId"] != last_batch:
            last_batch, quiet_since = progress["batchId"], time.monotonic()
        if query.status["isTriggerActive"] and query.status["isDataAvailable"]:
            quiet_since = time.monotonic()
        if time.monotonic() - quiet_since >= quiet_seconds:
            query.stop()
            return
        query.awaitTermination(min(1.0, max(quiet_seconds / 5, 0.1)))
    if query.exception():
        raise query.exception()
