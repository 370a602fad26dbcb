"""Exact deduplication as a stateful stream.

DataFrame and SQL functions only.  A stream of the documents' files keeps one entry per text digest in a
disk-backed state store, without expiry: the smallest stable identifier, where its text is found, and how
often the digest arrived.  Texts are never kept in the state; where a digest was hit, full texts are compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwright.session import work_path

from .common import store

BLANK_RUN = r"[\x20\x09-\x0D]+"
# A digest that many rows share meets its comparison in this many tasks.
SALTS = 16
# Input bytes for one state store, whose entries take some tenth of them; each has fixed costs of its own.
BYTES_PER_STORE = 4 << 30
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # a batch uploads what it changed, not the whole state
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # batches are few and large: a task gives its store's local disk and memory back when it ends
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    # memory of all stores of an executor together
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def sha256_of(body: Column) -> Column:
    return F.sha2(body, 256)


def _pattern(path: str) -> str:
    """``path`` as a pattern: the stream then takes a single file as well as a folder."""
    return f"{path[:-1]}[{path[-1]}]"


def _located(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """doc_id, body, digest, and the locator of each row: its file and its number there."""
    body = F.regexp_replace(F.coalesce("text", F.lit("")), BLANK_RUN, " ")
    located = docs.select(
        "doc_id",
        body.alias("body"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    return located.withColumn("digest", digest(F.col("body")))


def _keeper() -> Column:
    """Smallest doc_id first, null last; equal ids by place."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")


def _stores(spark: SparkSession, path: str) -> int:
    """State stores for the files under ``path``: a stream keeps the number that it starts with."""
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    return max(spark.sparkContext.defaultParallelism, -(-size // BYTES_PER_STORE))


def follow(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    digest: Callable[[Column], Column] = sha256_of,
    files_per_batch: int | None = None,
    stores: int | None = None,
) -> DataFrame:
    """Take in the files under ``path`` that ``checkpoint`` has not seen; the state: digest, keep, copies.

    Calling it again after more files have arrived reads those alone.  Rows are aggregated within each task
    before they are shuffled, so a text that many rows hold is a row a task.  A batch that fails is run again
    by the stream from its last committed state.  ``stores`` is the number of parts of the state, by default
    as the files' bytes ask; plan for the corpus to come, as it holds as long as the checkpoint.
    """
    session = spark.newSession()
    parts = str(stores or _stores(spark, path))
    for key, value in {**STREAM_SETTINGS, "spark.sql.shuffle.partitions": parts}.items():
        session.conf.set(key, value)
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    reader = session.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    arriving = _located(reader.parquet(_pattern(path)), digest)
    state = arriving.groupBy("digest").agg(F.min(_keeper()).alias("keep"), F.count(F.lit(1)).alias("copies"))
    writer = state.writeStream.format("noop").outputMode("update")
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    held = spark.read.format("statestore").load(checkpoint)
    return held.select("key.digest", F.col("value.min").alias("keep"), F.col("value.count").alias("copies"))


def digests_of_unequal_texts(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Digests that stand for more than one text, from the full texts of all digests that were hit.

    Every task sends at most the least and the greatest text of a digest; if those two are equal, all are.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    hit = state.where("copies > 1").select("digest", salts.alias("salt"))
    dealt = rows.select("digest", "body", F.pmod(F.xxhash64("file", "row"), F.lit(SALTS)).cast("int").alias("salt"))
    texts = dealt.join(hit, ["digest", "salt"]).groupBy("digest").agg(
        F.min("body").alias("least"), F.max("body").alias("greatest")
    )
    return texts.where("least <> greatest").select("digest")


def exact_dedup(
    spark: SparkSession,
    path: str,
    checkpoint: str | None = None,
    digest: Callable[[Column], Column] = sha256_of,
    files_per_batch: int | None = None,
) -> DataFrame:
    """One row per row under ``path``: doc_id, keep_id, group_size, kept, text_sha256, keep_file, keep_row.

    Texts are equal when they are after each run of blanks is replaced by one space; a null text is empty.
    Of equal texts the row with the smallest doc_id stays; rows with a null doc_id come last, and of rows with
    the same id the first by file and place stays, so exactly one row of a group is kept.  ``keep_file`` and
    ``keep_row`` locate its text.  Other columns are not read, an empty table gives no rows.
    """
    found = spark.read.parquet(path)
    rows = _located(found, digest)
    if found.isEmpty():
        # the stream would leave no state to read
        state = rows.select("digest", _keeper().alias("keep"), F.lit(1).cast("long").alias("copies")).where("false")
    else:
        state = follow(spark, path, checkpoint or work_path(spark, "llm-dedup"), digest, files_per_batch)
    unequal = store(digests_of_unequal_texts(rows, state), "dedup-unequal")
    narrow = rows.select("digest", "doc_id", "file", "row", sha256_of(F.col("body")).alias("text_sha256"))
    placed = narrow.join(state, "digest")
    if not unequal.isEmpty():
        # such digests are told apart by their texts
        apart = rows.join(unequal, "digest", "left_semi")
        groups = apart.groupBy("digest", "body").agg(F.min(_keeper()).alias("keep"), F.count(F.lit(1)).alias("copies"))
        columns = ["digest", "doc_id", "file", "row", sha256_of(F.col("body")).alias("text_sha256"), "keep", "copies"]
        placed = placed.join(unequal, "digest", "left_anti").unionByName(
            apart.join(groups, ["digest", "body"]).select(*columns)
        )
    here = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
    return placed.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        here.alias("kept"),
        "text_sha256",
        F.col("keep.file").alias("keep_file"),
        F.col("keep.row").alias("keep_row"),
    )


def op13_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP13_SQL = r"""
WITH normal AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM normal WINDOW w AS (PARTITION BY text_sha256)
"""
