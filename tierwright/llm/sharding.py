"""Contiguous shards of nearly equal bytes, cut from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, running_totals


def shard_documents(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document with its shard and its place there.

    A document's size is the UTF-8 bytes of its text (none for null) plus 1.  Documents are ordered by id
    (null first, then size and checksum, so ties and repeated rows have a place of their own); the prefix
    sums of sizes come from per-partition totals, and a document goes to the shard whose share of all bytes
    holds its middle byte.  So shards are contiguous in the order and differ from the equal target by less
    than the two documents on their borders.  A shard can be empty when there are fewer documents than
    shards or one document is larger than a target.  An empty table gives no rows.  Only ids, sizes and
    checksums are shuffled, never texts; extra columns of ``docs`` are not read.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit(""))).alias("text_crc32"),
        F.lit(1).cast("long").alias("one"),
    )
    placed = running_totals(sized, ("doc_id", "size", "text_crc32"), ("size", "one"), label="shards").withColumn(
        "shard", F.expr(f"cast(((2 * size_before + size) * {shards}L) div (2 * size_total) as int)")
    )
    first = placed.groupBy("shard").agg(F.min("one_before").alias("first"))
    return placed.join(first, "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("one_before") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"))
