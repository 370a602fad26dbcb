"""Batch readers.  Every schema is explicit: nothing is inferred from data."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRANSACTION_JSON = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("transaction_date", T.StringType()),
        T.StructField("transaction_time", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        # a key missing from every line still becomes a typed NULL column
        T.StructField("merchant_subcategory", T.StringType()),
        # text keeps the digits of numbers and of quoted numbers alike
        T.StructField("amount", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField(
            "location",
            T.StructType(
                [
                    T.StructField("province", T.StringType()),
                    T.StructField("city", T.StringType()),
                    T.StructField("coordinates", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("device_id", T.StringType()),
                    T.StructField("session_id", T.StringType()),
                    T.StructField("retry_flag", T.BooleanType()),
                ]
            ),
        ),
    ]
)


class EmptySource(RuntimeError):
    """A source that must have rows has none."""


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV with a header, every column as text.

    ``enforceSchema=False`` checks the header against the expected names, and
    ``FAILFAST`` stops on a malformed line instead of nulling it.
    """
    return (
        spark.read.schema(text_schema(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


# Distinct headers of one source; each is a case of the parsing expression.
MOST_HEADERS = 200


class TooManyHeaders(RuntimeError):
    """The files of a source have more different headers than any source has versions."""


def _csv_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    return lines.where("trim(value) <> ''")


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, header): the first line of every file.  One map-side aggregate over the lines."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("begins"),
        F.monotonically_increasing_id().alias("at"),
    )
    # the part of a file that begins at 0 is read by one task, in order
    firsts = lines.where("begins = 0 AND trim(value) <> ''")
    return firsts.groupBy("source_file").agg(F.min_by("value", "at").alias("header"))


def _header_names(header: str) -> list[str]:
    return next(csv.reader([header.lstrip("\ufeff")]))


def unknown_csv_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> list[str]:
    """Columns in any file's header that are not among ``columns``."""
    return sorted({n for h in _distinct_headers(csv_headers(spark, path)) for n in _header_names(h)} - set(columns))


def _distinct_headers(headers: DataFrame) -> list[str]:
    rows = headers.select("header").distinct().limit(MOST_HEADERS + 1).collect()
    if len(rows) > MOST_HEADERS:
        raise TooManyHeaders(f"more than {MOST_HEADERS} different headers")
    return sorted(r["header"] for r in rows)


def read_csv_drifting(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV files each read by its own header: ``columns`` as text, unknown_columns, malformed, source_file.

    A file may have further columns, fewer or another order: absent ones are NULL, others go to the map
    ``unknown_columns`` (NULL where a row has none).  A line that does not have its header's number of fields, or
    whose quotes do not close, is kept whole in ``malformed``, its columns NULL.  A record is one line; empty lines
    and repeated headers are no rows.
    """
    headers = csv_headers(spark, path)
    kinds = _distinct_headers(headers)
    lines = _csv_lines(spark, path).join(headers, "source_file").where("value <> header")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line"}
    parsed = None
    for header in kinds:
        names = _header_names(header)
        fields = [T.StructField(f"f{i}", T.StringType()) for i in range(len(names))]
        schema = T.StructType([*fields, T.StructField("_line", T.StringType())])
        r = F.from_csv("value", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
        # of columns with one name the first counts
        place = {n: f"f{i}" for i, n in reversed(list(enumerate(names)))}
        known = [(r[place[c]] if c in place else F.lit(None).cast("string")).alias(c) for c in columns]
        extra = [p for n in place if n not in columns for p in (F.lit(n), r[place[n]])]
        unknown = F.create_map(*extra) if extra else F.lit(None).cast("map<string,string>")
        if extra:
            unknown = F.map_filter(unknown, lambda _, v: v.isNotNull())
            unknown = F.when(F.size(unknown) > 0, unknown)
        row = F.struct(*known, unknown.alias("unknown_columns"), r["_line"].alias("malformed"))
        parsed = F.when(F.col("header") == header, row) if parsed is None else parsed.when(F.col("header") == header, row)
    if parsed is None:
        text, extra = T.StringType(), T.MapType(T.StringType(), T.StringType())
        empty = text_schema(columns).add("unknown_columns", extra).add("malformed", text).add("source_file", text)
        return spark.createDataFrame([], empty)
    rows = lines.select(parsed.alias("r"), "source_file", "value").select("r.*", "source_file", "value")
    # the parser takes an open quote for a value up to the line's end
    quotes = F.regexp_count(F.regexp_replace("value", r"\\.", ""), F.lit('"'))
    rows = rows.withColumn("malformed", F.when(quotes % 2 == 1, F.col("value")).otherwise(F.col("malformed")))
    whole = F.col("malformed").isNull()
    return rows.select(
        *[F.when(whole, F.col(c)).alias(c) for c in columns],
        F.when(whole, F.col("unknown_columns")).alias("unknown_columns"),
        "malformed",
        "source_file",
    )


def read_json_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TRANSACTION_JSON,
    corrupt_column: str | None = None,
) -> DataFrame:
    """JSON lines, split across tasks by Spark.

    A malformed line fails the read, or lands in ``corrupt_column`` when one is
    named, so that it can be quarantined.
    """
    reader = spark.read
    if corrupt_column:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option(
            "columnNameOfCorruptRecord", corrupt_column
        )
    else:
        reader = reader.option("mode", "FAILFAST")
    return reader.schema(schema).json(path)


def read_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Undecoded lines, for checks on the JSON text itself."""
    return spark.read.text(path)


def scan_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """A stored table, reading only ``columns``; a known schema saves a look at the files."""
    reader = spark.read.format(fmt)
    table = (reader.schema(schema) if schema else reader).load(path)
    return table.select(*columns) if columns else table


def spread(df: DataFrame) -> DataFrame:
    """Use every core on an input with fewer splits than cores.

    A file with a single row group or a compressed text file is one split.  Large
    inputs have many, and are returned as they are; so whatever a hot value of the
    first column holds here, it is less than a few splits.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, df.columns[0]) if df.rdd.getNumPartitions() < cores else df


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add each absent column as a typed NULL; present columns are left alone."""
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(absent) if absent else df


def require_rows(df: DataFrame, label: str) -> DataFrame:
    """Fail on an empty source; looks at a single row only."""
    if df.isEmpty():
        raise EmptySource(f"source is empty: {label}")
    return df
