"""Table writers.

A layer table lives in ``<root>/<layer>/<table>/batch=<id>``.  A write is checked
against its contract and then published with a marker file, so a reader never
sees an off-contract or half-written batch, and nothing has to be renamed.  A run
publishes all its tables with one marker, after its last check.
Re-running a batch overwrites only its own folder, schema included.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwright.operators.contracts import (
    Contract,
    ContractError,
    breaching_rows,
    enforce,
    enforce_unique,
    structural_violations,
)
from tierwright.session import dropping_shuffles
from tierwright.sources.files import scan_table
from tierwright.sources.folders import mark, remove, versions

PUBLISHED = "_PUBLISHED"
# Folder of the markers that publish all tables of a batch at once.
BATCHES = "_batches"


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema``, in its order, cast to its types.

    A zoned timestamp cast to a zone-less one keeps its UTC reading.
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> str:
    """Write ``df``; an empty frame still leaves a table with its schema.

    Partitioned writes are rebalanced on the partition columns first: small
    values share files, and a value holding much of the data is split over
    several tasks.  ``path`` must not be a table that ``df`` reads.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.format(fmt).mode(mode)
    if fmt == "parquet":
        # digests and ids shrink by a third more than with the default codec
        writer = writer.option("compression", "zstd")
    if mode == "overwrite" and fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    # nothing needs the shuffle files behind a table once it is written
    with dropping_shuffles(df.sparkSession):
        writer.save(path)
    return path


def write_quarantine(df: DataFrame, path: str) -> str:
    """Diverted rows of one batch under ``source=…/reason=…`` folders; writing it again replaces them."""
    return write_table(df, path, partition_by=("source", "reason"))


def write_report(report: DataFrame, path: str) -> str:
    """A report as one JSON file; a report has one row per rule."""
    report.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_object(totals: DataFrame, path: str) -> str:
    """A frame of one row, nested ones included, as one JSON object in one file."""
    totals.limit(1).coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


@dataclass(frozen=True)
class Written:
    path: str
    rows: int


@dataclass
class LayerStore:
    spark: SparkSession
    root: str
    batch_id: str
    fmt: str = "parquet"
    # schemas of tables written here, so that reading them back opens no file
    schemas: dict[tuple[str, str], T.StructType] = field(default_factory=dict)

    def path(self, layer: str, table: str, batch_id: str | None = None) -> str:
        return f"{self.root}/{layer}/{table}/batch={batch_id or self.batch_id}"

    def read(
        self,
        layer: str,
        table: str,
        columns: Sequence[str] | None = None,
        batch_id: str | None = None,
    ) -> DataFrame:
        schema = self.schemas.get((layer, table)) if batch_id in (None, self.batch_id) else None
        return scan_table(self.spark, self.path(layer, table, batch_id), columns, self.fmt, schema)

    def latest(self, layer: str, table: str, columns: Sequence[str] | None = None) -> DataFrame:
        """The newest published batch; batch ids sort by time."""
        folder = f"{self.root}/{layer}/{table}"
        written = set(versions(self.spark, folder, "batch"))
        whole = versions(self.spark, f"{self.root}/{BATCHES}", "batch", PUBLISHED)
        alone = versions(self.spark, folder, "batch", PUBLISHED)
        done = sorted({*alone, *(b for b in whole if b in written)})
        if not done:
            raise FileNotFoundError(f"no published batch of {layer}/{table} under {self.root}")
        return self.read(layer, table, columns, done[-1])

    def _batch_folder(self) -> str:
        return f"{self.root}/{BATCHES}/batch={self.batch_id}"

    def publish_batch(self) -> None:
        """Make all tables of this batch visible with one marker."""
        mark(self.spark, f"{self._batch_folder()}/{PUBLISHED}")

    def withdraw_batch(self) -> None:
        """Hide a batch that is about to be written again."""
        remove(self.spark, self._batch_folder())

    def write(
        self,
        df: DataFrame | Sequence[DataFrame],
        layer: str,
        table: str,
        contract: Contract | None = None,
        partition_by: Sequence[str] = (),
        guaranteed: Sequence[str] = (),
        publish: bool = True,
        dense: str | None = None,
    ) -> Written:
        """Write, check, publish; without ``publish`` it waits for :meth:`publish_batch`.

        Rows, and rows breaking a null or domain rule, are counted while the write
        runs, so the plan is executed once; only unique columns are read back.
        Which rules were broken is looked up when there is something to report.

        Proving a column unique shuffles all its values.  ``guaranteed`` names
        columns that the plan of ``df`` already makes unique (a deduplication key, a
        surrogate key), for which that would only repeat the work.  ``dense`` names a
        surrogate key that must go from 1 to the number of rows, seen while writing.  Several frames of one schema
        are written one after the other, so that only one's shuffle files take room at a time.
        """
        path = self.path(layer, table)
        parts = [df] if isinstance(df, DataFrame) else list(df)
        df = parts[0]
        if contract:
            broken = structural_violations(df.schema, contract)
            if broken:
                raise ContractError(contract.name, broken)
        metrics = [F.count(F.lit(1)).alias("rows")]
        if contract:
            metrics.append(breaching_rows(contract, df.columns).alias("breaches"))
        if dense:
            metrics += [F.min(dense).alias("lowest"), F.max(dense).alias("highest")]
        seen = []
        for part in parts:
            observed = Observation()
            mode = "append" if seen else "overwrite"
            write_table(part.observe(observed, *metrics), path, mode, partition_by, self.fmt)
            seen.append(observed.get)
        if not partition_by:
            # partition columns move to the end and are typed by their folder names
            self.schemas[(layer, table)] = df.schema
        rows = sum(counts.get("rows") or 0 for counts in seen)
        filled = [counts for counts in seen if counts.get("rows")]
        if dense and rows and (min(c["lowest"] for c in filled), max(c["highest"] for c in filled)) != (1, rows):
            raise ContractError(contract.name if contract else table, [(dense, "dense", 1)])
        if contract:
            stored = self.read(layer, table)
            if any(counts.get("breaches") for counts in seen):
                enforce(stored, contract)
            enforce_unique(stored, contract, skip=guaranteed)
        if publish:
            mark(self.spark, f"{path}/{PUBLISHED}")
        return Written(path, rows)
