"""Upserted streaming tables without a merge-capable table format.

Each micro-batch writes only what it changed, in a folder named after its batch
id; readers merge those increments with the last compacted base.  Replaying a
batch overwrites its own folders and ignores its own ledger entry, so it comes
to the same result.

    delivered/batch=N   rows and new ids of batch N, where the stream's state tells ids apart
    arrived/batch=N     usable rows of batch N, one per transaction id
    unusable/batch=N    rows of batch N that lack a required value or have an unknown type
    ledger/batch=N      rows of batch N whose transaction id is new
    balances/batch=N    net change and latest event per account touched by N
    recent/batch=N      newest rows per account within N, but for those below the last base's cut
    parked/batch=N      rows that wait for their account since N, and those that stopped waiting
    released/batch=N    earlier rows applied by N, because their account is there now
    ledger_ids/upto=N, balances/upto=N, recent/upto=N, parked/upto=N
                        everything up to N, merged; recent rows with their place in the account
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwright.functions.literals import empty_frame
from tierwright.functions.values import MONEY
from tierwright.operators.dedup import keep_first, top_per_key
from tierwright.sources.folders import COMMITTED, exists, remove, versions

RECENT_PER_ACCOUNT = 50
# What a row of each type does to a balance.
BALANCE_SIGNS = {"CREDIT": 1, "REVERSAL": 1, "DEBIT": -1, "FEE": -1}

ARRIVED_SCHEMA = (
    "account_id string, transaction_id string, transaction_timestamp timestamp, "
    f"amount {MONEY}, transaction_type string, channel string, updated_at timestamp"
)
# Marks the rows that :func:`with_new_ids` adds.
NEW_ID = "_new_id"
DELIVERED_SCHEMA = f"{ARRIVED_SCHEMA}, {NEW_ID} boolean"
LEDGER_SCHEMA = f"{ARRIVED_SCHEMA}, is_orphan boolean, opening {MONEY}"
PARKED_SCHEMA = f"{ARRIVED_SCHEMA}, gone boolean"
REQUIRED = ("transaction_id", "account_id", "transaction_timestamp", "amount", "transaction_type")
BALANCE_SCHEMA = (
    "account_id string, net_change decimal(28,2), last_transaction_timestamp timestamp, "
    f"updated_at timestamp, opening {MONEY}, as_of bigint"
)
RECENT_COLUMNS = (
    "account_id",
    "transaction_id",
    "transaction_timestamp",
    "amount",
    "transaction_type",
    "channel",
    "updated_at",
)
RECENT_SCHEMA = ARRIVED_SCHEMA
RECENT_BASE_SCHEMA = f"{RECENT_SCHEMA}, place int"
ID_SCHEMA = "transaction_id string"


def _newest() -> list[Column]:
    """Newest first; the id settles equal timestamps."""
    return [F.col("transaction_timestamp").desc(), F.col("transaction_id").asc()]


def matching(large: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """Rows of ``large`` whose key occurs in ``small``."""
    return large.join(small.select(key).distinct(), key, "left_semi")


def signed_amount(signs: Mapping[str, int] = BALANCE_SIGNS) -> Column:
    """Amount with the sign of its type; rows of a type without a sign are set aside before."""
    pairs = [F.lit(p) for k, v in signs.items() for p in (k, v)]
    return F.col("amount") * F.element_at(F.create_map(*pairs), F.col("transaction_type"))


def usable(signs: Mapping[str, int] = BALANCE_SIGNS) -> Column:
    """Whether a row has all it needs; a type without a sign would change the balance by nothing, unseen."""
    complete = F.lit(True)
    for name in REQUIRED:
        complete = complete & F.col(name).isNotNull()
    return complete & F.coalesce(F.col("transaction_type").isin(*signs), F.lit(False))


def with_new_ids(rows: DataFrame, signs: Mapping[str, int] = BALANCE_SIGNS) -> DataFrame:
    """A stream's rows, and one row more for every transaction id that the stream has not had before.

    The ids are kept in the stream's state, so a batch looks up its own ids only, however many were
    applied before it.  Which of a batch's rows with one id counts is left to :meth:`StreamTables.apply`,
    which chooses it by content: the state holds nothing but ids.  Unusable rows take no id.
    """
    ids = rows.where(usable(signs)).select("transaction_id").dropDuplicates(["transaction_id"])
    return rows.withColumn(NEW_ID, F.lit(False)).unionByName(
        ids.withColumn(NEW_ID, F.lit(True)), allowMissingColumns=True
    )


@dataclass
class StreamTables:
    """Write side (:meth:`apply`, for ``foreachBatch``) and read side of the tables.

    ``accounts`` has a unique ``account_id`` and the opening ``current_balance``; it is a frame, or a
    function that gives the frame of the moment and the same one while nothing has changed.  Rows of
    unknown accounts wait, and are applied by the first batch after their account has appeared: those
    that wait are joined with the accounts only when those are another frame than in the batch before.
    An account that leaves keeps its balance, from the opening balance it had when last touched.

    Incoming rows have the columns of ``ARRIVED_SCHEMA`` except ``updated_at``.  With ``keyed`` they come
    through :func:`with_new_ids`, and no batch reads the ids applied before it; they are then known to
    the stream's checkpoint alone, which must live as long as the tables.  Otherwise each batch reads
    the ids of the ledger, one column wide.
    """

    spark: SparkSession
    root: str
    accounts: DataFrame | Callable[[], DataFrame]
    keep: int = RECENT_PER_ACCOUNT
    compact_every: int = 20
    signs: Mapping[str, int] | None = None
    updated_at: Column | None = None
    keyed: bool = False
    # the accounts that waiting rows have been held against
    _judged_by: DataFrame | None = field(default=None, init=False, repr=False)

    def _accounts(self) -> DataFrame:
        return self.accounts() if callable(self.accounts) else self.accounts

    @cached_property
    def _clock(self) -> Column:
        return self.updated_at if self.updated_at is not None else F.current_timestamp()

    @property
    def _signs(self) -> Mapping[str, int]:
        return self.signs or BALANCE_SIGNS

    # folders

    def _batch(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/batch={batch_id:012d}"

    def _base(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/upto={batch_id:012d}"

    def _parts(self, base: str, increments: str, before: int | None) -> tuple[list[str], list[str]]:
        """Paths of the newest base and of the increments after it, below ``before``."""
        limit = f"{before:012d}" if before is not None else None
        bases = versions(self.spark, f"{self.root}/{base}", "upto")
        bases = [b for b in bases if limit is None or b < limit]
        floor = bases[-1] if bases else ""
        batches = versions(self.spark, f"{self.root}/{increments}", "batch", after=floor)
        batches = [b for b in batches if limit is None or b < limit]
        return (
            [f"{self.root}/{base}/upto={floor}"] if floor else [],
            [f"{self.root}/{increments}/batch={b}" for b in batches],
        )

    def _read(self, schema: str, base: str, increments: str, before: int | None = None) -> DataFrame:
        older, newer = self._parts(base, increments, before)
        paths = older + newer
        if not paths:
            return empty_frame(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # write side

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Apply one micro-batch."""
        if f"{batch_id:012d}" in versions(self.spark, f"{self.root}/{self._first_base}", "upto"):
            # all of it was written before it was merged; only merging may be unfinished
            self.compact(batch_id)
            return
        listed = self._accounts()
        accounts = listed.select("account_id", F.col("current_balance").cast(MONEY).alias("opening"))
        arrived = self._take_in(batch, batch_id)
        fresh = arrived
        if not self.keyed:
            applied = self._read(ID_SCHEMA, "ledger_ids", "ledger", before=batch_id)
            seen = matching(applied, arrived, "transaction_id")
            fresh = arrived.join(seen, "transaction_id", "left_anti")
        known = matching(accounts, arrived, "account_id").withColumn("is_orphan", F.lit(False))
        placed = fresh.join(known, "account_id", "left").fillna(True, ["is_orphan"])
        self._write(placed, LEDGER_SCHEMA, self._batch("ledger", batch_id))
        # the written rows are the materialised result; the tables derive from them
        placed = self._stored(LEDGER_SCHEMA, "ledger", batch_id)
        released = self._release(batch_id, accounts, listed)
        waiting = placed.where("is_orphan").withColumn("gone", F.lit(False))
        self._write(
            waiting.unionByName(released.withColumn("gone", F.lit(True))), PARKED_SCHEMA, self._batch("parked", batch_id)
        )
        valid = placed.where("not is_orphan").unionByName(released)
        changes = valid.groupBy("account_id").agg(
            F.sum(signed_amount(self._signs)).alias("net_change"),
            F.max("transaction_timestamp").alias("last_transaction_timestamp"),
            F.max("updated_at").alias("updated_at"),
            F.max("opening").alias("opening"),
            F.lit(batch_id).alias("as_of"),
        )
        self._write(changes, BALANCE_SCHEMA, self._batch("balances", batch_id))
        newest = top_per_key(self._above_cut(valid, batch_id), ["account_id"], _newest(), self.keep)
        self._write(newest, RECENT_SCHEMA, self._batch("recent", batch_id))
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(batch_id)

    def _take_in(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Usable rows of the batch, one per id (per new id with ``keyed``), stored; the others are set aside.

        The batch is small next to the ledger and the accounts.  Once it is stored its size is known, so Spark
        can broadcast it and reduce those two while scanning them; a large batch is shuffled instead.
        """
        rows = batch.withColumn("updated_at", self._clock)
        if self.keyed:
            # stored first, so that the stream's state is gone through once
            self._write(rows, DELIVERED_SCHEMA, self._batch("delivered", batch_id))
            delivered = self._stored(DELIVERED_SCHEMA, "delivered", batch_id)
            rows = delivered.where(f"not {NEW_ID}").drop(NEW_ID)
        good = usable(self._signs)
        self._write(rows.where(~good), ARRIVED_SCHEMA, self._batch("unusable", batch_id))
        rows = rows.where(good)
        if self.keyed:
            rows = matching(rows, delivered.where(NEW_ID), "transaction_id")
        first = keep_first(rows, ["transaction_id"], self._arrival_order())
        self._write(first, ARRIVED_SCHEMA, self._batch("arrived", batch_id))
        return self._stored(ARRIVED_SCHEMA, "arrived", batch_id)

    def _release(self, batch_id: int, accounts: DataFrame, listed: DataFrame) -> DataFrame:
        """Rows of earlier batches whose account is known now; ``listed`` is the frame that was given.

        A batch that is applied again keeps to what it released first.
        """
        path = self._batch("released", batch_id)
        if not exists(self.spark, f"{path}/{COMMITTED}"):
            if listed is self._judged_by:
                return empty_frame(self.spark, LEDGER_SCHEMA)
            waiting = self._merge_parked(before=batch_id)
            now = waiting.join(matching(accounts, waiting, "account_id"), "account_id")
            if self.updated_at is None:
                now = now.withColumn("updated_at", F.current_timestamp())
            self._write(now.withColumn("is_orphan", F.lit(False)), LEDGER_SCHEMA, path)
        self._judged_by = listed
        return self._stored(LEDGER_SCHEMA, "released", batch_id)

    def _stored(self, schema: str, table: str, batch_id: int) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self._batch(table, batch_id))

    def _arrival_order(self) -> Sequence[str]:
        return ["transaction_timestamp", "account_id", "amount", "transaction_type", "channel"]

    def _write(self, df: DataFrame, schema: str, path: str) -> None:
        fields = T.StructType.fromDDL(schema)
        ready = df.select(*[F.col(f.name).cast(f.dataType) for f in fields])
        ready.write.mode("overwrite").parquet(path)

    def compact(self, batch_id: int) -> None:
        """Merge everything up to ``batch_id`` into new bases.

        Increments below the previous base are no longer read by anyone and go, and so do
        all but the last two bases.  Ledger and unusable rows are the record and stay.
        """
        merges = [
            ("balances", BALANCE_SCHEMA, self._merge_changes),
            ("recent", RECENT_BASE_SCHEMA, self._merge_recent),
            ("parked", PARKED_SCHEMA, self._merge_parked),
        ]
        if not self.keyed:
            merges.insert(0, ("ledger_ids", ID_SCHEMA, self._merge_ids))
        for table, schema, merge in merges:
            # a base left by an earlier try of this batch is complete, and is an
            # input of the merge below, so it must not be overwritten
            if f"{batch_id:012d}" not in versions(self.spark, f"{self.root}/{table}", "upto"):
                self._write(merge(before=batch_id + 1), schema, self._base(table, batch_id))
        bases = {table: versions(self.spark, f"{self.root}/{table}", "upto") for table, _, _ in merges}
        increments = {"arrived": self._first_base, "delivered": self._first_base, "released": "parked"}
        increments |= {table: table for table in ("balances", "recent", "parked")}
        for table, base in increments.items():
            if len(bases[base]) > 1:
                self._expire(table, "batch", bases[base][-2])
        for table, known in bases.items():
            if len(known) > 2:
                self._expire(table, "upto", known[-3])

    @property
    def _first_base(self) -> str:
        """The base that :meth:`compact` writes first."""
        return "balances" if self.keyed else "ledger_ids"

    def _expire(self, table: str, key: str, last: str) -> None:
        """Remove the folders up to and including ``last``."""
        for version in versions(self.spark, f"{self.root}/{table}", key):
            if version <= last:
                remove(self.spark, f"{self.root}/{table}/{key}={version}")

    # read side

    def _merge_ids(self, before: int | None = None) -> DataFrame:
        return self._read(ID_SCHEMA, "ledger_ids", "ledger", before)

    def _merge_changes(self, before: int | None = None) -> DataFrame:
        parts = self._read(BALANCE_SCHEMA, "balances", "balances", before)
        return parts.groupBy("account_id").agg(
            F.sum("net_change").cast("decimal(28,2)").alias("net_change"),
            F.max("last_transaction_timestamp").alias("last_transaction_timestamp"),
            F.max("updated_at").alias("updated_at"),
            F.expr("max_by(opening, if(opening is null, null, as_of))").alias("opening"),
            F.max("as_of").alias("as_of"),
        )

    def _merge_parked(self, before: int | None = None) -> DataFrame:
        parts = self._read(PARKED_SCHEMA, "parked", "parked", before)
        return parts.where("not gone").join(parts.where("gone").select("transaction_id"), "transaction_id", "left_anti")

    def _recent_parts(self, before: int | None = None) -> tuple[DataFrame, DataFrame | None]:
        """The last base of recent rows, and the increments after it, if any."""
        older, newer = self._parts("recent", "recent", before)
        base, added = empty_frame(self.spark, RECENT_BASE_SCHEMA), None
        if older:
            base = self.spark.read.schema(RECENT_BASE_SCHEMA).parquet(*older)
        if newer:
            added = self.spark.read.schema(RECENT_SCHEMA).parquet(*newer)
        return base, added

    def _above_cut(self, rows: DataFrame, before: int) -> DataFrame:
        """``rows`` without those that ``keep`` rows of the last base precede.

        An account's cut is its row at place ``keep``: one row of the base, found by a pushed filter.  Rows below
        it can never be shown again, as a base's rows give way to newer ones only.  They go before the rows
        are ranked.
        """
        base, _ = self._recent_parts(before)
        cuts = base.where(F.col("place") == self.keep).select(
            "account_id", F.col("transaction_timestamp").alias("_cut_at"), F.col("transaction_id").alias("_cut_id")
        )
        newer = "_cut_at IS NULL OR transaction_timestamp > _cut_at"
        tied = "transaction_timestamp = _cut_at AND transaction_id < _cut_id"
        held = rows.join(matching(cuts, rows, "account_id"), "account_id", "left")
        return held.where(f"{newer} OR ({tied})").drop("_cut_at", "_cut_id")

    def _merge_recent(self, before: int | None = None) -> DataFrame:
        """The newest ``keep`` rows of each account with their place.

        Only accounts with rows since the base are ranked anew; those of the others are taken over as they lie.
        """
        base, added = self._recent_parts(before)
        # a base of an earlier version has no places, and its rows have been cut already
        base = base.where(f"coalesce(place, 0) <= {int(self.keep)}")
        if added is None:
            return base
        touched = added.select("account_id").distinct()
        held = base.join(touched, "account_id", "left_semi").drop("place").unionByName(added)
        place = F.row_number().over(W.partitionBy("account_id").orderBy(*_newest()))
        ranked = held.withColumn("place", place).where(F.col("place") <= self.keep)
        return base.join(touched, "account_id", "left_anti").unionByName(ranked)

    def current_balances(self) -> DataFrame:
        """One row per account that has had an event, those that have left the accounts included."""
        listed = self._accounts().select("account_id", F.col("current_balance").alias("listed"))
        opening = F.coalesce("listed", "opening")
        return (
            self._merge_changes()
            .join(listed, "account_id", "left")
            .select(
                "account_id",
                (opening + F.col("net_change")).cast(MONEY).alias("current_balance"),
                "last_transaction_timestamp",
                "updated_at",
            )
        )

    def recent_transactions(self) -> DataFrame:
        """The newest ``keep`` rows per account."""
        return self._merge_recent().select(*RECENT_COLUMNS)

    def _all_batches(self, table: str, schema: str) -> DataFrame:
        done = versions(self.spark, f"{self.root}/{table}", "batch")
        if not done:
            return empty_frame(self.spark, schema)
        paths = [f"{self.root}/{table}/batch={b}" for b in done]
        return self.spark.read.schema(schema).parquet(*paths)

    def ledger(self) -> DataFrame:
        """Every identified row that arrived, once; ``is_orphan`` is whether its account was unknown then."""
        return self._all_batches("ledger", LEDGER_SCHEMA)

    def quarantined(self) -> DataFrame:
        """Rows that changed no table, or not yet, with the reason."""
        orphaned = self._merge_parked().drop("gone").select(*RECENT_COLUMNS)
        unusable = self._all_batches("unusable", ARRIVED_SCHEMA)
        complete = F.lit(True)
        for name in REQUIRED:
            complete = complete & F.col(name).isNotNull()
        reason = F.when(complete, F.lit("UNKNOWN_TYPE")).otherwise(F.lit("NULL_REQUIRED"))
        return orphaned.withColumn("reason", F.lit("ORPHANED_ACCOUNT")).unionByName(
            unusable.withColumn("reason", reason)
        )
