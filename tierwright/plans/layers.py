"""The whole run: raw -> typed -> star -> checks, each table written once."""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from tierwright.functions.literals import small_frame
from tierwright.operators.audit import new_batch_id, with_audit
from tierwright.operators.contracts import Contract, enforce_unique
from tierwright.operators.dedup import together
from tierwright.operators.drift import require_known_keys
from tierwright.operators.flatten import flatten_structs
from tierwright.operators.integrity import count_orphans
from tierwright.operators.keys import REPEATED_KEY
from tierwright.operators.reconcile import require_conserved, within_tolerance
from tierwright.plans import contracts as C
from tierwright.plans.checks import require_star_checks
from tierwright.plans.settings import Settings
from tierwright.plans.star import (
    dim_accounts,
    dim_customers,
    link_transactions,
    numbered_transactions,
)
from tierwright.plans.typed import typed_accounts, typed_customers, typed_transactions
from tierwright.session import run_together
from tierwright.sinks.tables import LayerStore
from tierwright.sources.files import (
    TRANSACTION_JSON,
    EmptySource,
    read_csv_text,
    read_json_lines,
    read_raw_lines,
)

logger = logging.getLogger("tierwright")

# How each source names itself in the audit columns
SOURCE_SYSTEMS = {
    "customers": "bank_crm",
    "accounts": "fintech_accounts",
    "transactions": "fintech_events",
}

# Star table: the typed table whose natural key is numbered for it, and that table's contract.
NUMBERED = {
    "dim_customers": ("customers", C.TYPED_CUSTOMERS),
    "dim_accounts": ("accounts", C.TYPED_ACCOUNTS),
    "fact_transactions": ("transactions", C.TYPED_TRANSACTIONS),
}


@dataclass(frozen=True)
class Inputs:
    customers: str
    accounts: str
    transactions: str


@dataclass
class RunLog:
    """Rows in and out of every written table, and seconds per step."""

    batch_id: str
    tables: list[tuple[str, str, int, int]] = field(default_factory=list)
    seconds: dict[str, float] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)

    def warn(self, text: str) -> None:
        logger.warning(text)
        self.warnings.append(text)

    def as_frame(self, spark: SparkSession) -> DataFrame:
        schema = "layer string, table_name string, rows_in bigint, rows_out bigint"
        return small_frame(spark, self.tables, schema)

    @contextmanager
    def timed(self, step: str):
        started = time.monotonic()
        logger.info("step=%s start", step)
        yield
        self.seconds[step] = round(time.monotonic() - started, 3)
        logger.info("step=%s done seconds=%.1f", step, self.seconds[step])


def raw_customers(df: DataFrame, **audit) -> DataFrame:
    return with_audit(df, C.CUSTOMER_COLUMNS, SOURCE_SYSTEMS["customers"], **audit)


def raw_accounts(df: DataFrame, **audit) -> DataFrame:
    return with_audit(df, C.ACCOUNT_COLUMNS, SOURCE_SYSTEMS["accounts"], **audit)


def raw_transactions(df: DataFrame, **audit) -> DataFrame:
    """``df`` as read from JSON lines: nested objects become flat columns."""
    flat = flatten_structs(df)
    return with_audit(flat, C.TRANSACTION_COLUMNS, SOURCE_SYSTEMS["transactions"], **audit)


@dataclass
class Run:
    """One batch being built: where it goes, and what every step shares."""

    spark: SparkSession
    inputs: Inputs
    store: LayerStore
    log: RunLog
    audit: dict
    run_date: dt.date | str | None = None
    recheck_unique: bool = False
    settings: Settings = field(default_factory=Settings)

    @classmethod
    def begin(
        cls,
        spark: SparkSession,
        inputs: Inputs,
        root: str,
        run_date: dt.date | str | None = None,
        batch_id: str | None = None,
        ingested_at: dt.datetime | None = None,
        hash_algorithm: str = "xxhash64",
        recheck_unique: bool = False,
        settings: Settings | None = None,
    ) -> Run:
        batch_id = batch_id or new_batch_id()
        audit = {
            "batch_id": batch_id,
            "ingested_at": ingested_at or dt.datetime.now(dt.timezone.utc),
            "algorithm": hash_algorithm,
        }
        store = LayerStore(spark, root, batch_id)
        store.withdraw_batch()
        return cls(spark, inputs, store, RunLog(batch_id), audit, run_date, recheck_unique, settings or Settings())

    def step(
        self,
        layer: str,
        table: str,
        df: DataFrame | Sequence[DataFrame],
        contract: Contract,
        rows_in: int | None = None,
    ) -> int:
        """Write a table; the number of rows it got.

        Every unique column of a run is a key that is numbered for the star, or such a number, and numbering proves
        both unique (:func:`tierwright.operators.keys.dense_keys`).  A dimension's numbers must also end at its
        number of rows.  The fact table's join repeats no row, as the dimensions' keys are unique, and loses
        none, as its rows are counted.
        """
        with self.log.timed(f"{layer}.{table}"):
            unique = [] if self.recheck_unique else [c.name for c in contract.columns if c.unique]
            dense = contract.names[0] if table.startswith("dim_") else None
            try:
                rows = self.store.write(df, layer, table, contract, guaranteed=unique, publish=False, dense=dense).rows
            except PySparkException as error:
                if layer == "star" and REPEATED_KEY in str(error):
                    # says how many rows share their key
                    source, typed = NUMBERED[table]
                    enforce_unique(self.store.read("typed", source), typed)
                raise
        self.log.tables.append((layer, table, rows if rows_in is None else rows_in, rows))
        return rows

    def raw_customers(self, contract: Contract = C.RAW_CUSTOMERS) -> int:
        source = read_csv_text(self.spark, self.inputs.customers, C.CUSTOMER_COLUMNS)
        return self.step("raw", "customers", raw_customers(source, **self.audit), contract)

    def raw_accounts(self, contract: Contract = C.RAW_ACCOUNTS) -> int:
        source = read_csv_text(self.spark, self.inputs.accounts, C.ACCOUNT_COLUMNS)
        return self.step("raw", "accounts", raw_accounts(source, **self.audit), contract)

    def typed(self, table: str, df: DataFrame, contract: Contract, rows_in: int) -> int:
        return self.step("typed", table, df.select(*contract.names), contract, rows_in)

    def customer_dimension(self, rows: int) -> int:
        typed = self.store.read("typed", "customers")
        dim = dim_customers(typed, self.run_date, self.settings.age_bands, rows=rows)
        return self.step("star", "dim_customers", dim, C.DIM_CUSTOMERS, rows)

    def account_dimension(self, rows: int) -> int:
        dim = dim_accounts(self.store.read("typed", "accounts"), rows=rows)
        return self.step("star", "dim_accounts", dim, C.DIM_ACCOUNTS, rows)

    def typed_customers(self, raw: DataFrame) -> DataFrame:
        raw = together(raw, ["customer_id"])
        return typed_customers(raw, self.settings.date_formats, self.settings.province_aliases)

    def typed_accounts(self, raw: DataFrame) -> DataFrame:
        return typed_accounts(together(raw, ["account_id"]), self.settings.date_formats)

    def typed_transactions(self, raw: DataFrame) -> DataFrame:
        s = self.settings
        raw = together(raw, ["transaction_id"])
        return typed_transactions(
            raw, s.date_formats, s.currency_codes, s.currency, province_aliases=s.province_aliases
        )

    def customers_flow(self) -> int:
        n = self.raw_customers()
        typed = self.typed_customers(self.store.read("raw", "customers"))
        n = self.typed("customers", typed, C.TYPED_CUSTOMERS, n)
        return self.customer_dimension(n)

    def _compare_totals(self, found: dict[str, list]) -> None:
        """Warn of counts per transaction type or province outside the tolerance of the expected totals."""
        s = self.settings
        types = [(r["transaction_type"], r["record_count"]) for r in found["volume_by_type"]]
        provinces = [(r["province"], r["account_count"]) for r in found["provinces"]]
        for what, rows, expected, tolerance in (
            ("transaction_type", types, s.type_totals, s.type_tolerance),
            ("province", provinces, s.province_totals, s.province_tolerance),
        ):
            if not expected:
                continue
            schema = "name string, n bigint"
            actual = small_frame(self.spark, rows, schema)
            wanted = small_frame(self.spark, [(k, int(n)) for k, n in expected.items()], schema)
            compared = within_tolerance(actual, wanted, ["name"], "n", tolerance)
            for r in compared.where("NOT within").orderBy("name").collect():
                self.log.warn(f"{what} {r['name']}: {r['actual_value']} rows, expected {r['expected_value']}")

    def finish(
        self,
        numbered: DataFrame | Sequence[DataFrame],
        rows: int,
        before_publishing: Callable[[], None] | None = None,
    ) -> RunLog:
        """Link the fact table to the dimensions, slice by slice, check the star, then publish the batch."""
        accounts = self.store.read("star", "dim_accounts")
        customers = self.store.read("star", "dim_customers")
        slices = [numbered] if isinstance(numbered, DataFrame) else numbered
        fact = [link_transactions(part, accounts, customers) for part in slices]
        loaded = self.step("star", "fact_transactions", fact, C.FACT_TRANSACTIONS, rows)
        require_conserved("fact_transactions", rows, loaded=loaded)
        with self.log.timed("checks"):
            fact = self.store.read("star", "fact_transactions")
            self._compare_totals(require_star_checks(fact, accounts, customers))
            if before_publishing:
                before_publishing()
        self.store.publish_batch()
        return self.log


def run_layers(spark: SparkSession, inputs: Inputs, root: str, *args, **options) -> RunLog:
    """Build and publish all tables of a batch under ``root``; stop at the first breach.

    Nothing is visible to readers until the last check holds.  Keys that a JSON line
    was not expected to have stop the run, nested ones too.  Unique columns are
    proved unique by the sort that numbers them; ``recheck_unique=True`` proves them once
    more from the written tables, with a shuffle per column.  Further arguments are
    those of :meth:`Run.begin`.
    """
    run = Run.begin(spark, inputs, root, *args, **options)

    def accounts_flow() -> int:
        n = run.raw_accounts()
        typed = run.typed_accounts(run.store.read("raw", "accounts"))
        return run.account_dimension(run.typed("accounts", typed, C.TYPED_ACCOUNTS, n))

    def transactions_flow() -> tuple[int, DataFrame]:
        lines = read_json_lines(spark, inputs.transactions)
        raw = raw_transactions(lines, **run.audit)
        n = run.step("raw", "transactions", raw, C.RAW_TRANSACTIONS)
        if n == 0:
            raise EmptySource(f"source is empty: {inputs.transactions}")
        typed = run.typed_transactions(run.store.read("raw", "transactions"))
        n = run.typed("transactions", typed, C.TYPED_TRANSACTIONS, n)
        return n, numbered_transactions(run.store.read("typed", "transactions"), rows=n)

    def known_keys() -> None:
        lines = read_raw_lines(spark, inputs.transactions)
        require_known_keys(lines, TRANSACTION_JSON, SOURCE_SYSTEMS["transactions"])

    # the sources do not depend on each other until the fact table joins them
    with run.log.timed("sources_to_dimensions"):
        done = run_together(spark, transactions_flow, accounts_flow, run.customers_flow, known_keys)
    rows, numbered = done[0]
    return run.finish(numbered, rows)


def integrity_report(store: LayerStore) -> DataFrame:
    """Orphans of both foreign keys of the typed layer, as counts and percentages."""
    customers = store.read("typed", "customers", ["customer_id"])
    accounts = store.read("typed", "accounts", ["account_id", "customer_ref"])
    transactions = store.read("typed", "transactions", ["account_id"])
    return count_orphans(
        accounts, "customer_ref", customers, "customer_id", "accounts.customer_ref"
    ).unionByName(
        count_orphans(
            transactions, "account_id", accounts, "account_id", "transactions.account_id"
        )
    )
