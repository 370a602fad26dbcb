"""Files in, published tables out, on small hand-written sources."""

import datetime as dt
import json
from dataclasses import replace
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tierwright.operators.contracts import ColumnRule, Contract, ContractError
from tierwright.operators.drift import UnknownColumns
from tierwright.operators.quality import QualityFailed, load_rules
from tierwright.operators.reconcile import RowsLost
from tierwright.plans import checks, layers
from tierwright.plans import contracts as C
from tierwright.plans import quality as Q
from tierwright.plans.quality_run import run_with_rules
from tierwright.functions.domains import PROVINCES, TRANSACTION_TYPES
from tierwright.sinks.tables import LayerStore, cast_to_schema, write_quarantine, write_report, write_table
from tierwright.sources import files, folders

RUN = dt.date(2025, 12, 31)


def csv(path, columns, rows):
    Path(path).write_text("\n".join([",".join(columns), *[",".join(r) for r in rows]]) + "\n")
    return str(path)


def transaction(i, account, **changes):
    row = {
        "transaction_id": f"t{i:02d}",
        "account_id": account,
        "transaction_date": "2025-06-18",
        "transaction_time": "11:52:40",
        "transaction_type": TRANSACTION_TYPES[i % 4],
        "merchant_category": "GROCERY",
        "amount": 10.5 + i,
        "currency": "ZAR",
        "channel": "POS",
        "location": {"province": "Gauteng", "city": "Utopia", "coordinates": None},
        "metadata": {"device_id": None, "session_id": None, "retry_flag": False},
    }
    return row | changes


@pytest.fixture
def sources(tmp_path):
    """Nine customers, one per province, with an account and a transaction each."""

    def make(transactions=None, account_rows=None):
        customers = [
            [f"c{i}", "*1234", "A", "B", "1984-09-02", "F", p, "LOW", "MASS", "5", "VERIFIED", "HL|CC"]
            for i, p in enumerate(PROVINCES)
        ]
        accounts = account_rows or [
            [f"a{i}", f"c{i}", "CREDIT" if i % 2 else "SAVINGS", "ACTIVE", "2019-10-30", "BASIC", "",
             "APP", "5000.00" if i % 2 else "", "12.50", "" if i % 3 else "03/11/2025"]
            for i in range(9)
        ]
        lines = transactions if transactions is not None else [transaction(i, f"a{i}") for i in range(9)]
        jsonl = tmp_path / "transactions.jsonl"
        jsonl.write_text("".join(json.dumps(t) + "\n" for t in lines))
        return layers.Inputs(
            csv(tmp_path / "customers.csv", C.CUSTOMER_COLUMNS, customers),
            csv(tmp_path / "accounts.csv", C.ACCOUNT_COLUMNS, accounts),
            str(jsonl),
        )

    return make


def test_whole_run(spark, sources, folder):
    root = folder()
    twice = transaction(3, "a3", transaction_time="14:37:06")
    spelled = [
        transaction(20, "a1", transaction_date="18/06/2025", currency="rands"),
        transaction(21, "a1", transaction_date="1750204800", currency=710, amount="12.30"),
        transaction(22, "a2", currency="USD"),
    ]
    inputs = sources([*[transaction(i, f"a{i}") for i in range(9)], twice, *spelled])
    log = layers.run_layers(spark, inputs, root, RUN)
    assert {(layer, t): (i, o) for layer, t, i, o in log.tables} == {
        ("raw", "customers"): (9, 9),
        ("raw", "accounts"): (9, 9),
        ("raw", "transactions"): (13, 13),
        ("typed", "customers"): (9, 9),
        ("typed", "accounts"): (9, 9),
        ("typed", "transactions"): (13, 12),
        ("star", "dim_customers"): (9, 9),
        ("star", "dim_accounts"): (9, 9),
        ("star", "fact_transactions"): (12, 12),
    }
    store = LayerStore(spark, root, "another run")
    fact = {r.transaction_id: r for r in store.latest("star", "fact_transactions").collect()}
    assert list(fact["t00"].asDict()) == C.FACT_TRANSACTIONS.names
    assert {r.currency for r in fact.values()} == {"ZAR"}
    assert {k for k, r in fact.items() if r.dq_flag} == {"t22"}
    assert fact["t22"].dq_flag == "CURRENCY_VARIANT"
    assert {fact[k].transaction_timestamp for k in ("t20", "t21")} == {dt.datetime(2025, 6, 18, 11, 52, 40)}
    assert fact["t21"].amount == Decimal("12.30")
    assert sorted(r.transaction_sk for r in fact.values()) == list(range(1, 13))
    assert [r.transaction_sk for _, r in sorted(fact.items())] == list(range(1, 13))
    accounts = {r.account_id: r for r in store.latest("star", "dim_accounts").collect()}
    assert accounts["a0"].credit_limit is None and accounts["a1"].credit_limit == Decimal("5000.00")
    assert accounts["a0"].last_activity_date == dt.date(2025, 11, 3)
    assert accounts["a1"].last_activity_date is None
    assert {r.age_band for r in store.latest("star", "dim_customers").collect()} == {"36-45"}
    raw = store.latest("raw", "transactions")
    assert raw.where("merchant_subcategory is not null").count() == 0
    integrity = layers.integrity_report(LayerStore(spark, root, log.batch_id)).collect()
    assert {r.orphans for r in integrity} == {0}


def test_rerun_gives_the_same_tables(spark, sources, folder):
    root, inputs = folder(), sources()
    same = {"batch_id": "20250101T000000Z-000000", "ingested_at": dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)}

    def rows():
        layers.run_layers(spark, inputs, root, RUN, **same)
        table = LayerStore(spark, root, "x").latest("star", "fact_transactions")
        return sorted(tuple(r) for r in table.collect())

    assert rows() == rows()
    assert folders.versions(spark, f"{root}/star/fact_transactions", "batch") == [same["batch_id"]]


def test_unique_columns_hold_when_rechecked(spark, sources, folder):
    twice = [transaction(i % 5, f"a{i % 5}", transaction_time=f"10:00:0{i}") for i in range(9)]
    log = layers.run_layers(spark, sources(twice), folder(), RUN, recheck_unique=True)
    assert ("star", "fact_transactions", 5, 5) in log.tables


@pytest.mark.parametrize("table", ["customers", "accounts", "transactions"])
def test_repeated_keys_stop_the_run_without_a_shuffle_for_them(spark, sources, folder, monkeypatch, table):
    """A typed table whose key is not unique is refused by the sort that numbers it."""
    real = getattr(layers, f"typed_{table}")
    monkeypatch.setattr(layers, f"typed_{table}", lambda *a, **k: real(*a, **k).union(real(*a, **k).limit(1)))
    root = folder()
    with pytest.raises(ContractError) as stopped:
        layers.run_layers(spark, sources(), root, RUN)
    key = f"{table[:-1]}_id"
    assert stopped.value.violations == [(key, "unique", 2)]
    with pytest.raises(FileNotFoundError):
        LayerStore(spark, root, "x").latest("star", "dim_customers")


def test_a_dimension_ends_at_its_number_of_rows(spark, folder):
    store, rows = LayerStore(spark, folder(), "b"), spark.range(1, 5).selectExpr("id AS k")
    assert store.write(rows, "star", "t", dense="k").rows == 4
    with pytest.raises(ContractError):
        store.write(rows.where("k <> 2"), "star", "u", dense="k")


def test_guaranteed_columns_are_not_proved_again(spark, folder):
    twice = spark.range(4).selectExpr("id % 2 AS k", "'a' AS v")
    with pytest.raises(ContractError):
        LayerStore(spark, folder(), "b").write(twice, "typed", "t", SMALL)
    assert LayerStore(spark, folder(), "b").write(twice, "typed", "t", SMALL, guaranteed=["k"]).rows == 4


def test_orphans_stop_the_run(spark, sources, folder):
    root = folder()
    with pytest.raises(RowsLost):
        layers.run_layers(spark, sources([transaction(0, "a0"), transaction(1, "nowhere")]), root, RUN)


def test_empty_source_stops_the_run(spark, sources, folder):
    with pytest.raises(files.EmptySource):
        layers.run_layers(spark, sources([]), folder(), RUN)


def test_missing_type_fails_the_check(spark, sources, folder):
    rows = [transaction(i, "a0", transaction_type="DEBIT") for i in range(3)]
    with pytest.raises(checks.CheckFailed, match="CREDIT"):
        layers.run_layers(spark, sources(rows), folder(), RUN)


def test_underage_breaks_the_contract_but_not_the_operator(spark, sources, folder):
    with pytest.raises(ContractError, match="age_band: not_null"):
        layers.run_layers(spark, sources(), folder(), "2000-01-01")


def test_header_must_match(spark, tmp_path):
    path = csv(tmp_path / "c.csv", [*C.CUSTOMER_COLUMNS, "rogue"], [["x"] * 13])
    with pytest.raises(Exception, match="(?i)header|column"):
        files.read_csv_text(spark, path, C.CUSTOMER_COLUMNS).collect()


def test_broken_json_line(spark, tmp_path):
    path = tmp_path / "t.jsonl"
    path.write_text(json.dumps(transaction(1, "a")) + "\n{broken\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_json_lines(spark, str(path)).collect()
    kept = files.read_json_lines(spark, str(path), corrupt_column="_corrupt").collect()
    assert [r._corrupt for r in kept] == [None, "{broken"]


def test_missing_and_present_subcategory(spark, tmp_path):
    path = tmp_path / "t.jsonl"
    rows = [transaction(1, "a"), transaction(2, "a", merchant_subcategory="Butchery")]
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    got = files.read_json_lines(spark, str(path)).orderBy("transaction_id").collect()
    assert [r.merchant_subcategory for r in got] == [None, "Butchery"]


# sinks ----------------------------------------------------------------------

SMALL = Contract("small", (ColumnRule("k", "bigint", unique=True), ColumnRule("v", domain=("a", "b"))))


def test_off_contract_batch_is_not_published(spark, folder):
    root = folder()
    good = spark.range(4).selectExpr("id AS k", "if(id % 2 = 0, 'a', 'b') AS v")
    assert LayerStore(spark, root, "b1").write(good, "typed", "t", SMALL).rows == 4
    broken = {
        "unique": good.union(good),
        "domain": good.withColumn("v", F.lit("z")),
        "not_null": good.withColumn("v", F.expr("if(k = 1, null, v)")),
    }
    for i, (rule, df) in enumerate(broken.items()):
        with pytest.raises(ContractError) as error:
            LayerStore(spark, root, f"b{i + 2}").write(df, "typed", "t", SMALL)
        assert {r for _, r, _ in error.value.violations} == {rule}
    assert LayerStore(spark, root, "b9").latest("typed", "t").count() == 4
    with pytest.raises(FileNotFoundError):
        LayerStore(spark, root, "b9").latest("typed", "unknown")


def test_structure_is_checked_before_writing(spark, folder):
    root = folder()
    with pytest.raises(ContractError):
        LayerStore(spark, root, "b").write(spark.range(1), "typed", "t", SMALL)
    assert not folders.exists(spark, f"{root}/typed/t/batch=b")


def test_empty_table_keeps_its_schema(spark, folder):
    store = LayerStore(spark, folder(), "b")
    empty = spark.range(0).selectExpr("id AS k", "cast(null AS string) AS v")
    assert store.write(empty, "typed", "t", SMALL).rows == 0
    back = LayerStore(spark, store.root, "c").latest("typed", "t")
    assert back.dtypes == [("k", "bigint"), ("v", "string")] and back.count() == 0


def test_partitioned_write_splits_a_hot_value(spark, folder):
    df = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('p', id % 5)) AS p")
    path = write_table(df, folder(), partition_by=["p"])
    back = files.scan_table(spark, path)
    assert back.count() == 3000 and back.where("p = 'hot'").count() == 1000
    written = LayerStore(spark, folder(), "b").write(df, "raw", "t", partition_by=["p"])
    assert written.rows == 3000


def test_overwrite_replaces_schema(spark, folder):
    path = write_table(spark.range(3), folder())
    write_table(spark.range(2).selectExpr("id", "'x' AS extra"), path)
    assert files.scan_table(spark, path).columns == ["id", "extra"]


def test_cast_removes_the_zone(spark):
    df = spark.sql("SELECT timestamp'2025-01-02 03:04:05 UTC' AS t, '7.5' AS n, 1 AS gone")
    schema = Contract("c", (ColumnRule("n", "decimal(18,2)"), ColumnRule("t", "timestamp_ntz"))).schema
    out = cast_to_schema(df, schema)
    assert out.columns == ["n", "t"]
    assert tuple(out.first()) == (Decimal("7.50"), dt.datetime(2025, 1, 2, 3, 4, 5))


# quality --------------------------------------------------------------------


def test_every_dirty_row_has_a_place(spark, folder):
    def row(i, account="a1", date="2025-06-18", amount="10.00", currency="ZAR", text=False, key=None):
        return (key or f"t{i}", account, date, "10:00:00", "DEBIT", amount, currency, text, dt.datetime(2025, 1, 1), f"h{i:02d}")

    rows = [
        row(1),
        row(2, date="18/06/2025"),
        row(3, date="soon"),
        row(4, currency="710"),
        row(5, text=True),
        row(6, amount="n/a", text=True),
        row(7, account="nobody"),
        row(8, account=None),
        row(9, account="nobody", date="soon"),
        row(10, key="dup", date="soon"),
        row(11, key="dup", currency="R"),
        row(12, key="dup"),
    ]
    columns = (
        "transaction_id string, account_id string, transaction_date string, transaction_time string, "
        "transaction_type string, amount string, currency string, amount_is_text boolean, "
        "_ingested_at timestamp, _source_row_hash string"
    )
    nameless = (None, *row(13)[1:])
    raw = spark.createDataFrame([*rows, nameless], columns)
    accounts = spark.createDataFrame([("a1",)], "account_id string")
    rules = load_rules()
    marked = files.scan_table(spark, write_table(Q.mark_transactions(raw, accounts, rules), folder()))
    parts = Q.assess_transactions(marked, rules)
    loaded = {r.transaction_id: r for r in parts.loaded.collect()}
    assert {k: (r.dq_flag, r.issues) for k, r in loaded.items()} == {
        "t1": (None, []),
        "t2": ("DATE_FORMAT", ["DATE_FORMAT"]),
        "t4": ("CURRENCY_VARIANT", ["CURRENCY_VARIANT"]),
        "t5": ("TYPE_MISMATCH", ["TYPE_MISMATCH"]),
        "dup": ("DUPLICATE_DEDUPED", ["DUPLICATE_DEDUPED", "CURRENCY_VARIANT"]),
    }
    assert loaded["t2"].transaction_timestamp == dt.datetime(2025, 6, 18, 10)
    assert {r.currency for r in loaded.values()} == {"ZAR"}
    out = {(r.transaction_id, r.reason) for r in parts.kept_out.collect()}
    assert out == {
        ("t3", "DATE_FORMAT"),
        ("t6", "TYPE_MISMATCH"),
        ("t7", "ORPHANED_ACCOUNT"),
        ("t8", "NULL_REQUIRED"),
        ("t9", "ORPHANED_ACCOUNT"),
        (None, "NULL_REQUIRED"),
    }
    assert sum(r.copies for r in parts.losers.collect()) == 2
    total = Q.conservation(marked, rules).first()
    assert tuple(total) == (13, 5, 6, 0, 2, True)
    report = {r.issue_code: r.records_affected for r in parts.report.collect()}
    assert report == {
        "NULL_REQUIRED": 2, "ORPHANED_ACCOUNT": 2, "DUPLICATE_DEDUPED": 2, "TYPE_MISMATCH": 2,
        "DATE_FORMAT": 4, "CURRENCY_VARIANT": 2,
    }
    path = write_quarantine(parts.kept_out.withColumn("source", F.lit("transactions")), folder())
    assert Path(path, "source=transactions", "reason=NULL_REQUIRED").is_dir()
    written = write_report(parts.report, folder())
    assert len(list(Path(written).glob("*.json"))) == 1


def test_run_with_rules_places_every_row(spark, sources, folder):
    def account(key, customer, opened="2019-10-30", balance="12.50"):
        return [key, customer, "SAVINGS", "ACTIVE", opened, "BASIC", "", "APP", "", balance, ""]

    accounts = [
        *[account(f"a{i}", f"c{i}") for i in range(9)],
        account("a0", "c0", balance="13.00"),  # same key again
        account("", "c1"),  # no key
        account("lost", "c99"),  # no such customer
        account("odd", "c1", opened="14/06/2021"),
        account("bad", "c1", opened="then"),
        account("worse", "c1", balance="much"),
    ]
    rows = [
        *[transaction(i, f"a{i}") for i in range(9)],
        transaction(3, "a3", transaction_time="14:37:06"),
        transaction(20, "a1", transaction_date="18/06/2025"),
        transaction(21, "a1", amount="7.25"),
        transaction(22, "a1", currency="USD"),
        transaction(23, "lost"),
        transaction(24, "bad"),
        transaction(25, None),
        transaction(26, "a1", amount="much"),
        transaction(27, "a1", terminal="x1"),
        transaction(28, "odd"),
    ]
    inputs = sources(rows, accounts)
    with open(inputs.transactions, "a") as f:
        f.write("{broken\n")
    root = folder()
    rules = replace(load_rules(), fail_threshold=0.9)
    log = run_with_rules(spark, inputs, root, RUN, rules=rules)
    assert ("star", "fact_transactions", 14, 14) in log.tables
    store = LayerStore(spark, root, log.batch_id)
    fact = {r.transaction_id: r.dq_flag for r in store.read("star", "fact_transactions").collect()}
    assert {k: v for k, v in fact.items() if v} == {
        "t03": "DUPLICATE_DEDUPED",
        "t20": "DATE_FORMAT",
        "t21": "TYPE_MISMATCH",
        "t22": "CURRENCY_VARIANT",
    }

    def reasons(source):
        aside = spark.read.parquet(store.path("quarantine", source))
        return {r["reason"]: r["n"] for r in aside.groupBy("reason").agg(F.sum("copies").alias("n")).collect()}

    assert reasons("transactions") == {
        "DUPLICATE_DEDUPED": 1, "ORPHANED_ACCOUNT": 2, "NULL_REQUIRED": 1, "TYPE_MISMATCH": 1,
        "MALFORMED_LINE": 1, "UNKNOWN_COLUMNS": 1,
    }
    assert reasons("accounts") == {
        "DUPLICATE_DEDUPED": 1, "NULL_REQUIRED": 1, "ORPHANED_ACCOUNT": 1, "DATE_FORMAT": 1,
        "TYPE_MISMATCH": 1,
    }
    report = spark.read.json(store.path("report", "dq")).collect()
    found = {(r.source, r.issue_code): r.records_affected for r in report if r.records_affected}
    assert found == {
        ("accounts", "NULL_REQUIRED"): 1, ("accounts", "DATE_FORMAT"): 2,
        ("transactions", "NULL_REQUIRED"): 1, ("transactions", "ORPHANED_ACCOUNT"): 2,
        ("transactions", "DUPLICATE_DEDUPED"): 1, ("transactions", "TYPE_MISMATCH"): 2,
        ("transactions", "DATE_FORMAT"): 1, ("transactions", "CURRENCY_VARIANT"): 1,
    }
    with pytest.raises(UnknownColumns, match="terminal"):
        run_with_rules(spark, inputs, folder(), RUN, rules=rules, drift_policy="strict")
    with pytest.raises(QualityFailed, match="TYPE_MISMATCH"):
        run_with_rules(spark, inputs, folder(), RUN, rules=replace(rules, fail_threshold=0.1))


def test_failed_batch_publishes_nothing(spark, sources, folder):
    rows = [transaction(i, f"a{i}") for i in range(9)] + [transaction(50, "nobody")]
    root = folder()
    with pytest.raises(Exception, match="fact_transactions"):
        layers.run_layers(spark, sources(rows), root, RUN, batch_id="b1")
    for layer, table in (("star", "fact_transactions"), ("star", "dim_accounts"), ("raw", "customers")):
        with pytest.raises(FileNotFoundError):
            LayerStore(spark, root, "x").latest(layer, table)


@pytest.mark.parametrize("extra", [{"terminal": "T7"}, {"metadata": {"device_id": None, "session_id": None, "retry_flag": False, "os": "x"}}])
def test_unknown_json_key_stops_the_run(spark, sources, folder, extra):
    rows = [transaction(i, f"a{i}") for i in range(8)] + [transaction(8, "a8", **extra)]
    with pytest.raises(Exception, match="unknown columns"):
        layers.run_layers(spark, sources(rows), folder(), RUN)
