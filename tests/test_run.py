"""Runs with settings: contract breaches set aside, exit codes, reports, failing fast."""

import json
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_layers import RUN, sources, transaction  # noqa: F401 - a fixture

from tierwright.__main__ import main
from tierwright.operators.contracts import ColumnRule, Contract, breach_list
from tierwright.plans.quality_run import run_with_rules
from tierwright.plans.settings import Settings, parse_settings
from tierwright.session import run_together
from tierwright.sinks.tables import LayerStore


def account(key, customer, **changes):
    row = {
        "account_id": key, "customer_ref": customer, "account_type": "SAVINGS", "account_status": "ACTIVE",
        "open_date": "2019-10-30", "product_tier": "BASIC", "mobile_number": "", "digital_channel": "APP",
        "credit_limit": "", "current_balance": "12.50", "last_activity_date": "",
    }
    return list((row | changes).values())


def aside(spark, store, source):
    rows = spark.read.parquet(store.path("quarantine", source)).collect()
    return sorted((r.reason, ",".join(r.breaches), r.copies) for r in rows)


def test_breach_list(spark):
    contract = Contract("c", (ColumnRule("a"), ColumnRule("b", nullable=True, domain=("x", "y")), ColumnRule("later")))
    other = Contract("d", (ColumnRule("a"), ColumnRule("b")))
    df = spark.createDataFrame([(None, None), ("1", "x"), ("2", "z")], "a string, b string")
    values = {"a": F.col("a"), "b": F.col("b")}
    got = df.select(breach_list([(contract, values), (other, values)]).alias("r")).collect()
    assert [r.r for r in got] == [["a:not_null", "b:not_null"], [], ["b:domain"]]


def test_rows_that_only_a_contract_refuses(spark, sources, folder):  # noqa: F811
    accounts = [account(f"a{i}", f"c{i}") for i in range(9)] + [
        account("cold", "c1", account_status="FROZEN"),
        account("paper", "c1", digital_channel="FAX", product_tier="GOLD"),
    ]
    good = [transaction(i, f"a{i}") for i in range(9)] + [transaction(30 + i, "a1") for i in range(20)]
    bad = [
        transaction(9, "a1", channel=None),
        transaction(10, "a1", transaction_time="9am"),
        transaction(11, "a1", metadata=None),
        transaction(12, "a1", transaction_type="GIFT"),
        transaction(13, "a1", location={"province": "Atlantis"}),
        transaction(14, "a1", merchant_category="MAGIC", channel="PIGEON"),
        transaction(15, "cold"),
    ]
    root = folder()
    log = run_with_rules(spark, sources(good + bad, accounts), root, RUN)
    store = LayerStore(spark, root, log.batch_id)
    assert store.read("star", "fact_transactions").count() == len(good)
    assert aside(spark, store, "transactions") == [
        ("CONTRACT_BREACH", "channel:not_null", 1),
        ("CONTRACT_BREACH", "merchant_category:domain,channel:domain", 1),
        ("CONTRACT_BREACH", "metadata_retry_flag:not_null", 1),
        ("CONTRACT_BREACH", "province:domain", 1),
        ("CONTRACT_BREACH", "transaction_timestamp:not_null", 1),
        ("CONTRACT_BREACH", "transaction_type:domain", 1),
        ("ORPHANED_ACCOUNT", "", 1),
    ]
    assert aside(spark, store, "accounts") == [
        ("CONTRACT_BREACH", "account_status:domain", 1),
        ("CONTRACT_BREACH", "product_tier:domain,digital_channel:domain", 1),
    ]
    report = json.loads(next(iter(_files(store.path("report", "dq_report")))).read_text())
    assert report["summary"] == {"total_records": 36, "loaded_records": 29, "total_flagged_records": 0}
    assert {i["issue_code"] for i in report["issues"]} >= {"ORPHANED_ACCOUNT", "CURRENCY_VARIANT"}
    integrity = spark.read.json(store.path("report", "integrity")).collect()
    assert len(integrity) == 2


def _files(path):
    from pathlib import Path

    return Path(path).glob("*.json")


def test_settings_reach_the_run(spark, sources, folder):  # noqa: F811
    rows = [transaction(i, f"a{i}") for i in range(9)] + [
        transaction(20, "a1", transaction_date="18.06.2025", currency="rand"),
        transaction(21, "a1", location={"province": " kzn"}),
    ]
    settings = parse_settings(
        {
            "date_formats": ["yyyy-MM-dd", "dd/MM/yyyy", "dd.MM.yyyy"],
            "currency_codes": {"ZAR": "ZAR", "RAND": "ZAR"},
            "province_aliases": {"KZN": "KwaZulu-Natal"},
            "age_bands": [[18, "18-25"], [40, "36-45"]],
            "type_totals": {"DEBIT": 100},
            "province_totals": {"Gauteng": 1, "Limpopo": 1},
        }
    )
    root = folder()
    log = run_with_rules(spark, sources(rows), root, RUN, settings=settings)
    store = LayerStore(spark, root, log.batch_id)
    fact = {r.transaction_id: r for r in store.read("star", "fact_transactions").collect()}
    assert str(fact["t20"].transaction_date) == "2025-06-18" and fact["t20"].dq_flag == "DATE_FORMAT"
    assert fact["t21"].province == "KwaZulu-Natal"
    assert {r.age_band for r in store.read("star", "dim_customers").collect()} == {"36-45"}
    assert any(w.startswith("transaction_type DEBIT") for w in log.warnings)
    assert any(w.startswith("DATE_FORMAT: more than") for w in log.warnings)
    assert not any(w.startswith("province") and ("Gauteng" in w or "Limpopo" in w) for w in log.warnings)


@pytest.mark.parametrize("spec", [{"colour": 1}, {"drift_policy": "ignore"}, {"rules": {"rules": [{"code": "X", "action": "flag"}]}}])
def test_bad_settings(spec):
    with pytest.raises(ValueError):
        parse_settings(spec)


def test_exit_codes(spark, sources, folder, tmp_path):  # noqa: F811
    rows = [transaction(i, f"a{i}") for i in range(9)]
    inputs = sources(rows)
    paths = [f"--{n}={getattr(inputs, n)}" for n in ("customers", "accounts", "transactions")]
    aliases = tmp_path / "settings.json"
    aliases.write_text(json.dumps({"province_aliases": {"GP": "Gauteng"}}))
    root = folder()
    assert main([*paths, f"--root={root}", f"--settings={aliases}", "--run-date=2025-12-31"], spark) == 0
    assert LayerStore(spark, root, "x").latest("star", "fact_transactions").count() == 9
    aliases.write_text(json.dumps({"alias": {}}))
    assert main([*paths, f"--root={folder()}", f"--settings={aliases}"], spark) == 2
    assert main(["--root=x"], spark) == 2
    broken = sources([*rows, transaction(9, "nobody")])
    paths = [f"--{n}={getattr(broken, n)}" for n in ("customers", "accounts", "transactions")]
    assert main([*paths, f"--root={folder()}", "--clean", "--run-date=2025-12-31"], spark) == 1


def test_flags_must_agree_with_the_report(spark, sources, folder, monkeypatch):  # noqa: F811
    from tierwright.plans import quality_run

    monkeypatch.setattr(quality_run._Sorted, "summary", lambda *_: 50)
    rows = [transaction(i, f"a{i}") for i in range(9)]
    root = folder()
    with pytest.raises(quality_run.QualityFailed, match="0 flagged rows in the fact table, 50"):
        run_with_rules(spark, sources(rows), root, RUN)
    with pytest.raises(FileNotFoundError):
        LayerStore(spark, root, "x").latest("star", "fact_transactions")


def test_first_error_ends_the_other_jobs(spark):
    def slow():
        spark.range(0, 40_000_000_000, 1, 8).selectExpr("sum(hash(id) % 7)").collect()

    def broken():
        time.sleep(1)
        raise ValueError("broken source")

    started = time.monotonic()
    with pytest.raises(ValueError, match="broken source"):
        run_together(spark, slow, broken, lambda: 3)
    assert time.monotonic() - started < 30
    assert run_together(spark, lambda: 1, lambda: spark.range(5).count()) == [1, 5]
    assert not spark.sparkContext.getJobTags()


def test_replaced_rules_and_policy(spark):
    settings = replace(Settings(), drift_policy="strict")
    assert settings.drift_policy == "strict" and settings.rules.fail_threshold == 0.5
