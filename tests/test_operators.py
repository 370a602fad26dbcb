import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tierwright.operators import audit, contracts, dedup, drift, flatten, integrity, profile
from tierwright.operators import quality, reconcile
from tierwright.operators import keys as keys_module
from tierwright.operators.keys import REPEATED_KEY, _literal_array, bucket_of, dense_keys
from tierwright.plans import contracts as C

# dedup ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key; some rows are equal copies."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(700)}"
        rows.append((key, rng.randrange(40), rng.choice("ab")))
    return spark.createDataFrame(rows, "k string, o int, v string").repartition(6), rows


def best_of(rows):
    best = {}
    for k, o, v in rows:
        best[k] = min(best.get(k, (o, v)), (o, v))
    return best


def test_keep_first(skewed):
    df, rows = skewed
    got = {r.k: (r.o, r.v) for r in dedup.keep_first(df, ["k"], ["o", "v"]).collect()}
    assert got == best_of(rows)


def test_keep_first_counted(skewed):
    df, rows = skewed
    got = dedup.keep_first_counted(df, ["k"], ["o"]).collect()
    sizes = Counter(r[0] for r in rows)
    assert {r.k: ((r.o, r.v), r._copies) for r in got} == {
        k: (b, sizes[k]) for k, b in best_of(rows).items()
    }


def test_losers_and_winners_make_up_the_input(skewed):
    df, rows = skewed
    losers = Counter()
    for r in dedup.duplicate_losers(df, ["k"], ["o"]).collect():
        losers[(r.k, r.o, r.v)] += r.copies
    winners = Counter((k, *b) for k, b in best_of(rows).items())
    assert losers + winners == Counter(rows)


def test_losers_with_null_keys(spark):
    rows = [(None, 1), (None, 2), (None, 2), ("a", 1)]
    df = spark.createDataFrame(rows, "k string, o int")
    got = dedup.duplicate_losers(df, ["k"], ["o"]).collect()
    assert [(r.k, r.o, r.copies) for r in got] == [(None, 2, 2)]


def test_dedup_counts(skewed, spark):
    df, rows = skewed
    r = dedup.dedup_counts(df, ["k"]).first()
    assert (r.rows_in, r.rows_out) == (len(rows), len(best_of(rows)))
    empty = dedup.dedup_counts(df.where("false"), ["k"]).first()
    assert tuple(empty[c] for c in ("rows_in", "rows_out", "duplicates_removed")) == (0, 0, 0)


def test_top_per_key(skewed):
    df, rows = skewed
    got = Counter(r.k for r in dedup.top_per_key(df, ["k"], ["o", "v"], 5).collect())
    assert got == {k: min(5, n) for k, n in Counter(r[0] for r in rows).items()}


def test_rank_prunes_before_the_shuffle(skewed):
    df, _ = skewed
    plan = dedup.keep_first(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


# keys -----------------------------------------------------------------------


@pytest.mark.parametrize("buckets", [1, 7])
@pytest.mark.parametrize("cast", ["string", "bigint"])
def test_numbering_refuses_a_repeated_key(spark, folder, buckets, cast):
    path = folder()
    spark.range(500).selectExpr(f"cast(id as {cast}) AS k").write.parquet(path)
    once = spark.read.parquet(path)
    assert dense_keys(once, "k", "sk", buckets=buckets).agg(F.max("sk"), F.countDistinct("sk")).first()[:] == (500, 500)
    twice = once.union(once.where("k = '321'"))
    with pytest.raises(PySparkException, match=REPEATED_KEY):
        dense_keys(twice, "k", "sk", buckets=buckets).collect()
    nulls = once.union(spark.sql(f"select cast(null as {cast}) k from range(3)"))
    assert dense_keys(nulls, "k", "sk", buckets=buckets).agg(F.countDistinct("sk")).first()[0] == 503


@pytest.mark.parametrize("n_cuts", [0, 1, 2, 3, 7, 8, 13])
def test_bucket_of(spark, n_cuts):
    cuts = [10 * (i + 1) for i in range(n_cuts)]
    df = spark.range(-5, 10 * n_cuts + 15)
    array = _literal_array(cuts, df.schema["id"].dataType)
    for r in df.select("id", bucket_of(F.col("id"), array, n_cuts).alias("b")).collect():
        assert r.b == sum(c <= r.id for c in cuts)


@pytest.mark.parametrize("buckets", [None, 25, 64])
def test_dense_keys_match_a_sort(spark, buckets):
    rng = random.Random(3)
    keys = list({f"{'aaaa' if rng.random() < 0.4 else ''}{rng.getrandbits(40):x}é'\"," for _ in range(900)})
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
    got = dense_keys(df, "k", "sk", buckets=buckets)
    ordered = sorted(keys, key=lambda s: s.encode())
    assert {r.k: r.sk for r in got.collect()} == {k: i + 1 for i, k in enumerate(ordered)}
    assert got.columns == ["sk", "k"] and got.schema["sk"].dataType.simpleString() == "bigint"


def test_dense_keys_on_integers_and_nothing(spark):
    df = spark.range(500).select((F.col("id") * 7 % 1000 - 300).alias("k"))
    got = dense_keys(df, "k", "sk", buckets=25).collect()
    assert [r.sk for r in sorted(got, key=lambda r: r.k)] == list(range(1, 501))
    assert dense_keys(df.where("k > 10000"), "k", "sk").count() == 0


def test_hashed_keys_are_checked(spark, monkeypatch):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "k string")
    got = {(r.sk, r.k) for r in keys_module.hashed_keys(df, "k", "sk").collect()}
    assert len(got) == 3 and (None, None) in got and all(0 <= sk < 2**63 for sk, _ in got if sk is not None)
    monkeypatch.setattr(keys_module, "hashed_key", lambda c: F.when(F.col(c).isNotNull(), F.lit(1)))
    with pytest.raises(keys_module.KeyCollision):
        keys_module.hashed_keys(df, "k", "sk")


def test_dense_keys_reject_other_types(spark):
    with pytest.raises(TypeError):
        dense_keys(spark.range(3).select(F.col("id").cast("double").alias("k")), "k", "sk")


# integrity ------------------------------------------------------------------


def test_orphans(spark):
    child = spark.createDataFrame([("a",), ("x",), (None,), ("x",)], "fk string")
    parent = spark.createDataFrame([("a",), ("b",)], "id string")
    assert integrity.orphans(child, "fk", parent, "id").count() == 3
    r = integrity.count_orphans(child, "fk", parent, "id", "rel").first()
    assert (r.orphans, r.total, r.orphan_pct) == (3, 4, 75.0)
    r = integrity.count_orphans(child.where("false"), "fk", parent, "id", "rel").first()
    assert (r.orphans, r.total, r.orphan_pct) == (0, 0, 0.0)
    marked = integrity.mark_orphans(child, "fk", parent, "id").collect()
    assert Counter((r.fk, r.is_orphan) for r in marked) == Counter(
        {("a", False): 1, ("x", True): 2, (None, True): 1}
    )


# contracts ------------------------------------------------------------------


def dim_customer(spark, **changes):
    row = dict(
        customer_sk=1, customer_id="c", gender="F", province="Gauteng", income_band="LOW",
        segment="MASS", risk_score=5, kyc_status="VERIFIED", age_band="36-45",
    ) | changes
    return spark.createDataFrame([tuple(row[n] for n in C.DIM_CUSTOMERS.names)], loose(C.DIM_CUSTOMERS))


def loose(contract):
    return ", ".join(f"{c.name} {c.type}" for c in contract.columns)


def rules_broken(df, contract):
    with pytest.raises(contracts.ContractError) as error:
        contracts.enforce(df, contract)
    return {(c, r) for c, r, _ in error.value.violations}


def test_contract_accepts(spark):
    contracts.enforce(dim_customer(spark), C.DIM_CUSTOMERS)


def test_contract_rejects(spark):
    good = dim_customer(spark)
    D = C.DIM_CUSTOMERS
    assert rules_broken(good.withColumn("rogue_column", F.lit(1)), D) == {("rogue_column", "unexpected")}
    assert rules_broken(good.drop("age_band"), D) == {("age_band", "missing")}
    assert rules_broken(good.withColumn("risk_score", F.lit("5")), D) == {("risk_score", "type")}
    swapped = good.select(*[D.names[1], D.names[0], *D.names[2:]])
    assert ("customer_id", "order") in rules_broken(swapped, D)
    assert rules_broken(dim_customer(spark, age_band=None), D) == {("age_band", "not_null")}
    assert rules_broken(dim_customer(spark, province="Atlantis"), D) == {("province", "domain")}
    assert rules_broken(good.union(good), D) == {("customer_sk", "unique"), ("customer_id", "unique")}
    with pytest.raises(contracts.ContractError):
        contracts.enforce_unique(good.union(good), D)


def test_contract_report_counts(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), (None, "y"), (None, "x")], "k string, v string")
    contract = contracts.Contract(
        "t",
        (
            contracts.ColumnRule("k", unique=True),
            contracts.ColumnRule("v", nullable=True, domain=("x",)),
        ),
    )
    got = {(r.column_name, r.rule): r.violations for r in contracts.contract_report(df, contract).collect()}
    assert got == {("k", "not_null"): 2, ("k", "unique"): 2, ("v", "domain"): 1}


@pytest.mark.parametrize(
    "contract, width",
    [
        (C.RAW_CUSTOMERS, 16), (C.RAW_ACCOUNTS, 15), (C.RAW_TRANSACTIONS, 20),
        (C.TYPED_CUSTOMERS, 16), (C.TYPED_ACCOUNTS, 15), (C.TYPED_TRANSACTIONS, 22),
        (C.DIM_CUSTOMERS, 9), (C.DIM_ACCOUNTS, 11), (C.FACT_TRANSACTIONS, 15),
        (C.CURRENT_BALANCES, 4), (C.RECENT_TRANSACTIONS, 7),
    ],
)
def test_contract_widths(spark, contract, width):
    assert len(contract.names) == width
    empty = spark.createDataFrame([], contract.schema)
    contracts.enforce(empty, contract)


def test_star_keeps_personal_data_out():
    assert C.DIM_ACCOUNTS.names[2] == "customer_id"
    shown = {*C.DIM_CUSTOMERS.names, *C.DIM_ACCOUNTS.names, *C.FACT_TRANSACTIONS.names}
    assert not shown & {"dob", "first_name", "last_name", "id_number", "mobile_number"}
    assert not shown & set(audit.AUDIT_COLUMNS)


# drift ----------------------------------------------------------------------


def test_drift_policies(spark):
    df = spark.createDataFrame([("1", "a", "z"), ("2", "b", None)], "id string, v string, extra string")
    known = ["id", "v"]
    with pytest.raises(drift.UnknownColumns):
        drift.apply_drift_policy(df, known, "id", "s")
    kept = drift.apply_drift_policy(df, known, "id", "s", "quarantine")
    assert kept.in_band.columns == known and kept.in_band.count() == 2
    assert [tuple(r) for r in kept.diverted.collect()] == [("s", "UNKNOWN_COLUMNS", "1", "z")]
    evolved = drift.apply_drift_policy(df, known, "id", "s", "autoevolve")
    assert evolved.in_band.columns == df.columns
    assert drift.evolve_union(df.select(*known), evolved.in_band).columns == df.columns
    clean = drift.apply_drift_policy(df.select(*known), known, "id", "s")
    assert clean.unknown == () and clean.diverted is None
    with pytest.raises(ValueError):
        drift.apply_drift_policy(df, known, "id", "s", "ignore")


# quality --------------------------------------------------------------------


def test_rules_file_is_checked():
    assert quality.load_rules().action_of("NULL_REQUIRED") == "quarantine"
    with pytest.raises(ValueError):
        quality.parse_rules({"rules": [{"code": "MADE_UP", "action": "flag"}]})
    with pytest.raises(ValueError):
        quality.parse_rules({"rules": [{"code": "DATE_FORMAT", "action": "drop"}]})


def test_first_rule_wins_and_strongest_action(spark):
    rules = quality.parse_rules(
        {
            "rules": [
                {"code": "DATE_FORMAT", "action": "correct", "when_unfixable": "reject"},
                {"code": "CURRENCY_VARIANT", "action": "flag"},
                {"code": "NULL_REQUIRED", "action": "quarantine"},
            ]
        }
    )
    df = spark.createDataFrame(
        [(1, True, True, False, False), (2, True, False, False, True), (3, False, True, True, False),
         (4, False, False, None, False)],
        "id int, d boolean, c boolean, n boolean, bad boolean",
    )
    detectors = {"DATE_FORMAT": F.col("d"), "CURRENCY_VARIANT": F.col("c"), "NULL_REQUIRED": F.col("n")}
    marked = quality.with_issues(df, detectors, rules)
    unfixable = {"DATE_FORMAT": F.col("bad")}
    got = {
        r.id: (r.f, r.issues, r.h, r.why)
        for r in marked.select(
            "id", "issues", quality.first_issue().alias("f"),
            quality.handling(rules, unfixable).alias("h"),
            quality.blocking_reason(rules, unfixable).alias("why"),
        ).collect()
    }
    assert got == {
        1: ("DATE_FORMAT", ["DATE_FORMAT", "CURRENCY_VARIANT"], "load", None),
        2: ("DATE_FORMAT", ["DATE_FORMAT"], "reject", "DATE_FORMAT"),
        3: ("CURRENCY_VARIANT", ["CURRENCY_VARIANT", "NULL_REQUIRED"], "quarantine", "NULL_REQUIRED"),
        4: (None, [], "load", None),
    }
    report = quality.grade(quality.summarize(quality.count_issues(marked, rules), rules), rules)
    assert {r.issue_code: (r.records_affected, r.pct_of_total, r.level) for r in report.collect()} == {
        "DATE_FORMAT": (2, 50.0, "warn"),
        "CURRENCY_VARIANT": (2, 50.0, "warn"),
        "NULL_REQUIRED": (1, 25.0, "warn"),
    }
    empty = quality.summarize(quality.count_issues(marked.where("false"), rules), rules)
    assert {r.pct_of_total for r in empty.collect()} == {0.0}


# the rest -------------------------------------------------------------------


def test_flatten(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('a', 2, 'b', named_struct('c', 'x', 'd.e', 3)) AS s, 'z' AS t")
    flat = flatten.flatten_structs(df)
    assert flat.columns == ["id", "s_a", "s_b_c", "s_b_d.e", "t"]
    assert tuple(flat.first()) == (1, 2, "x", 3, "z")


def test_audit(spark):
    now = dt.datetime(2025, 1, 2, 5, 4, 5, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    batch = audit.new_batch_id(now)
    assert batch.startswith("20250102T030405Z-") and len(batch) == 23
    df = audit.with_audit(spark.range(2).selectExpr("cast(id AS string) AS a"), ["a"], "sys", batch, now)
    rows = df.select("*", F.date_format("_ingested_at", "yyyy-MM-dd HH:mm:ss").alias("t")).collect()
    assert {r.t for r in rows} == {"2025-01-02 03:04:05"}
    assert {(r._source_system, r._batch_id) for r in rows} == {("sys", batch)}
    assert len({r._source_row_hash for r in rows}) == 2


def test_domain_difference(spark):
    df = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "v string")
    got = {(r.value, r.status, r.row_count) for r in profile.domain_difference(df, "v", ["a", "b"]).collect()}
    assert got == {("b", "missing", 0), ("c", "unexpected", 1), (None, "unexpected", 1)}


def test_dense_key_report(spark):
    good = spark.range(1, 6).withColumnRenamed("id", "sk")
    assert profile.dense_key_report(good, "sk").first().holds
    for bad in (good.where("sk <> 3"), good.union(good), good.selectExpr("sk + 1 AS sk"),
                good.selectExpr("cast(sk AS int) AS sk")):
        assert not profile.dense_key_report(bad, "sk").first().holds


def test_tolerance(spark):
    a = spark.createDataFrame([("x", 102), ("y", 94), ("z", 1)], "k string, n bigint")
    e = spark.createDataFrame([("x", 100), ("y", 100), ("w", 5)], "k string, n bigint")
    got = {r.k: r.within for r in reconcile.within_tolerance(a, e, ["k"], "n", 0.05).collect()}
    assert got == {"x": True, "y": False, "z": False, "w": False}


def test_conservation():
    reconcile.require_conserved("t", 10, loaded=7, quarantined=3)
    with pytest.raises(reconcile.RowsLost, match="10 rows in, 9"):
        reconcile.require_conserved("t", 10, loaded=9)


def test_rows_meet_once_unless_a_key_is_hot(spark):
    few = spark.range(0, 1000).selectExpr("cast(id % 300 as string) k", "id o", "'x' v")
    placed = dedup.together(few, ["k"])
    plan = dedup.keep_first(placed, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    # one shuffle, below every sort
    assert plan.count("Exchange ") == 1 and plan.index("Sort ") < plan.index("Exchange ")
    hot = spark.range(0, 400_000).selectExpr("cast(if(id % 3 = 0, -1, id) as string) k", "id o")
    assert dedup.has_hot_key(hot, ["k"]) and not dedup.has_hot_key(few, ["k"])
    assert dedup.together(hot, ["k"]) is hot


@pytest.mark.parametrize("placed", [None, False, True])
def test_duplicate_losers_are_the_same_however_rows_are_placed(spark, placed):
    rows = [("a", 1, "x")] * 3 + [("a", 2, "y"), ("b", 1, None), ("b", 1, None), (None, 1, "z"), (None, 2, "z"), ("c", 5, "w")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    got = dedup.duplicate_losers(df, ["k"], ["o"], placed=placed).collect()
    assert sorted(got, key=str) == sorted([("a", 1, "x", 2), ("a", 2, "y", 1), ("b", 1, None, 1), (None, 2, "z", 1)], key=str)
    if placed is None:
        plan = dedup.duplicate_losers(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1 and "Join" not in plan
