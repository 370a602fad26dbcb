import datetime as dt
import json
import random
import time
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tierwright.plans import contracts as C
from tierwright.operators.contracts import enforce
from tierwright.sources.folders import versions
from tierwright.streaming.freshness import freshness_report
from tierwright.streaming.source import (
    ledger_rows,
    read_stream,
    run_available,
    start_polling,
    state_session,
    stop_when_quiet,
)
from tierwright.streaming.tables import ARRIVED_SCHEMA, BALANCE_SIGNS, StreamTables, with_new_ids

BATCH_SCHEMA = ARRIVED_SCHEMA.rsplit(", ", 1)[0]
START = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)


def events(n, seed=1):
    """Events of four accounts, one of them with most rows, and of an unknown one."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        account = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "c", "unknown"])
        at = START + dt.timedelta(minutes=rng.randrange(5000))
        kind = rng.choice(list(BALANCE_SIGNS))
        out.append((account, f"t{i}", at, Decimal(rng.randrange(1, 9999)) / 100, kind, "POS"))
    return out


def expected(rows, keep):
    known = [r for r in rows if r[0] != "unknown"]
    balances, latest, recent = {}, {}, {}
    for account, _, at, amount, kind, _ in known:
        balances[account] = balances.get(account, Decimal(100)) + BALANCE_SIGNS[kind] * amount
        latest[account] = max(latest.get(account, at), at)
        recent.setdefault(account, []).append((at, account, _))
    for account in recent:
        rows_of = sorted((r for r in known if r[0] == account), key=lambda r: (-r[2].timestamp(), r[1]))
        recent[account] = [r[1] for r in rows_of[:keep]]
    return balances, latest, recent


def check(tables, rows, keep):
    balances, latest, recent = expected(rows, keep)
    shown = tables.current_balances()
    enforce(shown, C.CURRENT_BALANCES)
    seconds = F.unix_seconds("last_transaction_timestamp").alias("s")
    got = shown.select("account_id", "current_balance", seconds).collect()
    assert {r.account_id: r.current_balance for r in got} == balances
    assert {r.account_id: r.s for r in got} == {a: int(t.timestamp()) for a, t in latest.items()}
    shown = tables.recent_transactions()
    enforce(shown, C.RECENT_TRANSACTIONS)
    got = {}
    for r in shown.orderBy(F.desc("transaction_timestamp"), "transaction_id").collect():
        got.setdefault(r.account_id, []).append(r.transaction_id)
    assert got == recent
    unknown = {r[1] for r in rows if r[0] == "unknown"}
    out = tables.quarantined().where("reason = 'ORPHANED_ACCOUNT'").collect()
    assert sorted(r.transaction_id for r in out) == sorted(unknown)


@pytest.fixture
def accounts(spark):
    rows = [(a, Decimal("100.00")) for a in ("a", "b", "c", "hot", "idle")]
    return spark.createDataFrame(rows, "account_id string, current_balance decimal(18,2)")


def test_batches_redelivery_replay_and_compaction(spark, accounts, folder):
    rows = events(240)
    tables = StreamTables(spark, folder(), accounts, keep=7, compact_every=2)
    frame = lambda part: spark.createDataFrame(part, BATCH_SCHEMA)
    batches = [rows[:80], rows[80:160] + rows[:30], rows[160:200] + rows[100:140] + rows[160:170], rows[200:]]
    for i, part in enumerate(batches):
        tables.apply(frame(part), i)
    check(tables, rows, 7)
    # a batch that is applied again after a crash, compacted or not, changes nothing
    for i in (3, 3):
        tables.apply(frame(batches[i]), i)
    check(tables, rows, 7)
    assert versions(spark, f"{tables.root}/balances", "upto") == ["000000000001", "000000000003"]
    tables.apply(frame(rows[:50]), 4)
    check(tables, rows, 7)
    later = [("a", "late", START - dt.timedelta(days=900), Decimal("5.00"), "CREDIT", None)]
    tables.apply(frame(later), 5)
    check(tables, rows + later, 7)


def test_storage_of_a_batch_does_not_grow_with_history(spark, accounts, folder, monkeypatch):
    from tierwright.sources import folders

    tables = StreamTables(spark, folder(), accounts, keep=3, compact_every=2)
    rows, looked = events(48, seed=4), []
    real = folders.exists
    monkeypatch.setattr(folders, "exists", lambda *a: looked.append(0) or real(*a))
    for i in range(12):
        tables.apply(spark.createDataFrame(rows[4 * i : 4 * i + 4], BATCH_SCHEMA), i)
        looked.append(1)
    counts = [len(part) for part in "".join(map(str, looked)).split("1")[:-1]]
    assert counts[-2:] == counts[-4:-2] == counts[-6:-4]
    assert len(versions(spark, f"{tables.root}/ledger_ids", "upto")) == 2
    for table in ("arrived", "balances", "recent"):
        assert versions(spark, f"{tables.root}/{table}", "batch") == ["000000000010", "000000000011"]
    check(tables, rows, 3)


def test_crash_between_ledger_and_balances(spark, accounts, folder, monkeypatch):
    rows = events(60, seed=2)
    tables = StreamTables(spark, folder(), accounts, keep=5)
    tables.apply(spark.createDataFrame(rows[:30], BATCH_SCHEMA), 0)
    real = StreamTables._write

    def fail_on_balances(self, df, schema, path):
        if "/balances/" in path:
            raise OSError("executor lost")
        real(self, df, schema, path)

    monkeypatch.setattr(StreamTables, "_write", fail_on_balances)
    with pytest.raises(OSError):
        tables.apply(spark.createDataFrame(rows[20:], BATCH_SCHEMA), 1)
    monkeypatch.setattr(StreamTables, "_write", real)
    tables.apply(spark.createDataFrame(rows[20:], BATCH_SCHEMA), 1)
    check(tables, rows, 5)


def test_unusable_rows_are_kept_aside(spark, accounts, folder):
    rows = [
        ("a", None, START, Decimal("1.00"), "CREDIT", None),
        ("a", None, START, Decimal("2.00"), "CREDIT", None),
        ("a", "t1", None, Decimal("1.00"), "CREDIT", None),
        (None, "t2", START, Decimal("1.00"), "CREDIT", None),
        ("a", "t3", START, None, "CREDIT", None),
    ]
    tables = StreamTables(spark, folder(), accounts)
    assert tables.current_balances().count() == 0 and tables.quarantined().count() == 0
    tables.apply(spark.createDataFrame(rows, BATCH_SCHEMA), 0)
    assert [r.reason for r in tables.quarantined().collect()] == ["NULL_REQUIRED"] * 5
    # the same id can still arrive intact
    tables.apply(spark.createDataFrame([("a", "t3", START, Decimal("3.00"), "CREDIT", None)], BATCH_SCHEMA), 1)
    assert tables.current_balances().first().current_balance == Decimal("103.00")


def lines(path, rows):
    Path(path).mkdir(exist_ok=True)
    name = Path(path) / f"{time.time_ns()}.jsonl"
    out = []
    for account, key, at, amount, kind, channel in rows:
        out.append(
            json.dumps(
                {
                    "transaction_id": key, "account_id": account, "transaction_type": kind,
                    "transaction_date": f"{at:%Y-%m-%d}", "transaction_time": f"{at:%H:%M:%S}",
                    "amount": float(amount), "channel": channel,
                }
            )
        )
    name.write_text("\n".join(out) + "\n")


@pytest.mark.parametrize("keyed", [False, True])
def test_files_restart_and_redelivery(spark, accounts, folder, keyed):
    rows, source, root = events(90, seed=3), folder(), folder()
    tables = StreamTables(spark, root, accounts, keep=6, compact_every=2, keyed=keyed)

    def run():
        found = ledger_rows(read_stream(state_session(spark) if keyed else spark, source, files_per_batch=1))
        found = with_new_ids(found) if keyed else found
        run_available(found.writeStream.foreachBatch(tables.apply), f"{root}/_checkpoint")

    lines(source, rows[:40])
    lines(source, rows[40:60])
    run()
    check(tables, rows[:60], 6)
    lines(source, rows[30:])  # overlaps what was delivered
    run()
    check(tables, rows, 6)
    run()  # nothing new
    check(tables, rows, 6)


def test_polling_stops_when_quiet(spark, folder):
    source, root = folder(), folder()
    lines(source, events(5))
    writer = read_stream(spark, source).select("transaction_id").writeStream.format("parquet").option("path", root)
    query = start_polling(writer, folder(), poll_seconds=1)
    started = time.monotonic()
    stop_when_quiet(query, quiet_seconds=4)
    assert not query.isActive and time.monotonic() - started < 60
    assert spark.read.parquet(root).count() == 5


def test_freshness_tiers(spark):
    rows = [(START, START + dt.timedelta(seconds=s)) for s in (0, 300, 301, 600, 601)]
    df = spark.createDataFrame(rows, "transaction_timestamp timestamp, updated_at timestamp")
    assert {r.tier: r["rows"] for r in freshness_report(df).collect()} == {"full": 2, "partial": 2, "none": 1}


def test_unknown_type_is_set_aside(spark, accounts, folder):
    tables = StreamTables(spark, folder(), accounts)
    rows = [
        ("a", "t1", START, Decimal("5.00"), "CREDIT", "POS"),
        ("a", "t2", START, Decimal("7.00"), "TRANSFER", "POS"),
    ]
    tables.apply(spark.createDataFrame(rows, BATCH_SCHEMA), 0)
    assert [r.transaction_id for r in tables.ledger().collect()] == ["t1"]
    assert [(r.transaction_id, r.reason) for r in tables.quarantined().collect()] == [("t2", "UNKNOWN_TYPE")]
    assert [r.current_balance for r in tables.current_balances().collect()] == [Decimal("105.00")]


def balances(tables):
    return {r.account_id: r.current_balance for r in tables.current_balances().collect()}


def test_state_of_ids_replay_and_conflicting_copies(spark, accounts, folder, monkeypatch):
    """A batch that fails behind the stream's state is run again and loses nothing; no batch reads earlier ids."""
    source, root = folder(), folder()
    tables = StreamTables(spark, root, accounts, keep=6, compact_every=3, keyed=True)
    read, real_read, real_write = [], StreamTables._read, StreamTables._write
    monkeypatch.setattr(StreamTables, "_read", lambda self, schema, base, *a, **k: read.append(base) or real_read(self, schema, base, *a, **k))

    def run():
        found = with_new_ids(ledger_rows(read_stream(state_session(spark, 2), source, files_per_batch=1)))
        run_available(found.writeStream.foreachBatch(tables.apply), f"{root}/_checkpoint")

    # copies of one id in one batch: the first by content counts, as without the state
    copies = [("a", "t1", START + dt.timedelta(days=d), Decimal(5 + d), "CREDIT", None) for d in (2, 0, 1)]
    lines(source, copies)
    run()
    assert balances(tables) == {"a": Decimal("105.00")}

    def fail(self, df, schema, path):
        if "/balances/" in path:
            raise OSError("executor lost")
        real_write(self, df, schema, path)

    lines(source, copies + [("b", "t3", START, Decimal(7), "CREDIT", None)])
    monkeypatch.setattr(StreamTables, "_write", fail)
    with pytest.raises(Exception, match="executor lost"):
        run()
    monkeypatch.setattr(StreamTables, "_write", real_write)
    run()
    assert balances(tables) == {"a": Decimal("105.00"), "b": Decimal("107.00")}
    for i in range(5):
        lines(source, copies + [("b", f"u{i}", START, Decimal(1), "DEBIT", None)])
    run()
    assert balances(tables) == {"a": Decimal("105.00"), "b": Decimal("102.00")}
    assert tables.ledger().count() == 7
    assert "ledger_ids" not in read and not versions(spark, f"{root}/ledger_ids", "upto")
    assert len(versions(spark, f"{root}/delivered", "batch")) <= 6


def test_orphans_come_back_once(spark, folder):
    """Rows of an unknown account are applied by the first batch after it appears; a leaver keeps its balance."""
    schema = "account_id string, current_balance decimal(18,2)"
    frames = [
        spark.createDataFrame([("a", Decimal("100.00"))], schema),
        spark.createDataFrame([("a", Decimal("100.00")), ("new", Decimal("50.00"))], schema),
        spark.createDataFrame([("new", Decimal("50.00"))], schema),
    ]
    now = [0]
    tables = StreamTables(spark, folder(), lambda: frames[now[0]], keep=2, compact_every=3)

    def apply(batch_id, *rows):
        tables.apply(spark.createDataFrame([(a, t, START + dt.timedelta(hours=h), Decimal(n), "CREDIT", None) for a, t, h, n in rows], BATCH_SCHEMA), batch_id)

    waiting = lambda: sorted(r.transaction_id for r in tables.quarantined().collect())
    apply(0, ("new", "t1", 5, 1), ("a", "t2", 1, 10), ("never", "t3", 1, 99))
    apply(1, ("new", "t4", 4, 2), ("new", "t1", 5, 1))
    assert balances(tables) == {"a": Decimal("110.00")} and waiting() == ["t1", "t3", "t4"]
    now[0] = 1
    apply(2, ("new", "t5", 1, 4))  # compacted
    apply(2, ("new", "t5", 1, 4))  # and applied again
    assert balances(tables) == {"a": Decimal("110.00"), "new": Decimal("57.00")} and waiting() == ["t3"]
    assert sorted(r.transaction_id for r in tables.recent_transactions().where("account_id = 'new'").collect()) == ["t1", "t4"]
    apply(3, ("new", "t1", 5, 1), ("new", "t4", 4, 2))  # redelivered
    now[0] = 2
    apply(4, ("a", "t6", 9, 7), ("new", "t7", 9, 3))
    apply(4, ("a", "t6", 9, 7), ("new", "t7", 9, 3))
    assert balances(tables) == {"a": Decimal("110.00"), "new": Decimal("60.00")} and waiting() == ["t3", "t6"]
    now[0] = 1
    apply(5)
    assert balances(tables) == {"a": Decimal("117.00"), "new": Decimal("60.00")} and waiting() == ["t3"]
    assert tables.ledger().count() == 7


def test_recent_rows_are_cut_before_they_are_ranked(spark, folder):
    """Late rows below an account's cut go before the shuffle; other accounts are not ranked anew."""
    rows = events(400, seed=8)
    known = ["hot", "a", "b", "c", "quiet"]
    accounts = spark.createDataFrame([(a, Decimal(100)) for a in known], "account_id string, current_balance decimal(18,2)")
    tables = StreamTables(spark, folder(), accounts, keep=5, compact_every=2)
    quiet = [("quiet", f"q{i}", START + dt.timedelta(minutes=i), Decimal(1), "CREDIT", "POS") for i in range(7)]
    tables.apply(spark.createDataFrame(rows[:200] + quiet, BATCH_SCHEMA), 0)
    tables.apply(spark.createDataFrame(rows[200:300], BATCH_SCHEMA), 1)
    # the row at the cut: a tie with a smaller id comes before it, one with a larger id goes
    cut = tables._merge_recent().where("account_id = 'hot' and place = 5").first()
    moment = cut.transaction_timestamp.replace(tzinfo=dt.timezone.utc)
    old = START - dt.timedelta(days=1)
    late = [("hot", f"late{i}", old, Decimal(1), "DEBIT", "POS") for i in range(30)]
    tied = [("hot", name, moment, Decimal(1), "FEE", "POS") for name in ("a-tie", "z-tie")]
    tables.apply(spark.createDataFrame(late + tied, BATCH_SCHEMA), 2)
    written = {r.transaction_id for r in tables._stored(ARRIVED_SCHEMA, "recent", 2).collect()}
    assert written == {"a-tie"}
    tables.apply(spark.createDataFrame(rows[300:], BATCH_SCHEMA), 3)
    tables.apply(spark.createDataFrame([], BATCH_SCHEMA), 4)
    check(tables, rows + quiet + late + tied, 5)

    plan = tables._above_cut(spark.createDataFrame(rows, BATCH_SCHEMA), 5)
    assert "EqualTo(place,5)" in plan._jdf.queryExecution().toString()


def test_fewer_recent_rows_are_kept_from_an_older_base(spark, folder):
    rows = [r for r in events(200, seed=3)]
    accounts = spark.createDataFrame([(a, Decimal(100)) for a in ("hot", "a", "b", "c")], "account_id string, current_balance decimal(18,2)")
    root = folder()
    StreamTables(spark, root, accounts, keep=9, compact_every=1).apply(spark.createDataFrame(rows[:120], BATCH_SCHEMA), 0)
    tables = StreamTables(spark, root, accounts, keep=4, compact_every=1)
    check(tables, rows[:120], 4)
    tables.apply(spark.createDataFrame(rows[120:], BATCH_SCHEMA), 1)
    check(tables, rows, 4)
