import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import pytest

from tierwright.llm.turn_repair import (
    END,
    Steps,
    backward,
    damaged,
    level,
    mend,
    op11_turn_repair,
    repair_conversations,
    repaired_turns,
)

SMALLEST = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, _conv string, place int"
WORD = r"[^\x20\x09-\x0D]"


def brute_repair(rows):
    """(cost, audit, turns) of the best edits of rows in order, with every prefix kept apart by its roles' state."""
    best = {"": (0, "", ())}

    def better(table, state, found):
        if state not in table or found[:2] < table[state][:2]:
            table[state] = found

    def with_inserts(table):
        for _ in range(3):
            for state, (cost, audit, turns) in list(table.items()):
                role = "assistant" if state == "u" else "user"
                better(table, role[0], (cost + 5, audit + "I", (*turns, (role, ""))))
        return table

    def may_follow(state, initial):
        return initial == "s" and state == "" or initial == "u" and state != "u" or initial == "a" and state == "u"

    seen = set()
    for role, text in rows:
        blank = not re.search(WORD, text)
        forced = blank or (role, text) in seen
        seen.add((role, text))
        extra = 0 if forced or re.findall(WORD, text)[-1] in ".!?" else 5
        after = {}
        for state, (cost, audit, turns) in with_inserts(best).items():
            better(after, state, (cost + 2, audit + "D", turns))
            if forced:
                continue
            if may_follow(state, role[:1]):
                better(after, role[:1], (cost + extra, audit + "K", (*turns, (role, text))))
            for new in ("user", "assistant"):
                if may_follow(state, new[0]):
                    better(after, new[0], (cost + 1 + extra, audit + "R", (*turns, (new, text))))
        best = after
    ends = with_inserts(best)
    return min(ends[s] for s in ("", "a") if s in ends)


def brute_row(conv, rows):
    """Expected result of rows (turn, role, text) of one conversation, as the report and its digests give it."""
    digest = lambda t: hashlib.sha256(t.encode()).digest()
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[2])))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen = Counter(), set()
    for _, role, text in rows:
        words = re.findall(WORD, text)
        if not words:
            faults["blank"] += 1
        elif (role, text) in seen:
            faults["duplicate"] += 1
        elif words[-1] not in ".!?":
            faults["truncated"] += 1
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, kept = brute_repair([(r, x) for _, r, x in rows])
    sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest()
    return (conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, sha)


def brute_damage(rows):
    text = lambda v: " " if v is None else str(v)
    for conv, turn, role, said in rows:
        k = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        if k == 0:
            continue
        said = "" if k == 1 else re.sub("[.!?]", "", text(said)) if k == 2 else text(said)
        yield from [(conv, turn, "user" if k == 4 else text(role), said)] * (2 if k == 3 else 1)


def by_conversation(rows):
    out = {}
    for conv, turn, role, said in rows:
        out.setdefault(conv, []).append((turn, role, said))
    return out


def random_turns(rng, conv, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "sys", "ai"]
    texts = ["Yes.", "No!", "So?", "and then", "", " \n", None, "é…", "a. ", "b\t"]
    return [
        (conv, rng.choice([None, *range(n)]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"{i}{rng.choice('.?x')}")
        for i in range(n)
    ]


def rows_out(repair):
    from tierwright.llm.turn_repair import _key, digests

    report = repair.report.withColumn("_conv", _key("conv_id")).join(digests(repair.edits), "_conv")
    names = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    return {r.conv_id: tuple(r[n] for n in names) for r in report.collect()}


@pytest.mark.parametrize("chunk_rows, fix_ups", [(1, 2), (3, 0), (5, 100), (4096, 4)])
def test_against_brute_force(spark, chunk_rows, fix_ups):
    rng = random.Random(chunk_rows)
    rows = [r for conv in [*range(12), None] for r in random_turns(rng, conv, rng.randrange(1, 25))]
    rows += [(50, i, "user", "same text") for i in range(20)] + [(51, i, "tool", f"{i}.") for i in range(21)]
    rows += [(52, i, "user", f"{i}") for i in range(20)] + [(52, 20, "assistant", "a.")] + rows[3:9] * 2
    rows += [(53, 0, "system", "S."), (54, 0, "user", "U."), (55, 0, "user", "x.\n"), (55, 1, "assistant", "y. z")]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    repair = repair_conversations(turns, chunk_rows, fix_ups)
    want = {conv: brute_row(conv, part) for conv, part in by_conversation(rows).items()}
    assert rows_out(repair) == want
    # what stands afterwards is well-formed
    kept = {}
    for r in sorted(repaired_turns(repair.edits).collect(), key=lambda r: (str(r.conv_id), r.place, r.part)):
        kept[r.conv_id] = kept.get(r.conv_id, "") + r.role[:1]
    assert all(re.fullmatch("s?(ua)+", k) for k in kept.values()) and kept


def test_mended_chunks_are_those_of_a_run_from_the_true_end():
    rng = random.Random(5)
    for _ in range(300):
        steps = Steps()
        symbols = bytes(rng.randrange(12) for _ in range(rng.randrange(1, 40)))
        end, other = level(END)[0], backward(steps, bytes(rng.randrange(12) for _ in range(9)), level(END)[0])[0][0]
        assert mend(steps, symbols, *backward(steps, symbols, end), other) == backward(steps, symbols, other)


def test_empty_table(spark):
    repair = repair_conversations(spark.createDataFrame([], SCHEMA))
    assert repair.edits.collect() == [] and repair.report.collect() == []


def test_damage(spark):
    rng = random.Random(6)
    rows = [r for conv in [*range(40), None] for r in random_turns(rng, conv, 12)]
    out = []
    for r in damaged(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect():
        out += [(r.conv_id, r.turn, r.role, r.text)] * r.copies
    assert Counter(out) == Counter(brute_damage(rows))


@pytest.mark.skipif(not Path(SMALLEST).is_dir(), reason="test tables not present")
def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALLEST}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hurt = by_conversation(brute_damage(rows))
    got = {r[0]: tuple(r) for r in op11_turn_repair(spark, SMALLEST).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: brute_row(c, hurt[c]) if c in hurt else (c, *nothing) for c in {r[0] for r in rows}}
