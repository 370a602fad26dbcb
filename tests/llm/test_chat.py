"""Chat windows: an exact round trip."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tierwright.llm.chat import chat_windows, escape, read_back, unescape

PARTS = ["<|", "|>", "<|end|>\n", "\\", "\\\\", "</s>", "<s>", "[INST]", "[/INST]", "<", "|", ">", "[", "a", "é😀", "\n", " ", "word " * 30]


def turns():
    rng = random.Random(9)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 14)):
            role = "system" if turn == 0 and conv % 3 == 0 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn, role, "".join(rng.choices(PARTS, k=rng.randint(0, 25)))))
    rows += [(70, t, ("user", "assistant")[t % 2], "many turns " * (t % 30)) for t in range(700)]
    rows += [(71, 0, None, None), (71, 1, "assistant", None), (None, 0, "user", "x"), (None, 1, "assistant", "y")]
    rows += [(72, 0, "assistant", "twice")] * 2 + [(73, 0, "assistant", "long " * 40_000), (73, None, "<|odd|>\n", "|")]
    return [(*r, "own", 5) for r in rows]


SCHEMA = "conv_id long, turn long, role string, text string, window string, size int"


def order(row):
    return tuple((v is not None, v) for v in (row[1], row[2] or "", row[3] or ""))


@pytest.mark.parametrize("budget", [(1024, 192), (200, 60)])
def test_round_trip(spark, budget):
    rows = turns()
    windows = chat_windows(spark.createDataFrame(rows, SCHEMA), *budget)
    got = {r.conv_id: r for r in read_back(windows).collect()}
    total = {r.conv_id: r.n for r in windows.groupBy("conv_id").agg(F.sum(F.length("formatted")).alias("n")).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=order)
        assert r.n_turns == len(own)
        whole = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        learned = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert r.formatted_chars == total[conv]


def test_windows_keep_system_and_budget(spark):
    said = [(1, 0, "system", "be brief")] + [(1, t, ("assistant", "user")[t % 2], f"turn {t} " * 9) for t in range(1, 90)]
    rows = chat_windows(spark.createDataFrame([(*r, "", 0) for r in said], SCHEMA), 200, 40).orderBy("window").collect()
    assert len(rows) > 5
    for r in rows:
        assert r.formatted.startswith("<|system|>\nbe brief<|end|>\n")
        assert len(r.formatted.encode()) <= 4 * 200
    assert rows[1].new_from > len("<|system|>\nbe brief<|end|>\n")


def tokens(role, text):
    return -(-len(f"<|{role}|>\n{text}<|end|>\n".encode()) // 4)


def plain_windows(own, budget, history):
    """Brute force for texts without control strings: for each window its lead, repeated and new turns."""
    sizes = [tokens(r, t) for r, t in own]
    begins = [sum(sizes[:i]) for i in range(len(own))]
    system = [i for i, (r, _) in enumerate(own) if r == "system"]
    room = max(budget - history - sum(sizes[i] for i in system), budget // 8)
    out, upto, stretch = [], -1, None
    for i in range(len(own)):
        border, stretch = begins[i] // (16 * budget) != stretch, begins[i] // (16 * budget)
        if border or begins[i] + sizes[i] > upto:
            upto = begins[i] + (budget if i == 0 else room)
            past = [j for j in range(i) if begins[j] >= begins[i] - history and own[j][0] != "system"]
            out.append((system[:1] if system and system[0] < i else [], past, []))
        out[-1][2].append(i)
    return out


@pytest.mark.parametrize("budget, history", [(200, 40), (1024, 192)])
def test_windows_against_brute_force(spark, budget, history):
    rng = random.Random(11)
    rows = []
    for conv in range(25):
        for turn in range(rng.choice([3, 40, 400])):
            role = "system" if turn == (0 if conv % 2 else 5) else ("user", "assistant")[turn % 2]
            long = budget * 5 if rng.random() < 0.02 else budget
            rows.append((conv, turn, role, "x" * rng.randrange(long), "", 0))
    # turns of 400 and 900 tokens do not share a window
    rows += [(90, 0, "user", "u" * 1580, "", 0), (90, 1, "assistant", "a" * 3580, "", 0)]
    rows += [(91, t, "system", "", "", 0) for t in range(3000)]
    got = {}
    for r in chat_windows(spark.createDataFrame(rows, SCHEMA), budget, history).orderBy("conv_id", "window").collect():
        got.setdefault(r.conv_id, []).append((r.formatted, r.new_from, len(r.loss)))
    for conv, windows in got.items():
        own = [(x[2], x[3]) for x in sorted((x for x in rows if x[0] == conv), key=order)]
        wanted = []
        for lead, past, new in plain_windows(own, budget, history):
            before, fresh = ["".join(f"<|{own[j][0]}|>\n{own[j][1]}<|end|>\n" for j in part) for part in (lead + past, new)]
            wanted.append((before + fresh, len(before), sum(own[j][0] == "assistant" for j in new)))
            spent = sum(tokens(*own[j]) for j in lead + past + new)
            assert spent <= budget or len(new) == 1
        assert windows == wanted
    assert len(got[90]) == 2


def test_escape(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 8))) for _ in range(800)]
    table = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", escape(F.col("t"))).withColumn("u", F.expr(unescape("e")))
    for r in table.collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("<|", "|>", "</s>", "<s>", "[INST]", "[/INST]"))


def test_empty_table(spark):
    assert read_back(chat_windows(spark.createDataFrame([], SCHEMA))).count() == 0
