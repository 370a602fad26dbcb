import hashlib
import random
import re
import time
from pathlib import Path

import pytest

from tierwright.llm.periodic_runs import op12_period_tiles, periodic_runs, repeat_a_part, runs_of, z_function

SMALLEST = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, _row int, runs string, octave string"


def brute_runs(words, least=24, copies=3):
    """(start, length, period) from comparing all words with those of every period."""
    n, found = len(words), []
    for q in range(1, n // copies + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, copies * q):
                stretch = words[i : j + q]
                if not any(all(x == y for x, y in zip(stretch, stretch[d:])) for d in range(1, q)):
                    found.append((i, j + q - i, q))
            i = j + 1 if j == i else j
    return sorted(found)


def brute_row(doc_id, text, rewrite=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if rewrite:
        words = repeat_a_part(words, None if doc_id is None else str(doc_id))
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = None
    for s, n, q in runs:
        if top is None or n * top[2] > top[1] * q:
            top = (s, n, q)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    best = (*top, top[1] * 1000 // top[2]) if top else (None,) * 4
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)]
    return (doc_id, len(runs), *best, *sha)


def text_with_runs(rng, n):
    words = []
    while len(words) < n:
        period = [rng.choice("abcdefgh") for _ in range(rng.choice([1, 1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 33, 40]))]
        times = rng.choice([1, 1, 2, 3, 3, 4, 9, 30])
        words += (period * times)[: len(period) * times - rng.randrange(len(period))]
        words += [rng.choice("abxyz") for _ in range(rng.choice([0, 0, 1, 2, 10]))]
    return words[:n]


def test_z_function():
    rng = random.Random(1)
    for _ in range(50):
        s = [rng.randrange(2) for _ in range(rng.randrange(30))]
        want = [next((k for k in range(len(s) - i) if s[i + k] != s[k]), len(s) - i) for i in range(len(s))]
        assert z_function(s) == want


def test_one_tile_against_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        words = text_with_runs(rng, rng.randrange(1, 300))
        assert sorted((s, e - s, q) for q, s, e in runs_of(words)) == brute_runs(words), words


def test_shorter_runs_against_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        words = text_with_runs(rng, rng.randrange(1, 120))
        for least, copies in ((1, 3), (10, 2), (6, 4)):
            got = sorted((s, e - s, q) for q, s, e in runs_of(words, least, copies))
            assert got == brute_runs(words, least, copies), (words, least, copies)


@pytest.mark.parametrize("tile_words", [16, 100, 65_536])
def test_tiles_against_brute_force(spark, tile_words):
    rng = random.Random(4)
    texts = [None, "", " \n ", "a", "a " * 23, "a " * 24, "a  b\n" * 12, "a b " * 30]
    texts += [" ".join(text_with_runs(rng, n)) for n in (30, 100, 300, 500, 900)]
    rows = [(i, t, 1, "r", "o") for i, t in enumerate(texts)]
    rows += [(None, texts[-1], 0, "", ""), (None, None, 0, "", ""), rows[9], rows[9], (8, "b " * 50, 0, "", "")]
    out = periodic_runs(spark.createDataFrame(rows, SCHEMA), tile_words=tile_words).collect()
    assert len(out) == len(rows)
    got = sorted((str(r.doc_id), [tuple(x) for x in r.runs], r.collapsed_sha256) for r in out)
    want = []
    for doc_id, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        want.append((str(doc_id), brute_runs(words), brute_row(doc_id, text, rewrite=False)[-1]))
    assert got == sorted(want)


def test_long_text_of_one_word(spark):
    """No period but the shortest is followed up, however long the text."""
    started = time.monotonic()
    rows = [(1, "a " * 300_000 + "b " + "c d " * 20_000, 0, "", "")]
    out = periodic_runs(spark.createDataFrame(rows, SCHEMA)).first()
    assert [tuple(r) for r in out.runs] == [(0, 300_000, 1), (300_001, 40_000, 2)]
    assert out.collapsed == "a b c d"
    assert time.monotonic() - started < 120


def test_empty_table(spark):
    assert periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_rewritten_part():
    words = list("abcdefghij")
    for i in range(2_000):
        out = repeat_a_part(words, str(i))
        assert len(out) == 10
    assert repeat_a_part(words, None) == words and repeat_a_part([], "9") == []


@pytest.mark.skipif(not Path(SMALLEST).is_dir(), reason="test tables not present")
def test_query(spark):
    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet").select("doc_id", "text").collect()
    short = {d.doc_id: d.text for d in docs if len(d.text or "") < 6_000}
    got = {r[0]: tuple(r) for r in op12_period_tiles(spark, SMALLEST).collect()}
    assert len(got) == len(docs)
    for doc_id, text in short.items():
        assert got[doc_id] == brute_row(doc_id, text)
