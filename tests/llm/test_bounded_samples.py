"""Bounds of the toxicity sample and cost of the secret scan, each against a plain brute force."""

import hashlib
import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tierwright.llm import secret_scan, toxicity

LABELS = "doc_id long, quality int, toxic int"


def test_sample_has_at_most_so_many_rows_of_a_label(spark):
    labels = spark.createDataFrame([(i, 1, i % 3 == 0 and 1 or 0) for i in range(400)], LABELS)
    # one id holds most rows, all of them different texts
    rows = [(i, f"text {i}") for i in range(400)] + [(i, f"other {i} {n}") for i in (0, 1, 3, 4) for n in range(500)] + [(5, None), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for per_class in (400, 20):
        sample = toxicity.training_rows(docs, labels, per_class).collect()
        assert max(sum(r.toxic == x for r in sample) for x in (0, 1)) <= per_class
        assert len({r.text for r in sample}) == len(sample)
    assert sorted(r.text for r in sample) == sorted(r.text for r in toxicity.training_rows(docs.repartition(7), labels, 20).collect())
    assert toxicity.training_rows(docs.limit(0), labels, 20).count() == toxicity.training_rows(docs, labels.limit(0), 20).count() == 0


def test_no_task_ranks_all_labels(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(toxicity, "store", lambda df, label: plans.append(df._jdf.queryExecution().toString()) or df)
    labels, docs = spark.createDataFrame([(1, 1, 1)], LABELS), spark.createDataFrame([(1, "a")], "doc_id long, text string")
    toxicity.training_rows(docs, labels, toxicity.SAMPLE_PER_CLASS)
    physical = plans[0].split("== Physical Plan ==")[1]
    assert "Window" not in physical and physical.count("TakeOrderedAndProject") == 2
    assert "hashpartitioning(toxic" not in physical


def plain_hits(lexicon, folded):
    """Every term tried at every place."""
    found = []
    for start in range(len(folded)):
        if start and folded[start - 1].isalpha():
            continue
        best = None
        for term, weight in lexicon.weights.items():
            word = term.rstrip()
            end = start + len(word)
            cut_off = term.endswith(" ") and end < len(folded) and folded[end].isalpha()
            if folded[start:end] == word and not cut_off and weight > (best[1] if best else 0):
                best = (end, weight)
        around = folded[max(0, start - 40) : start].split()[-1:], folded[start : start + 80].split()[:2]
        phrases = {" ".join(around[0] + around[1][:1]), " ".join(around[1])} if best else set()
        if best and not phrases & lexicon.exceptions:
            found.append((start, *best))
    return found


def test_hits_against_brute_force():
    rng = random.Random(5)
    lexicon = toxicity.Lexicon({"vile ": 3.0, "vil": 2.5, "fool": 4.0, "foolish": 5.0, "rot ": 2.6}, frozenset({"vile river", "old fool"}))
    automaton, parts = lexicon.matcher(), ["vile", "v1le", "vіle", "river", "fool", "f00lish", "old", "rot", "rotten", "de", " ", " ", "\n", ".", "é", "ﬁ"]
    for _ in range(600):
        folded = toxicity.fold("".join(rng.choices(parts, k=rng.randint(0, 14))))
        assert lexicon.hits(folded, automaton) == plain_hits(lexicon, folded)


def plain_extra(text):
    """The method's own kinds, each match held against all spans taken before it."""
    taken = [(c[1], c[2]) for c in secret_scan.candidates(text) if c[0] in secret_scan.BASE_KINDS]
    found = []
    for kind, pattern in (("prefixed", secret_scan.PREFIXED), ("opaque", secret_scan.OPAQUE)):
        for m in pattern.finditer(text):
            if (kind == "prefixed" or secret_scan.looks_random(m[0])) and not any(s < m.end() and m.start() < e for s, e in taken):
                found.append((kind, *m.span()))
                taken.append(m.span())
    return sorted(found)


def test_spans_against_brute_force():
    rng = random.Random(6)
    parts = ["ghp_aB3dE5gH7jK9mN1pQ2", "sk-aB3dE5gH7jK9mN1p", "Zx9" * 9, "aB3dE5gH7jK9mN1pQ2rS4tU6", "0a1b2c3d" * 3, "AKIA" + "Q7" * 8, "token=", "secret: ", " ", " ", "/", "\n"]
    for _ in range(800):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert sorted(c[:3] for c in secret_scan.candidates(text) if c[0] not in secret_scan.BASE_KINDS) == plain_extra(text)


def test_many_spans_in_one_text_take_linear_time():
    text = " ".join(f"sk-aB3dE5gH7jK9mN{i:06d} {hashlib.sha256(str(i).encode()).hexdigest()}" for i in range(20_000))
    started = time.process_time()
    assert len(secret_scan.candidates(text)) == 40_000
    assert time.process_time() - started < 4


def test_ownership_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(f"v{min(rng.randrange(12), 5)}", rng.choice(["a", "b", None, "-", "+"]), rng.choice(["r1", "r2", None])) for _ in range(200)]
    want = defaultdict(lambda: (set(), set(), []))
    for value, owner, repository in rows:
        for held, x in zip(want[value], (owner, repository), strict=False):
            held.add(x)
        want[value][2].append(1)
    frame = spark.createDataFrame(rows, "value_hash string, owner string, repository string")
    got = {r.value_hash: (r.n_owners, r.n_repositories, r.n_copies) for r in secret_scan.ownership(frame).collect()}
    assert got == {v: tuple(map(len, held)) for v, held in want.items()}
    assert secret_scan.ownership(frame.where(F.lit(False))).collect() == []


@pytest.mark.parametrize("text", [None, "", " ", "x" * 200_000, "a1B2" * 50_000])
def test_odd_texts_do_not_stop_the_scan(text):
    secret_scan.candidates(text)
