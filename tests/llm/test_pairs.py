"""Similarity joins and components against brute force."""

import random
import re

import numpy as np
import pytest

from tierwright.llm import ngram_join, spherical
from tierwright.llm.components import components
from tierwright.llm.ngram_join import Rule, keep_one_of_each, ngram_components


def smallest_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1150)] + [(2000, k) for k in range(2001, 2300)]
    want = smallest_reachable({n for ab in links if ab[0] != ab[1] for n in ab}, links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_sets(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[k : k + words]) for k in range(len(found) - words + 1)}


def near_copies(n):
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(300)]
    bases = [[rng.choice(vocabulary) for _ in range(size)] for size in (5, 8, 9, 12, 20, 45, 90, 150, 300) for _ in range(6)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 3))):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            words += passage
        rows.append((i, " ".join(words)))
    family = list(bases[-1])[:150]
    for i in range(n, n + 130):  # one large family, walking away from its first text
        family[rng.randrange(len(family))] = rng.choice(vocabulary)
        rows.append((i, " ".join(family)))
    odd = [None, "", " \n", "A", "a", "B c", "ÄB ÄB", "äB äB", "x " * 6000, "x " * 6000 + "y"]
    return rows + [(n + 200 + k, t) for k, t in enumerate(odd)] + [(3, rows[3][1])]


@pytest.mark.parametrize("rule", [Rule(), Rule(5, 80)])
@pytest.mark.parametrize("limits", [(64, 48), (4, 5)])
def test_ngram_join_equals_brute_force(spark, monkeypatch, rule, limits):
    monkeypatch.setattr(ngram_join, "FREQUENT", limits[0])
    monkeypatch.setattr(ngram_join, "SHORT_LIST", limits[1])
    rows = near_copies(250)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, name string").repartition(5)
    sets = {i: brute_sets(t, rule.words) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= rule.percent * len(sets[a] | sets[b])
    ]
    want = smallest_reachable(ids, links)
    got = ngram_components(docs, rule).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((i, len(sets[i]), want[i]) for i, _ in rows)
    if limits[0] == 64:
        kept = keep_one_of_each(docs, rule)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted({i for i in ids if want[i] == i})


def test_ngram_join_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_components(empty).count() == 0
    nulls = spark.createDataFrame([(None, "some words are here now"), (None, None), (1, "other words are there then")], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.component_id is None) for r in ngram_components(nulls).collect()) == [(False, False), (True, True), (True, True)]


def vectors(n, d=24):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((n // 3, d))
    rows = []
    for k in range(n):
        v = centres[k % len(centres)] + rng.standard_normal(d) * rng.choice([0.02, 0.1, 0.22])
        rows.append((k, [float(x) for x in v.astype("float32")]))
    hot = rng.standard_normal(d)
    rows += [(n + k, [float(x) for x in (hot + rng.standard_normal(d) * 0.1).astype("float32")]) for k in range(150)]
    rows += [(n + 500 + k, rows[0][1]) for k in range(4)]
    nan = float("nan")
    odd = [None, [], [0.0] * d, [nan] * d, [float("inf")] + [1.0] * (d - 1), [None] + [1.0] * (d - 1), [1.0, 2.0], [1e30] * d, [1e-30] * d]
    return rows + [(n + 600 + k, v) for k, v in enumerate(odd)]


def test_spherical_caps_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spherical, "LIST_BLOCK", 60)
    rows = vectors(600)
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, node int, f string").repartition(5)
    good = {i: np.asarray(v, dtype="float32").astype("float64") for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    ids = sorted(good)
    links = set()
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if len(good[a]) == len(good[b]):
                x, y = good[a] / np.abs(good[a]).max(), good[b] / np.abs(good[b]).max()
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                    links.add((a, b))
    got = {r.vec_id: r for r in spherical.near_duplicates(table).collect()}
    assert len(got) == len(rows)
    degree = dict.fromkeys(got, 0)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    assert all(got[i].n_links <= degree[i] for i in got)
    assert sum(r.n_links for r in got.values()) >= 0.98 * 2 * len(links) > 0
    want = smallest_reachable(sorted(got), links)
    same = [got[i].component_id == want[i] for i in got]
    assert np.mean(same) > 0.98
    assert all(got[i].kept == (got[i].component_id == i) for i in got)
    assert spherical.near_duplicates(table.limit(0)).count() == 0


def test_decoding_finds_every_exceeding_filter():
    code = spherical.ProductCode.build(12, 200)
    x = np.random.default_rng(5).standard_normal((40, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    scores = code.scores(x)
    total = scores[0]
    for s in scores[1:]:
        total = (total[:, :, None] + s[:, None, :]).reshape(len(x), -1)
    for k, found in enumerate(code.decode(x)):
        assert set(np.flatnonzero(total[k] >= code.threshold)) <= set(found.tolist())


@pytest.mark.parametrize("points", [10_000, 1_000_000])
def test_recall_does_not_fall_as_the_table_grows(points):
    x, y = spherical.made_pairs(np.random.default_rng(9), 3_000, 64, spherical.COSINE)
    codes = spherical.product_codes(64, points, spherical.codes_needed(64, points, spherical.COSINE))
    missed = 0
    for at in range(0, len(x), 200):
        a, b = (spherical.decode_all(codes, v[at : at + 200]) for v in (x, y))
        missed += sum(not set(p.tolist()) & set(q.tolist()) for p, q in zip(a, b, strict=True))
    assert missed <= 0.002 * len(x)
