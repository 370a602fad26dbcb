import zlib

import pytest

from tierwright.llm.mixing import materialise_mix, mix_sources
from tierwright.llm.sharding import shard_documents

SCHEMA = "doc_id long, text string, source string, size string, shard int, target string"


def rows(n):
    out = [(i, "word " * (i * 7 % 40), f"s{i % 3}" if i % 4 else "s0", "x", 9, None) for i in range(n)]
    return out + [(None, "no id", None, None, None, None), (5, None, "s1", "x", 1, "t"), (5, None, "s1", "x", 1, "t"), (n, "w " * 5000, None, "x", 1, "t")]


def test_shards_are_contiguous_and_balanced(spark):
    data = rows(200)
    got = shard_documents(spark.createDataFrame(data, SCHEMA), 5).toPandas()
    assert len(got) == len(data)
    sizes = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in data)
    assert sorted(zip(got["size"], got["text_crc32"], strict=True)) == sizes
    for _, shard in got.groupby("shard"):
        assert sorted(shard["slot"]) == list(range(len(shard)))
    known = got.dropna(subset=["doc_id"]).sort_values(["doc_id", "slot"])
    assert known["shard"].is_monotonic_increasing
    total, largest = got["size"].sum(), got["size"].max()
    assert (got.groupby("shard")["size"].sum() - total / 5).abs().max() <= largest


@pytest.mark.parametrize("n", [0, 300])
def test_mix_meets_budgets(spark, n):
    data = rows(n)
    got = mix_sources(spark.createDataFrame(data, SCHEMA)).toPandas()
    size = {}
    for _, text, source, *_ in data:
        size[source] = size.get(source, 0) + len((text or "").split())
    names = sorted(s for s in size if s is not None) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(size.values()), set()
    while True:  # share, cap, share the excess again
        left = total - sum(3 * size[s] for s in capped)
        w = sum(weight[s] for s in names if s not in capped)
        target = {s: 3.0 * size[s] if s in capped else left * weight[s] / w for s in names}
        over = {s for s in names if s not in capped and target[s] > 3 * size[s]}
        if not over:
            break
        capped |= over
    for source, part in got.groupby(got["source"].fillna("none")):
        s = None if source == "none" else source
        assert part["target"].iloc[0] == pytest.approx(target[s])
        assert part["source_size"].iloc[0] == size[s]
        assert abs(part["taken"].sum() - target[s]) < 1
        assert (part["taken"] <= 3 * part["size"]).all()


@pytest.mark.parametrize("extra", [[], [(7, "same row " * 3, "s2", "x", 1, "t")] * 150])
def test_materialised_mix_has_the_words_taken(spark, extra):
    docs = spark.createDataFrame(rows(100) + extra, SCHEMA).withColumnRenamed("shard", "_cut")
    mixed = materialise_mix(docs)
    assert mixed.columns == docs.columns
    taken, mixed_words = {}, {}
    for r in mix_sources(docs).collect():
        taken[r.doc_id, r.source] = taken.get((r.doc_id, r.source), 0) + r.taken
    texts = {}
    for r in docs.collect():
        texts.setdefault((r.doc_id, r.source), set()).add(r.text)
    shortened = 0
    for r in mixed.collect():
        name = (r.doc_id, r.source)
        mixed_words[name] = mixed_words.get(name, 0) + len((r.text or "").split())
        if r.text not in texts[name]:
            shortened += 1
            assert any((t or "").startswith(r.text) for t in texts[name])
    assert {k: n for k, n in mixed_words.items() if n} == {k: n for k, n in taken.items() if n}
    assert shortened <= 4  # one cut a source
    wordless = [r for r in docs.collect() if not (r.text or "").split()]
    assert sum(not (r.text or "").split() for r in mixed.collect()) == len(wordless)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert shard_documents(empty).count() == mix_sources(empty).count() == materialise_mix(empty).count() == 0
