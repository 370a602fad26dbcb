"""How the sets of the n-gram join are hashed, dealt and compared, and in what memory."""

import numpy as np
import pandas as pd

from tierwright.llm import ngram_join


def test_sets_do_not_depend_on_how_texts_are_hashed_together(monkeypatch):
    texts = [None, "", " \n", "a", "A b", "a b c", "a b c d", "a " * 9, "\ud800 x y z w", "É é x y\x0bz\x1cq", "p q r s t u v w"]
    whole = list(ngram_join.shingle_sets(texts, 4))
    assert [len(s) for s in whole] == [0, 0, 0, 1, 1, 1, 1, 1, 2, 2, 5]
    monkeypatch.setattr(ngram_join, "CHUNK_WORDS", 1)  # every text alone
    alone = list(ngram_join.shingle_sets(texts, 4))
    assert all((a == b).all() for a, b in zip(whole, alone, strict=True))


def test_elements_are_dealt_some_at_a_time_however_rows_come_in(monkeypatch):
    texts = [f"w{i} x{i} y{i} z{i} v{i}" for i in range(10)] * 2
    monkeypatch.setattr(ngram_join, "GATHERED", 6)
    runs = list(ngram_join._gathered(iter([pd.DataFrame({"text": texts[:13]}), pd.DataFrame({"text": texts[13:]})]), 4))
    assert [sum(len(s) for s, _ in run) for run in runs] == [6, 6, 6, 2]  # repeated texts once


def test_a_block_is_compared_in_strips_of_bounded_memory():
    import tracemalloc

    n = 2_000  # near copies: 40 elements of a family of their own and one of each set
    own = np.arange(n, dtype="uint64") + np.uint64(1 << 40)
    sets = [np.sort(np.append(np.arange(40, dtype="uint64") + np.uint64(1000 * (i % 2)), own[i])) for i in range(n)]
    block = pd.DataFrame({"node": np.arange(n), "component": np.arange(n), "elements": [s.tobytes() for s in sets]})
    tracemalloc.start()
    links = ngram_join.block_links(block, ngram_join.Rule())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # a star around the smallest of either family
    assert sorted(zip(links["a"], links["b"])) == sorted((i % 2, i) for i in range(2, n))
    assert peak < 80e6


def test_texts_go_to_python_in_small_batches(spark):
    from tierwright.llm.common import BATCH_BYTES, TEXT_BATCH, small_batches

    session = spark.newSession()
    small_batches(session)
    assert session.conf.get(BATCH_BYTES) == TEXT_BATCH
    session.conf.set(BATCH_BYTES, "1m")
    small_batches(session)
    assert session.conf.get(BATCH_BYTES) == "1m"
