"""Rows that must not be lost, linked rows without ids, bounds on samples, and columns of any name."""

import random

import pytest

from tierwright.llm.language import learn_models, reject_unknown
from tierwright.llm.ngram_join import Rule, keep_one_of_each, ngram_components
from tierwright.llm.secret_scan import redact

LETTERS = "abcdefghijklmnopqrstuvwxyz"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, _live string, _row int"


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(6)) for _ in range(n)]


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), 1, "x", 2) for i, t, lang in rows], DOCS)


def chain():
    """A - B - C, where A and C link only through B (4-word shingles, 85 of 100)."""
    base = words(400, 1)
    a, c = list(base), list(base)
    a[:24], c[-24:] = words(24, 2), words(24, 3)
    return " ".join(a), " ".join(base), " ".join(c)


@pytest.mark.parametrize("middle", [5, None])
def test_links_through_a_row_without_id(spark, middle):
    a, b, c = chain()
    rows = [(1, a), (middle, b), (2, c), (9, "another text of six words")]
    out = {(r.doc_id, r.component_id) for r in ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {(1, 1), (middle, 1), (2, 1), (9, 9)}


def test_different_texts_under_one_id_stay(spark):
    one, two = " ".join(words(40, 4)), " ".join(words(40, 5))
    rows = [(7, one, "en"), (7, two, "en"), (7, two, "en"), (8, one, "en"), (None, two, "en"), (None, " ".join(words(40, 6)), "en")]
    rows += [(7, None, "en"), (7, "", "en"), (None, None, "en"), (3, " \n", "en")]
    kept = keep_one_of_each(docs_frame(spark, rows), Rule(words=5, percent=80))
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    texts = sorted((str(r.doc_id), r.text or "") for r in kept.collect())
    assert texts == sorted(
        [("7", one), ("7", two), ("None", rows[5][1]), ("7", ""), ("7", ""), ("None", ""), ("3", " \n")]
    )


def test_near_duplicates_of_empty_tables(spark):
    assert keep_one_of_each(docs_frame(spark, []), Rule(words=5, percent=80)).collect() == []


def test_language_sample_is_bounded_by_rows(spark):
    rows = [(4, f"the {w} text of one id repeated often and in many forms", "en") for w in words(500, 7)]
    models = learn_models(docs_frame(spark, rows + [(5, "un texte en langue", "fr")]), per_language=5)
    assert models.languages == ["en", "fr"]
    learned = models.bits[models.languages.index("en")]
    assert 0 < learned < 10  # 5 texts of some 60 symbols each: 2 ** bits places


def test_foreign_texts_go_whatever_their_length(spark):
    rng = random.Random(8)
    clean = "the morning train to the coast was late and the people on the platform read their papers "
    labelled = [(i, clean * 3 + f" {w}", "en") for i, w in enumerate(words(60, 9))]
    noise = [(1000 + n, "".join(rng.choice(LETTERS) for _ in range(n)), None) for n in (200, 300, 480, 900, 3_000)]
    short = [(2000, "a", None), (2001, "the people", None), (2002, "on the platform", None)]
    none = [(3000, None, None), (3001, "", None), (3002, "12 34", None)]
    kept = reject_unknown(docs_frame(spark, labelled + noise + short + none).withColumnRenamed("_row", "_language"))
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {r[0] for r in labelled + short} and "_language" in kept.columns
    assert reject_unknown(docs_frame(spark, [])).collect() == []


def test_redact_with_columns_of_its_own_names(spark):
    secret = "AKIA" + "Q7ZK3M9XW2LB8VN4"
    rows = [(1, f"key {secret} end", "en"), (2, None, "en"), (3, "", "en"), (4, "nothing here", "en"), (4, "nothing here", "en")]
    out = sorted(redact(docs_frame(spark, rows)).collect(), key=lambda r: (r.doc_id, r.text or ""))
    assert [r.text for r in out] == ["key [REDACTED] end", None, "", "nothing here", "nothing here"]
    assert all((r.row, r._live, r._row) == (1, "x", 2) for r in out) and out[0].n_chars == 18
    assert redact(docs_frame(spark, [])).collect() == []
