"""Operators that judge each text: language, quality, secrets, toxicity."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierwright.llm import language, quality, secret_scan, toxicity

TEXTS = [None, "", " \n\t", "12 34", "word", "a b c a b c a b c\na b c\n\na b c", "ünï 漢字 😀 text", "x " * 9000]


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    marked = {k + d for k, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(marked), len(words) < 50 or 100 * len(marked) > 50 * len(words)


def test_quality_counts(spark):
    rng = random.Random(2)
    texts = TEXTS[:-1] + ["".join(rng.choices(["a", "b", "é", "#", " ", "\n", "\x1f", "\x85"], k=rng.randint(0, 120))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, _quality string")
    judged, q = quality.apply_quality(docs)
    for r in judged.select("text", f"{q}.*").collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(r.text)
        assert not (r.kept and r.base_failed)


def written(rng, first, letters, lengths, size):
    """Made-up prose of a script: Zipf-weighted words of its letters, up to ``size`` bytes."""
    words = ["".join(chr(first + rng.randrange(letters)) for _ in range(rng.choice(lengths))) for _ in range(8000)]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = ""
    while len(text.encode()) < size:
        text += " ".join(rng.choices(words, weights, k=12)) + ". "
    return text


@pytest.mark.parametrize("size", [543, 1374, 2133, 3822, 8187, 21_876, 48_930])
def test_bands_keep_scripts_of_several_bytes_a_letter(size):
    import zstandard

    z = zstandard.ZstdCompressor(level=3)
    # characters of Han, syllables of Hangul, letters of Cyrillic
    for first, letters, lengths in ((0x4E00, 3500, (1, 2, 2, 3)), (0xAC00, 2000, (2, 3, 4)), (0x430, 32, (3, 5, 7, 9))):
        for seed in range(6):
            rng = random.Random(seed)
            assert quality.compression(written(rng, first, letters, lengths, size), z)[2], (first, seed)
            noise = "".join(chr(first + rng.randrange(letters)) for _ in range(size // 3))
            if letters > 1000 and size >= 2133 * 3 // 2:
                assert not quality.compression(noise, z)[2], (first, seed)


def test_lower_limit_follows_the_bytes_of_a_character():
    assert quality.lower_limit(1.75, b"abc") == 1.75
    assert quality.lower_limit(1.75, "жжж".encode()) == pytest.approx(1 + 0.75 * 0.88)
    assert quality.lower_limit(1.75, "汉字".encode()) == pytest.approx(1 + 0.75 * 0.76)
    assert quality.lower_limit(1.75, "汉字".encode()[1:2]) > 1  # a chunk that cuts a character


def test_quality_of_an_empty_table(spark):
    judged, q = quality.apply_quality(spark.createDataFrame([], "doc_id long, text string"))
    assert judged.select(f"{q}.*").count() == 0


def test_compression_bands():
    import zstandard

    rng, z = random.Random(1), zstandard.ZstdCompressor(level=3)
    prose = " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(900))
    noise = " ".join("".join(rng.choices("ABCDEFGHIJabcdefghij0123456789+/", k=60)) for _ in range(300)).encode("utf-8").hex()
    blob = " ".join("".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(9)) for _ in range(400))
    assert quality.measure(prose, z)[6]
    assert not quality.measure("the same line over again\n" * 300, z)[6]
    assert quality.measure(blob, z)[7] < quality.BANDS[2][1] + 0.4
    assert len(noise) > 0


@pytest.mark.parametrize(
    ("letters", "sizes"),
    [
        ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", (450, 500, 1000, 1500, 10_000)),
        ("".join(map(chr, range(33, 127))), (450, 500, 1000, 1500, 10_000)),
        ("abcdefghijklmnopqrstuvwxyz", (3000, 10_000)),
        ("0123456789abcdef", (10_000,)),
    ],
)
def test_noise_is_rejected(letters, sizes):
    import zstandard

    rng, z = random.Random(7), zstandard.ZstdCompressor(level=3)
    for size in sizes:
        text = " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(size))[:size]
        assert not quality.compression(text, z)[2], size


def test_a_noisy_rest_counts():
    import zstandard

    rng, z = random.Random(8), zstandard.ZstdCompressor(level=3)
    prose = " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(900))[:2048]
    noise = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=1900))
    assert quality.compression(prose, z)[1] == 0 and quality.compression(prose + noise, z)[1] > quality.BAD_CHUNKS


def test_secrets_against_plain_patterns(spark):
    rng = random.Random(3)
    parts = ["password", "Token", "API_KEY", "secret", ": ", "=", " ", '"', "AKIA" + "Q7" * 8, "AKIAQ", "0a1b2c3d" * 3, "0a1b2c3d" * 2, "abcde", "abcdefg", "ſecret", "\n", "é"]
    texts = TEXTS[:-1] + ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(400)]
    docs = spark.createDataFrame([(i, t, "s" + str(i % 3), 1) for i, t in enumerate(texts)], "doc_id long, text string, source string, row int")
    staged, judged, column = secret_scan.scan_secrets(docs)
    got = {}
    for r in staged.select("doc_id", f"{column}.found").collect():
        got[r.doc_id] = [(c["kind"], c["first"], c["last"]) for c in r.found if c["kind"] in secret_scan.BASE_KINDS]
    order = {k: i for i, k in enumerate(secret_scan.BASE_KINDS)}
    for i, text in enumerate(texts):
        text = text or ""
        want = [("assign", *m.span()) for m in secret_scan.ASSIGN.finditer(text) if len(m[2]) >= 6]
        want += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert got[i] == sorted(want, key=lambda s: (s[1], order[s[0]]))


def test_widely_copied_values_are_not_live(spark):
    own, common = hashlib.sha256(b"own").hexdigest()[:32], hashlib.sha256(b"common").hexdigest()[:32]
    rows = [(i, f"see token = {common} number {i}", f"owner{i}", 0) for i in range(9)] + [(99, f"my token = {own}", "owner1", 0), (100, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    out = {r.doc_id: r for r in secret_scan.redact(docs).collect()}
    assert len(out) == len(rows) and common in out[3].text
    assert own not in out[99].text and out[99].n_chars == len(out[99].text) and out[100].text is None


def test_a_key_in_many_texts_of_one_owner_is_live(spark):
    own = hashlib.sha256(b"many").hexdigest()[:32]
    rows = [(i, f"my token = {own} number {i}", "owner1", 0) for i in range(45)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    assert not any(own in r.text for r in secret_scan.redact(docs).collect())


@pytest.mark.parametrize("value", ["sk-aB3dE5gH7jK9mN1p", "eyJaB3dE5gH7jK9mN1p"])
def test_prefixed_tokens_of_19_characters(value):
    assert [c[:3] for c in secret_scan.candidates(f"x {value} y")] == [("prefixed", 2, 21)]


def corpus(n):
    rng = random.Random(4)
    stems = {"aa": ["lor", "em", "ip", "sum"], "bb": ["zwi", "kra", "ont", "ube"], "cc": ["ñad", "éle", "que", "ina"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(stems))
        words = ["".join(rng.choices(stems[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(20, 90))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            words[5] = rng.choice(["vilethings", "V1leth1ngs", "vіleword"])
        rows.append((i, " ".join(words), lang, toxic))
    return rows


def test_language_held_out(spark):
    rows = [(i, t, lang) for i, t, lang, _ in corpus(400)] + [(900 + k, t, None) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged, name = language.with_language(docs)
    right = total = 0
    for r in judged.select("doc_id", "text", "lang", f"{name}.*").collect():
        assert 0 <= r.score <= 1
        if r.lang:
            held = zlib.crc32(str(r.doc_id).encode()) % 5 == 0
            right, total = right + (held and r.lang == r.lang_pred), total + held
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))
    assert right >= 0.95 * total > 0
    assert language.reject_unknown(docs).columns == docs.columns


def test_phrases_against_plain_search():
    rng = random.Random(6)
    model = language.Models.build({"x": ["abra cadabra abba"], "y": ["kalo kilo mela"]})
    alphabet = language.Alphabet(model.letters)
    samples = {n: alphabet.symbols(t).tolist() + [language.SPACE] for n, t in (("x", "abra cadabra abba"), ("y", "kalo kilo mela"))}
    spans = [alphabet.symbols("".join(rng.choices("abrkilo e", k=rng.randint(1, 40)))) for _ in range(60)]
    spans = [s for s in spans if len(s)]
    got = language.phrases(spans, model)

    def inside(part, whole):
        return any(whole[k : k + len(part)] == part for k in range(len(whole) - len(part) + 1))

    for column, span in enumerate(spans):
        for k, name in enumerate(model.languages):
            seq, count, at = span.tolist(), 1, 0
            for end in range(1, len(seq) + 1):
                if not inside(seq[at:end], samples[name]):
                    # the first symbol of all opens the first phrase, known or not
                    count, at = count + 1, end - 1
                    if not inside(seq[at:end], samples[name]):
                        at = end
            assert got[k, column] == count


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    judged, name = language.with_language(docs)
    assert judged.select(f"{name}.lang_pred").first()[0] == "und"
    assert language.with_language(docs.limit(0))[0].count() == 0


def test_toxicity_held_out(spark):
    rows = corpus(800)
    docs = spark.createDataFrame([(i, t, "x") for i, t, *_ in rows] + [(9000 + k, t, "x") for k, t in enumerate(TEXTS)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, x) for i, _, _, x in rows] + [(9001, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learn_lexicon(docs, labels)
    scores = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.toxicity(lexicon, F.col("text")).alias("s")).collect()}
    held = [(scores[i] >= toxicity.PREDICT_AT, x == 1) for i, _, _, x in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert all(0 <= s <= 1 for s in scores.values()) and scores[9000] == 0
    empty = toxicity.learn_lexicon(docs.limit(0), labels.limit(0))
    assert docs.select(toxicity.toxicity(empty, F.col("text"))).count() == docs.count()


def test_exceptions_excuse():
    lexicon = toxicity.Lexicon({"vile": 3.0}, frozenset({"vile river"}))
    automaton = lexicon.matcher()
    assert lexicon.density("a v1le man", automaton) > 0
    assert lexicon.density("the vile river runs", automaton) == 0
    assert lexicon.density("devile", automaton) == 0


@pytest.mark.parametrize("text", TEXTS)
def test_candidates_of_odd_texts(text):
    assert secret_scan.candidates(text) == []
