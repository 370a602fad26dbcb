import random
import zlib

import numpy as np
import pytest

from tierwright.llm.packing import default_tokenizer, encoder, pack_documents, pack_histogram

SCHEMA = "doc_id long, text string, length string, one int"


@pytest.fixture(scope="module")
def reference_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_equal_those_of_tokenizers(reference_ids):
    rng = random.Random(5)
    parts = "a é ² 3 _ ' s 's 're . , ß 漢 😀 ! The - ० <|endoftext|>".split() + list("  \n\t\r\v\x1c\x85\xa0") + ["\n\n", "́"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 9)))
        got = np.frombuffer(encoder(default_tokenizer()).encode(text), "<u4").tolist()
        assert got == reference_ids(text), repr(text)


def test_histogram_keeps_every_length():
    histogram = {1024: 3, 700: 5, 324: 9, 10: 1000, 1: 1}
    packs = pack_histogram(histogram)
    counted = {}
    for count, pattern in packs:
        assert sum(pattern) <= 1024
        for length in pattern:
            counted[length] = counted.get(length, 0) + count
    assert counted == histogram


def test_every_id_lies_in_one_piece(spark, reference_ids):
    long = "very long text, " * 3000
    rows = [(i, f"word {i} " * (i % 90), "x", 7) for i in range(300)]
    rows += [(1000, None, None, None), (1001, "", "x", 1), (None, "no id", "x", 1), (1002, long, "x", 1), (3, "word 3 " * 3, "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = pack_documents(docs, default_tokenizer()).toPandas()
    texts = [(None if i is None else i, t or "") for i, t, *_ in rows]
    want = []
    for doc_id, text in texts:
        ids = np.asarray([*reference_ids(text), 0], dtype="<u4")
        for start in range(0, len(ids), 1024):
            piece = ids[start : start + 1024]
            want.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
    have = [
        (None if r.doc_id != r.doc_id else int(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens)
        for r in got.itertuples()
    ]
    key = lambda t: tuple(-1 if v is None else v for v in t)
    assert sorted(have, key=key) == sorted(want, key=key)
    got = got.sort_values(["sequence_id", "offset"])
    assert (got["offset"] == got.groupby("sequence_id")["length"].cumsum() - got["length"]).all()
    assert got.groupby("sequence_id")["length"].sum().max() <= 1024
    assert sorted(got["sequence_id"].unique()) == list(range(got["sequence_id"].nunique()))


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA), default_tokenizer()).count() == 0


def test_added_tokens_have_their_ids(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    rng = random.Random(6)
    parts = ["<|endoftext|>", "a", " ", "  ", "\n", "\n\n", "'s", "é", "<|", "3", "endoftext"]
    texts = ["a <|endoftext|> b", *("".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(1000))]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in pack_documents(docs, default_tokenizer()).collect()}
    for i, text in enumerate(texts):
        ids = np.asarray([*tokenizer.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        assert got[i] == (len(ids), zlib.crc32(ids.tobytes())), repr(text)
