"""Quality rules: word and line counts, and bands of zstandard compression ratios."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, free_name, read_table

# (bytes from, least ratio, largest ratio) of whole documents, and of their chunks.  Short texts compress
# less: the frame and the first occurrence of everything weigh more.
# Lower limits lie between base64 noise and clean text, from 2,048 bytes also above random letters, from 8,192
# above random hex; below that clean text compresses no better than those.
BANDS = ((0, 1.25, 3.0), (512, 1.33, 3.2), (1024, 1.4, 3.2), (2048, 1.75, 3.6), (8192, 1.95, 4.2), (65536, 2.0, 5.0))
CHUNK_BYTES = 2048
CHUNK_BAND = (1.4, 3.6)
REST_BYTES = 512  # a shorter rest of a chunked text is too small a share of it to decide
BAD_CHUNKS = 0.3
# What a lower limit asks for beyond 1 shrinks by this share for each byte of a character beyond the first: a
# script of many characters says more in each, and its clean text compresses less.
SCRIPT_SHARE = 0.12
SYMBOLS = "#*$%&|<>"
# White space to str.split that is no word border here.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, bad_chunks double"
)


def words_of(text: str) -> list[str]:
    return WORD.findall(text) if _OTHER_SPACE.search(text) else text.split()


def repeated_words(words: Sequence[str]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype="int64", count=n)
    k = len(number)
    pairs = ids[:-2] * k + ids[1:-1]
    if k > 2_000_000:  # three numbers no longer fit in 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs * k + ids[2:]
    order = np.argsort(windows)
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, dtype=bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def chunk_limit(n: int) -> float:
    return CHUNK_BAND[0] if n == CHUNK_BYTES else [b for b in BANDS if n >= b[0]][-1][1]


def lower_limit(limit: float, data: bytes) -> float:
    """``limit``, which holds for one byte a character, for the bytes that ``data`` takes a character."""
    if data.isascii():
        return limit
    # every byte but a continuation starts a character
    chars = int(np.count_nonzero(np.frombuffer(data, dtype=np.uint8) & 0xC0 != 0x80))
    return 1 + (limit - 1) * (1 - SCRIPT_SHARE * (len(data) / max(chars, 1) - 1))


def compression(text: str, compressor) -> tuple[float, float, bool]:
    """Whole ratio, share of chunked bytes outside their band, and whether the document stays in its bands."""
    data = text.encode("utf-8", "surrogatepass")
    if not data:
        return 1.0, 0.0, True
    ratio = len(data) / len(compressor.compress(data))
    _, low, high = [b for b in BANDS if len(data) >= b[0]][-1]
    chunks = [data[k : k + CHUNK_BYTES] for k in range(0, len(data), CHUNK_BYTES)]
    # a text of less than a chunk is judged whole; a rest has a lower limit for its own length
    judged = [c for c in chunks if len(c) == CHUNK_BYTES or len(data) > CHUNK_BYTES and len(c) >= REST_BYTES]
    bad = 0
    for c in judged:
        if not lower_limit(chunk_limit(len(c)), c) <= len(c) / len(compressor.compress(c)) <= CHUNK_BAND[1]:
            bad += len(c)
    share = bad / sum(map(len, judged)) if judged else 0.0
    return ratio, share, lower_limit(low, data) <= ratio <= high and share <= BAD_CHUNKS


def measure(text: str | None, compressor) -> tuple:
    text = text or ""
    words = words_of(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n, repeated = len(words), repeated_words(words)
    failed = n < 50 or 100 * repeated > 50 * n
    ratio, share, inside = compression(text, compressor)
    symbols = sum(map(text.count, SYMBOLS))
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated, failed, inside and not failed, ratio, share


def quality(text: Column | str) -> Column:
    """Struct of counts and verdict for one text column.

    A null or empty text counts nothing and fails the base rule.  ``kept`` needs the base rule and the
    compression ratios of the whole text and of its 2,048-byte chunks within their bands, whose lower limits follow the bytes a character.  Each text is
    judged alone, whole and in one pass, so order, ties and repeated rows do not matter; a very long text
    costs memory in proportion to itself.
    """

    @F.pandas_udf(FIELDS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=3)
        names = [f.split()[0] for f in FIELDS.split(", ")]
        for batch in batches:
            yield pd.DataFrame([measure(t, compressor) for t in batch], columns=names)

    return run(text)


def apply_quality(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct of :func:`quality` added, and that column's name."""
    name = free_name(docs.columns, "_quality")
    return docs.withColumn(name, quality(F.col(text_col))), name


def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, q = apply_quality(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", f"{q}.*")
