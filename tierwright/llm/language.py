"""Language identification by cross-parsing against suffix automata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import crc_of_id, free_name, read_table

SAMPLE_DOCS = 40  # labelled documents per language that the models are built from
SAMPLE_SYMBOLS = 20_000  # symbols of them in a model
LETTERS = 46  # most frequent letters with a class of their own
SHARED = 16  # classes that all other letters share by code point
END, SPACE, FIRST = 0, 1, 2
CLASSES = FIRST + LETTERS + SHARED
SPAN = 2048  # symbols parsed in one go; a longer text is several spans
COLUMNS = 2048  # spans parsed side by side
UNKNOWN = "und"
# A text that needs more bits per symbol than its length allows is in no learned language.  Measured on sf0.1 cut
# to a length, and on random letters of that length: learned languages take up to 7.12 bits until 200 characters,
# 6.17 at 300, 5.27 at 400 and 4.73 at 500; random letters 7.5 to 9.8 at 80 and 8 to 9 from 300 on, random
# words of letters 6.8 to 8.3 at 200, hex digits 5.3 to 6.5 at 500.
SHORT_CHARS, LONG_CHARS = 200, 500
SHORT_BITS, LONG_BITS = 7.3, 5.2
# A phrase takes some 14.3 bits, and two of them are allowed however short the text is.
TWO_PHRASES = 28.6

FIELDS = "lang_pred string, score double, bits double"


class Alphabet:
    """Symbols of a text: classes of lower-case letters, and one blank for each run of anything else."""

    def __init__(self, letters: str):
        self.letters = letters
        table = np.full(0x10000, SPACE, dtype="uint8")
        for code in range(0x10000):
            if chr(code).isalpha():
                table[code] = FIRST + LETTERS + code % SHARED
        for k, c in enumerate(letters):
            table[ord(c)] = FIRST + k
        self.table = table

    def symbols(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        if codes.size and codes.max() >= 0x10000:
            high = codes >= 0x10000
            classes = self.table[np.where(high, 32, codes)]
            classes[high] = [
                FIRST + LETTERS + int(c) % SHARED if chr(c).isalpha() else SPACE for c in codes[high]
            ]
        else:
            classes = self.table[codes]
        blank = classes == SPACE
        keep = ~blank
        keep[1:] |= blank[1:] & ~blank[:-1]
        return classes[keep]


def suffix_automaton(symbols: np.ndarray) -> np.ndarray:
    """Transitions (state, class) of the automaton of all substrings; state 1 is the root, 0 is none."""
    nexts: list[dict[int, int]] = [{}, {}]
    link, length = [0, 0], [0, 0]
    last = 1
    for c in symbols.tolist():
        state = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(1)
        p = last
        while p and c not in nexts[p]:
            nexts[p][c] = state
            p = link[p]
        if p:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and nexts[p].get(c) == q:
                    nexts[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    table = np.zeros((len(nexts), CLASSES), dtype="int32")
    for state, out in enumerate(nexts):
        if out:
            table[state, list(out)] = list(out.values())
    return table


@dataclass
class Models:
    """Automata of all languages in one table, with root and bits per phrase of each."""

    languages: list[str]
    letters: str
    table: np.ndarray
    roots: np.ndarray
    bits: np.ndarray

    @classmethod
    def build(cls, texts: dict[str, list[str]]) -> Models:
        counts: dict[str, int] = {}
        for c in "".join(t for ts in texts.values() for t in ts).lower():
            if c.isalpha() and ord(c) < 0x10000:
                counts[c] = counts.get(c, 0) + 1
        letters = "".join(sorted(sorted(counts), key=lambda c: -counts[c])[:LETTERS])
        alphabet = Alphabet(letters)
        names, tables, roots, bits, base = [], [], [], [], 0
        for name in sorted(texts):
            # every document gives its share, so that one long text does not make the model
            share = -(-SAMPLE_SYMBOLS // max(1, len(texts[name])))
            parts = [alphabet.symbols(t) for t in texts[name]]
            parts = [p[: max(share, SAMPLE_SYMBOLS - sum(len(q) for q in parts) + len(p))] for p in parts]
            sample = np.concatenate([np.append(p, SPACE) for p in parts])[:SAMPLE_SYMBOLS].astype("uint8")
            if not (sample >= FIRST).any():
                continue
            table = suffix_automaton(sample)
            tables.append(np.where(table > 0, table + base, 0))
            roots.append(base + 1)
            bits.append(np.log2(len(sample) + 1))
            names.append(name)
            base += len(table)
        table = np.concatenate(tables) if tables else np.zeros((2, CLASSES), dtype="int32")
        return cls(names, letters, table.astype("int32"), np.asarray(roots, dtype="int32"), np.asarray(bits))


def phrases(spans: list[np.ndarray], models: Models) -> np.ndarray:
    """Phrases per language and span: greedily the longest match that the language's text holds.

    All spans and languages advance together, one symbol a step, longest spans first.
    """
    flat, roots = models.table.reshape(-1), models.roots[:, None]
    out = np.ones((len(models.languages), len(spans)), dtype="int64")
    order = sorted(range(len(spans)), key=lambda k: -len(spans[k]))
    for at in range(0, len(order), COLUMNS):
        group = order[at : at + COLUMNS]
        lengths = np.asarray([len(spans[k]) for k in group])
        block = np.zeros((lengths.max(initial=0), len(group)), dtype="int32")
        for column, k in enumerate(group):
            block[: len(spans[k]), column] = spans[k]
        alive = np.searchsorted(-lengths, -np.arange(len(block)), side="left")  # longer than that place
        state = np.repeat(roots, len(group), axis=1)
        count = np.ones_like(state)
        first = flat[roots * CLASSES + np.arange(CLASSES, dtype="int32")]  # from the root, by class
        first = np.where(first > 0, first, roots)
        for row, n in zip(block, alive.tolist(), strict=True):
            if n < state.shape[1]:
                out[:, group[n : state.shape[1]]] = count[:, n:]
                state, count = state[:, :n], count[:, :n]
            symbol = row[:n]
            following = flat[state * CLASSES + symbol]
            ends = following == 0
            count += ends
            state = np.where(ends, first[:, symbol], following)
        out[:, group[: state.shape[1]]] = count
    return out


def parse(texts: list[str | None], models: Models, alphabet: Alphabet) -> pd.DataFrame:
    spans, owner, sizes = [], [], np.zeros(len(texts), dtype="int64")
    for k, text in enumerate(texts):
        symbols = alphabet.symbols(text) if text else np.zeros(0, dtype="uint8")
        if (symbols >= FIRST).any():
            sizes[k] = len(symbols)
            for at in range(0, len(symbols), SPAN):
                spans.append(symbols[at : at + SPAN])
                owner.append(k)
    n = len(models.languages)
    total = np.zeros((n, len(texts)))
    if spans and n:
        np.add.at(total, (slice(None), np.asarray(owner)), phrases(spans, models))
    with np.errstate(invalid="ignore", divide="ignore"):
        rate = total * models.bits[:, None] / sizes if n else total
    named, scores, best_bits = [], [], []
    for k in range(len(texts)):
        if not sizes[k] or not n:
            named.append(UNKNOWN), scores.append(0.0), best_bits.append(None)
            continue
        order = np.argsort(rate[:, k], kind="stable")
        best = rate[order[0], k]
        second = rate[order[1], k] if n > 1 else 2 * best
        named.append(models.languages[order[0]])
        scores.append(float(min(1.0, max(0.0, 1 - best / second))))
        best_bits.append(float(best))
    return pd.DataFrame({"lang_pred": named, "score": scores, "bits": best_bits})


def learn_models(docs: DataFrame, per_language: int = SAMPLE_DOCS) -> Models:
    """Models from labelled rows whose crc32(doc_id) mod 5 is not 0.

    The sample is bounded: for each language the ``per_language`` documents with the smallest id hash, and of
    each the symbols that make up its share of ``SAMPLE_SYMBOLS``.  Only ids and labels are ranked; the
    chosen texts are then read by their ids, at most ``per_language`` rows a language even where ids repeat.
    """
    train = docs.filter(F.col("lang").isNotNull() & (crc_of_id("doc_id") % 5 != 0))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = train.select("doc_id", "lang").withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= per_language)
    ids = [r["doc_id"] for r in chosen.select("doc_id").distinct().collect()]  # at most per_language a language
    rows = train.filter(F.col("doc_id").isin(ids) & F.col("text").isNotNull())
    again = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    rows = rows.select("doc_id", "lang", "text").withColumn("_n", F.row_number().over(again)).filter(F.col("_n") <= per_language)
    # enough symbols for a model of this language alone
    texts: dict[str, list[str]] = {}
    for r in rows.select("doc_id", "lang", F.substring("text", 1, SAMPLE_SYMBOLS).alias("text")).orderBy("doc_id").collect():
        texts.setdefault(r["lang"], []).append(r["text"])
    return Models.build(texts)


def identify(models: Broadcast, text: Column) -> Column:
    """Struct (lang_pred, score, bits) of a text column.

    ``lang_pred`` is the language that needs the fewest phrases, each counted as the bits that name a place
    in the language's sample; ties go to the first name.  ``score`` is how much less it needs than the next,
    ``bits`` what it needs for a symbol.  Null texts and texts without a letter are ``und`` with score 0, as
    all texts are if nothing was learned.  Whole texts are parsed, in spans that each begin a new phrase.
    """

    @F.pandas_udf(FIELDS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        learned = models.value
        alphabet = Alphabet(learned.letters)
        for batch in batches:
            texts = batch.tolist()
            parts = [parse(texts[k : k + 2000], learned, alphabet) for k in range(0, len(texts), 2000)]
            yield pd.concat(parts, ignore_index=True) if parts else parse([], learned, alphabet)

    return run(text)


def with_language(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with the struct of :func:`identify` added, and that column's name."""
    models = docs.sparkSession.sparkContext.broadcast(learn_models(docs))
    name = free_name(docs.columns, "_language")
    return docs.withColumn(name, identify(models, F.col("text"))), name


def most_bits(chars: Column) -> Column:
    """Bits per symbol that a text of ``chars`` characters may take: fewer the longer it is."""
    part = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (chars - SHORT_CHARS) / (LONG_CHARS - SHORT_CHARS)))
    return F.greatest(SHORT_BITS - part * (SHORT_BITS - LONG_BITS), TWO_PHRASES / F.greatest(chars, F.lit(1)))


def reject_unknown(docs: DataFrame) -> DataFrame:
    """``docs`` without texts that have no letter or that no learned language explains.

    The limit follows the text's length, see :func:`most_bits`.  Null texts have no letter and go; repeated rows
    are judged alike; an empty table, or one without labels to learn from, gives no rows; columns of any name
    go along.
    """
    judged, name = with_language(docs)
    foreign = F.col(f"{name}.bits") > most_bits(F.length("text"))
    kept = (F.col(f"{name}.lang_pred") != UNKNOWN) & ~F.coalesce(foreign, F.lit(False))
    return judged.filter(kept).select(*docs.columns)


def op2_cross_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, name = with_language(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return docs.select(
        "doc_id",
        F.coalesce(crc_of_id("doc_id") % 5 == 0, F.lit(False)).alias("held_out"),
        f"{name}.lang_pred",
        f"{name}.score",
        f"{name}.bits",
    )
