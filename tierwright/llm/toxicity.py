"""Toxicity: a learned weighted lexicon, matched by Aho-Corasick after folding disguises."""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_of_id, read_table, store
from .quality import words_of

# Letters of other scripts and signs that are read as these Latin letters.
HOMOGLYPHS = {
    "a": "аα@ɑ", "b": "Ьв", "c": "сϲ", "d": "ԁ", "e": "еε€", "g": "ɡ", "h": "һ", "i": "іιı!|", "j": "ј",
    "k": "кκ", "l": "ӏ", "m": "м", "n": "ո", "o": "оοσ", "p": "рρ", "r": "г", "s": "ѕ$", "t": "тτ",
    "u": "υս", "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγ", "z": "ᴢ",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
_FOLD = str.maketrans({**{c: a for a, cs in HOMOGLYPHS.items() for c in cs}, **DIGITS})

SAMPLE_PER_CLASS = 6_000  # labelled documents that the lexicon is learned from, per label
MAX_TERMS = 5_000
MIN_TOXIC_DOCS = 4
MIN_LOG_ODDS = 2.5
MIN_PREFIX, MAX_PREFIX = 4, 9
SMOOTH_WORDS = 50  # added to a text's length, so that one hit in a short text does not fill the scale
PREDICT_AT = 0.3


def fold(text: str) -> str:
    """Lower case, compatibility forms, look-alikes and digits as the Latin letters they stand for."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return text.lower().translate(_FOLD)


def terms_of(text: str) -> set[str]:
    """Word starts of several lengths, and whole words with a closing blank."""
    found = set()
    for word in set(words_of(fold(text))):
        word = word.strip(".,;:?\"'()[]-_*#&%")
        if len(word) >= 2 and word.isalpha():
            found.add(f"{word} ")
            found.update(word[:k] for k in range(MIN_PREFIX, min(len(word), MAX_PREFIX) + 1))
    return found


@dataclass
class Lexicon:
    """Terms with weights, phrases that excuse a term, and the density that scores 0.3."""

    weights: dict[str, float]
    exceptions: frozenset[str] = field(default_factory=frozenset)
    at: float = 1.0

    def matcher(self):
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            automaton.add_word(term.rstrip(), (len(term.rstrip()), term.endswith(" "), weight))
        automaton.make_automaton()
        return automaton

    def hits(self, folded: str, automaton) -> list[tuple[int, int, float]]:
        """(start, end, weight) of matches at word starts, the heaviest of each start, without excused ones."""
        if not self.weights:
            return []
        best: dict[int, tuple[int, float]] = {}
        for last, (n, whole, weight) in automaton.iter(folded):
            start, end = last - n + 1, last + 1
            if start and folded[start - 1].isalpha() or whole and end < len(folded) and folded[end].isalpha():
                continue
            if weight > best.get(start, (0, 0.0))[1]:
                best[start] = (end, weight)
        return [(s, e, w) for s, (e, w) in sorted(best.items()) if not self.excused(folded, s)]

    def excused(self, folded: str, start: int) -> bool:
        return bool(self.exceptions) and any(p in self.exceptions for p in phrases_at(folded, start))

    def density(self, text: str | None, automaton) -> float:
        """Weight of all hits for each 100 words."""
        if not text:
            return 0.0
        found = self.hits(fold(text), automaton)
        return 100 * sum(w for _, _, w in found) / (len(words_of(text)) + SMOOTH_WORDS) if found else 0.0

    def score(self, density: float) -> float:
        return 1.0 - math.exp(math.log(1 - PREDICT_AT) * density / self.at)


def phrases_at(folded: str, start: int) -> list[str]:
    """The word at ``start`` with the word before it, and with the word after it."""
    before, after = folded[max(0, start - 40) : start].split(), folded[start : start + 80].split()[:2]
    return ([f"{before[-1]} {after[0]}"] if before else []) + ([" ".join(after)] if len(after) == 2 else [])


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(text, toxic) of a bounded sample: per label the ``per_class`` documents with the smallest id hash.

    Each task keeps its first ``per_class`` ids of a label, so no task meets all labels.  Of several texts
    under one id the least by code point is learned from, so the sample has at most ``2 * per_class`` rows.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & (crc_of_id("doc_id") % 4 != 2))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    clean, toxic = (
        known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for label in (0, 1)
    )
    # at most 2 * per_class ids are broadcast, so only texts of the sample are shuffled; it is read several times
    chosen = F.broadcast(clean.unionByName(toxic))
    sample = docs.select("doc_id", "text").join(chosen, "doc_id").filter("text is not null")
    sample = sample.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return store(sample.select("text", "toxic"), "toxicity-sample")


def count_keys(rows: DataFrame, keys) -> DataFrame:
    """Documents of each label per key; ``keys`` maps a text to a set of strings."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                (toxic if label else clean).update(keys(text))
            names = list(toxic.keys() | clean.keys())
            yield pd.DataFrame(
                {"key": names, "toxic": [toxic[k] for k in names], "clean": [clean[k] for k in names]}
            ).astype({"toxic": "int64", "clean": "int64", "key": object})

    return rows.mapInPandas(count, "key string, toxic long, clean long").groupBy("key").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )


def choose_terms(counted: Sequence[tuple[str, float]]) -> dict[str, float]:
    """Short terms first; a longer one only where it says clearly more than the ones it begins with."""
    kept: dict[str, float] = {}
    for term, weight in sorted(counted, key=lambda t: (len(t[0]), t[0])):
        shorter = [kept[term[:k]] for k in range(1, len(term)) if term[:k] in kept]
        if not shorter or weight > max(shorter) + 1.0:
            kept[term] = weight
    return kept


def learn_lexicon(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Lexicon:
    """A lexicon from labelled rows whose crc32(doc_id) mod 4 is not 2.

    Terms are counted where the rows are; at most ``MAX_TERMS`` of the largest log-odds come to the driver,
    and at most ``2 * per_class`` densities to choose the scale.  Without labels the lexicon is empty.
    """
    rows = training_rows(docs, labels, per_class)
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic:
        return Lexicon({})
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    counted = (
        count_keys(rows, terms_of)
        .filter(F.col("toxic") >= MIN_TOXIC_DOCS)
        .select("key", odds.alias("odds"))
        .filter(F.col("odds") >= MIN_LOG_ODDS)
        .orderBy(F.desc("odds"), "key")
        .limit(MAX_TERMS)
        .collect()
    )
    lexicon = Lexicon(choose_terms([(r["key"], r["odds"]) for r in counted]))
    lexicon.exceptions = learn_exceptions(rows, lexicon)
    lexicon.at = learn_scale(rows, lexicon)
    return lexicon


def learn_exceptions(rows: DataFrame, lexicon: Lexicon) -> frozenset[str]:
    """Two-word phrases around a term that clean texts have at least three times as often as toxic ones."""

    def phrases(text: str) -> set[str]:
        folded, automaton = fold(text), _automaton(lexicon)
        return {p for start, _, _ in lexicon.hits(folded, automaton) for p in phrases_at(folded, start)}

    common = count_keys(rows, phrases).filter("clean >= 3 and clean >= 3 * toxic")
    return frozenset(r["key"] for r in common.orderBy(F.desc("clean"), "key").limit(MAX_TERMS).collect())


_automata: dict[tuple, object] = {}


def _automaton(lexicon: Lexicon):
    """One automaton per worker process and lexicon."""
    key = tuple(sorted(lexicon.weights.items()))
    if key not in _automata:
        _automata.clear()
        _automata[key] = lexicon.matcher()
    return _automata[key]


def learn_scale(rows: DataFrame, lexicon: Lexicon) -> float:
    """The density with the best F1 on the sample, halfway to the next lower one."""
    pairs = rows.select("toxic", density(lexicon)(F.col("text")).alias("d")).collect()  # at most 2 * per_class
    values = np.asarray([r["d"] for r in pairs])
    toxic = np.asarray([r["toxic"] == 1 for r in pairs])
    cuts = np.unique(values[values > 0])
    if not len(cuts):
        return 1.0
    order = np.argsort(-values, kind="stable")
    hits, seen = np.cumsum(toxic[order]), np.arange(1, len(values) + 1)
    f1 = 2 * hits / (seen + toxic.sum())
    last = np.append(values[order][1:] != values[order][:-1], True) & (values[order] > 0)
    best = values[order][last][int(np.argmax(f1[last]))]
    lower = cuts[cuts < best]
    return float((best + (lower[-1] if len(lower) else 0.0)) / 2)


def density(lexicon: Lexicon):
    """Pandas UDF: text to the lexicon's density."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = lexicon.matcher()
        for batch in batches:
            yield pd.Series([lexicon.density(t, automaton) for t in batch], dtype="float64")

    return run


def toxicity(lexicon: Lexicon, text: Column) -> Column:
    """Score 0 to 1; null, empty and unmatched texts score 0.

    Each text is scored alone and whole, so ties and repeated rows score alike.
    """
    return 1 - F.exp(F.lit(math.log(1 - PREDICT_AT) / lexicon.at) * density(lexicon)(text))


def op9_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = learn_lexicon(docs, read_table(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id",
        F.coalesce(crc_of_id("doc_id") % 4 == 2, F.lit(False)).alias("held_out"),
        toxicity(lexicon, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= PREDICT_AT).cast("int"))
