"""Packing token sequences: shortest pack first over the length histogram."""

from __future__ import annotations

import heapq
import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, running_totals, store

SEQUENCE_TOKENS = 1024
END_ID = 0

# How byte-level BPE splits text before merging (fixed pattern of the public vocabulary).
SPLITS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The same for text without two white-space characters in a row: no look-ahead, so no backtracking.
SPLITS_NO_RUNS = SPLITS.replace(r"\s+(?!\S)|\s+", r"\s")
# White space as \s has it there, but for space and \n.
_RARE_SPACE = re.compile("[\t\v\f\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: printable Latin-1 for itself, others from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = (b for b in range(256) if b not in kept)
    return {**{chr(b): b for b in kept}, **{chr(256 + k): b for k, b in enumerate(moved)}}


class Encoder:
    """Token ids by the vocabulary of a byte-level BPE ``tokenizers`` file.

    The merges run in ``tiktoken``, which gives the same ids in a fifth of the time; a test holds the two
    libraries against each other.  In such a vocabulary the order of ids is the order of merges.  With
    ``added`` the file's added tokens have their ids wherever a text holds them, as in ``tokenizers`` by default.
    """

    def __init__(self, tokenizer_path: str, added: bool = False):
        import tiktoken

        model = json.loads(Path(tokenizer_path).read_text(encoding="utf-8"))
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self._added = tuple(special) if added else ()  # otherwise they are ordinary text
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
        self._any, self._no_runs = (
            tiktoken.Encoding(name, pat_str=splits, mergeable_ranks=ranks, special_tokens=special if added else {})
            for name, splits in (("any", SPLITS), ("no-runs", SPLITS_NO_RUNS))
        )

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        runs = "  " in text or " \n" in text or "\n " in text or "\n\n" in text or _RARE_SPACE.search(text)
        merges = self._any if runs else self._no_runs
        if any(token in text for token in self._added):
            ids = array("I", merges.encode(text, allowed_special="all"))
        else:
            ids = array("I", merges.encode_ordinary(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(tokenizer_path: str, added: bool = False) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if (tokenizer_path, added) not in _encoders:
        _encoders[tokenizer_path, added] = Encoder(tokenizer_path, added)
    return _encoders[tokenizer_path, added]


def cut_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = SEQUENCE_TOKENS) -> DataFrame:
    """Token pieces of at most ``limit`` ids: whole ones from the front, then what is left."""
    end = np.asarray([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer_path, added=True).encode
        for batch in batches:
            ids, starts, lengths, crcs, totals = [], [], [], [], []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                tokens = (encode(text) if text else b"") + end
                total = len(tokens) // 4
                for start in range(0, total, limit):
                    piece = tokens[4 * start : 4 * (start + limit)]
                    ids.append(doc_id)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    crcs.append(zlib.crc32(piece))
                    totals.append(total)
            yield pd.DataFrame(
                {
                    "doc_id": pd.array(ids, dtype=batch["doc_id"].dtype),
                    "start": np.asarray(starts, dtype="int64"),
                    "length": np.asarray(lengths, dtype="int64"),
                    "ids_crc32": np.asarray(crcs, dtype="int64"),
                    "doc_tokens": np.asarray(totals, dtype="int64"),
                }
            )

    # ids travel as text, so that null ids of any type come through unchanged
    narrow = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = narrow.mapInPandas(cut, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long")
    return pieces.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def pack_histogram(histogram: dict[int, int], limit: int = SEQUENCE_TOKENS) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns (number of packs, lengths in them) from counts per length.

    Lengths are placed longest first into the pack that is shortest so far; packs that look alike are
    handled as one pattern with a count.
    """
    # (used, tie, count, pattern); a pattern is split when only some of its packs grow
    packs: list[tuple[int, int, int, tuple[int, ...]]] = []
    tie = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            if packs and packs[0][0] + length <= limit:
                used, _, count, pattern = heapq.heappop(packs)
                grown = min(count, left)
                if count > grown:
                    tie += 1
                    heapq.heappush(packs, (used, tie, count - grown, pattern))
                tie += 1
                heapq.heappush(packs, (used + length, tie, grown, (*pattern, length)))
                left -= grown
            else:
                tie += 1
                heapq.heappush(packs, (length, tie, left, (length,)))
                left = 0
    return [(count, pattern) for _, _, count, pattern in sorted(packs, key=lambda p: (p[3], p[1]))]


def place_slots(packs: list[tuple[int, tuple[int, ...]]]) -> pd.DataFrame:
    """One row per pattern place: ranks ``[first, first + count)`` of ``length`` sit at ``offset`` there."""
    rows, used, sequence = [], {}, 0
    for count, pattern in packs:
        offset = 0
        for length in pattern:
            first = used.get(length, 0)
            rows.append((length, first, sequence, offset))
            used[length] = first + count
            offset += length
        sequence += count
    return pd.DataFrame(rows, columns=["length", "first", "sequence", "offset"]).sort_values(["length", "first"], ignore_index=True)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = SEQUENCE_TOKENS
) -> DataFrame:
    """One row per piece with its sequence and offset there.

    A document's ids (none for a null or empty text) end with id 0; they are cut from the front into pieces
    of ``limit`` and a rest, so a very long text fills sequences of its own.  The histogram of piece lengths
    (at most ``limit`` counts) gives the packing patterns on the driver; pieces find their place by their
    rank within their length, ordered by id, start and checksum, which prefix sums over ranges give even if
    most pieces have one length.  Repeated rows are packed each on their own, null ids too; an empty table
    gives no rows.  Texts are read once and never shuffled.
    """
    pieces = cut_pieces(docs, tokenizer_path, id_col, text_col, limit).withColumn("one", F.lit(1).cast("long"))
    ranked = running_totals(pieces, ("doc_id", "start", "ids_crc32"), ("one",), by=("length",), label="pack")
    ranked = store(ranked.withColumnRenamed("one_before", "rank").drop("one"), "pack-ranks")
    counts = ranked.groupBy("length").agg(F.max("one_total").alias("n")).collect()  # at most `limit` rows
    slots = place_slots(pack_histogram({r["length"]: r["n"] for r in counts}, limit))
    lengths, firsts = slots["length"].to_numpy("int64"), slots["first"].to_numpy("int64")
    sequences, offsets = slots["sequence"].to_numpy("int64"), slots["offset"].to_numpy("int64")
    # where the slots of each length begin and end in that table
    lower = np.searchsorted(lengths, np.arange(limit + 2))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            of, rank = batch["length"].to_numpy("int64"), batch["rank"].to_numpy("int64")
            at = np.empty(len(batch), dtype="int64")
            for length in np.unique(of):
                here, a, b = of == length, lower[length], lower[length + 1]
                at[here] = a + np.searchsorted(firsts[a:b], rank[here], side="right") - 1
            batch["sequence_id"] = sequences[at] + rank - firsts[at]
            batch["offset"] = offsets[at]
            yield batch[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    placed = ranked.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        place, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
    return placed.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), default_tokenizer())
