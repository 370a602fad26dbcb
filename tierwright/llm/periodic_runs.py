"""Periodic runs of words: tiles per period octave, boundary Z-functions, stitched interval fragments."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import WORD, partitions, read_table, store

MIN_WORDS = 24
MIN_COPIES = 3
# Words of a tile, of the text it owns; a tile of long periods owns at least eight of them.
TILE_WORDS = 65_536
# Output of a task is handed over in batches of about so many characters.
BATCH_CHARS = 8_000_000

Words = list[str]
Fragment = tuple[int, int, int]  # period, start, end

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, dtype=np.uint64)


def _powers_upto(n: int) -> np.ndarray:
    """Powers of the hash base, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        factors = np.full(2 * n, _BASE, dtype=np.uint64)
        factors[0] = 1
        _powers = np.multiply.accumulate(factors)
    return _powers


def z_function(s: list[int]) -> list[int]:
    """For each position, how long the text from there agrees with the whole text."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def prime_factors(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return [*found, n] if n > 1 else found


class Octave:
    """Periods ``low`` to ``high - 1``, and the anchors at multiples of ``spacing`` that see their runs.

    The first octave takes all periods for which the least number of words decides, not that of copies.
    A run of period q has an anchor in its first ``spacing`` words, from which ``agreeing(q)`` words agree
    with those q further on.
    """

    def __init__(self, low: int, high: int, spacing: int, min_words: int, copies: int):
        self.low, self.high, self.spacing = low, high, spacing
        self.min_words, self.copies = min_words, copies
        # from the last anchor that sees a run to the run's end
        self.reach = max(min_words, copies * (high - 1)) + 2

    def agreeing(self, q):
        return np.maximum(self.min_words, self.copies * q) - self.spacing + 1 - q


def octaves(n: int, min_words: int = MIN_WORDS, copies: int = MIN_COPIES) -> Iterator[Octave]:
    """Octaves of the periods that a text of ``n`` words can have."""
    low = max(1, min_words // copies)
    if low > 1 and n >= min_words:
        yield Octave(1, low, low, min_words, copies)
    while copies * low <= n:
        yield Octave(low, 2 * low, low, min_words, copies)
        low *= 2


def numbered(words: Words) -> list[int]:
    """Equal words, and only they, have equal numbers."""
    seen: dict[str, int] = {}
    return [seen.setdefault(w, len(seen)) for w in words]


def stitch(fragments: list[Fragment]) -> list[Fragment]:
    """Fragments of one period that share at least a period of words are one."""
    out: list[list[int]] = []
    for q, start, end in sorted(fragments):
        if out and out[-1][0] == q and start <= out[-1][2] - q:
            out[-1][2] = max(out[-1][2], end)
        else:
            out.append([q, start, end])
    return [tuple(f) for f in out]


class Tile:
    """Numbered words from word ``first`` of a text on."""

    def __init__(self, ids: list[int], first: int = 0):
        self.ids, self.first = ids, first
        powers = _powers_upto(len(ids) + 1)
        terms = (np.array(ids, dtype=np.uint64) + np.uint64(1)) * _MIX * powers[: len(ids)]
        self.powers = powers
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def candidates(self, octave: Octave, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Anchors (from ``start`` to before ``end``, both counted in the tile) and periods whose hashes agree.

        Hashes of equal words are equal, so no run is missed; the Z-functions settle the rest.
        """
        first = -(-(self.first + start) // octave.spacing) * octave.spacing - self.first
        anchors = np.arange(first, end, octave.spacing)
        periods = np.arange(octave.low, octave.high)
        length = octave.agreeing(periods)
        c = np.repeat(anchors, len(periods))
        q, m = np.tile(periods, len(anchors)), np.tile(length, len(anchors))
        whole = c + q + m <= len(self.ids)
        c, q, m = c[whole], q[whole], m[whole]
        sums = self.sums
        agree = (sums[c + m] - sums[c]) * self.powers[q] == sums[c + q + m] - sums[c + q]
        return c[agree], q[agree]

    def extend(self, octave: Octave, anchor: int, periods: list[int]) -> Iterator[Fragment]:
        """The stretch around ``anchor`` of each period that is its smallest, from two Z-functions."""
        ids = self.ids
        ahead = z_function(ids[anchor : anchor + octave.reach])
        begin, stop = max(0, anchor - octave.spacing), min(len(ids), anchor + octave.high)
        head = ids[begin:anchor][::-1]
        behind = z_function([*head, -1, *ids[begin:stop][::-1]])
        for q in periods:
            if ahead[q] < octave.agreeing(q):
                continue
            # a stretch whose first q words are copies of a part of them has a smaller period
            if any(ahead[q // r] >= q - q // r for r in prime_factors(q)):
                continue
            back = behind[len(head) + 1 + stop - (anchor + q)]
            yield q, self.first + anchor - back, self.first + anchor + q + ahead[q]

    def fragments(self, octave: Octave, start: int, end: int, known: list[Fragment] = ()) -> list[Fragment]:
        """Stretches seen from the anchors from ``start`` to before ``end``.

        What lies within a ``known`` run of a divisor of its period is not looked at.
        """
        c, q = self.candidates(octave, start, end)
        for period, low, high in known:
            if not len(c):
                return []
            at = c + self.first
            inside = (q % period == 0) & (at >= low) & (at + q + octave.agreeing(q) <= high)
            c, q = c[~inside], q[~inside]
        found: list[Fragment] = []
        by_anchor: dict[int, list[int]] = {}
        for anchor, period in zip(c.tolist(), q.tolist()):
            by_anchor.setdefault(anchor, []).append(period)
        for anchor, periods in by_anchor.items():
            found.extend(self.extend(octave, anchor, periods))
        return stitch(found)


def runs_of(words: Words, min_words: int = MIN_WORDS, copies: int = MIN_COPIES) -> list[Fragment]:
    """All runs of a text that is one tile."""
    found: list[Fragment] = []
    tile = None
    for octave in octaves(len(words), min_words, copies):
        tile = tile or Tile(numbered(words))
        seen = tile.fragments(octave, 0, len(words), found)
        found += [f for f in seen if f[2] - f[1] >= max(min_words, copies * f[0])]
    return found


def collapse(words: Words, runs: list[Fragment]) -> Words:
    """Words that no run holds after its first period."""
    kept, at = [], 0
    for start, end in sorted((s + q, e) for q, s, e in runs):
        kept += words[at:start] if start > at else []
        at = max(at, end)
    return kept + words[at:]


def sha256_text(words: Words) -> str:
    return hashlib.sha256(" ".join(words).encode("utf-8", "surrogatepass")).hexdigest()


RUN = "struct<start: bigint, length: bigint, period: bigint>"
# What a document is while its runs are looked for; rows with an octave are tiles.
READ = (
    "_row bigint, n_words bigint, octave bigint, first bigint, own_words bigint, body string, digest string, "
    "fragments array<struct<period: bigint, first: bigint, last: bigint>>"
)
FRAGMENTS = "_row bigint, period bigint, first bigint, last bigint"
COLLAPSED = f"n_words bigint, runs array<{RUN}>, collapsed string, collapsed_sha256 string"


def _batches(rows: Iterator[dict], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    form, held, chars = to_arrow_schema(schema), [], 0
    for row in rows:
        held.append(row)
        chars += 100 + len(row.get("body") or row.get("collapsed") or "") + 50 * len(row.get("fragments") or ())
        if chars > BATCH_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema=form)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=form)


def _tiles(octave: Octave, n: int, tile_words: int) -> Iterator[tuple[int, int]]:
    """(first word, words) that each tile of a text of ``n`` words owns."""
    own = -(-max(tile_words, 8 * octave.high) // octave.spacing) * octave.spacing
    for first in range(0, n, own):
        yield first, min(own, n - first)


def _read_documents(schema: T.StructType, rewrite, min_words: int, copies: int, tile_words: int):
    """Rows (_row, doc_id, id_text, text) to documents, and to tiles where a document is more than one."""

    def parts(row: dict, words: Words) -> Iterator[dict]:
        if len(words) <= tile_words:
            found = [{"period": q, "first": s, "last": e} for q, s, e in runs_of(words, min_words, copies)]
            if found:
                yield row | {"body": " ".join(words), "fragments": found}
            else:
                yield row | {"digest": sha256_text(words)}
            return
        yield row | {"body": " ".join(words)}
        for octave in octaves(len(words), min_words, copies):
            for first, own in _tiles(octave, len(words), tile_words):
                # with what its anchors look back at and what they reach
                begin = max(0, first - octave.spacing)
                body = " ".join(words[begin : first + own + octave.reach])
                yield row | {"octave": octave.low, "first": first, "own_words": own, "body": body}

    def run(batches):
        def rows():
            for batch in batches:
                for number, doc_id, id_text, text in zip(*batch.columns):
                    words = WORD.findall(text.as_py() or "")
                    if rewrite:
                        words = rewrite(words, id_text.as_py())
                    row = {"_row": number.as_py(), "doc_id": doc_id.as_py(), "n_words": len(words)}
                    yield from parts(row, words)

        yield from _batches(rows(), schema)

    return run


def _solve_tiles(schema: T.StructType, min_words: int, copies: int):
    def run(batches):
        def rows():
            for batch in batches:
                for row in batch.to_pylist():
                    octave = next(o for o in octaves(row["n_words"], min_words, copies) if o.low == row["octave"])
                    begin = max(0, row["first"] - octave.spacing)
                    start = row["first"] - begin
                    tile = Tile(numbered(row["body"].split(" ")), begin)
                    for q, s, e in tile.fragments(octave, start, start + row["own_words"]):
                        yield {"_row": row["_row"], "period": q, "first": s, "last": e}

        yield from _batches(rows(), schema)

    return run


def _stitched(fragments: DataFrame, min_words: int, copies: int) -> DataFrame:
    """_row, runs: those of each document in order."""
    alike = Window.partitionBy("_row", "period").orderBy("first", "last")
    reached = F.max("last").over(alike.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("first") > reached - F.col("period"), F.lit(True))
    islands = fragments.withColumn("opens", opens.cast("int")).withColumn("island", F.sum("opens").over(alike))
    whole = islands.groupBy("_row", "period", "island").agg(F.min("first").alias("start"), F.max("last").alias("end"))
    length = F.col("end") - F.col("start")
    runs = whole.where(length >= F.greatest(F.lit(min_words), copies * F.col("period")))
    run = F.struct("start", length.alias("length"), "period")
    return runs.groupBy("_row").agg(F.sort_array(F.collect_list(run)).alias("runs"))


def _collapse_documents(schema: T.StructType):
    def run(batches):
        def rows():
            for batch in batches:
                for row in batch.to_pylist():
                    words, runs = row["body"].split(" "), row["runs"] or []
                    kept = collapse(words, [(r["period"], r["start"], r["start"] + r["length"]) for r in runs])
                    yield {
                        "doc_id": row["doc_id"],
                        "n_words": row["n_words"],
                        "runs": runs,
                        "collapsed": " ".join(kept) if runs else None,
                        "collapsed_sha256": sha256_text(kept),
                    }

        yield from _batches(rows(), schema)

    return run


def periodic_runs(
    docs: DataFrame,
    rewrite: Callable[[Words, str | None], Words] | None = None,
    min_words: int = MIN_WORDS,
    copies: int = MIN_COPIES,
    tile_words: int = TILE_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs, collapsed, collapsed_sha256.

    A run is a stretch of words with smallest period q that no neighbouring word extends, of at least
    ``min_words`` words and ``copies`` (two or more) periods.  ``runs`` lists (start, length, period) by start,
    then period.  Collapsing drops each word that a run holds after its first q words; ``collapsed`` is what
    stays, one space between words, and null where nothing goes.  ``rewrite`` changes the words of a document
    before (words, id as text).

    Documents are exploded into overlapping tiles, those of longer periods owning more words; one of at most
    ``tile_words`` is a single tile and is solved where it is read.  Anchors of a tile find runs by Z-functions
    to both sides.  Fragments are shuffled by document and period and stitched.  Null texts have no words, rows
    with a null or repeated doc_id are documents of their own, other columns are not read.
    """
    id_field = T.StructType([docs.schema["doc_id"]])
    # row numbers hold once they are stored with the rows
    keyed = docs.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", F.col("doc_id").cast("string").alias("id_text"), "text"
    )
    schema = T.StructType(id_field.fields + T.StructType.fromDDL(READ).fields)
    read = keyed.mapInArrow(_read_documents(schema, rewrite, min_words, copies, tile_words), schema)
    stored = store(read, "periodic")
    # tiles of one document are as many tasks
    tiles = stored.where("octave is not null").select("_row", "n_words", "octave", "first", "own_words", "body")
    tiles = tiles.repartition(partitions(docs.sparkSession), "_row", "octave", "first")
    inside = stored.select("_row", F.explode("fragments").alias("f")).select("_row", "f.period", "f.first", "f.last")
    schema = T.StructType.fromDDL(FRAGMENTS)
    fragments = inside.unionByName(tiles.mapInArrow(_solve_tiles(schema, min_words, copies), schema))
    runs = _stitched(fragments, min_words, copies)
    whole = stored.where("octave is null")
    plain = whole.where("body is null").select(
        "doc_id",
        "n_words",
        F.array().cast(f"array<{RUN}>").alias("runs"),
        F.col("body").alias("collapsed"),
        F.col("digest").alias("collapsed_sha256"),
    )
    held = whole.where("body is not null").select("_row", "doc_id", "n_words", "body").join(runs, "_row", "left")
    schema = T.StructType(id_field.fields + T.StructType.fromDDL(COLLAPSED).fields)
    return plain.unionByName(held.mapInArrow(_collapse_documents(schema), schema))


def repeat_a_part(words: Words, id_text: str | None) -> Words:
    """The query's damage: some documents repeat a part of their words up to their end."""
    h = zlib.crc32(id_text.encode()) if id_text is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + p]
    return words[:a] + (part * (-(-(n - a) // p)))[: n - a]


def op12_period_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(read_table(spark, sf_dir, "documents").select("doc_id", "text"), repeat_a_part)
    # runs are in order, so of equal exponents the first stays
    top = "aggregate(runs, get(runs, 0), (top, r) -> if(r.length * top.period > top.length * r.period, r, top))"
    listed = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    return found.withColumn("top", F.expr(top)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("top.length * 1000 div top.period").alias("exponent_milli"),
        F.sha2(F.expr(listed), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )
