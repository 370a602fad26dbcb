"""Jaccard self-join of word n-gram sets: size-aware, heavy and light."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_PATTERN, free_name, partitions, read_table, store
from .components import components, forest

# Elements that the prefixes of two linked large sets must share, and the size of subsets of small sets.
SHARED = 3
SUBSET = 2
MAX_BOUNDARY = 256
# Elements are counted by their first bits, and the frequent ones come last in the order.  Any function of an
# element gives a right order; with many more elements than 2 ** COUNT_BITS it would only be a worse one.
COUNT_BITS = 36
FREQUENT = 64
MAX_FREQUENT = 1_000_000  # bound of the broadcast: 8 MB
# A list of up to so many sets is compared in full; a longer one first around pivots.
SHORT_LIST = 48
# A long list is compared in blocks of at most so many sets and about so many elements.
BLOCK_SETS, BLOCK_ELEMENTS = 2_000, 1_000_000
VOCABULARY = 1_024  # columns of a block's matrix at a time
STRIP = 256  # rows of a block whose links are looked at together



@dataclass(frozen=True)
class Rule:
    """Sets of distinct ``words``-grams link when 100 * intersection >= ``percent`` * union."""

    words: int = 4
    percent: int = 85

    def links(self, common, a, b):
        return 100 * common >= self.percent * (a + b - common)

    def near(self, small, large):
        """Whether the sizes allow a link."""
        return 100 * small >= self.percent * large

    def prefix(self, n: int, shared: int) -> int:
        """Elements at the front of the common order, of which two linked sets share ``shared``."""
        least_overlap = -(-self.percent * n // 100)
        return min(n, n - least_overlap + shared)

    def can_link(self, n: int) -> bool:
        """Whether a set of this size can link to a different one: at best one is the other plus an element."""
        return self.near(n, n + 1)


_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype="uint64")


def _finish(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit sums (splitmix finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


# Words that are hashed and mixed together, and elements that are dealt over buckets together: more only takes memory.
CHUNK_WORDS = 50_000
GATHERED = 3_000_000


def _grams(words: list[bytes], ends: list[int], words_each: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each stretch of ``words``, whose ends are given."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype="uint64", count=len(words))
    n = max(0, len(h) - words_each + 1)
    sums = np.zeros(n, dtype="uint64")
    for k in range(words_each):
        sums += _finish(h[k : k + n] + _MIX[k]) * _MIX[k]
    grams, start = _finish(sums), 0
    for end in ends:
        if end - start >= words_each:
            own = np.sort(grams[start : end - words_each + 1])
            yield own[np.append(True, own[1:] != own[:-1])]
        elif end > start:
            short = h[start:end]
            yield _finish(sum((short[k : k + 1] * _MIX[k] for k in range(len(short))), np.full(1, len(short), dtype="uint64")))
        else:
            yield np.zeros(0, dtype="uint64")
        start = end


def shingle_sets(texts: Iterable[str | None], words_each: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's word n-grams; A-Z are lower-cased, nothing else.

    Texts are hashed together, ``CHUNK_WORDS`` words at a time, as most have few words.
    """
    words, ends = [], []
    for text in texts:
        # on UTF-8 bytes, lower() and split() know ASCII only: exactly A-Z and the six white-space characters
        if text:
            words += text.encode("utf-8", "surrogatepass").lower().split()
        ends.append(len(words))
        if len(words) >= CHUNK_WORDS:
            yield from _grams(words, ends, words_each)
            words, ends = [], []
    yield from _grams(words, ends, words_each)


def digest(elements: np.ndarray) -> int:
    """64-bit name of a set; equal sets have one name."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(elements.tobytes())).astype("int64"))


def _sets(batch_texts, seen: set[int], words_each: int):
    """(set, name) of texts whose set has not come up in this task yet."""
    for elements in shingle_sets(batch_texts, words_each):
        if len(elements):
            name = digest(elements)
            if name not in seen:
                if len(seen) < 1_000_000:
                    seen.add(name)
                yield elements, name


def _gathered(batches: Iterator[pd.DataFrame], words_each: int) -> Iterator[list[tuple[np.ndarray, int]]]:
    """What :func:`_sets` has of a task's texts, some ``GATHERED`` elements at a time, however its rows come in."""
    seen: set[int] = set()
    run, n = [], 0
    for batch in batches:
        for elements, name in _sets(batch["text"], seen, words_each):
            run.append((elements, name))
            n += len(elements)
            if n >= GATHERED:
                yield run
                run, n = [], 0
    if run:
        yield run


def _buckets(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys & np.uint64(0xFFFFFFFF)) * np.uint64(n) >> np.uint64(32)).astype("int64")


def _dealt(keys: np.ndarray, columns: list[np.ndarray], n: int) -> pd.DataFrame:
    """One row per bucket with the packed parts of each column."""
    bucket = _buckets(keys, n)
    order = np.argsort(bucket, kind="stable")
    names, starts = np.unique(bucket[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    out = {"bucket": names.astype("int32")}
    for k, column in enumerate([keys, *columns]):
        moved = column[order]
        out[f"c{k}"] = [moved[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    return pd.DataFrame(out)


def name_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, text_hash, n_shingles, name): the size and name of every document's set; name null for an empty set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [(len(s), digest(s) if len(s) else None) for s in shingle_sets(batch["text"], rule.words)]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "text_hash": batch["text_hash"],
                    "n_shingles": np.asarray([n for n, _ in sets], dtype="int64"),
                    "name": pd.array([name for _, name in sets], dtype="Int64"),
                }
            )

    ids = F.col("doc_id").cast("string").alias("doc_id")
    return docs.select(ids, F.xxhash64("text").alias("text_hash"), "text").mapInPandas(
        run, "doc_id string, text_hash long, n_shingles long, name long"
    ).withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def _squeeze(numbers: np.ndarray, compressor) -> bytes:
    """Compressed byte planes of 64-bit numbers: high bytes are mostly zero."""
    return compressor.compress(np.ascontiguousarray(numbers.astype("<u8").view("uint8").reshape(-1, 8).T).tobytes())


def _expand(data: bytes, decompressor) -> np.ndarray:
    planes = np.frombuffer(decompressor.decompress(data), "uint8").reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def frequent_elements(docs: DataFrame, rule: Rule) -> tuple[np.ndarray, float]:
    """Sorted first bits of frequent elements, and the mean list length that the others meet.

    Exact counts over all texts and elements.  Each task counts its own first, so a frequent element is one
    number a task; sorted numbers travel as compressed differences.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    shift = np.uint64(64 - COUNT_BITS)
    borders = np.asarray([(k << COUNT_BITS) // n for k in range(n)], dtype="uint64")

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=1)
        for sets in _gathered(batches, rule.words):
            found = [s >> shift for s, _ in sets]
            keys, counts = np.unique(np.concatenate(found), return_counts=True)
            at = np.append(np.searchsorted(keys, borders), len(keys))
            rows = []
            for k in range(n):
                part, times = keys[at[k] : at[k + 1]], counts[at[k] : at[k + 1]]
                if len(part):
                    rows.append((k, _squeeze(np.diff(part, prepend=np.uint64(0)), compressor), _squeeze(times, compressor)))
            yield pd.DataFrame(rows, columns=["bucket", "keys", "counts"]).astype({"bucket": "int32"})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        decompressor = zstandard.ZstdDecompressor()
        keys, counts = [], []
        for batch in batches:
            keys += [np.cumsum(_expand(x, decompressor)) for x in batch["keys"]]
            counts += [_expand(x, decompressor).astype("int64") for x in batch["counts"]]
        if keys:
            keys, counts = np.concatenate(keys), np.concatenate(counts)
            order = np.argsort(keys)
            keys, counts = keys[order], counts[order]
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            keys, counts = keys[starts], np.add.reduceat(counts, starts)
            often = counts > FREQUENT
            yield pd.DataFrame({"key": keys[often].astype("int64"), "n": counts[often], "light": 0.0})
            rest = counts[~often].astype("float64")
            # the light ones as two sums, marked by n = 0 and n = -1
            yield pd.DataFrame({"key": [0, 0], "n": [0, -1], "light": [float(rest.sum()), float((rest**2).sum())]})

    dealt = docs.select("text").mapInPandas(local, "bucket int, keys binary, counts binary").repartitionById(n, "bucket")
    counted = store(dealt.mapInPandas(count, "key long, n long, light double"), "ngram-counts")
    rows = counted.filter("n > 0").orderBy(F.desc("n"), "key").limit(MAX_FREQUENT).select("key")
    often = np.sort(np.asarray([r["key"] for r in rows.collect()], dtype="int64").astype("uint64"))
    sums = {r["n"]: r["s"] for r in counted.filter("n <= 0").groupBy("n").agg(F.sum("light").alias("s")).collect()}
    return often, sums.get(-1, 0.0) / sums[0] if sums.get(0) else 1.0


def choose_boundary(sizes: dict[int, int], mean_list: float, rule: Rule) -> int:
    """The largest size of a *small* set, by cost.

    Small sets cost the subsets they emit; large ones (and small ones near the boundary, which can link to
    them) cost a posting and a list scan for each prefix element.  ``sizes`` counts sets by size up to
    ``MAX_BOUNDARY``; the cost of the others does not depend on the boundary.
    """

    def cost(x: int) -> float:
        subsets = sum(c * comb(rule.prefix(n, SUBSET), SUBSET) for n, c in sizes.items() if n <= x)
        scans = sum(c * rule.prefix(n, SHARED) for n, c in sizes.items() if rule.near(n, x + 1))
        return subsets + scans * (1 + mean_list)

    return min(range(0, MAX_BOUNDARY + 1), key=cost)


@dataclass
class Order:
    """The common order of elements: rare ones by hash, then frequent ones by hash."""

    often: np.ndarray

    def prefix(self, elements: np.ndarray, length: int) -> np.ndarray:
        if not len(self.often):
            return elements[:length]
        first_bits = elements >> np.uint64(64 - COUNT_BITS)
        at = np.minimum(np.searchsorted(self.often, first_bits), len(self.often) - 1)
        common = self.often[at] == first_bits
        rare = elements[~common]
        return rare[:length] if len(rare) >= length else np.concatenate([rare, elements[common]])[:length]


def posting_keys(elements: np.ndarray, order: Order, boundary: int, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Keys under which a set is filed, and the weight of each: what a pair found there has shared."""
    n = len(elements)
    keys, weights = [], []
    if n <= boundary:
        prefix = order.prefix(elements, rule.prefix(n, SUBSET))
        i, j = np.triu_indices(len(prefix), 1)
        # the two of a pair in hash order, so that every set makes the same key of them
        low, high = np.minimum(prefix[i], prefix[j]), np.maximum(prefix[i], prefix[j])
        keys.append(_finish(low * _MIX[0] + high * _MIX[1]))
        weights.append(np.full(len(i), SHARED, dtype="uint8"))
    if rule.near(n, boundary + 1):
        prefix = order.prefix(elements, rule.prefix(n, SHARED))
        keys.append(_finish(prefix + _MIX[2]))
        weights.append(np.ones(len(prefix), dtype="uint8"))
    return np.concatenate(keys), np.concatenate(weights)


def file_sets(docs: DataFrame, order: Broadcast, boundary: int, rule: Rule) -> DataFrame:
    """Postings of all sets, packed by bucket: key, name, size, weight."""
    n = partitions(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for sets in _gathered(batches, rule.words):
            keys, names, sizes, weights = [], [], [], []
            for elements, name in sets:
                if rule.can_link(len(elements)):
                    own, weight = posting_keys(elements, order.value, boundary, rule)
                    keys.append(own)
                    weights.append(weight)
                    names.append(np.full(len(own), name, dtype="int64"))
                    sizes.append(np.full(len(own), len(elements), dtype="uint32"))
            if keys:
                yield _dealt(np.concatenate(keys), [np.concatenate(c) for c in (names, sizes, weights)], n)

    packed = docs.select("text").mapInPandas(run, "bucket int, c0 binary, c1 binary, c2 binary, c3 binary")
    return packed.repartitionById(n, "bucket")


def scan_lists(packed: DataFrame, rule: Rule) -> DataFrame:
    """Pairs and long lists of the postings: (kind, a, b, n).

    kind 'pair': names a < b and what they share here; kind 'long': key a, name b, size n of a list too long
    to compare in full, whose sets are paired with pivots only.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for batch in batches:
            for k, kind in enumerate(("uint64", "int64", "uint32", "uint8")):
                columns[k] += [np.frombuffer(x, kind) for x in batch[f"c{k}"]]
        if not columns[0]:
            return
        key, name, size, weight = (np.concatenate(c) for c in columns)
        order = np.lexsort((name, size, key))
        key, name, size, weight = key[order], name[order], size[order].astype("int64"), weight[order]
        again = np.append(False, (key[1:] == key[:-1]) & (name[1:] == name[:-1]))  # equal sets of other tasks
        key, name, size, weight = key[~again], name[~again], size[~again], weight[~again]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        lengths = np.diff(np.append(starts, len(key)))
        inside = np.repeat(lengths, lengths)
        long = inside > SHORT_LIST
        left, right, shared = [], [], []

        def add(i: np.ndarray, j: np.ndarray, given: np.ndarray) -> None:
            fits = rule.near(size[i], size[j])
            left.append(np.minimum(name[i], name[j])[fits])
            right.append(np.maximum(name[i], name[j])[fits])
            shared.append(given[fits])

        # short lists: every pair, by the distance of the two in the list
        at = np.flatnonzero(inside > 1)
        place = at - np.repeat(starts, lengths)[at]
        at, place = at[~long[at]], place[~long[at]]
        for distance in range(1, SHORT_LIST):
            further = place + distance < inside[at]
            at, place = at[further], place[further]
            if not len(at):
                break
            add(at, at + distance, weight[at].astype("int64"))
        # long lists: each set with the first of its size range, and with the one before it
        for k in np.flatnonzero(lengths > SHORT_LIST):
            a, b = starts[k], starts[k] + lengths[k]
            pivot, pivots = a, np.empty(b - a, dtype="int64")
            for i in range(a, b):
                if not rule.near(size[pivot], size[i]):
                    pivot = i
                pivots[i - a] = pivot
            members = np.arange(a, b)
            rest = pivots != members
            add(pivots[rest], members[rest], np.full(rest.sum(), SHARED))
            add(members[:-1], members[1:], np.full(b - a - 1, SHARED))
        if left:
            a, b, s = np.concatenate(left), np.concatenate(right), np.concatenate(shared)
            if len(a):
                order = np.lexsort((b, a))
                a, b, s = a[order], b[order], s[order]
                first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
                yield pd.DataFrame({"kind": "pair", "a": a[first], "b": b[first], "n": np.add.reduceat(s, first)})
        if long.any():
            yield pd.DataFrame({"kind": "long", "a": key[long].astype("int64"), "b": name[long], "n": size[long]})

    return packed.mapInPandas(run, "kind string, a long, b long, n long")


def rebuilt_sets(names: DataFrame, docs: DataFrame, named: DataFrame, rule: Rule) -> DataFrame:
    """(name, elements) of the sets called ``names``, from one document of each, with or without an id."""
    one = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("one")
    chosen = named.groupBy("name").agg(one).join(names, "name").select(_id_text("one.doc_id").alias("id_text"), "one.text_hash")
    keyed = docs.select("text", _id_text("doc_id").alias("id_text"), F.xxhash64("text").alias("text_hash"))
    texts = keyed.join(chosen.distinct(), ["id_text", "text_hash"], "left_semi")

    def rebuild(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [(digest(s), s.tobytes()) for s in shingle_sets(batch["text"], rule.words) if len(s)]
            yield pd.DataFrame(sets, columns=["name", "elements"]).astype({"name": "int64"})

    return store(texts.select("text").mapInPandas(rebuild, "name long, elements binary").dropDuplicates(["name"]), "ngram-sets")


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) of set names whose sets do link, by their full intersection."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x, "uint64"), np.frombuffer(y, "uint64")
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                linked.append(rule.links(common, len(x), len(y)))
            yield batch.loc[linked, ["a", "b"]]

    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    return both.select("a", "b", "x", "y").mapInPandas(compare, "a long, b long")


def block_links(block: pd.DataFrame, rule: Rule) -> pd.DataFrame:
    """A forest of the links between sets of different components in one block of a long list."""
    block = block.drop_duplicates("node")
    names, component = block["node"].to_numpy(), block["component"].to_numpy()
    elements = [np.frombuffer(x, "uint64") for x in block["elements"]]
    sizes = np.asarray([len(e) for e in elements], dtype="int64")
    owner = np.repeat(np.arange(len(sizes)), sizes)
    values, inverse, counts = np.unique(np.concatenate(elements), return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1  # elements of one set alone are in no intersection
    shared = counts[inverse] > 1
    owner, column = owner[shared], number[inverse[shared]]
    common = np.zeros((len(sizes), len(sizes)), dtype="float32")
    strips = [slice(top, top + STRIP) for top in range(0, len(sizes), STRIP)]
    for first in range(0, int(column.max(initial=-1)) + 1, VOCABULARY):
        here = (column >= first) & (column < first + VOCABULARY)
        matrix = np.zeros((len(sizes), VOCABULARY), dtype="float32")
        matrix[owner[here], column[here] - first] = 1
        for rows in strips:
            common[rows] += matrix[rows] @ matrix.T
    a, b = np.zeros(0, "int64"), np.zeros(0, "int64")
    for rows in strips:
        linked = rule.links(common[rows], sizes[rows, None], sizes[None, :])
        linked &= component[rows, None] < component[None, :]
        i, j = np.nonzero(linked)
        i += rows.start
        low, high = np.minimum(names[i], names[j]), np.maximum(names[i], names[j])
        a, b = forest(np.concatenate([a, low]), np.concatenate([b, high]))
    return pd.DataFrame({"a": a, "b": b})


def long_list_links(long: DataFrame, found: DataFrame, docs: DataFrame, named: DataFrame, rule: Rule) -> DataFrame:
    """Links between the components that long lists (key, node, size) still hold, as forests.

    A list whose sets are one component already is done.  The others are compared block by block, every
    block of a list with every other, so a list of any length is many tasks of bounded size and no pair
    becomes a row.
    """
    labelled = long.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("key").agg(
        F.min("component").alias("lo"),
        F.max("component").alias("hi"),
        F.greatest(F.ceil(F.sum("size") / BLOCK_ELEMENTS), F.ceil(F.count("*") / BLOCK_SETS)).cast("int").alias("blocks"),
    )
    mixed = mixed.filter("lo < hi").select("key", "blocks")
    open_lists = store(labelled.join(mixed, "key").select("key", "node", "component", "blocks"), "ngram-open")
    sets = rebuilt_sets(open_lists.select(F.col("node").alias("name")).distinct(), docs, named, rule)
    own = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    dealt = open_lists.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "component")
    filled = dealt.join(sets.withColumnRenamed("name", "node"), "node")
    return filled.groupBy("key", "i", "j").applyInPandas(lambda block: block_links(block, rule), "a long, b long")


def _id_text(doc_id: str) -> Column:
    """Text of an id, empty for null: rows are told apart by it and the hash of their text."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def grouped_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, text_hash, n_shingles, component of every row of ``docs``; component null for an empty set.

    Sets of distinct word shingles link by ``rule``.  Equal sets are one set from
    the start.  All sets follow one order of elements, rare ones first, in which two linked sets must share
    some of their first elements.  Small sets are filed under the 2-element subsets of that prefix, large
    sets in an inverted list for each prefix element, and pairs that share enough lists are compared in full;
    where small ends is chosen by cost.  Long lists are first compared around pivots; what they leave in
    different components is then compared block by block, so no link between components is lost.
    """
    spark = docs.sparkSession
    named = store(name_sets(docs, rule), "ngram-names")
    sized = named.filter(F.col("name").isNotNull()).groupBy("name").agg(F.first("n_shingles").alias("n"))
    histogram = {r["n"]: r["c"] for r in sized.filter(F.col("n") <= MAX_BOUNDARY).groupBy("n").agg(F.count("*").alias("c")).collect()}
    often, mean_list = frequent_elements(docs, rule)
    boundary = choose_boundary({n: c for n, c in histogram.items() if rule.can_link(n)}, mean_list, rule)
    order = spark.sparkContext.broadcast(Order(often))
    scanned = store(scan_lists(file_sets(docs, order, boundary, rule), rule), "ngram-scan")
    pairs = store(
        scanned.filter("kind = 'pair'").groupBy("a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") >= SHARED).select("a", "b"),
        "ngram-pairs",
    )
    sets = rebuilt_sets(pairs.select(F.col("a").alias("name")).union(pairs.select("b")).distinct(), docs, named, rule)
    links = store(verified(pairs, sets, rule), "ngram-links")
    found = components(links, "ngram-components")
    long = scanned.filter("kind = 'long'").select(F.col("a").alias("key"), F.col("b").alias("node"), F.col("n").alias("size"))
    if not long.isEmpty():
        more = store(long_list_links(long, found, docs, named, rule), "ngram-more-links")
        found = components(links.union(more), "ngram-components")
    groups = named.join(found.withColumnRenamed("node", "name"), "name", "left")
    return groups.select("doc_id", "text_hash", "n_shingles", F.coalesce("component", "name").alias("component"))


def ngram_components(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text), by :func:`grouped_sets`.

    Null and empty texts have no set and link with nothing; a text with fewer words than a shingle has one shingle.  Ties:
    the component is named by its smallest doc_id.  Repeated rows each get a row.  A row with a null doc_id links
    like any other, and its component_id is null only where all of its component have none.  Other columns are
    not read, and an empty table gives no rows.
    """
    groups = grouped_sets(docs, rule)
    smallest = groups.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    with_set = groups.filter("component is not null").join(smallest, "component").select("doc_id", "n_shingles", "component_id")
    without = groups.filter("component is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return with_set.unionByName(without)


def keep_one_of_each(docs: DataFrame, rule: Rule) -> DataFrame:
    """One row of each component of ``docs``: of the smallest doc_id (null last), then text hash.

    Rows are told apart by id and text, so different texts under one id are different documents, and only
    exact copies of the row that stays go with it.  Null and empty texts are in no component and stay.
    """
    groups = grouped_sets(docs.select("doc_id", "text"), rule)
    one = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("one")
    kept = groups.filter("component is not null").groupBy("component").agg(one)
    id_text, text_hash = free_name(docs.columns, "_id_text"), free_name(docs.columns, "_text_hash")
    kept = kept.select(_id_text("one.doc_id").alias(id_text), F.col("one.text_hash").alias(text_hash))
    keyed = docs.withColumns({id_text: _id_text("doc_id"), text_hash: F.xxhash64("text")})
    key = [id_text, text_hash]
    wordless = ~F.coalesce(F.col("text").rlike(WORD_PATTERN), F.lit(False))
    once = keyed.filter(~wordless).join(kept, key, "left_semi").dropDuplicates(key)
    return once.select(*docs.columns).unionByName(docs.filter(wordless))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


OP7_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM worded
), elements AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS e FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common
  FROM elements a JOIN elements b ON a.e = b.e AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM shared WHERE 100 * common >= 85 * (na + nb - common)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS node, doc_id AS target FROM documents
  UNION
  SELECT r.node, l.b FROM reach r JOIN both_ways l ON r.target = l.a
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.target) AS component_id
FROM sets s JOIN reach r ON r.node = s.doc_id
GROUP BY s.doc_id, len(s.s)
"""
