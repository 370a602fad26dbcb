"""Near-duplicate embeddings by spherical-cap filters."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, read_table, store
from .components import components, forest

COSINE = 0.95
BLOCKS = 3  # parts of a vector, each with its own random directions
POINTS_PER_FILTER = 1.0  # filters grow with the vectors, so that lists do not
EXPECTED = 16  # filters that a random vector exceeds, on average
AT_LEAST = 12  # best filters taken where fewer are exceeded
LOOSE = 12  # how many times more filters are decoded to find those
LIST_BLOCK = 2_000  # longer lists are compared in blocks
SEED = 20
MISSED = 0.001  # share of pairs at the least cosine that may share no filter, whatever the number of vectors
TRIAL_PAIRS = 2_000  # made pairs from which the number of codes follows


@dataclass
class ProductCode:
    """Filter directions: all ways to join one random direction from each part of a rotated vector.

    A filter's score is the sum of its parts' scores, so the exceeding ones are found without looking at
    all: parts are joined one by one, as long as the best rest could still reach the threshold.
    """

    rotation: np.ndarray
    parts: list[np.ndarray]  # (dimensions, directions) of each part
    threshold: float
    loose: float

    @classmethod
    def build(cls, dimensions: int, points: int, seed: int = SEED) -> ProductCode:
        rng = np.random.default_rng([seed, dimensions])
        blocks = min(BLOCKS, dimensions)
        directions = int(np.clip(round((points / POINTS_PER_FILTER) ** (1 / blocks)), 6, 4096))
        rotation, _ = np.linalg.qr(rng.standard_normal((dimensions, dimensions)))
        parts = []
        for columns in np.array_split(np.arange(dimensions), blocks):
            c = rng.standard_normal((len(columns), directions))
            parts.append(c / np.linalg.norm(c, axis=0))
        # thresholds from what random vectors score on random filters
        sample = rng.standard_normal((2_000, dimensions))
        sample /= np.linalg.norm(sample, axis=1, keepdims=True)
        code = cls(rotation, parts, 0.0, 0.0)
        scores = code.scores(sample)
        drawn = sum(s[:, rng.integers(0, s.shape[1], 2_000)] for s in scores)
        share = EXPECTED / directions**blocks
        code.threshold = float(np.quantile(drawn, max(0.0, 1 - share)))
        code.loose = float(np.quantile(drawn, max(0.0, 1 - LOOSE * share)))
        return code

    def scores(self, vectors: np.ndarray) -> list[np.ndarray]:
        turned = vectors @ self.rotation
        edges = np.cumsum([0, *[p.shape[0] for p in self.parts]])
        return [turned[:, a:b] @ p for a, b, p in zip(edges[:-1], edges[1:], self.parts, strict=True)]

    def decode(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Sorted filters of each vector: all it exceeds, and never fewer than its best ``AT_LEAST``."""
        scores = self.scores(vectors)
        n, directions = len(vectors), self.parts[0].shape[1]
        rest = np.cumsum([s.max(axis=1) for s in scores[::-1]], axis=0)[::-1]
        # even the best vectors of a batch may stay below the loose threshold: then it gives way for them
        floor = np.minimum(self.loose, rest[0] * 0.8)
        row, total, name = np.arange(n), np.zeros(n), np.zeros(n, dtype="int64")
        for k, s in enumerate(scores):
            after = rest[k + 1] if k + 1 < len(scores) else np.zeros(n)
            reach = total[:, None] + s[row]
            i, j = np.nonzero(reach >= (floor - after)[row][:, None])
            row, total, name = row[i], reach[i, j], name[i] * directions + j
        order = np.lexsort((-total, row))
        row, total, name = row[order], total[order], name[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = (total >= self.threshold) | (place < AT_LEAST)
        row, name = row[keep], name[keep]
        edges = np.searchsorted(row, np.arange(n + 1))
        return [np.sort(name[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def product_codes(dimensions: int, points: int, number: int) -> list[ProductCode]:
    return [ProductCode.build(dimensions, points, SEED + k) for k in range(number)]


def decode_all(codes: list[ProductCode], vectors: np.ndarray) -> list[np.ndarray]:
    """Sorted filters of each vector over independent codes, numbered apart."""
    each = [code.decode(vectors) for code in codes]
    shift = codes[0].parts[0].shape[1] ** len(codes[0].parts)
    return [np.concatenate([f + k * shift for k, f in enumerate(lists)]) for lists in zip(*each, strict=True)]


def made_pairs(rng: np.random.Generator, n: int, dimensions: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and partners at exactly that cosine."""
    x, z = rng.standard_normal((2, n, dimensions))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    return x, cosine * x + np.sqrt(1 - cosine**2) * z


def codes_needed(dimensions: int, points: int, least: float) -> int:
    """Independent codes by which at most ``MISSED`` of the pairs at cosine ``least`` share no filter.

    The filters grow with the points, so one code misses more pairs of a larger table.  A code is rotated
    at random: its misses on made pairs are those on any pairs of that cosine, and independent codes
    multiply them.
    """
    if dimensions == 1 or least >= 1:
        return 1
    code = ProductCode.build(dimensions, points)
    rng = np.random.default_rng([SEED, dimensions, TRIAL_PAIRS])
    missed = 0
    for at in range(0, TRIAL_PAIRS, 200):
        x, y = made_pairs(rng, min(200, TRIAL_PAIRS - at), dimensions, least)
        missed += sum(not np.isin(a, b).any() for a, b in zip(code.decode(x), code.decode(y), strict=True))
    share = (missed + 2 * np.sqrt(missed) + 2) / TRIAL_PAIRS  # an upper limit, for the trial is small
    if share > 0.9:
        raise ValueError(f"filters do not find pairs at a cosine of {least} among {points} vectors")
    return int(np.ceil(np.log(MISSED) / np.log(share)))


def as_vectors(column: pd.Series, dimensions: int) -> np.ndarray:
    return np.asarray(np.vstack(column.tolist()), dtype="float64").reshape(-1, dimensions)


def directed(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(embedding: str) -> str:
    """SQL: whether a vector has a direction."""
    return (
        f"coalesce({embedding} is not null and size({embedding}) > 0 "
        f"and forall({embedding}, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) "
        f"and exists({embedding}, x -> x <> 0), false)"
    )


def decoded(points: DataFrame, least: float) -> DataFrame:
    """``points`` (node, copies, embedding) with their filters; vectors of another length have other filters."""
    sizes = {r["d"]: r["n"] for r in points.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).collect()}
    numbers = {d: codes_needed(d, n, least) for d, n in sizes.items() if n > 1}

    # components travel as they are, half as wide as the double-precision directions made of them
    kept = "float32" if points.schema["embedding"].dataType.elementType.typeName() == "float" else "float64"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes: dict[int, list[ProductCode]] = {}
        for batch in batches:
            lengths = batch["embedding"].map(len).to_numpy()
            for d in np.unique(lengths):
                d = int(d)
                if d not in codes:
                    codes[d] = product_codes(d, sizes[d], numbers.get(d, 1))
                for at in range(0, int((lengths == d).sum()), 1_000):
                    part = batch[lengths == d].iloc[at : at + 1_000]
                    x = as_vectors(part["embedding"], d)
                    sent = [v.tobytes() for v in x.astype(kept)]
                    yield pd.DataFrame({"node": part["node"], "copies": part["copies"], "d": d, "x": sent, "filters": code_lists(codes[d], directed(x))})

    def code_lists(codes: list[ProductCode], x: np.ndarray) -> list[list[int]]:
        return [f.tolist() for f in decode_all(codes, x)]

    return points.mapInPandas(run, "node long, copies long, d int, x binary, filters array<long>")


def _earlier(filters: list[np.ndarray], at: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs already meet under a filter before ``at``."""
    before = [f[f < at] for f in filters]
    width = max(map(len, before), default=0)
    met = np.zeros(len(i), dtype=bool)
    if not width:
        return met
    table = np.full((len(before), width), -1, dtype="int64")
    for k, f in enumerate(before):
        table[k, : len(f)] = f
    other = np.where(table < 0, -2, table)
    left = np.arange(len(i))
    for column in range(width):
        left = left[table[i[left], column] >= 0]
        for low in range(0, len(left), 200_000):
            part = left[low : low + 200_000]
            met[part] = (table[i[part], column][:, None] == other[j[part]]).any(axis=1)
        left = left[~met[left]]
        if not len(left):
            break
    return met


def compare_list(members: pd.DataFrame, at: int, first: int, second: int, least: float) -> tuple[np.ndarray, ...]:
    """Links of one list or pair of its blocks: (node, linked copies) and a forest."""
    width = len(members["x"].iloc[0]) // int(members["d"].iloc[0])
    x = directed(np.frombuffer(b"".join(members["x"]), dtype=f"f{width}").astype("float64").reshape(len(members), -1))
    node, copies = members["node"].to_numpy(), members["copies"].to_numpy()
    i, j = np.nonzero(np.triu(x @ x.T >= least, 1))
    if first != second:
        own = members["own"].to_numpy()
        across = own[i] != own[j]
        i, j = i[across], j[across]
    if len(i):
        new = ~_earlier([np.asarray(f, dtype="int64") for f in members["filters"]], at, i, j)
        i, j = i[new], j[new]
    a, b = forest(np.minimum(node[i], node[j]), np.maximum(node[i], node[j]))
    linked = np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
    return node, linked.astype("int64"), a, b


def links_of(points: DataFrame, least: float) -> DataFrame:
    """Rows (kind, a, b): 'count' node and copies linked to it; 'link' an edge of a forest of links."""
    stored = store(decoded(points, least), "caps-filters")
    n = partitions(stored.sparkSession)
    long = stored.select("d", F.explode("filters").alias("f")).groupBy("d", "f").count().filter(F.col("count") > LIST_BLOCK)
    long = long.select(F.col("d").alias("ld"), F.col("f").alias("lf"), F.ceil(F.col("count") / LIST_BLOCK).cast("int").alias("blocks"))
    long = store(long, "caps-long")  # its size is known then, and where it is small the points are not shuffled for it
    filed = stored.select("*", F.explode("filters").alias("f"))
    filed = filed.join(long, (F.col("d") == F.col("ld")) & (F.col("f") == F.col("lf")), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    filed = filed.withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    filed = filed.select("d", "f", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "copies", "x", F.expr("filter(filters, g -> g < f)").alias("filters"))
    lists = filed.repartition(n, "d", "f", "i", "j").sortWithinPartitions("d", "f", "i", "j")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: list[np.ndarray] = []
        edges: list[np.ndarray] = []

        def flush() -> Iterator[pd.DataFrame]:
            if counts:
                table = np.concatenate(counts, axis=1)
                nodes, index = np.unique(table[0], return_inverse=True)
                yield pd.DataFrame({"kind": "count", "a": nodes, "b": np.bincount(index, table[1]).astype("int64")})
            if edges:
                a, b = forest(*np.concatenate(edges, axis=1))
                yield pd.DataFrame({"kind": "link", "a": a, "b": b})
            counts.clear()
            edges.clear()

        def finish(frame: pd.DataFrame) -> None:
            key = frame[["d", "f", "i", "j"]].to_numpy()
            starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
            for a, b in zip(starts, np.append(starts[1:], len(frame)), strict=True):
                if b - a > 1:
                    _, at, first, second = key[a]
                    node, linked, p, q = compare_list(frame.iloc[a:b], at, first, second, least)
                    if linked.any():
                        counts.append(np.stack([node[linked > 0], linked[linked > 0]]))
                        edges.append(np.stack([p, q]))

        # lists are sorted; the last of a batch may go on in the next
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            key = batch[["d", "f", "i", "j"]].to_numpy()
            same = (key == key[-1]).all(axis=1)
            begin = len(batch) - int(same[::-1].argmin()) if not same.all() else 0
            finish(batch.iloc[:begin])
            rest = batch.iloc[begin:]
            if sum(c.shape[1] for c in counts) > 1_000_000:
                yield from flush()
        if rest is not None:
            finish(rest)
        yield from flush()

    return lists.mapInPandas(run, "kind string, a long, b long")


def near_duplicates(vectors: DataFrame, least: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Two vectors link when their cosine, in double precision, is at least ``least``.  Equal vectors are one
    point with copies from the start.  Points are filed under all filter directions of structured random
    product codes that they exceed (their best dozen of each at least), points of one filter are compared in
    full, and a pair is counted under the first filter it shares.  A list longer than ``LIST_BLOCK`` is compared block
    by block; counts and forests of links leave a task, never pairs.  A pair that shares no filter is missed:
    at the threshold at most one in a thousand is expected to be (``MISSED``), for any number of vectors, since
    the number of codes follows from made pairs; well above it hardly any.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do
    vectors of different length.  Repeated rows are rows: they link to each other.  A null id counts as a row
    without a name: its component is the smallest id it reaches, null if there is none.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"))
    valid = rows.filter(usable("embedding")).withColumn("embedding", F.expr("transform(embedding, x -> x + cast(0 as float))"))
    points = valid.groupBy("embedding").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    points = store(points.withColumn("node", F.monotonically_increasing_id()), "caps-points")
    found = store(links_of(points.select("node", "copies", "embedding"), least), "caps-links")
    counts = found.filter("kind = 'count'").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("linked"))
    grouped = components(found.filter("kind = 'link'").select("a", "b"), "caps-components")
    labelled = points.join(grouped, "node", "left").join(counts, "node", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "node"))
    smallest = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    point_rows = labelled.join(smallest, "component").select(
        F.col("embedding").alias("p_embedding"),
        (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        "component_id",
    )
    linked = valid.join(point_rows, F.col("embedding") == F.col("p_embedding")).select("vec_id", "n_links", "component_id")
    alone = rows.filter(f"not {usable('embedding')}").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op1_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS node, vec_id AS target FROM embeddings
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON r.target = l.a
), grouped AS (
  SELECT node, min(target) AS component_id FROM reach GROUP BY node
)
SELECT g.node AS vec_id, (SELECT count(*) FROM links l WHERE l.a = g.node)::BIGINT AS n_links,
  g.component_id, g.node = g.component_id AS kept
FROM grouped g
"""
