"""Connected components of a link table, without bringing links to the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

MAX_ROUNDS = 60


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links as a star around the smallest member of each component of this block."""
    if not len(a):
        return a, b
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:  # smallest label over each link, then jump to the label's label
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[label[moved]], nodes[moved]


def contract(links: DataFrame) -> DataFrame:
    """Each partition's links (a, b) reduced to a star for each of its components."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = np.zeros(0, "int64"), np.zeros(0, "int64")
        for batch in batches:
            a, b = forest(np.concatenate([a, batch["a"].to_numpy()]), np.concatenate([b, batch["b"].to_numpy()]))
        yield pd.DataFrame({"a": a, "b": b})

    return links.mapInPandas(run, "a long, b long")


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.

    Large-star and small-star rounds until nothing changes; each round is a written table.  Blocks are
    contracted on the way, so a group of any size costs a few rows for each task.  No links, no rows.
    """
    edges = store(contract(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")), label)
    before = None
    for _ in range(MAX_ROUNDS):
        # large star: every neighbour above a node is linked to the node's smallest neighbour
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").filter("b > a").select(F.col("low").alias("a"), "b").distinct()
        # small star: a node and its smaller neighbours are linked to the smallest of them
        least = large.groupBy("b").agg(F.min("a").alias("low"))
        small = large.join(least, "b").filter("a != low").select(F.col("low").alias("a"), F.col("a").alias("b"))
        edges = store(contract(small.union(least.select(F.col("low").alias("a"), "b")).distinct()), label)
        state = edges.agg(
            F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_003), F.lit(0)), F.count_distinct("b")
        ).first()
        if state == before and state[0] == state[2]:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        edges.select("a", "a").distinct().toDF("node", "component")
    )
