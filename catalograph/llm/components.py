"""Connected components of a link table by alternating star contraction.

Each round points every node at the smallest neighbour it knows, first from the
larger side, then from the smaller. Aggregates are combined before they are
shuffled and the joins are plain equi-joins whose hot keys adaptive execution
splits. Rounds are written to the shared folder, so a lost executor costs a
round at most; the driver only learns whether stars are left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalograph.llm.support import written


def _root(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links (a, b) as (node, smallest node of its component), roots left out."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = np.arange(len(nodes))
    left, right = index[:len(a)], index[len(a):]
    while len(left):
        low = np.minimum(label[left], label[right])
        high = np.maximum(label[left], label[right])
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
        open_ = label[left] != label[right]
        left, right = left[open_], right[open_]
    away = label != np.arange(len(nodes))
    return nodes[away], nodes[label[away]]


def _contract(links: DataFrame) -> DataFrame:
    """Replace each task's links by stars: the same components with fewer rows."""

    def stars(source):
        held_a, held_b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in source:
            held_a, held_b = forest(np.concatenate([held_a, batch.column(0).to_numpy()]),
                                    np.concatenate([held_b, batch.column(1).to_numpy()]))
        yield pa.record_batch([pa.array(held_a, pa.int64()), pa.array(held_b, pa.int64())], names=["a", "b"])

    return links.mapInArrow(stars, "a long, b long")


def _large_star(links: DataFrame) -> DataFrame:
    """For every node: its larger neighbours point at the smallest of its neighbourhood."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .where("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """For every node: itself and its smaller neighbours point at the smallest of them (b < a holds)."""
    low = links.groupBy("a").agg(F.min("b").alias("low"))
    others = links.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return others.union(low.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b): each linked node and the smallest node it can reach, for nodes that are not the smallest.

    ``links`` has long columns a and b, in any direction and any number.
    """
    links = written(_contract(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))),
                    "links")
    while not _stars(links):
        links = written(_contract(_small_star(_large_star(links))), "links")
    return links


def _stars(links: DataFrame) -> bool:
    """True if every node points at one other node, and at none that points on itself."""
    ends = links.select("a", F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        links.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("a").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where(
        "out > 1 OR (out = 1 AND into = 1)").isEmpty()
