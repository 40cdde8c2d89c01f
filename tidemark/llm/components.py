"""Connected components of a large edge list by alternating stars.

Tasks first join up the edges that they read, as a combiner would: up to ``EDGES``
each, however long the list. A list that is one task's share is done then, without
any shuffle. Of a longer one stars are left, which meet in steps; each is a grouped
minimum and a join, written below the shared folder, so a step survives lost
executors and the plan does not grow. Chains of length n take about log n steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import discard, stored

EDGES = 1 << 18  # that one task holds at a time


def _joined_up(edges: DataFrame) -> DataFrame:
    """(u, v): every node of the edges that a task holds, and the least node they connect it with."""

    def stars(held: list[pd.DataFrame]) -> pd.DataFrame:
        ends = pd.concat(held)[["u", "v"]].to_numpy().T
        nodes, at = np.unique(ends, return_inverse=True)
        at = at.reshape(2, -1)
        return pd.DataFrame({"u": nodes, "v": nodes[forest(len(nodes), *at)]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for frame in frames:
            for low in range(0, len(frame), EDGES):
                part = frame.iloc[low : low + EDGES]
                if n + len(part) > EDGES:
                    yield stars(held)
                    held, n = [], 0
                held.append(part)
                n += len(part)
        if held:
            yield stars(held)

    return edges.mapInPandas(run, "u long, v long")


def _large(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is hung on the least node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below are hung on the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v), a written table; component is its least node."""
    given = edges.select("u", "v").filter("u <> v")
    shares = max(1, -(-given.count() // EDGES))
    now = stored(_joined_up(given.coalesce(shares)), "stars")
    if shares == 1:
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    before, last = None, now
    now = now.filter("u <> v")
    while True:
        now = stored(_small(_large(now)).filter("u <> v").distinct(), "stars")
        discard(last)  # a step reads the one before only
        last = now
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def forest(size: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least of the numbers below ``size`` connected with each, within one task."""
    label = np.arange(size)
    while True:
        x, y = label[u], label[v]
        if (x == y).all():
            return label
        least = np.minimum(x, y)
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        while (label[label] != label).any():
            label = label[label]
