"""k-means on integer vectors; the nearest centroid is found by the threshold algorithm.

For every dimension the centroids are listed in the order of their value. From a
vector's own value each list is walked outward, nearest entry first. A centroid is
measured exactly when any list first shows it. A centroid that no list has shown
yet lies, in each dimension, at least as far as the entry shown last, so the sum of
these squared frontier distances is a lower bound for it: the walk ends when that
sum strictly exceeds the best exact distance (an equal one could still hide a
smaller number), or when every centroid has been shown. Vectors of a batch walk
side by side and leave when they are done.

A round is one job over the written vectors: each task folds its own into a sum
and a count per centroid, these are added up by (centroid, dimension), and k times
width numbers reach the driver, whatever the input or the size of a cluster. A
lost executor's tasks run again from files. A round that moves no centroid is the
last: all later ones would repeat it.

Defined results: vectors that are NULL, of another width, or hold a NULL, NaN or
infinite component are not clustered and not returned; a repeated row counts once
per row; a NULL id is an empty one in the hash of the first centroids and comes
back as NULL; with fewer vectors than k there are fewer centroids. Numbers whose
squared distance passes 64 bits (quantised components of about 2^28) wrap around.
Other columns are not read, so their names do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import stored
from tidemark.llm.topk import quantised, usable

K = 40
ROUNDS = 5
WIDTH = 64
SCALE = 256
CHUNK = 1024  # vectors that walk side by side
_FAR = np.iinfo(np.int64).max


class Lists:
    """The sorted list of every dimension, ready to be walked."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.order, axis=0)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance, centroids measured) of every row of ``x``."""
        k, width = self.centroids.shape
        best = np.full(len(x), _FAR)
        who = np.full(len(x), k)
        measured = np.zeros(len(x), dtype=np.int64)
        above = np.stack([np.searchsorted(self.values[:, d], x[:, d]) for d in range(width)], axis=1)
        below = above - 1
        shown = np.zeros((len(x), k), dtype=bool)
        live, dims = np.arange(len(x)), np.arange(width)
        while len(live):
            v, up, down = x[live], above[live], below[live]
            to_up = np.where(up < k, self.values[np.minimum(up, k - 1), dims] - v, _FAR)
            to_down = np.where(down >= 0, v - self.values[np.maximum(down, 0), dims], _FAR)
            falls = to_down <= to_up
            met = self.order[np.where(falls, down, up), dims]
            now = np.zeros((len(live), k), dtype=bool)
            np.put_along_axis(now, met, True, axis=1)
            row, number = np.nonzero(now & ~shown[live])
            exact = np.full((len(live), k), _FAR)
            exact[row, number] = ((v[row] - self.centroids[number]) ** 2).sum(axis=1)
            shown[live] |= now
            measured[live] += np.bincount(row, minlength=len(live))
            first = exact.argmin(axis=1)  # of equal ones the smallest number
            least = exact[np.arange(len(live)), first]
            better = (least < best[live]) | ((least == best[live]) & (first < who[live]))
            best[live[better]], who[live[better]] = least[better], first[better]
            frontier = (np.where(falls, to_down, to_up) ** 2).sum(axis=1)
            going = (frontier <= best[live]) & ~shown[live].all(axis=1)
            above[live] += ~falls
            below[live] -= falls
            live = live[going]
        return who, best, measured


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def kept_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    width: int = WIDTH,
    scale: int = SCALE,
) -> DataFrame:
    """(vec_id, v), written once: vectors of ``width`` sound components, quantised."""
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("raw"))
    sound = F.coalesce(F.size("raw") == width, F.lit(False)) & usable(F.col("raw"))
    return stored(given.filter(sound).select("vec_id", quantised(F.col("raw"), scale).alias("v")), "vectors")


def first_centroids(kept: DataFrame, k: int = K, seed: int = 2) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of their ids, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    # `k` rows at most; rows of one id and vector are alike
    first = kept.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in first], dtype=np.int64)


def _totals(kept: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sum of the vectors nearest to every centroid that has some."""
    k, width = centroids.shape

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        sums, counts = np.zeros((k, width), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            for at in range(0, len(x), CHUNK):
                part = x[at : at + CHUNK]
                who, _, _ = lists.nearest(part)
                np.add.at(sums, who, part)
                counts += np.bincount(who, minlength=k)
        some = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some, pa.int32()),
                pa.array(counts[some], pa.int64()),
                pa.array(sums[some].tolist(), pa.list_(pa.int64())),
            ],
            ["cluster", "n", "sums"],
        )

    folded = kept.select("v").mapInArrow(fold, "cluster int, n long, sums array<long>")
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))  # noqa: E731  beyond 64 bits, too
    added = (
        folded.select("cluster", "n", F.posexplode("sums").alias("d", "x"))
        .groupBy("cluster", "d")
        .agg(whole("n").alias("n"), whole("x").alias("total"))
    )
    out: dict[int, tuple[int, list[int]]] = {}
    for r in added.collect():  # k times width rows at most
        out.setdefault(r.cluster, (int(r.n), [0] * width))[1][r.d] = int(r.total)
    return out


def fit(kept: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = 2) -> np.ndarray:
    """Centroids after ``rounds`` rounds; empty ones stay where they are."""
    centroids = first_centroids(kept, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        moved = centroids.copy()
        for number, (n, sums) in _totals(kept, centroids).items():
            moved[number] = [total // n for total in sums]
        if (moved == centroids).all():
            break
        centroids = moved
    return centroids


def assign(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every row of ``kept``."""
    out = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return kept.sparkSession.createDataFrame([], out)
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        for batch in batches:
            x = _matrix(batch.column(1), width)
            found = [lists.nearest(x[at : at + CHUNK])[:2] for at in range(0, max(1, len(x)), CHUNK)]
            who, best = (np.concatenate(part) for part in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(who, pa.int32()), pa.array(best, pa.int64())],
                ["vec_id", "cluster", "distance"],
            )

    return kept.select("vec_id", "v").mapInArrow(run, out)


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia and centroid_sha256; written before it is summed."""
    assigned = stored(assigned, "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    if not sums:
        return assigned.selectExpr(
            "*", "0L as cluster_inertia", "0L as inertia", "'' as centroid_sha256"
        )
    spell = lambda c: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
    rows = [(r.cluster, int(r.total), spell(centroids[r.cluster])) for r in sums]  # one per centroid
    side = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, centroid_sha256 string")
    return (
        assigned.join(F.broadcast(side), "cluster")
        .withColumn("inertia", F.lit(sum(r[1] for r in rows)).cast("long"))
        .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    )
