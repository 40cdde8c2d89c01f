"""Exact top-k inner products with multi-resolution segment statistics.

Vectors are cut into 1, 2, 4, ... segments. Mean and deviation of the segments
bound a distance from below: |q - c|^2 >= sum of n ((mean_q - mean_c)^2 +
(dev_q - dev_c)^2), since the deviation parts can at best be parallel. With both
lengths known that is an upper bound of the inner product, q.c <= sum of
n (mean_q mean_c + dev_q dev_c). Each resolution drops the candidates whose bound
is below the k-th best exact score known for the query, and survivors are scored
with exact integers. Nothing is approximate: a dropped candidate cannot be in the
result, and bounds are widened by their rounding error.

Rows and queries are dealt into blocks of bounded size and every pair of blocks
is one group, so a task holds two blocks, whatever the table's size or its most
frequent vector. Per pair, k rows a query go on to the final ranking.

Defined results: vectors that are NULL or hold a NULL, NaN or infinite component
take no part, nor do rows with a NULL id; vectors of different lengths are not
compared; a repeated row is a candidate, and a query, of its own, and only the
row itself is left out of its answer. Scores beyond 64 bits wrap.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

SCALE = 256
K = 5
ROW_BLOCK = 512
QUERY_BLOCK = 1024
_OUT = "query_id long, _query long, vec_id long, score long"


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(F.coalesce(vector, F.array().cast("array<double>")), bad)


def _levels(width: int) -> list[list[slice]]:
    """Segmentations from one segment to segments of two components."""
    out, parts = [], 1
    while parts <= max(1, width // 2):
        edges = np.linspace(0, width, parts + 1).astype(int)
        out.append([slice(a, b) for a, b in zip(edges, edges[1:])])
        parts *= 4
    return out


def _statistics(m: np.ndarray, segments: list[slice]) -> np.ndarray:
    """sqrt(n) * mean and sqrt(n) * deviation per segment: bounds are then one product."""
    cols = []
    for s in segments:
        part, n = m[:, s], max(1, s.stop - s.start)
        mean = part.sum(axis=1) / n
        spread = np.sqrt(np.maximum((part * part).sum(axis=1) / n - mean * mean, 0.0))
        cols += [mean * np.sqrt(n), spread * np.sqrt(n)]
    return np.stack(cols, axis=1)


def _best(q: np.ndarray, c: np.ndarray, q_row: np.ndarray, c_row: np.ndarray, c_id: np.ndarray, k: int):
    """(query index, candidate index, score) of the k best of this pair of blocks."""
    qf, cf = q.astype(float), c.astype(float)
    limit = np.abs(qf).sum(axis=1) * np.abs(cf).max(initial=0.0)
    slack = 1e-6 * (1.0 + limit)
    levels = _levels(q.shape[1])
    stats = [(_statistics(qf, s), _statistics(cf, s)) for s in levels]
    bounds = stats[0][0] @ stats[0][1].T
    exact = np.full(bounds.shape, np.iinfo(np.int64).min, dtype=np.int64)
    known = np.zeros(bounds.shape, dtype=bool)
    own = q_row[:, None] == c_row[None, :]
    alive = ~own

    def score(which: np.ndarray) -> None:
        qi, ci = np.nonzero(which)
        for a in range(0, len(qi), 65536):
            i, j = qi[a : a + 65536], ci[a : a + 65536]
            exact[i, j] = (q[i] * c[j]).sum(axis=1)
        known[which] = True

    # The most promising candidates of the finest level give the first k-th best.
    finest = stats[-1][0] @ stats[-1][1].T
    if c.shape[0] > k:
        seeds = np.argpartition(np.where(alive, -finest, np.inf), k - 1, axis=1)[:, :k]
        first = np.zeros_like(alive)
        np.put_along_axis(first, seeds, True, axis=1)
        score(first & alive)
        floor = np.sort(exact, axis=1)[:, -k].astype(float)
        for level in range(len(levels)):
            bound = stats[level][0] @ stats[level][1].T
            alive &= bound + slack[:, None] >= floor[:, None]
    score(alive & ~known)
    out = []
    for i in range(q.shape[0]):
        j = np.nonzero(known[i] & ~own[i])[0]
        out.append((i, j[np.lexsort((c_id[j], -exact[i, j]))[:k]]))
    return out, exact


def _pair(k: int):
    def run(key, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(queries):
            c, q = np.stack(rows["v"].to_numpy()), np.stack(queries["v"].to_numpy())
            ids, q_ids = rows["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
            places, q_places = rows["_row"].to_numpy(), queries["_row"].to_numpy()
            best, exact = _best(q, c, q_places, places, ids, k)
            for i, j in best:
                found.append(
                    pd.DataFrame(
                        {"query_id": q_ids[i], "_query": q_places[i], "vec_id": ids[j], "score": exact[i, j]}
                    )
                )
        if not found:
            return pd.DataFrame({"query_id": [], "_query": [], "vec_id": [], "score": []}, dtype="int64")
        return pd.concat(found, ignore_index=True)

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    row_block: int = ROW_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query row.

    Ties go to the smaller id. ``is_query`` is a condition on ``vectors``.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).alias("_v"),
        F.coalesce(is_query, F.lit(False)).alias("_asks"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("_v"))).select(
        "vec_id", quantised(F.col("_v"), scale).alias("v"), "_asks", "_row"
    )
    rows = rows.withColumn("_width", F.size("v"))
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("_asks").alias("q")).first()
    groups, asks = max(1, -(-counts.n // row_block)), max(1, -(-counts.q // query_block))
    deal = lambda n: F.pmod(F.xxhash64("_row"), F.lit(n)).cast("int")
    columns = ["_width", "_group", "_ask", "vec_id", "_row", "v"]
    left = rows.withColumns(
        {"_group": deal(groups), "_ask": F.explode(F.sequence(F.lit(0), F.lit(asks - 1)))}
    ).select(columns)
    right = rows.filter("_asks").withColumns(
        {"_ask": deal(asks), "_group": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))}
    ).select(columns)
    keys = ["_width", "_group", "_ask"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_pair(k), _OUT)
    order = Window.partitionBy("query_id", "_query").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
