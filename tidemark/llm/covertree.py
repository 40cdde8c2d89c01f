"""Exact near-duplicate links between vectors by dual traversal of cover trees.

Cosine ``similar`` or more is, between unit vectors, a distance of at most
``sqrt(2 - 2 similar)``. Only vectors of one group (label) are compared.

1. Classes. Equal vectors of a group become one class with a weight, so copies are
   never paired.
2. Top level. A group too large for one block gets pivots, a bounded number over
   all groups, and each class goes to the cell of its nearest pivot; the largest
   distance in a cell is its covering radius. A cell still too large is dealt into
   blocks by hash. A block is bounded in bytes, however many vectors share a group.
3. Trees. Each block becomes a cover tree, built once and written: a node's points
   lie within its radius, its children are a net of half the radius (each at least
   that far from the others), and its centre is its first child's centre as well.
   Levels that would have one child are skipped, leaves are single points.
4. Meetings. Two blocks meet unless the distance of their pivots exceeds both
   covering radii and the link distance. In a meeting, pairs of nodes are opened
   from the roots down. With centres ``D`` apart and radii ``r`` and ``s``, a pair
   is dropped when ``D - r - s`` exceeds the link distance and taken whole when
   ``D + r + s`` does not; only pairs of points that rounding leaves open are
   measured again, in a fixed order of summation. What is taken whole is counted,
   not listed, so a dense group costs no pair of rows.
5. Result. A meeting hands back, per class, the weight of its links and one edge to
   a class it is connected with. Edges go through connected components.

Nothing is approximate: every pair of a group is decided by a bound or by its
cosine, in double precision. Vectors that no bound separates (random ones in many
dimensions are all about equally far apart) are compared centre by centre, so
such data cost the square of a group; clustered data do not.

Defined results: a vector that is NULL, all zero or holds a NULL, NaN or infinite
component, one without label and one with a NULL id has no links and is its own
component (NULL for a NULL id); these are kept. Vectors of different lengths have
no cosine. A repeated row is a vector of its own, linked with the other, and all
rows that bear the least id of a component are kept. Other columns are not read,
so their names do not matter.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import stored
from tidemark.llm.components import components, forest
from tidemark.llm.topk import usable

SIMILAR = 0.98
BLOCK_BYTES = 1 << 20  # of doubles: 2048 vectors of 64 components
PIVOTS = 1024  # over all groups
SMALL = 32  # a node of so few points is opened to its points at once
SLACK = 1e-6  # more than the rounding error of a distance


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, whatever their magnitude."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _apart(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


class CoverTree:
    """Nodes are ranges of the reordered points; the first point of a range is the node's centre."""

    FIELDS = ("points", "ids", "weights", "start", "end", "radius", "child", "children", "leaf")

    def __init__(self, **arrays: np.ndarray):
        for name in self.FIELDS:
            setattr(self, name, arrays[name])
        self.heavy = np.concatenate([[0], np.cumsum(self.weights)])

    @classmethod
    def build(cls, points: np.ndarray, ids: np.ndarray, weights: np.ndarray) -> CoverTree:
        order = np.arange(len(points))
        first = np.sqrt(((points - points[0]) ** 2).sum(axis=1)).max()
        nodes = [[0, len(points), float(first), 0, 0]]
        at = 0
        while at < len(nodes):
            start, end, radius, _, _ = nodes[at]
            if end - start > 1:
                nodes[at][3] = len(nodes)
                level = 2.0
                while level >= radius and level > SLACK:
                    level /= 2
                left, done = order[start:end], []
                while len(left):
                    far = np.sqrt(((points[left] - points[left[0]]) ** 2).sum(axis=1))
                    far[0] = 0.0
                    near = far <= level if level > SLACK else far < 0
                    near[0] = True
                    done.append(left[near])
                    nodes.append([start, start + int(near.sum()), float(far[near].max()), 0, 0])
                    start += int(near.sum())
                    left = left[~near]
                order[nodes[at][0] : end] = np.concatenate(done)
                nodes[at][4] = len(done)
            at += 1
        start, end, radius, child, children = (np.array(c) for c in zip(*nodes))
        leaf = np.zeros(len(points), dtype=np.int64)
        single = np.nonzero(end - start == 1)[0]
        leaf[start[single]] = single
        return cls(
            points=points[order], ids=ids[order], weights=weights[order], start=start, end=end,
            radius=radius, child=child, children=children, leaf=leaf,
        )

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.FIELDS})
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> CoverTree:
        with np.load(io.BytesIO(data), allow_pickle=False) as kept:
            return cls(**{name: kept[name] for name in cls.FIELDS})

    def opened(self, node: int) -> np.ndarray:
        """The nodes that ``node`` is opened to: its children, its points, or itself."""
        if not self.children[node]:
            return np.array([node])
        if self.end[node] - self.start[node] <= SMALL:
            return self.leaf[self.start[node] : self.end[node]]
        return np.arange(self.child[node], self.child[node] + self.children[node])

    def weight(self, nodes: np.ndarray) -> np.ndarray:
        return self.heavy[self.end[nodes]] - self.heavy[self.start[nodes]]


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    """The cosine of two vectors, the same whatever block they were met in."""
    return math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


class Meeting:
    """All links between the points of two trees, or within one."""

    def __init__(self, a: CoverTree, b: CoverTree | None, similar: float):
        self.same = b is None
        self.a, self.b = a, a if b is None else b
        self.similar = similar
        self.reach = math.sqrt(2.0 - 2.0 * similar)
        self.base = 0 if self.same else len(a.points)  # where the points of b begin
        size = len(a.points) + (0 if self.same else len(self.b.points))
        self.gain = np.zeros(size + 1, dtype=np.int64)  # differences of the weight of links
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.whole_a, self.whole_b = (np.zeros(len(t.start), dtype=bool) for t in (a, self.b))
        self.compared = 0
        self._walk()

    def _walk(self) -> None:
        a, b = self.a, self.b
        todo = [(0, 0)]
        while todo:
            p, q = todo.pop()
            x, y = a.opened(p), b.opened(q)
            cosine = a.points[a.start[x]] @ b.points[b.start[y]].T
            apart, radii = _apart(cosine), a.radius[x][:, None] + b.radius[y][None, :]
            if self.same and p == q:  # each pair once
                np.fill_diagonal(apart, 0.0)
                todo_here = np.triu(np.ones(apart.shape, dtype=bool))
            else:
                todo_here = np.ones(apart.shape, dtype=bool)
            self.compared += int(todo_here.sum())
            whole = todo_here & (apart + radii <= self.reach - SLACK)
            if self.same and p == q:  # a point is counted with itself, and taken off in links()
                np.fill_diagonal(whole, np.diag(whole) | (a.children[x] == 0))
            unsure = todo_here & ~whole & (apart - radii <= self.reach + SLACK)
            self._take(x, y, whole)
            for i, j in zip(*np.nonzero(unsure)):
                u, v = int(x[i]), int(y[j])
                if a.children[u] or b.children[v]:
                    todo.append((u, v))
                elif not (self.same and u == v):
                    if exact_cosine(a.points[a.start[u]], b.points[b.start[v]]) >= self.similar:
                        self._take(x[i : i + 1], y[j : j + 1], np.ones((1, 1), dtype=bool))

    def _take(self, x: np.ndarray, y: np.ndarray, taken: np.ndarray) -> None:
        """Every point below ``x[i]`` is linked with every point below ``y[j]`` where ``taken[i, j]``."""
        i, j = np.nonzero(taken)
        if not len(i):
            return
        a, b, u, v = self.a, self.b, x[i], y[j]
        if self.same:
            itself = u == v  # all pairs within one node
            own = u[itself]
            np.add.at(self.gain, a.start[own], a.weight(own))
            np.subtract.at(self.gain, a.end[own], a.weight(own))
            self.whole_a[own] = True
            u, v = u[~itself], v[~itself]
        for t, nodes, other, partners, at in ((a, u, b, v, 0), (b, v, a, u, self.base)):
            added = other.weight(partners)
            np.add.at(self.gain, at + t.start[nodes], added)
            np.subtract.at(self.gain, at + t.end[nodes], added)
        self.whole_a[u] = True
        self.whole_b[v] = True
        if len(u):
            self.edges.append((a.start[u], self.base + b.start[v]))

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class, class it is connected with, weight of its links) of every class with links."""
        a, b = self.a, self.b
        n = np.cumsum(self.gain[:-1])
        if self.same:
            n -= a.weights
        for t, whole, at in ((a, self.whole_a, 0), (b, self.whole_b, self.base)):
            for node in np.nonzero(whole & (t.end - t.start > 1))[0]:
                # all of its points share a partner or each other
                inside = np.arange(t.start[node] + 1, t.end[node])
                self.edges.append((at + inside, np.full(len(inside), at + t.start[node])))
        ids = a.ids if self.same else np.concatenate([a.ids, b.ids])
        if self.edges:
            u, v = (np.concatenate(side) for side in zip(*self.edges))
        else:
            u = v = np.zeros(0, dtype=np.int64)
        root = forest(len(ids), u, v)
        some = np.nonzero((n > 0) | (root != np.arange(len(ids))))[0]
        return ids[some], ids[root[some]], n[some]


def _classes(vectors: DataFrame, id_col: str, vector_col: str, group_col: str) -> tuple[DataFrame, DataFrame]:
    """All rows as (vec_id, grp, v), v NULL where it links with nothing; and the written classes."""
    numbers = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(group_col).cast("string").alias("grp"),
        numbers.alias("v"),
    )
    some = F.exists(F.col("v"), lambda x: x != 0)
    able = F.col("vec_id").isNotNull() & F.col("grp").isNotNull() & usable(F.col("v"))
    able = F.coalesce(able & some, F.lit(False))
    rows = rows.select("vec_id", "grp", F.when(able, F.col("v")).alias("v"))
    classes = (
        rows.filter(F.col("v").isNotNull())
        .groupBy("grp", "v")
        .agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"))
        .select("grp", "v", "weight", "least", F.size("v").alias("width"))
        .withColumn("node", F.monotonically_increasing_id())  # fixed once it is written
    )
    return rows, stored(classes, "classes")


def _top_level(classes: DataFrame, block_bytes: int, pivots: int) -> tuple[dict, int]:
    """{(grp, width): pivots as unit vectors} of the largest groups, and blocks of any other group."""
    sized = classes.groupBy("grp", "width").agg((F.count(F.lit(1)) * F.col("width") * 8).alias("bytes"))
    large = sized.filter(F.col("bytes") > block_bytes).orderBy(F.col("bytes").desc(), "grp", "width")
    found = large.limit(pivots + 1).collect()
    others = -(-found[pivots].bytes // block_bytes) if len(found) > pivots else 1
    found = found[:pivots]
    total = sum(r.bytes for r in found)
    wanted = {
        (r.grp, r.width): max(1, min(-(-r.bytes // block_bytes), (pivots - len(found)) * r.bytes // total))
        for r in found
    }
    if not wanted:
        return {}, others
    spark = classes.sparkSession
    listed = F.broadcast(  # `pivots` rows at most
        spark.createDataFrame([(*k, int(n)) for k, n in wanted.items()], "grp string, width int, wanted int")
    )
    order = Window.partitionBy("grp", "width").orderBy(F.xxhash64("v"), "node")
    drawn = (
        classes.join(listed, ["grp", "width"])
        .withColumn("place", F.row_number().over(order))
        .filter((F.col("place") <= pivots) & (F.col("place") <= F.col("wanted")))
        .select("grp", "width", "v")
        .collect()
    )
    out: dict = {}
    for r in drawn:
        out.setdefault((r.grp, r.width), []).append(r.v)
    return {k: unit(np.array(v)) for k, v in out.items()}, others


def _celled(classes: DataFrame, tops: dict) -> DataFrame:
    """``classes`` with the number of the cell and the distance to its pivot."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            cell, gap = np.zeros(len(frame), dtype=np.int32), np.zeros(len(frame))
            for key, at in frame.groupby(["grp", "width"], sort=False).indices.items():
                if key in tops:
                    cosine = unit(np.stack(frame["v"].to_numpy()[at]).astype(float)) @ tops[key].T
                    cell[at] = cosine.argmax(axis=1)
                    gap[at] = _apart(cosine.max(axis=1))
            yield frame.assign(cell=cell, gap=gap)

    schema = "grp string, v array<double>, weight long, node long, width int, cell int, gap double"
    return classes.select("grp", "v", "weight", "node", "width").mapInPandas(run, schema)


def _partners(tops: dict, cells: dict, others: int, reach: float):
    """Function from a block to the blocks that it has to meet, itself among them."""
    near = {
        key: _apart(p @ p.T) for key, p in tops.items()
    }  # bounded by the square of the pivots, a few megabytes

    def of(key: tuple, cell: int, sub: int) -> Iterator[tuple[int, int]]:
        blocks = cells.get((*key, cell), (others, 0.0))[0]
        yield from ((cell, s) for s in range(sub, blocks))
        for other in range(cell + 1, len(tops.get(key, ()))):
            n, radius = cells.get((*key, other), (0, 0.0))
            if n and near[key][cell, other] <= cells[(*key, cell)][1] + radius + reach + SLACK:
                yield from ((other, s) for s in range(n))

    return of


def _name(grp: str, width: int, cell: int, sub: int) -> str:
    return f"{width}:{cell}:{sub}:{grp}"


def links(classes: DataFrame, similar: float, block_bytes: int = BLOCK_BYTES, pivots: int = PIVOTS) -> DataFrame:
    """(u, v, n): per meeting and class the weight of its links and a class it is connected with."""
    tops, others = _top_level(classes, block_bytes, pivots)
    celled = stored(_celled(classes, tops), "cells")
    measured = celled.groupBy("grp", "width", "cell").agg(
        (F.count(F.lit(1)) * F.col("width") * 8).alias("bytes"), F.max("gap").alias("radius")
    )
    spark = classes.sparkSession
    keys = spark.createDataFrame(list(tops) or [], "grp string, width int")
    rows = measured.join(F.broadcast(keys), ["grp", "width"]).collect()  # a row per pivot at most
    cells = {(r.grp, r.width, r.cell): (int(-(-r.bytes // block_bytes)), r.radius) for r in rows}
    side = spark.createDataFrame(
        [(*k, n) for k, (n, _) in cells.items()], "grp string, width int, cell int, blocks int"
    )
    sub = F.pmod(F.xxhash64("node"), F.coalesce("blocks", F.lit(others))).cast("int")
    dealt = celled.join(F.broadcast(side), ["grp", "width", "cell"], "left").withColumn("sub", sub)
    block = F.concat_ws(":", "width", "cell", "sub", "grp")

    def grow(frame: pd.DataFrame) -> pd.DataFrame:
        tree = CoverTree.build(
            unit(np.stack(frame["v"].to_numpy()).astype(float)),
            frame["node"].to_numpy(),
            frame["weight"].to_numpy(),
        )
        head = frame[["block", "grp", "width", "cell", "sub"]].iloc[:1]
        return head.assign(tree=[tree.pack()])

    trees = (
        dealt.select(block.alias("block"), "grp", "width", "cell", "sub", "node", "weight", "v")
        .groupBy("block")
        .applyInPandas(grow, "block string, grp string, width int, cell int, sub int, tree binary")
    )
    trees = stored(trees, "trees")
    reach = math.sqrt(2.0 - 2.0 * similar)

    def invite(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = _partners(tops, cells, others, reach)
        for frame in frames:
            for r in frame.itertuples(index=False):
                met = [_name(r.grp, r.width, c, s) for c, s in of((r.grp, r.width), r.cell, r.sub)]
                yield pd.DataFrame({"a": r.block, "b": met})

    pairs = trees.select("block", "grp", "width", "cell", "sub").mapInPandas(invite, "a string, b string")
    one = trees.select(F.col("block").alias("a"), F.col("tree").alias("t"))
    two = trees.select(F.col("block").alias("b"), F.col("tree").alias("s"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, t, s = (batch.column(batch.schema.names.index(c)) for c in "abts")
            for i in range(batch.num_rows):
                left = CoverTree.unpack(t[i].as_buffer().to_pybytes())
                same = a[i].as_py() == b[i].as_py()
                right = None if same else CoverTree.unpack(s[i].as_buffer().to_pybytes())
                found = Meeting(left, right, similar).links()
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["u", "v", "n"])

    return pairs.join(one, "a").join(two, "b").mapInArrow(meet, "u long, v long, n long")


def near_duplicates(
    vectors: DataFrame,
    similar: float = SIMILAR,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    group_col: str = "label",
    block_bytes: int = BLOCK_BYTES,
    pivots: int = PIVOTS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``."""
    rows, classes = _classes(vectors, id_col, vector_col, group_col)
    met = stored(links(classes, similar, block_bytes, pivots), "links")
    counted = met.groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
    joined = components(met.filter("u <> v").select("u", "v"))
    # a node is in both halves of what `components` returns if it is a root
    member = joined.groupBy("node").agg(F.min("component").alias("root"))
    named = classes.select("node", "grp", "v", "weight", "least").join(member, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node")).join(counted, "node", "left")
    named = stored(named, "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = named.join(least, "root").select(
        "grp", "v", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    whole = stored(known, "known")
    able = F.col("v").isNotNull()
    alone = rows.filter(~able).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = rows.filter(able).join(whole, ["grp", "v"]).select("vec_id", "n_links", "component_id")
    own = F.col("vec_id").isNull() | (F.col("vec_id") == F.col("component_id"))
    return linked.unionByName(alone).withColumn("kept", own)
