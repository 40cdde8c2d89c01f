"""Near-duplicates by SetSketch registers, joint likelihood and exact verification.

1. Sketch. Each shingle of a document's set throws a Poisson process of marked
   points; a register keeps the least point that bears its mark, rounded down to
   an exponentially spaced grid and truncated. Registers of unions are the minima
   of registers, and two registers agree with a probability near the Jaccard
   similarity. Only points below a limit are drawn, about ``m log m`` a document.
2. Classes. Documents with equal sets share a 128-bit digest of the set and are
   one class from here on, with a number of its own: one id may bear two texts.
3. Bands. Registers are cut into bands of six; classes that agree in a band are
   candidates. A pair of similarity 0.8 shares none of the 42 bands with
   probability 3e-6; the more similar, the rarer still.
4. Hubs. All pairs within a band are never listed. Each class is first held against
   the hub that it shares most bands with; the hub of a band is the member with the
   most company over all its bands, which near an original is the original. A pair
   is dropped when the sizes or the joint maximum-likelihood estimate of its
   similarity (4.5 deviations below the threshold, so one link in 300,000 at most)
   rule a link out; all others are verified on the full sets. What is connected then
   needs no further comparison.
5. Strays. A band that still holds several components has a home, the component of
   its member with the most company; its other members are strays. Classes joined by
   such bands form a cluster, dealt into blocks of bounded size, and each pair of
   blocks is one group: the shared shingles of its sets, as columns of zeros and
   ones, give the intersections of every stray with all others as one matrix
   product. A group hands back one edge per linked class, so no pair becomes a row.
6. Components of all links, joined back to every document.

Sets are held as 64-bit hashes of shingles. Defined results: NULL or empty texts
have an empty set and are linked with nothing; rows with a NULL doc_id are linked
with nothing, have a NULL component and are kept; repeated rows share their
component, and all rows that bear its least id are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import discard, stored
from tidemark.llm.components import components, forest

REGISTERS = 256
ROWS = 6
BANDS = REGISTERS // ROWS
BASE = 1.001
RATE = 20.0
SIMILAR = 80  # per cent
CHUNK = 128  # documents sketched together
BLOCK_SETS, BLOCK_BYTES = 512, 8 << 20  # of a cluster, in one group
COLUMNS = 4096  # shingles in one matrix product
DEVIATIONS = 4.5
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(z: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class _Hashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: str | None, hashes: dict, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``size``-word shingles of ``text``."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.array([hashes[w] for w in words], dtype=np.uint64)
    if len(h) < size:  # the whole sequence is the one shingle
        size = len(h)
    out = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        out = _mix(out + _GOLD + h[k : len(h) - size + 1 + k])
    return np.unique(out)


def registers(sets: list[np.ndarray], m: int = REGISTERS) -> np.ndarray:
    """The SetSketch registers of every set, one row each; an empty set has zeros."""
    sizes = np.array([len(s) for s in sets])
    least = np.full((len(sets), m), np.inf)
    flat = least.reshape(-1)
    limit = (np.log(m) + 3.0) / np.maximum(sizes, 1)
    todo = np.nonzero(sizes)[0]
    while len(todo):
        state = np.concatenate([sets[i] for i in todo])
        at = np.repeat(todo, sizes[todo])
        x = np.zeros(len(state))
        while len(state):
            state = state + _GOLD
            z = _mix(state)
            x = x - np.log(((z >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / m
            near = x <= limit[at]
            state, at, x, z = state[near], at[near], x[near], z[near]
            np.minimum.at(flat, at * m + (z % np.uint64(m)).astype(np.int64), x)
        todo = todo[np.isinf(least[todo]).any(axis=1)]
        limit[todo] *= 2  # some register of these saw no point yet
    grid = np.floor(1 - np.log(np.where(np.isinf(least), RATE * BASE, least) / RATE) / np.log(BASE))
    return np.clip(grid, 0, 65535).astype("<u2")


def likely_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from two rows of registers and the set sizes.

    The counts of registers that are greater, less and equal are multinomial;
    their probabilities follow from the sizes and the similarity.
    """
    more = (a > b).sum(axis=1)[:, None].astype(float)
    less = (a < b).sum(axis=1)[:, None].astype(float)
    same = a.shape[1] - more - less
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, 401)[None, :] * np.minimum(u / v, v / u)

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = p(u - v * j), p(v - u * j)
    tiny = 1e-300
    likelihood = (
        more * np.log(np.maximum(up, tiny))
        + less * np.log(np.maximum(down, tiny))
        + same * np.log(np.maximum(1 - up - down, tiny))
    )
    return np.take_along_axis(j, likelihood.argmax(axis=1)[:, None], axis=1)[:, 0]


def sketch(docs: DataFrame, words: int, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_key, registers) of every row; no key for empty sets."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        for frame in frames:
            for at in range(0, len(frame), CHUNK):
                part = frame.iloc[at : at + CHUNK]
                sets = [shingle_set(t, hashes, words) for t in part["text"]]
                rows = registers(sets)
                yield pd.DataFrame(
                    {
                        "name": part["name"],
                        "text_hash": part["text_hash"],
                        "n_shingles": [len(s) for s in sets],
                        "set_key": [_digest(s) for s in sets],
                        "registers": [r.tobytes() if len(s) else None for r, s in zip(rows, sets)],
                    }
                )

    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        # null ids travel as null, not as numbers with a fraction
        F.col(id_col).cast("string").alias("name"),
        F.col(text_col).alias("text"),
    ).drop("doc_id")
    out = given.mapInPandas(
        run, "name string, text_hash long, n_shingles long, set_key binary, registers binary"
    )
    return out.select(
        F.col("name").cast("long").alias("doc_id"), "text_hash", "n_shingles", "set_key", "registers"
    )


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _full_sets(docs: DataFrame, wanted: DataFrame, words: int, text_col: str, id_col: str) -> DataFrame:
    """(id, n, registers, shingles) of the classes in ``wanted``, from a text of their least document."""
    given = docs.select(F.col(id_col).cast("long").alias("least"), F.col(text_col).alias("text"))
    found = given.join(wanted, "least").select("id", "set_key", "n", "registers", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        for frame in frames:
            for at in range(0, len(frame), CHUNK):
                part = frame.iloc[at : at + CHUNK].drop(columns="text")
                sets = [shingle_set(t, hashes, words) for t in frame["text"].iloc[at : at + CHUNK]]
                # the document may bear other texts, of other classes
                own = np.array([_digest(s) == k for s, k in zip(sets, part["set_key"])], dtype=bool)
                part = part.assign(shingles=[s.tobytes() for s in sets])
                yield part[own].drop(columns="set_key")

    rows = found.mapInPandas(run, "id long, n long, registers binary, shingles binary")
    # into a fixed number of parts, so that the joins by id that follow need no other shuffle
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, "id").dropDuplicates(["id"])


def _links(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """(u, v) of the ``pairs`` (a, b) that are links: likely by size and estimate, judged on their full sets."""

    def end(x: str) -> DataFrame:
        return full.select(
            F.col("id").alias(x), *[F.col(c).alias(f"{c[0]}_{x}") for c in ("n", "registers", "shingles")]
        )

    least = SIMILAR / 100 - DEVIATIONS * np.sqrt(SIMILAR / 100 * (1 - SIMILAR / 100) / REGISTERS)

    def run(batches):
        import pyarrow as pa

        def values(column, kind):
            return [np.frombuffer(x.as_buffer(), dtype=kind) for x in column]

        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                column = dict(zip(batch.schema.names, batch.columns))
                n_a, n_b = (column[c].to_numpy().astype(float) for c in ("n_a", "n_b"))
                x, y = (np.stack(values(column[c], "<u2")) for c in ("r_a", "r_b"))
                likely = pa.array(likely_similarity(x, y, n_a, n_b) >= least)
                column = {c: column[c].filter(likely) for c in ("a", "b", "s_a", "s_b")}
                alike = []
                for s, t in zip(values(column["s_a"], np.uint64), values(column["s_b"], np.uint64)):
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    alike.append(100 * both >= SIMILAR * (len(s) + len(t) - both))
                alike = pa.array(alike, pa.bool_())
                yield pa.RecordBatch.from_arrays([column[c].filter(alike) for c in ("a", "b")], ["u", "v"])

    # all that a pair needs in one row, so that the pairs are shuffled once by each end
    sized = pairs.select("a", "b").join(end("a"), "a").join(end("b"), "b")
    fits = 100 * F.least("n_a", "n_b") >= SIMILAR * F.greatest("n_a", "n_b")
    return sized.filter(fits).mapInArrow(run, "u long, v long")


def _nearest(pairs: DataFrame) -> DataFrame:
    """Of the hubs ``b`` in ``pairs`` (a, b per band), the one that ``a`` shares most bands with."""
    counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times"))
    best = counted.groupBy("a").agg(F.max(F.struct("times", F.col("b"))).alias("top"))
    return best.select("a", F.col("top.b").alias("b"))


def near_duplicates(
    docs: DataFrame, words: int = 5, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    return _judged(docs, words, text_col, id_col).drop("text_hash")


def deduplicate(
    docs: DataFrame, words: int = 5, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group, and one of each repeated row."""
    kept = (
        _judged(docs, words, text_col, id_col)
        .filter("kept")
        .select(
            F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"),
            F.col("doc_id").isNull().alias("no_id"),
            F.col("text_hash").alias("key"),
        )
        .distinct()
    )
    # one struct, so that no column of the input can clash with the ones added here; plain
    # keys, so that the texts are shuffled once, for the join and for the choice
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("doc"),
        F.col(id_col).cast("long").isNull().alias("unnamed"),
        F.xxhash64(F.col(text_col)).alias("hash"),
    )
    same = (F.col("doc") == F.col("id")) & (F.col("unnamed") == F.col("no_id")) & (F.col("hash") == F.col("key"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc", "unnamed", "hash"]).select("row.*")


def _judged(docs: DataFrame, words: int, text_col: str, id_col: str) -> DataFrame:
    sketched = stored(sketch(docs, words, text_col, id_col), "sketches")
    classes = (
        sketched.filter("set_key is not null and doc_id is not null")
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("least"),
            F.first("n_shingles").alias("n"),
            F.first("registers").alias("registers"),
        )
        .withColumn("id", F.monotonically_increasing_id())  # fixed once it is written
    )
    classes = stored(classes, "classes")
    width = 2 * ROWS
    bands = classes.select(
        "id",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.lit(BANDS - 1)),
                lambda i: F.xxhash64(i, F.substring("registers", i * width + 1, F.lit(width))),
            )
        ).alias("band"),
    )
    hubs = (
        bands.groupBy("band")
        .agg(F.count(F.lit(1)).alias("members"))
        .filter("members > 1")
    )
    shared = stored(bands.join(hubs, "band").select("band", "id", "members"), "bands")
    wanted = classes.join(shared.select("id").distinct(), "id", "left_semi")
    full = _full_sets(docs, wanted, words, text_col, id_col)
    # stays where it is through all rounds; lost parts are computed again
    full = full.persist(StorageLevel.DISK_ONLY)
    try:
        label = _connected(shared, full)
    finally:
        full.unpersist()
    discard(shared)
    rooted = stored(
        classes.select("set_key", "id", "least")
        .join(label, F.col("id") == F.col("node"), "left")
        .select("set_key", "least", F.coalesce("component", "id").alias("root")),
        "rooted",
    )
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(lowest, "root").select("set_key", "component_id")
    discard(classes)
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (
        sketched.select("doc_id", "text_hash", "n_shingles", "set_key")
        .join(known, "set_key", "left")
        .select("doc_id", "text_hash", "n_shingles", own.alias("component_id"))
        .withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))
    )


def _connected(shared: DataFrame, full: DataFrame) -> DataFrame:
    """(node, component) of all that verified links connect."""
    company = shared.groupBy("id").agg(F.sum("members").alias("company"))
    shared = stored(shared.join(company, "id").select("band", "id", "company"), "band-members")
    hubs = shared.groupBy("band").agg(F.max(F.struct("company", "id")).alias("hub"))
    met = shared.join(hubs, "band").select(F.col("id").alias("a"), F.col("hub.id").alias("b"))
    pairs = stored(_nearest(met.filter("a <> b")), "hub-pairs")
    links = stored(_links(pairs, full), "links")
    label = components(links)
    discard(pairs, links)
    clusters = _clusters(shared, label)
    discard(shared)
    sets = full.select("id", "shingles").join(clusters, "id")
    sets = stored(sets.select("cluster", "id", "stray", "shingles"), "cluster-sets")
    found = stored(_stray_links(sets), "stray-links")
    discard(clusters, sets)
    if not found.head(1):
        return label
    # earlier links are as good as one link per node to its component
    return components(label.select(F.col("node").alias("u"), F.col("component").alias("v")).union(found))


def _clusters(shared: DataFrame, label: DataFrame) -> DataFrame:
    """(cluster, id, stray), written, of the classes in bands that hold several components."""
    labelled = stored(
        shared.join(label, F.col("id") == F.col("node"), "left").select(
            "band", "id", "company", F.coalesce("component", "id").alias("component")
        ),
        "labelled",
    )
    several = (
        labelled.groupBy("band")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.max(F.struct("company", "id", "component")).alias("top"),
        )
        .filter("low <> high")
        .select("band", F.col("top.id").alias("hub"), F.col("top.component").alias("home"))
    )
    members = labelled.join(several, "band").groupBy("id", "hub").agg(
        F.bool_or(F.col("component") != F.col("home")).alias("stray")
    )
    members = stored(members, "mixed")
    discard(labelled)
    joined = components(members.select(F.col("id").alias("u"), F.col("hub").alias("v")))
    strays = members.groupBy("id").agg(F.bool_or("stray").alias("stray"))
    out = strays.join(joined, F.col("id") == F.col("node")).select(F.col("component").alias("cluster"), "id", "stray")
    out = stored(out, "clusters")
    discard(members)
    return out


def _intersections(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of every set in ``a`` with every set in ``b``."""
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    if not a or not b:
        return out
    shared = np.intersect1d(np.unique(np.concatenate(a)), np.unique(np.concatenate(b)), assume_unique=True)

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(shared, flat)
        known = at < len(shared)
        known[known] = shared[at[known]] == flat[known]
        order = np.argsort(at[known], kind="stable")
        return at[known][order], row[known][order]

    (at_a, row_a), (at_b, row_b) = places(a), places(b)
    for low in range(0, len(shared), COLUMNS):
        high = min(len(shared), low + COLUMNS)

        def ones(at: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
            i, j = np.searchsorted(at, [low, high])
            x = np.zeros((n, high - low), dtype=np.float32)
            x[row[i:j], at[i:j] - low] = 1
            return x

        # counts up to COLUMNS are exact in single precision
        out += (ones(at_a, row_a, len(a)) @ ones(at_b, row_b, len(b)).T).astype(np.int64)
    return out


def _stray_links(sets: DataFrame) -> DataFrame:
    """(u, v): one edge per class that is linked with a stray of its cluster.

    ``sets`` (cluster, id, stray, shingles) is a written table.
    """
    size = F.sum(F.length("shingles")) / BLOCK_BYTES
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_SETS, size)).cast("int")
    dealt = sets.groupBy("cluster").agg(blocks.alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = (
        sets.join(dealt, "cluster")
        .withColumn("own", own)
        .withColumn("other", every)
        .withColumns({"one": F.least("own", "other"), "two": F.greatest("own", "other")})
        .select("cluster", "one", "two", "own", "id", "stray", "shingles")
    )

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(s, dtype=np.uint64) for s in frame["shingles"]]
        sizes = np.array([len(s) for s in sets])
        stray, side = frame["stray"].to_numpy(dtype=bool), (frame["own"] == frame["two"]).to_numpy()
        same = frame["one"].iloc[0] == frame["two"].iloc[0]
        u, v = [], []
        # strays of one block with all of the other, then the other way round
        for x in ([True] if same else [False, True]):
            a = np.nonzero(stray & (side == x))[0]
            b = np.nonzero(side == (x if same else not x))[0]
            both = _intersections([sets[i] for i in a], [sets[i] for i in b])
            alike = 100 * both >= SIMILAR * (sizes[a][:, None] + sizes[b][None, :] - both)
            i, j = np.nonzero(alike)
            u.append(a[i])
            v.append(b[j])
        root = forest(len(frame), np.concatenate(u), np.concatenate(v))
        some = root != np.arange(len(frame))
        ids = frame["id"].to_numpy()
        return pd.DataFrame({"u": ids[some], "v": ids[root[some]]})

    return rows.groupBy("cluster", "one", "two").applyInPandas(run, "u long, v long")
