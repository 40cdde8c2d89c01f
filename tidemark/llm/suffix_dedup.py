"""Exact removal of repeated passages by a distributed merge sort of suffixes.

A byte goes when it lies in a 100-byte string that also starts earlier (in a
smaller doc_id, or earlier in the same document).

1. Anchors. Of the 20-byte strings inside a 100-byte window the one with the
   least hash, the leftmost of equals, is the window's anchor. Equal windows have
   equal anchors at equal offsets, so windows are compared per anchor, and only
   anchors whose string occurs twice in the corpus go on: about one suffix for 40
   bytes, instead of one per byte. Copies of a row count here, so their anchors go
   on too, but once per document, not per copy.
2. Runs. A task sorts the suffixes at its documents' anchors (hash, then text up
   to the last window's end) and writes, per exchange bucket, a front-coded run:
   each suffix without the prefix it shares with the one before.
3. Merge. A bucket's runs meet in a loser tree that carries the common prefix
   with the last winner. Two heads with different known prefixes are ordered by
   them alone; with equal ones, comparison starts behind the prefix. The merge so
   yields the order and all common-prefix lengths without reading a known byte
   again.
4. Windows. Within a bucket the common-prefix lengths (and those of the reversed
   left contexts) number the distinct windows of every offset; all but the
   earliest of each are repeats.
5. Anchors more frequent than a bucket's share are dealt over several buckets.
   Windows that are the first of their bucket's part then meet once more by
   digest, one row per part at most.
6. Repeats are joined to their documents and cut out.

Strings are judged on the input, whatever is removed. The anchor hash only
selects what is compared; comparisons are of bytes, except that windows of
dealt-out anchors meet by a 128-bit digest. Defined results: NULL texts are
empty; NULL ids come after all others; different texts under one id are ordered
by a hash of the text; a row repeated as a whole gets one result, as one document.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import stored

LENGTH = 100
GRAM = 20
ANCHORS_PER_BUCKET = 20_000
RUN_BYTES = 32 << 20
_LAST = (1 << 63) - 1
_SPAN = LENGTH - GRAM + 1  # anchor places in a window
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_HEAD = ">QH"  # hash and part, in front of every suffix
_ROW = "<BBBqqq"  # shared, right, left, document, text hash, place
_ROW_SIZE = struct.calcsize(_ROW)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from every place."""
    have, size = _BYTE[raw], 1
    done = 0
    by_size = {}
    while size <= GRAM:
        by_size[size] = have
        if len(have) > size:
            have = have[:-size] * _power(size) + have[size:]
        size *= 2
    n = len(raw) - GRAM + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for size in sorted(by_size, reverse=True):
        if GRAM - done >= size:
            out = out * _power(size) + by_size[size][done : done + n]
            done += size
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def anchors(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, last window) of every anchor of one document."""
    if len(raw) < LENGTH:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, none
    hashes = gram_hashes(raw)
    value, place = hashes, np.arange(len(hashes), dtype=np.int64)
    size = 1
    while size < _SPAN:
        step = min(size, _SPAN - size)
        take = value[step:] < value[:-step]  # the left one wins a tie
        value = np.where(take, value[step:], value[:-step])
        place = np.where(take, place[step:], place[:-step])
        size += step
    first = np.nonzero(np.diff(place, prepend=-1))[0]
    last = np.append(first[1:], len(place)) - 1
    at = place[first]
    return hashes[at], at, first, last


# ---- runs ---------------------------------------------------------------------


def front_coded(suffixes: list[tuple[bytes, bytes, tuple[int, int, int]]]) -> bytes:
    """Sorted (suffix, left context, (document, text hash, place)) as one run."""
    out, before = [], b""
    for text, left, (doc, rep, at) in suffixes:
        shared = _common(before, text, 0)
        out.append(struct.pack(_ROW, shared, len(text), len(left), doc, rep, at))
        out.append(text[shared:])
        out.append(left)
        before = text
    return b"".join(out)


def _common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of ``a`` and ``b``, of which ``known`` is known."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    while a[known] == b[known]:
        known += 1
    return known


class _Run:
    """A reader of one run: the current suffix and what it shares with the one before."""

    __slots__ = ("blob", "at", "text", "left", "key", "shared")

    def __init__(self, blob: bytes):
        self.blob, self.at, self.text = blob, 0, b""
        self.step()

    def step(self) -> bool:
        if self.at >= len(self.blob):
            self.text = None
            return False
        shared, right, left, doc, rep, place = struct.unpack_from(_ROW, self.blob, self.at)
        at = self.at + _ROW_SIZE
        self.text = self.text[:shared] + self.blob[at : at + right - shared]
        at += right - shared
        self.left = self.blob[at : at + left]
        self.at, self.key, self.shared = at + left, (doc, rep, place), shared
        return True


def merged(blobs: list[bytes]) -> Iterator[tuple[bytes, int, bytes, tuple[int, int, int]]]:
    """(suffix, length shared with the one before, left context, key) in order.

    A loser tree over the runs; ``known[i]`` is what the head of run i shares with
    the last winner.
    """
    runs = [r for r in map(_Run, blobs) if r.text is not None]
    width = 1
    while width < len(runs):
        width *= 2
    if not runs:
        return
    known = [0] * width
    loser = [-1] * width
    heads = [r.text for r in runs] + [None] * (width - len(runs))

    def less(i: int, j: int) -> tuple[int, int]:
        """(winner, loser) of two runs; the loser's ``known`` is brought up to the winner."""
        a, b = heads[i], heads[j]
        if a is None:
            return j, i
        if b is None:
            return i, j
        if known[i] != known[j]:  # the longer prefix of the last winner is smaller
            return (i, j) if known[i] > known[j] else (j, i)
        shared = _common(a, b, known[i])
        if a[shared:] <= b[shared:]:
            known[j] = shared
            return i, j
        known[i] = shared
        return j, i

    def build(node: int) -> int:
        if node >= width:
            return node - width
        winner, loser[node] = less(build(2 * node), build(2 * node + 1))
        return winner

    top = build(1)
    shared = 0
    while heads[top] is not None:
        run = runs[top]
        yield run.text, shared, run.left, run.key
        run.step()
        heads[top] = run.text
        known[top] = run.shared
        node = (top + width) // 2
        while node:
            top, loser[node] = less(top, loser[node])
            node //= 2
        shared = known[top]


# ---- windows ------------------------------------------------------------------


def _classes(shared: np.ndarray, length: int) -> np.ndarray:
    """A number per sorted string that is equal for equal prefixes of ``length``."""
    return np.cumsum(shared < length)


def repeats(blobs: list[bytes]) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Repeated stretches of one bucket, and the first windows of dealt-out anchors."""
    rows = list(merged(blobs))
    n = len(rows)
    head = struct.calcsize(_HEAD)
    shared = np.array([r[1] for r in rows], dtype=np.int64) - head
    right = np.array([len(r[0]) for r in rows], dtype=np.int64) - head
    left = np.array([len(r[2]) for r in rows], dtype=np.int64)
    keys = np.array([r[3] for r in rows], dtype=np.int64).reshape(n, 3)
    dealt = np.array([r[0][8:10] != b"\0\0" for r in rows], dtype=bool)
    order = np.lexsort((keys[:, 2], keys[:, 1], keys[:, 0]))
    back = [r[2][::-1] for r in rows]
    by_left = np.array(sorted(range(n), key=back.__getitem__), dtype=np.int64)
    left_shared = np.zeros(n, dtype=np.int64)
    for i in range(1, n):
        left_shared[i] = _common(back[by_left[i - 1]], back[by_left[i]], 0)
    again = np.zeros((n, LENGTH + 2), dtype=bool)  # by offset + 1: a border on both sides
    first = np.zeros((n, LENGTH + 1), dtype=bool)
    for offset in range(0, _SPAN):
        valid = (left >= offset) & (right >= LENGTH - offset)
        who = order[valid[order]]
        if not len(who):
            continue
        l_class = np.empty(n, dtype=np.int64)
        l_class[by_left] = _classes(left_shared, offset) if offset else 0
        window = _classes(shared, LENGTH - offset)[who] * (n + 1) + l_class[who]
        _, earliest = np.unique(window, return_index=True)
        flag = np.ones(len(who), dtype=bool)
        flag[earliest] = False
        again[who[flag], offset + 1] = True
        first[who[~flag], offset] = True
    # runs of offsets are runs of windows: from place - last offset to place - first + 100
    edge = np.diff(again.astype(np.int8), axis=1)
    i, lo = np.nonzero(edge == 1)
    _, hi = np.nonzero(edge == -1)
    found = pd.DataFrame(
        {
            "_d": keys[i, 0],
            "_r": keys[i, 1],
            "start": keys[i, 2] - (hi - 1),
            "stop": keys[i, 2] - lo + LENGTH,
        }
    )
    i, offset = np.nonzero(first & dealt[:, None])
    digests = [
        hashlib.blake2b(
            (rows[k][2][len(rows[k][2]) - o :] if o else b"") + rows[k][0][head : head + LENGTH - o],
            digest_size=16,
        ).digest()
        for k, o in zip(i, offset)
    ]
    open_ = pd.DataFrame(
        {"_d": keys[i, 0], "_r": keys[i, 1], "start": keys[i, 2] - offset, "digest": digests}
    )
    return found, open_


# ---- Spark --------------------------------------------------------------------


def _keyed(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(_d, _r, text): a document's place among the others, and its text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("_d"),
        F.xxhash64(text).alias("_r"),
        text.alias("text"),
    )


def _raw(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)


def _listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for at in range(0, len(frame), 512):
            part = frame.iloc[at : at + 512]
            found = [anchors(_raw(t)) for t in part["text"]]
            sizes = [len(f[0]) for f in found]
            yield pd.DataFrame(
                {
                    "_d": np.repeat(part["_d"].to_numpy(), sizes),
                    "_r": np.repeat(part["_r"].to_numpy(), sizes),
                    "hash": np.concatenate([f[0] for f in found]).view(np.int64),
                    "place": np.concatenate([f[1] for f in found]),
                }
            )


def _cut_runs(buckets: int):
    """Documents with their repeated anchors -> front-coded runs per bucket."""

    def flush(bins: dict[int, list]) -> pd.DataFrame:
        blobs = [front_coded(sorted(b)) for b in bins.values()]
        return pd.DataFrame({"bucket": list(bins), "run": blobs})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins: dict[int, list] = {}
        held = 0
        for frame in frames:
            for doc, rep, text, wanted in zip(frame["_d"], frame["_r"], frame["text"], frame["wanted"]):
                raw = _raw(text)
                whole = raw.tobytes()
                hashes, at, first, last = anchors(raw)
                # (place, part) pairs, packed in one number each
                marks = np.unique(np.asarray(wanted, dtype=np.int64))
                places, parts = marks >> 16, marks & 0xFFFF
                for k, part in zip(np.searchsorted(at, places), parts):
                    a, h = int(at[k]), int(hashes[k])
                    suffix = struct.pack(_HEAD, h, int(part)) + whole[a : last[k] + LENGTH]
                    bucket = (h ^ (int(part) * _BASE & ((1 << 64) - 1))) % buckets
                    bins.setdefault(bucket, []).append((suffix, whole[first[k] : a], (doc, rep, a)))
                    held += 2 * LENGTH
                if held > RUN_BYTES:
                    yield flush(bins)
                    bins, held = {}, 0
        if bins:
            yield flush(bins)

    return run


def _merge_bucket(frame: pd.DataFrame) -> pd.DataFrame:
    found, open_ = repeats(list(frame["run"]))
    return pd.concat([found.assign(digest=None), open_.assign(stop=-1)], ignore_index=True)[
        ["_d", "_r", "start", "stop", "digest"]
    ]


def repeated_stretches(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(_d, _r, stretches): what goes from each document, in bytes, not merged yet."""
    spark = docs.sparkSession
    keyed = _keyed(docs, text_col, id_col)
    listed = keyed.mapInPandas(_listed, "_d long, _r long, hash long, place long")
    listed = stored(listed, "anchors")
    twice = listed.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chosen = stored(listed.join(twice, "hash"), "repeated-anchors")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = chosen.count()
    buckets = max(width, -(-total // ANCHORS_PER_BUCKET))
    share = max(64, total // (2 * buckets))
    # an anchor with more than half a bucket's share of places is dealt out
    parts = F.least(F.ceil(F.col("n") / share), F.lit(65_535))
    dealt = F.when(F.col("n") > share, 1 + F.pmod(F.xxhash64("_d", "_r", "place"), parts)).otherwise(0)
    # sets and one text per document: copies of a row collapse ahead of the shuffles
    wanted = chosen.groupBy("_d", "_r").agg(
        F.collect_set(F.shiftleft("place", 16).bitwiseOR(dealt.cast("long"))).alias("wanted")
    )
    single = keyed.groupBy("_d", "_r").agg(F.first("text").alias("text"))
    runs = single.join(wanted, ["_d", "_r"]).mapInPandas(_cut_runs(buckets), "bucket long, run binary")
    judged = stored(
        runs.groupBy("bucket").applyInPandas(
            _merge_bucket, "_d long, _r long, start long, stop long, digest binary"
        ),
        "repeats",
    )
    # one row per part of a dealt-out anchor at most
    met = (
        judged.filter("digest is not null")
        .groupBy("digest")
        .agg(F.sort_array(F.collect_list(F.struct("_d", "_r", "start"))).alias("met"))
        .filter(F.size("met") > 1)
        .select(F.explode(F.slice("met", 2, 1 << 30)).alias("w"))
        .select("w._d", "w._r", "w.start", (F.col("w.start") + LENGTH).alias("stop"))
    )
    found = judged.filter("digest is null").select("_d", "_r", "start", "stop").union(met)
    return found.groupBy("_d", "_r").agg(F.collect_list(F.struct("start", "stop")).alias("stretches"))


def _merged_spans(stretches) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s in sorted((x["start"], x["stop"]) for x in stretches):
        if out and s[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s[1]))
        else:
            out.append(s)
    return out


def remove_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept): one row per row of ``docs``.

    ``spans`` are the maximal removed runs [start, stop), ``kept`` the other bytes.
    """
    stretches = repeated_stretches(docs, text_col, id_col)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc, text, found in zip(frame["_d"], frame["text"], frame["stretches"]):
                raw = _raw(text).tobytes()
                spans = _merged_spans(found) if found is not None else []
                edges = [0, *[e for s in spans for e in s], len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append(
                    (
                        None if doc == _LAST else doc,
                        len(raw),
                        len(raw) - len(kept),
                        [{"start": a, "stop": b} for a, b in spans],
                        kept,
                    )
                )
            frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "spans", "kept"])
            yield frame.astype({"doc_id": "Int64"})

    return (
        _keyed(docs, text_col, id_col)
        .join(stretches, ["_d", "_r"], "left")
        .mapInPandas(
            run,
            "doc_id long, n_bytes long, n_removed long, "
            "spans array<struct<start: long, stop: long>>, kept binary",
        )
    )
