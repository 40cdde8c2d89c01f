"""Byte-level BPE by monoid tree reduction.

A text is split into halves down to leaves. A node of the tree is an encoded
stretch: its text, its token ids and the places where its pieces (matches of the
split pattern) start. Two neighbours are joined by matching the pattern again in
a window around the boundary:

* It begins at the first piece of the left node whose match could have looked at
  a character beyond the node. A match looks at most two characters past its own
  end's start (one after a greedy run, or the two letters of a contraction), so a
  piece that ends two or more characters before the node's end is settled.
* It grows to the right until one of its settled pieces ends where the right node
  starts a piece. Matching has no memory, so from there on both agree.

Tokens of pieces outside the window are kept as they are: merges never cross a
piece. The join is associative, so the shape of the tree does not matter.

Decoding maps ids to bytes and concatenates up a tree of the same kind.

Rows are encoded where they are read, without a shuffle. A task holds one Arrow
batch, which is cut by size, so a very long text makes a batch of its own.

Defined results: a NULL or empty text has no tokens; ids outside the vocabulary
raise on decoding; columns of the input that clash with the names added here are
replaced by them.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

LEAF = 512  # characters; the median text of the given documents has about 1800
FIRST_WINDOW = 64
BATCH_ROWS = 256
_SETTLED = 2


@dataclass
class Stretch:
    """An encoded stretch of a text that begins at ``at``, with the places in the text where its pieces start."""

    at: int
    text: str
    ids: list[int]
    starts: list[int] = field(repr=False)

    @property
    def end(self) -> int:
        return self.at + len(self.text)


class Codec:
    """Encoder and decoder for one vocabulary file and split pattern."""

    def __init__(self, path: str, pattern: str, leaf: int = LEAF):
        import regex
        import tiktoken

        with open(path, "rb") as f:
            pairs = (line.split() for line in f if line.strip())
            ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self._library = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # `regex` counts four control characters as blank that the library's matcher does not
        blanks = pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")
        self._pieces = regex.compile(blanks)
        self.leaf = max(1, leaf)
        self._bytes = {rank: token for token, rank in ranks.items()}  # the same objects, not copies

    def _encode(self, text: str) -> list[int]:
        return self._library.encode_ordinary(text)

    def stretch(self, text: str, at: int = 0) -> Stretch:
        return Stretch(at, text, self._encode(text), [at + m.start() for m in self._pieces.finditer(text)])

    def _size(self, part: Stretch, edges: list[int]) -> int:
        """Tokens of the pieces of ``part`` between ``edges``."""
        return sum(len(self._encode(part.text[s - part.at : e - part.at])) for s, e in zip(edges, edges[1:]))

    def join(self, a: Stretch, b: Stretch) -> Stretch:
        if not a.text:
            return b
        if not b.text:
            return a
        # first piece of `a` that is not settled
        first, edge = len(a.starts), a.end
        while first and edge + _SETTLED > a.end:
            first -= 1
            edge = a.starts[first]
        open_at = a.starts[first] if first < len(a.starts) else a.end
        dropped_left = self._size(a, [*a.starts[first:], a.end])
        tail, reach = a.text[open_at - a.at :], FIRST_WINDOW
        while True:
            window = tail + b.text[:reach]
            whole = reach >= len(b.text)
            met, pieces = b.end, []
            for m in self._pieces.finditer(window):
                if not whole and m.end() + _SETTLED > len(window):
                    met = -1  # not settled: the window must grow
                    break
                pieces.append(m.start())
                at = open_at + m.end()
                if at >= b.at:
                    k = bisect_left(b.starts, at)
                    if k < len(b.starts) and b.starts[k] == at:
                        met = at
                        break
            else:
                met = b.end if whole else -1
            if met >= 0:
                break
            reach *= 2
        # piece by piece: what follows the last one must not be forgotten
        ends = [*pieces[1:], met - open_at]
        middle = [i for s, e in zip(pieces, ends) for i in self._encode(window[s:e])]
        k = bisect_left(b.starts, met)
        dropped_right = self._size(b, [*b.starts[:k], met])
        kept = len(a.ids) - dropped_left
        return Stretch(
            a.at,
            a.text + b.text,
            a.ids[:kept] + middle + b.ids[dropped_right:],
            a.starts[:first] + [open_at + s for s in pieces] + b.starts[k:],
        )

    def reduce(self, text: str, at: int = 0) -> Stretch:
        if len(text) <= self.leaf:
            return self.stretch(text, at)
        half = len(text) // 2
        return self.join(self.reduce(text[:half], at), self.reduce(text[half:], at + half))

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if len(text) <= self.leaf:  # a tree of one leaf, of which no pieces are needed
            return self._encode(text)
        return self.reduce(text).ids

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf:
            return b"".join([self._bytes[i] for i in ids])
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def codec(path: str, pattern: str, leaf: int = LEAF) -> Codec:
    """One codec per Python worker.

    Kept beside the library: globals of this module are copies in each task.
    """
    import tiktoken

    kept = vars(tiktoken).setdefault("_corpus_codecs", {})
    key = (path, pattern, leaf)
    if key not in kept:
        kept[key] = Codec(path, pattern, leaf)
    return kept[key]


def _with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    fields = [f for f in df.schema.fields if f.name != name]
    return T.StructType([*fields, T.StructField(name, kind)])


def _replaced(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    columns = [batch.column(batch.schema.names.index(n)) for n in names]
    return pa.RecordBatch.from_arrays([*columns, column], [*names, name])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, BATCH_ROWS):
        yield batch.slice(at, BATCH_ROWS)


def encode(
    df: DataFrame,
    path: str,
    pattern: str,
    text_col: str = "text",
    to: str = "ids",
    leaf: int = LEAF,
    decoded: str | None = None,
) -> DataFrame:
    """``df`` with ``to``: the ids as little-endian unsigned 32-bit integers, one after another.

    With ``decoded`` the ids are decoded again in the same pass, by one Python
    worker with one vocabulary instead of two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern, leaf)
        for batch in batches:
            for part in _slices(batch):
                texts = part.column(part.schema.names.index(text_col))
                packed, back = [], []
                for t in texts:
                    ids = tool.encode(t.as_py())
                    packed.append(np.array(ids, dtype="<u4").tobytes())
                    if decoded is not None:
                        back.append(tool.decode(ids))
                out = _replaced(part, to, pa.array(packed, pa.binary()))
                yield out if decoded is None else _replaced(out, decoded, pa.array(back, pa.binary()))

    schema = _with(df, to, T.BinaryType())
    if decoded is not None:
        kept = [f for f in schema.fields if f.name != decoded]
        schema = T.StructType([*kept, T.StructField(decoded, T.BinaryType())])
    return df.mapInArrow(run, schema)


def decode(
    df: DataFrame, path: str, pattern: str, ids_col: str = "ids", to: str = "decoded", leaf: int = LEAF
) -> DataFrame:
    """``df`` with ``to``: the bytes that the packed ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern, leaf)
        for batch in batches:
            for part in _slices(batch):
                packed = part.column(part.schema.names.index(ids_col))
                out = [
                    tool.decode(np.frombuffer(x.as_py() or b"", dtype="<u4").tolist()) for x in packed
                ]
                yield _replaced(part, to, pa.array(out, pa.binary()))

    return df.mapInArrow(run, _with(df, to, T.BinaryType()))
