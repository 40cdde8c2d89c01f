"""Language ID: averaged hashed subword embeddings under a linear softmax.

Every byte n-gram (2 to 4 bytes, within words) of a lower-cased text is hashed to
an embedding; a text is the mean of its embeddings, and a linear softmax over
that mean gives the languages. Embeddings and softmax are trained together by
stochastic gradient descent in numpy, on the driver, from n-gram counts of a
bounded sample (``max_sample`` texts, the same number per language); the counts
themselves are taken on the executors. A part of the sample is set aside to fit
the temperature of the softmax and the confidence below which an answer is
rejected.

Prediction folds embeddings and softmax into one score table of fixed size, and
runs where the rows are read, without a shuffle, over whole texts.

Defined results: NULL texts and texts without a letter are ``und`` with score 0
and rejected. Without any labelled row, everything is. Rows with a NULL doc_id
or language are not learned from. Columns of the input that clash with the names
added here are replaced by them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

ORDERS = (2, 3, 4)
BITS = 12
DIM = 12
MAX_SAMPLE = 2000
EPOCHS = 8
LOSE = 0.002  # of right answers in the calibration set that may be rejected
MAX_THRESHOLD = 0.5
UNKNOWN = "und"
CHUNK = 1 << 20  # bytes counted at a time
_MIX = np.uint32(2654435761)

# Lower-case ASCII letters and all bytes of other scripts count; the rest parts words.
_LETTERS = np.full(256, 32, dtype=np.uint32)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def ngram_counts(text: str | None, bits: int = BITS) -> np.ndarray:
    """How often each hashed n-gram occurs, one range of ``2**bits`` per order."""
    width = 1 << bits
    out = np.zeros(width * len(ORDERS), dtype=np.int64)
    raw = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-8", "ignore"), dtype=np.uint8)
    overlap = max(ORDERS) - 1
    for at in range(0, len(raw), CHUNK):
        b = _LETTERS[raw[at : at + CHUNK + overlap]]
        last = at + CHUNK >= len(raw)
        for k, n in enumerate(ORDERS):
            size = len(b) - n + 1 if last else min(CHUNK, len(b) - n + 1)
            if size <= 0:
                continue
            code = np.zeros(size, dtype=np.uint32)
            inner = np.ones(size, dtype=bool)
            for i in range(n):
                part = b[i : i + size]
                code = (code << np.uint32(8)) | part
                if 0 < i < n - 1:
                    inner &= part != 32
            if n == 2:
                inner &= (b[:size] != 32) | (b[1 : 1 + size] != 32)
            hashed = (code[inner] * _MIX) >> np.uint32(32 - bits)
            out[k * width : (k + 1) * width] += np.bincount(hashed, minlength=width)
    return out


@dataclass
class Model:
    """``table`` holds each n-gram's score for each of ``languages``."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        """One row per row of ``counts``; zero rows give the bias alone."""
        share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
        return _softmax((share @ self.table + self.bias) / self.temperature)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


Counts = list[tuple[np.ndarray, np.ndarray]]  # of a row: hashed n-grams and how often each occurs


def _dense(counts: Counts) -> np.ndarray:
    out = np.zeros((len(counts), len(ORDERS) << BITS), dtype=np.float32)
    for row, (at, n) in zip(out, counts):
        row[at] = n
    return out


def _shares(counts: Counts) -> np.ndarray:
    out = _dense(counts)
    out /= np.maximum(out.sum(axis=1, keepdims=True), 1)
    return out


def fit(
    counts: Counts,
    labels: list[str],
    dim: int = DIM,
    epochs: int = EPOCHS,
    rate: float = 4.0,
    batch: int = 32,
    seed: int = 7,
) -> Model:
    """Train on n-gram counts; every fifth row calibrates instead.

    Only a batch of rows is spread out at a time: all of them would be 100 MB of the driver.
    """
    languages = sorted(set(labels))
    index = {name: i for i, name in enumerate(languages)}
    y = np.array([index[x] for x in labels])
    aside = np.arange(len(y)) % 5 == 4 if len(y) >= 20 else np.zeros(len(y), dtype=bool)
    random = np.random.default_rng(seed)
    embeddings = random.normal(0, 1.0 / np.sqrt(dim), (len(ORDERS) << BITS, dim)).astype(np.float32)
    weights = np.zeros((dim, len(languages)), dtype=np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)
    train = np.nonzero(~aside)[0]
    # n-grams are many and shares are small: scale the inputs, not the rate
    parts = (_shares([counts[i] for i in at]) for at in np.array_split(train, max(1, len(train) // batch)))
    squares = [np.einsum("ij,ij->i", x, x) for x in parts]
    scale = np.float32(np.sqrt(1.0 / max(float(np.concatenate(squares).mean()), 1e-9)))
    steps, step = epochs * max(1, -(-len(train) // batch)), 0
    for _ in range(epochs):
        order = random.permutation(train)
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            x = _shares([counts[i] for i in rows]) * scale
            hidden = x @ embeddings
            p = _softmax(hidden @ weights + bias)
            p[np.arange(len(rows)), y[rows]] -= 1
            p /= len(rows)
            now = np.float32(rate * (1 - step / steps) / np.sqrt(dim))
            back = p @ weights.T
            weights -= now * (hidden.T @ p)
            bias -= now * 0.1 * p.sum(axis=0)
            touched = np.nonzero(x.any(axis=0))[0]
            embeddings[touched] -= now * (x[:, touched].T @ back)
            step += 1
    model = Model(languages, (embeddings @ weights).astype(np.float64) * float(scale), bias.astype(np.float64))
    return calibrate(model, [counts[i] for i in np.nonzero(aside)[0]], y[aside])


def calibrate(model: Model, counts: Counts, y: np.ndarray, lose: float = LOSE) -> Model:
    """Set the temperature (least log loss) and the confidence that is rejected."""
    if len(y) == 0:
        return model
    parts = [_shares(counts[at : at + 64]) @ model.table for at in range(0, len(counts), 64)]
    scores = np.concatenate(parts) + model.bias
    best = (np.inf, 1.0)
    for t in np.geomspace(0.25, 8.0, 41):
        model.temperature = float(t)
        p = _softmax(scores / model.temperature)[np.arange(len(y)), y]
        best = min(best, (float(-np.log(np.maximum(p, 1e-12)).mean()), float(t)))
    model.temperature = best[1]
    p = _softmax(scores / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    if len(right):
        # a margin below the lowest quantile that may be lost
        model.threshold = float(min(MAX_THRESHOLD, np.quantile(right, lose) * 0.8))
    return model


def train(
    docs: DataFrame,
    learnable: Column,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    max_sample: int = MAX_SAMPLE,
) -> Model | None:
    """Fit a model on a bounded sample of the rows that satisfy ``learnable``."""
    usable = docs.filter(
        F.coalesce(learnable, F.lit(False))
        & F.col(lang_col).isNotNull()
        & F.col(id_col).isNotNull()
        & F.col(text_col).isNotNull()
    )
    found = usable.groupBy(lang_col).count().orderBy(F.col("count").desc(), lang_col)
    # languages beyond the sample size could not get a row each
    seen = found.limit(max_sample).collect()
    if not seen:
        return None
    quota = max(1, max_sample // len(seen))
    draw = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_003)) / 1_000_003
    wanted = F.lit(False)
    for r in seen:
        wanted = wanted | ((F.col(lang_col) == r[0]) & (draw < quota / r["count"]))
    picked = usable.filter(wanted).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            packed = []
            for text in frame["text"]:
                c = ngram_counts(text)
                at = np.nonzero(c)[0].astype("<u4")
                packed.append(at.tobytes() + c[at].astype("<u4").tobytes())
            yield pd.DataFrame({"lang": frame["lang"], "packed": packed})

    # 2 * max_sample rows of at most 8 bytes per hashed n-gram
    rows = picked.mapInPandas(count, "lang string, packed binary").limit(2 * max_sample).collect()
    rows.sort(key=lambda r: (r.lang, bytes(r.packed)))
    np.random.default_rng(1).shuffle(rows)
    counts = [tuple(np.split(np.frombuffer(bytes(r.packed), dtype="<u4"), 2)) for r in rows]
    return fit(counts, [r.lang for r in rows]) if len(rows) else None


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (confidence) and ``rejected``."""
    added = [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ]
    names = {f.name for f in added}
    kept = [f for f in docs.schema.fields if f.name not in names]

    def run(batches):
        import pyarrow as pa
        import regex

        letter = regex.compile(r"\p{L}")
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text_col))
            langs, scores, rejected = [], [], []
            for value in texts:
                text = value.as_py()
                if model is None or text is None or not letter.search(text):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                p = model.probabilities(ngram_counts(text)[None, :])[0]
                k = int(p.argmax())
                langs.append(model.languages[k])
                scores.append(float(p[k]))
                rejected.append(bool(p[k] < model.threshold))
            columns = [batch.column(batch.schema.names.index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                [*[f.name for f in kept], "lang_pred", "score", "rejected"],
            )

    return docs.mapInArrow(run, T.StructType([*kept, *added]))
