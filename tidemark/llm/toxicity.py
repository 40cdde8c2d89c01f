"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding maps look-alikes to one skeleton: accents go, Cyrillic and Greek letters
become the Latin ones they resemble, digits and signs inside words become
letters, and i, l and 1 are one letter. The lexicon holds folded words and word
beginnings, each weighted by its log odds among labelled texts; exception phrases
(a term with a neighbour, seen only in harmless texts) cancel the terms inside
them. A text's score is a logistic function of its weight per word.

The lexicon is learned from a bounded sample (``max_sample`` labelled rows per
class). Term counts and the sample's scores are computed by Spark; only the
lexicon and one number per sampled row reach the driver. Scoring runs where the
rows are read, over whole texts, without a shuffle.

Defined results: a NULL or empty text has no terms and the score of a harmless
text; without labels of both classes the lexicon is empty and every text is
harmless. Columns that clash with the names added here are replaced by them.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import stored

MAX_SAMPLE = 6000
CUT = 0.7
SHORTEST, LONGEST = 4, 12  # letters of a word beginning
MIN_DOCS, MIN_SHARE = 3, 0.01  # toxic texts a term must be in
MIN_ODDS = 100.0  # of a term that some harmless text holds as well
MAX_TERMS = 5000
MAX_PHRASES = 5000

# Letters of other scripts and the Latin letters they look like.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "һ": "h", "ӏ": "i",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ß": "ss", "ı": "i", "ł": "i", "ø": "o", "æ": "ae", "œ": "oe",
}
# Digits and signs that stand for letters inside words.
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}

_LOOK = {ord(a): b for a, b in LOOKALIKES.items()}
_MARKS = re.compile("[̀-ͯ​-‏⁠﻿]+")
_SIGNED = re.compile(r"[0134578@$!|]+")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str | None) -> list[str]:
    """The words of ``text`` as skeletons."""
    if not text:
        return []
    flat = text.lower()
    if not flat.isascii():
        flat = _MARKS.sub("", unicodedata.normalize("NFKD", flat))
        if not flat.isascii():
            flat = flat.translate(_LOOK)
    return _WORD.findall(_SIGNED.sub(_unsign, flat).replace("l", "i"))


def _unsign(m: re.Match) -> str:
    """A run of digits and signs as letters, where it stands in a word."""
    text, run = m.string, m.group()
    before = m.start() > 0 and text[m.start() - 1].isalpha()
    after = m.end() < len(text) and text[m.end()].isalpha()
    if not (before or after):
        return run
    if "!" in run or "|" in run:  # letters only between letters
        if not (before and after):
            return run
        run = run.replace("!", "i").replace("|", "i")
    return "".join([STAND_INS.get(c, c) for c in run])


def _terms(words: Sequence[str]) -> set[str]:
    """Candidates: whole words (with a blank behind) and their beginnings."""
    out = set()
    for w in set(words):
        if len(w) < SHORTEST:
            continue
        out.add(f"{w} ")
        out.update(w[:k] for k in range(SHORTEST, min(LONGEST, len(w)) + 1))
    return out


@dataclass
class Lexicon:
    """``terms`` and ``phrases`` start at a word; a final blank asks for its end."""

    terms: dict[str, float] = field(default_factory=dict)
    phrases: tuple[str, ...] = ()
    slope: float = 1.0
    offset: float = -2.0

    def automaton(self):
        import ahocorasick

        tree = ahocorasick.Automaton()
        for phrase in self.phrases:
            tree.add_word(f" {phrase}", (len(phrase) + 1, 0.0, True))
        for term, weight in self.terms.items():
            tree.add_word(f" {term}", (len(term) + 1, weight, False))
        if len(tree):
            tree.make_automaton()
        return tree

    def weigh(self, words: Sequence[str], tree) -> tuple[float, list[int]]:
        """Weight of the terms in ``words`` and the places (in the joined text) they start."""
        if not len(tree) or not words:
            return 0.0, []
        best: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        for end, (size, weight, phrase) in tree.iter(f" {' '.join(words)} "):
            start = end - size + 1
            if phrase:
                excused.append((start, end))
            else:  # one term per word, the heaviest
                best[start] = max(best.get(start, 0.0), weight)
        for a, b in excused:
            for start in [s for s in best if a <= s <= b - 1]:
                del best[start]
        return sum(best.values()), sorted(best)

    def score(self, weight: float, words: int) -> float:
        z = self.slope * density(weight, words) + self.offset
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def density(weight: float, words: int) -> float:
    """Lexicon weight per word on a compressed scale; short texts are padded a little."""
    return math.log1p(200.0 * weight / (words + 20)) if words else 0.0


def choose_terms(
    counts: Sequence[tuple[str, int, int]], toxic: int, harmless: int
) -> dict[str, float]:
    """Weighted terms from (term, toxic texts, harmless texts).

    A beginning is taken only where no longer term covers nearly the same texts,
    so that the lexicon stays as specific as the evidence allows.
    """
    least = max(MIN_DOCS, MIN_SHARE * toxic)
    good: dict[str, tuple[int, float]] = {}
    for term, bad, fine in counts:
        odds = (bad / toxic) / ((fine + 0.5) / (harmless + 1))
        if bad >= least and (fine == 0 or odds >= MIN_ODDS):
            good[term] = (bad, math.log(odds))
    covered = {
        t[:-1] for t, (bad, _) in good.items() if len(t) > 1 and t[:-1] in good and bad >= 0.9 * good[t[:-1]][0]
    }
    chosen = sorted(((w, t) for t, (_, w) in good.items() if t not in covered), reverse=True)
    return {t: w for w, t in chosen[:MAX_TERMS]}


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.02, steps: int = 400) -> tuple[float, float]:
    """Slope and offset of a one-dimensional logistic fit, classes weighted alike."""
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    a, b = 1.0, -1.0
    for _ in range(steps):  # Newton steps on a concave objective
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, h = weight * (y - p), weight * np.maximum(p * (1 - p), 1e-9)
        ga, gb = (g * x).sum() - penalty * a, g.sum() - penalty * 0.1 * b
        haa, hab, hbb = (h * x * x).sum() + penalty, (h * x).sum(), h.sum() + penalty * 0.1
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a + da, b + db
        if abs(da) + abs(db) < 1e-9:
            break
    return float(a), float(b)


def sample(
    docs: DataFrame,
    labels: DataFrame,
    learnable: Column,
    text_col: str = "text",
    id_col: str = "doc_id",
    label_col: str = "toxic",
    max_sample: int = MAX_SAMPLE,
) -> DataFrame:
    """(text, label) of at most ``max_sample`` expected, 2 * ``max_sample`` certain rows a class."""
    known = (
        labels.filter(F.coalesce(learnable, F.lit(False)) & F.col(id_col).isNotNull())
        .filter(F.col(label_col).isin(0, 1))
        .groupBy(id_col)
        .agg(F.max(label_col).cast("int").alias("_label"))
    )
    sizes = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    draw = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_003)) / 1_000_003
    parts = [
        known.filter((F.col("_label") == label) & (draw < max_sample / n)).limit(2 * max_sample)
        for label, n in sizes.items()
    ]
    picked = parts[0] if parts else known.limit(0)
    for part in parts[1:]:
        picked = picked.unionByName(part)
    # bounded by 4 * max_sample rows of 12 bytes
    chosen = docs.join(F.broadcast(picked.withColumnRenamed(id_col, "_id")), F.col(id_col) == F.col("_id"))
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    return chosen.select(text, F.col("_label").alias("label"))


def train(texts: DataFrame) -> Lexicon:
    """Learn a lexicon from a bounded frame of (text, label)."""
    texts = stored(texts, "toxic-sample")
    sizes = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
    toxic, harmless = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not harmless:
        return Lexicon()

    def candidates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for label, text in zip(frame["label"], frame["text"]):
                terms = sorted(_terms(fold(text)))
                if terms:
                    yield pd.DataFrame({"term": terms, "label": np.int32(label)})

    counts = (
        texts.mapInPandas(candidates, "term string, label int")
        .groupBy("term")
        .agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("seen"))
        .filter(F.col("bad") >= max(MIN_DOCS, MIN_SHARE * toxic))
        .filter(F.col("bad") / toxic > 5 * (F.col("seen") - F.col("bad")) / harmless)
        .orderBy(F.col("bad").desc(), "term")
        .limit(40 * MAX_TERMS)
        .collect()
    )
    lexicon = Lexicon(choose_terms([(r.term, r.bad, r.seen - r.bad) for r in counts], toxic, harmless))

    def contexts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = lexicon.automaton()
        for frame in frames:
            for label, text in zip(frame["label"], frame["text"]):
                words = fold(text)
                _, starts = lexicon.weigh(words, tree)
                if not starts:
                    continue
                at, place = {}, 0
                for i, w in enumerate(words):
                    at[place] = i
                    place += len(w) + 1
                found = set()
                for s in starts:
                    i = at[s]
                    if i:
                        found.add(f"{words[i - 1]} {words[i]} ")
                    if i + 1 < len(words):
                        found.add(f"{words[i]} {words[i + 1]} ")
                yield pd.DataFrame({"phrase": sorted(found), "label": np.int32(label)})

    phrases = (
        texts.mapInPandas(contexts, "phrase string, label int")
        .groupBy("phrase")
        .agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("seen"))
        .filter((F.col("bad") == 0) & (F.col("seen") >= MIN_DOCS))
        .orderBy(F.col("seen").desc(), "phrase")
        .limit(MAX_PHRASES)
        .collect()
    )
    lexicon.phrases = tuple(r.phrase for r in phrases)

    def weighed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = lexicon.automaton()
        for frame in frames:
            found = []
            for text in frame["text"]:
                words = fold(text)
                found.append(density(lexicon.weigh(words, tree)[0], len(words)))
            yield pd.DataFrame({"x": found, "label": frame["label"]})

    # one number per row of the bounded sample
    points = texts.mapInPandas(weighed, "x double, label int").collect()
    x, y = np.array([p.x for p in points]), np.array([p.label for p in points])
    lexicon.slope, lexicon.offset = fit_logistic(x, y)
    return lexicon


def assess(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (score >= ``cut``) and ``n_terms``."""
    added = [
        T.StructField("score", T.DoubleType()),
        T.StructField("predicted", T.IntegerType()),
        T.StructField("n_terms", T.LongType()),
    ]
    names = {f.name for f in added}
    kept = [f for f in docs.schema.fields if f.name not in names]

    def run(batches):
        import pyarrow as pa

        tree = lexicon.automaton()
        for batch in batches:
            scores, terms = [], []
            for value in batch.column(batch.schema.names.index(text_col)):
                words = fold(value.as_py())
                weight, starts = lexicon.weigh(words, tree)
                scores.append(lexicon.score(weight, len(words)))
                terms.append(len(starts))
            columns = [batch.column(batch.schema.names.index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays(
                [
                    *columns,
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= cut) for s in scores], pa.int32()),
                    pa.array(terms, pa.int64()),
                ],
                [*[f.name for f in kept], "score", "predicted", "n_terms"],
            )

    return docs.mapInArrow(run, T.StructType([*kept, *added]))
