"""Importance resampling against a plain version, and its cutoff on ties."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import resampling as rs

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TARGET = [("The Cat sat",), ("on the mat, the Éclair",), (None,), ("",)]


def rows():
    words = "the cat sat on a mat Éclair ÉCLAIR x1 42 naïve don't 猫 \U0001F600".split()
    out = [(i, " ".join(words[(i * k) % len(words)] for k in range(1, 18 + i % 9))) for i in range(200)]
    out += [(500, None), (501, ""), (502, "... --- !!!"), (None, out[3][1] * 3), (503, "cat-" * 40_000)]
    out += [(7, out[9][1] + " mat mat"), (8, out[8][1]), (8, out[8][1])]  # repeated ids and rows
    return out


def features(text, longest):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    return [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, per_cent, min_words, longest, buckets):
    place = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(place(f) for _, t in docs for f in features(t, longest))
    t = Counter(place(f) for (x,) in target for f in features(x, longest))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in range(buckets)
    ]
    out = []
    for i, text in docs:
        f = features(text, longest)
        weight, score = sum(gain[place(x)] for x in f), None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, len(features(text, 1))])
    able = sorted((r for r in out if r[3] is not None and r[5] >= min_words), key=lambda r: (-r[3], r[0], r[1]))
    for rank, r in enumerate(able[: per_cent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.mark.parametrize("per_cent,longest,buckets", [(10, 1, 10_000), (37, 3, 50), (100, 2, 1), (0, 1, 10)])
def test_against_a_plain_version(spark, per_cent, longest, buckets):
    docs = spark.createDataFrame(rows(), "doc_id long, text string").repartition(5)
    docs = docs.withColumns({c: F.lit("mine") for c in "words places place weight score rank n_words part own".split()})
    target = spark.createDataFrame(TARGET, "text string")
    got = rs.resample(docs, target, per_cent, 20, longest=longest, buckets=buckets).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows(), TARGET, per_cent, 20, longest, buckets)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert rs.resample(none, none.select("text")).count() == 0
    some = spark.createDataFrame(rows(), "doc_id long, text string")
    got = rs.resample(some, none.select("text")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows(), [], 10, 20, 1, 10_000)


@pytest.mark.parametrize("wanted", [1, 4, 5, 99, 100, 149, 150, 299, 300])
def test_cutoff_among_ties(spark, wanted):
    scores = [(i, 5 if 100 <= i < 250 else (-(10**12) if i >= 250 else 10**12 + i % 3)) for i in range(300)]
    df = spark.createDataFrame([(10**15 * (i - 150), s) for i, s in scores], "doc_id long, score long").cache()
    ordered = sorted(((s, i) for i, s in df.collect()), key=lambda x: (-x[0], x[1]))
    assert rs.cutoff(df, wanted) == ordered[wanted - 1]
    df.unpersist()


def test_a_hot_row_is_ranked_over_several_ranges(spark):
    one = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the cat sat " * 9).alias("text"))
    got = rs.resample(one, spark.createDataFrame(TARGET, "text string"), 50)
    assert sorted(r.rank for r in got.filter("rank is not null").collect()) == list(range(1, 1501))
    assert got.count() == 3000
