"""The corpus queries against DuckDB or a brute-force version, on the smallest data set."""

import base64
import glob
import hashlib
import os
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries
from tidemark.llm.common import tokenizer

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("select doc_id, coalesce(text, '') from documents").fetchall())


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda v: repr(round(v, 6)) if isinstance(v, float) else repr(v)
    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, duck, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    got = normal(df.collect(), df.columns)
    cursor = duck.execute(queries.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert got and got == normal(cursor.fetchall(), columns)


def test_all_queries_are_there():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in queries.QUERIES


@pytest.mark.parametrize("name", ["op1_license_scan", "op2_pii", "op5_mixing", "op6_quality"])
def test_native_plans(spark, name):
    plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|Arrow", plan)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_license_lines(spark, texts):
    notices = {
        "mit": "Released under the MIT License.",
        "apache": "Licensed under the Apache License, Version 2.0.",
        "gpl": "This work is licensed under the GNU General Public License, version 3.",
        "cc": "Licensed under CC BY-NC 4.0.",
    }
    for r in queries.QUERIES["op1_license_scan"](spark, SF_DIR).collect():
        lines = set(texts[r.doc_id].split("\n"))
        assert r.families == ",".join(sorted(k for k, v in notices.items() if v in lines))


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]
            if good():
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def spelled(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


def test_pii_base(spark, texts):
    for r in queries.QUERIES["op2_pii"](spark, SF_DIR).collect():
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(spelled(want).encode()).hexdigest()
        assert set(filter(None, spelled(want).split(","))) <= set(r.spans.split(","))
        assert r.n_card == sum(k == "card" for *_, k in want)


def test_bpe(spark, texts):
    import tiktoken

    path, pattern = tokenizer()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    for r in queries.QUERIES["op3_bpe"](spark, SF_DIR).collect():
        ids = own.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_toxicity_on_rows_it_never_saw(spark, duck):
    truth = dict(duck.execute("select doc_id, toxic from '/root/testdata/sf0.01/labels.parquet'").fetchall())
    rows = queries.QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.predicted == 0 for r in held if truth[r.doc_id] == 0)
    caught = [r.predicted for r in held if truth[r.doc_id] == 1]
    assert sum(caught) >= 0.6 * len(caught) and len(rows) == 1000


def test_language_on_rows_it_never_saw(spark, duck):
    truth = dict(duck.execute("select doc_id, lang from documents").fetchall())
    rows = queries.QUERIES["op8_language"](spark, SF_DIR).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_pipeline(spark, texts):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    before = docs
    for name, stage in p.STAGES:
        after = stage(spark, before, SF_DIR)
        after.write.parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}")
        after = spark.read.parquet(path)
        if name != "bpe":
            assert after.columns == columns
        if name == "near_dedup":
            check_near(before, after)
        if name == "pii":
            rows = dict(before.select("doc_id", "text").collect())
            for r in after.collect():
                assert r.text == redact(rows[r.doc_id]) and r.n_chars == len(r.text)
        if name == "mixing":
            check_mix(before, after)
        if name == "bpe":
            assert after.count() == before.count()
            assert after.filter(~F.col("round_trip") | F.col("round_trip").isNull()).count() == 0
        before = after


def redact(text):
    out, at = "", 0
    for start, _, end, kind in base_spans(text):
        if start >= at:
            out += text[at:start] + f"<{kind.upper()}>"
        at = max(at, end)
    return out + text[at:]


def check_near(before, after):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = {i: shingles(t or "") for i, t in before.select("doc_id", "text").collect()}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    assert sorted(r.doc_id for r in after.select("doc_id").collect()) == [i for i in ids if root(i) == i]


def check_mix(before, after):
    sizes = {i: len((t or "").split()) for i, t in before.select("doc_id", "text").collect()}
    sources = dict(before.select("doc_id", "source").collect())
    taken = {}
    for (i,) in after.select("doc_id").collect():
        taken[i] = taken.get(i, 0) + 1
    assert max(taken.values()) <= 2
    total = sum(sizes[i] * n for i, n in taken.items())
    assert abs(total - 1.5 * sum(sizes.values())) < 0.05 * sum(sizes.values())
    assert len({sources[i] for i in taken}) > 1
