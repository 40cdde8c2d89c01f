"""Odd inputs: nulls, empty and very long texts, ties, repeats, empty tables, clashing names."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import bpe, language, license_scan, mixing, pii, quality, setsketch, suffix_dedup, topk, toxicity
from tidemark.llm.common import tokenizer

LONG = ("word%d other " * 3) % (1, 2, 3) + " ".join(f"tok{i * 7919 % 10007}x" for i in range(30_000))
PROSE = "the quick brown fox jumps over the lazy dog and then runs far away from all of it"
ROWS = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, LONG, None, None),
    (4, PROSE, "en", "a"),
    (4, PROSE, "en", "a"),  # repeated row
    (5, PROSE, "en", "b"),  # tie
    (None, PROSE, "de", "b"),
    (None, "x", None, "b"),
    (6, " \t\n\r\x0b\x0c ", "en", "a"),
    (7, "9" * 50_000 + " @" + "a" * 50_000 + "+" * 1000, "en", "a"),
    (8, "Licensed under the Apache License, Version 2.0.\nmail me@x.org", "en", "a"),
]
# names that operators add themselves, and names of their helper columns
EXTRA = "n_words kept score predicted lang_pred rejected ids decoded size target digest verdicts spans base row label".split()


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit("mine") for c in EXTRA})


LABELS = [(1, 0, 0), (2, 1, 1), (3, 0, 0), (4, 1, 1), (None, 1, 1)]


def run_all(spark, docs):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    model = language.train(docs, F.lit(True))
    lexicon = toxicity.train(toxicity.sample(docs, labels, F.lit(True)))
    return {
        "license": license_scan.scan(docs, license_scan.train(spark, docs)),
        "pii": pii.with_spans(pii.scan(docs)),
        "redact": pii.redact(docs),
        "bpe": bpe.decode(bpe.encode(docs, *tokenizer()), *tokenizer()),
        "toxicity": toxicity.assess(docs, lexicon),
        "schedule": mixing.schedule(docs),
        "quality": quality.judge(docs),
        "near": setsketch.near_duplicates(docs, words=2),
        "language": language.predict(docs, model),
        "suffix": suffix_dedup.remove_repeats(docs),
    }


@pytest.fixture(scope="module")
def results(spark, odd):
    return {name: df.collect() for name, df in run_all(spark, odd).items()}


def by_id(rows, i):
    return [r for r in rows if r.doc_id == i]


def test_one_row_per_row(results):
    assert {name: len(rows) for name, rows in results.items()} == dict.fromkeys(results, len(ROWS))


def test_empty_tables(spark, odd):
    for name, df in run_all(spark, odd.limit(0)).items():
        assert df.count() == 0, name
    assert mixing.mix(odd.limit(0)).count() == 0


def test_defined_results(results):
    assert by_id(results["license"], 8)[0].family == "apache"
    assert pii.KINDS and [s.text for s in by_id(results["pii"], 8)[0].spans] == ["me@x.org"]
    assert by_id(results["redact"], 8)[0].text.endswith("mail <EMAIL>")
    assert by_id(results["redact"], 1)[0].text is None
    assert bytes(by_id(results["bpe"], 3)[0].decoded).decode() == LONG
    assert bytes(by_id(results["bpe"], 1)[0].ids) == b""
    assert by_id(results["language"], 1)[0].lang_pred == by_id(results["language"], 6)[0].lang_pred == "und"
    assert by_id(results["quality"], 1)[0].n_words == 0 and by_id(results["quality"], 2)[0].base_failed
    assert by_id(results["schedule"], 1)[0].taken == 0


WRAPPED = {
    "mit": """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software.
""",
    "gpl": """/*
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */""",
    "bsd": """# Redistribution and use in source and binary forms,
# with or without modification, are
# permitted provided that the following conditions are met:
#
# some code follows""",
    "apache": """// Licensed under the Apache
// License, Version 2.0 (the "License");
// you may not use this file except
// in compliance with the License.\r
int main() {}""",
    "unknown": """The council gave permission to the
baker to sell bread in the old town, and

the driver lost a license on
the way home from the sea.""",
}


def test_wrapped_notices(spark):
    rows = list(WRAPPED.items())
    df = spark.createDataFrame(rows, "name string, text string")
    got = license_scan.scan(df, license_scan.train(spark)).collect()
    assert {r["name"]: (r.family, r.families) for r in got} == {
        k: (k, [k] if k != "unknown" else []) for k, _ in rows
    }


def test_near_duplicates_of_odd_rows(results):
    rows = results["near"]
    assert {r.component_id for r in by_id(rows, 4) + by_id(rows, 5)} == {4}
    assert [r.kept for r in by_id(rows, 4)] == [True, True] and not by_id(rows, 5)[0].kept
    assert all(r.component_id is None and r.kept for r in by_id(rows, None))
    assert all(r.n_shingles == 0 and r.kept for i in (1, 2, 6) for r in by_id(rows, i))


def test_pipeline_of_odd_rows(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, "")
        assert docs.columns == odd.columns
    assert corpus_pipeline.STAGES[4][1](spark, docs, "").filter(~F.col("round_trip")).count() == 0


def test_suffixes(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(400))
    df = spark.createDataFrame([(2, text), (1, "zz" + text[:150]), (3, text[100:199]), (None, text)], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.spans) for r in suffix_dedup.remove_repeats(df).collect()}
    want = brute_force([(1, "zz" + text[:150]), (2, text), (3, text[100:199]), (None, text)])
    assert {k: v[0] for k, v in got.items()} == want and want[None] == len(text)


def test_a_repeated_row_is_one_document(spark):
    """Copies of a row are no earlier start; a passage repeated inside or in another row is."""
    own, inner, void = ("".join(random.Random(k).choices("abcdefghij ", k=500)) for k in range(3))
    rows = [(4, own)] * 3 + [(7, inner + "#" + inner[:200])] * 2 + [(9, "x" + own[:300])] + [(None, void)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r.doc_id or 99, r.n_removed) for r in suffix_dedup.remove_repeats(df).collect())
    want = brute_force(dict.fromkeys(rows))
    assert got == sorted((i or 99, want[i]) for i, _ in rows)
    assert want[4] == want[None] == 0 and want[7] >= 200 and want[9] >= 300


def brute_force(docs):
    seen, out = set(), {}
    for name, text in docs:
        raw, gone = text.encode(), set()
        for p in range(len(raw) - 99):
            window = raw[p : p + 100]
            if window in seen:
                gone.update(range(p, p + 100))
            seen.add(window)
        out[name] = len(gone)
    return out


def test_frequent_anchors_are_dealt_out_and_still_whole(spark):
    """One passage in a third of all rows, with other text around it."""
    passage = "".join(chr(97 + i * 7 % 26) for i in range(90)) + "0123456789" * 2
    rows = [(i, f"{i:05d}{'left' * (i % 7)} {passage} {i * 31:06d}") for i in range(600)]
    rows += [(1000 + i, f"{i * 7919:012d} unrelated {i}" * 5) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == brute_force(rows)


def test_large_group_of_near_copies(spark):
    """Variants of one text, linked in chains, without listing all pairs."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(150):
        words = list(base)
        for j in range(k // 10):
            words[(k * 13 + j * 7) % 120] = f"v{k}_{j}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, " ".join(f"u{k}_{i}" for i in range(60))) for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: {*zip(t.split(), t.split()[1:])} for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = {r.doc_id: r.component_id for r in setsketch.near_duplicates(df, words=2).collect()}
    assert got == {i: root(i) for i in sets}


def test_top_k_leaves_out_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]),
            (5, [None, 1.0]), (6, [1.0]), (7, [-0.001, 0.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(
        2 * [(0, 1, 0, 81920), (0, 2, 1, 81920), (0, 3, 7, -256)]
    )
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


HELPERS = "id _id key _key row _row doc _doc hash _hash spans own whole new least band cluster node".split()


def test_helper_names_of_the_operators_may_clash(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    docs = docs.withColumns({c: F.lit("mine") for c in HELPERS})
    for out in (pii.redact(docs), setsketch.deduplicate(docs, words=5)):
        assert out.columns == docs.columns
        assert {tuple(r[c] for c in HELPERS) for r in out.collect()} == {("mine",) * len(HELPERS)}


def test_one_id_with_two_texts_loses_no_link(spark):
    one, two = (" ".join(f"{p}{i}" for i in range(120)) for p in "ab")
    rows = [(1, one), (1, two), (2, one + " more"), (3, two + " more"), (4, "another text of its own")]
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [
        (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True),
    ]
