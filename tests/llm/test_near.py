"""Near-duplicates against brute force where strays abound: chains and copies of damaged copies."""

import random

import pytest

from tidemark.llm import setsketch


def families():
    draw, out = random.Random(5), []
    for f in range(6):
        base = [f"f{f}w{draw.randrange(900)}" for _ in range(150)]
        for _ in range(40):  # about as far from the original as a link may be
            text = list(base)
            for at in draw.sample(range(150), draw.choice((6, 8, 9, 10, 14))):
                text[at] = f"x{draw.randrange(10**6)}"
            out.append(text)
            if draw.random() < 0.4:  # a copy of the damaged copy
                again = list(text)
                for at in draw.sample(range(150), draw.choice((1, 5, 9))):
                    again[at] = f"y{draw.randrange(10**6)}"
                out.append(again)
    return [(i * 3, " ".join(w)) for i, w in enumerate(out)]


def brute(rows):
    sets = {i: set(zip(t.split(), t.split()[1:])) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted((i, root(i)) for i in sets)


@pytest.mark.parametrize("block", [512, 16])
def test_strays_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(setsketch, "BLOCK_SETS", block)
    rows = families()
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == brute(rows)


def test_texts_are_shuffled_once_for_the_rows_that_stay(spark):
    texts = families()[:20]
    rows = [*texts, *texts[:5], (None, "no id at all"), (None, "no id at all"), (0, "no id at all"), (7, None), (8, "")]
    out = setsketch.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), words=2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(doc#") == 1
    known = {i for i, r in brute(texts) if i == r}
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in out.collect()), key=repr)
    # the row without id, and of two texts of id 0 the one of its own and the base
    want = [(False, i, t) for i, t in texts if i in known]
    want += [(True, 0, "no id at all"), (False, 0, "no id at all"), (False, 7, None), (False, 8, "")]
    assert got == sorted(want, key=repr)


def test_pairs_meet_their_sets_in_one_pass(spark):
    rows = families()[:60]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    full = setsketch.sketch(docs, 2).selectExpr("doc_id as least", "doc_id as id", "n_shingles as n", "set_key", "registers")
    full = setsketch.stored(setsketch._full_sets(docs, full, 2, "text", "doc_id"), "full")
    pairs = spark.createDataFrame([(a, b) for a, _ in rows for b, _ in rows if a < b], "a long, b long")
    links = setsketch._links(pairs, full)
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2
    sets = {i: set(zip(t.split(), t.split()[1:])) for i, t in rows}
    near = {
        (a, b) for a in sets for b in sets
        if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    }
    assert near and {tuple(r) for r in links.select("u", "v").collect()} == near
