"""Connected components against a plain union of sets, with shares of any size."""

import random

import pytest

from tidemark.llm import components as module
from tidemark.llm.components import components


def graph():
    draw = random.Random(11)
    chain = list(range(0, 400, 2))
    draw.shuffle(chain)  # a long path, its numbers in no order
    edges = list(zip(chain, chain[1:]))
    edges += [(1001, 1003 + 2 * i) for i in range(150)]  # a star
    edges += [(5001 + 2 * draw.randrange(300), 5001 + 2 * draw.randrange(300)) for _ in range(200)]
    return edges + edges[:20] + [(v, u) for u, v in edges[:20]] + [(9, 9), (7, None), (None, 7)]


def plain(edges):
    group = {}
    for u, v in edges:
        if None not in (u, v) and u != v:
            both = group.get(u, {u}) | group.get(v, {v})
            group.update(dict.fromkeys(both, both))
    return sorted((node, min(both)) for node, both in group.items())


@pytest.mark.parametrize("share", [1 << 18, 200, 16])
def test_components_in_one_share_and_in_many(spark, monkeypatch, share):
    monkeypatch.setattr(module, "EDGES", share)
    edges = graph()
    rows = spark.createDataFrame(edges, "u long, v long").repartition(7)
    assert sorted(tuple(r) for r in components(rows).select("node", "component").collect()) == plain(edges)


def test_no_edges(spark):
    assert components(spark.createDataFrame([(3, 3)], "u long, v long")).collect() == []


def test_a_list_that_one_task_may_hold_takes_no_steps(spark, monkeypatch):
    wrote, write = [], module.stored
    monkeypatch.setattr(module, "stored", lambda df, label: wrote.append(label) or write(df, label))
    edges = spark.createDataFrame([(i, i + 1) for i in range(3000)], "u long, v long")
    found = components(edges)
    assert len(wrote) == 1
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.filter("component = 0").count() == 3001


@pytest.mark.parametrize("held", [40, 1000])
def test_a_task_holds_no_more_edges_than_its_share(spark, monkeypatch, held):
    monkeypatch.setattr(module, "EDGES", held)
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)], "u long, v long").coalesce(1)
    out = module._joined_up(edges).collect()
    # a path of 100 edges in pieces: each piece has all its nodes, on its least
    assert len(out) == 100 + -(-100 // held)
    assert {r.u - r.v for r in out if r.v == 0} == set(range(min(held, 100) + 1))
