"""Upsert and history."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.history import overlaps, scd2_apply, scd2_dim
from tidemark.operators.merge import merge_upsert, require_unique
from tidemark.operators.shape import schema_changes, sync_columns

T0, T1, T2, T3 = (f"2024-01-0{i} 00:00:00" for i in range(1, 5))


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_merge_replaces_and_inserts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    want = [(1, "a"), (2, "B"), (3, "C"), (None, "N"), (None, "n")]
    assert rows(merge_upsert(target, batch, ["k"]), "k", "v") == sorted(want, key=repr)


def test_merge_twice_is_merge_once(spark):
    target = spark.createDataFrame([(i, "old") for i in range(20)], "k int, v string")
    batch = spark.createDataFrame([(i, "new") for i in range(10, 30)], "k int, v string")
    once = merge_upsert(target, batch, ["k"])
    assert rows(once, "k", "v") == rows(merge_upsert(once, batch, ["k"]), "k", "v")


def test_batch_wins_unless_guarded(spark):
    target = spark.createDataFrame([(1, 5, "stored"), (2, 5, "stored")], "k int, t int, v string")
    batch = spark.createDataFrame([(1, 3, "late"), (2, 5, "same")], "k int, t int, v string")
    assert rows(merge_upsert(target, batch, ["k"]), "v") == [("late",), ("same",)]
    assert rows(merge_upsert(target, batch, ["k"], order_guard="t"), "v") == [("same",), ("stored",)]


def test_merge_syncs_columns(spark):
    target = spark.createDataFrame([(1, "a", 9)], "k int, v string, dropped int")
    batch = spark.createDataFrame([(2, "b", 1.5)], "k int, v string, added double")
    out = merge_upsert(target, batch, ["k"])
    assert out.columns == ["k", "v", "added"]
    assert rows(out, *out.columns) == [(1, "a", None), (2, "b", 1.5)]
    assert merge_upsert(target, batch, ["k"], sync_schema=False).columns == target.columns
    assert schema_changes(target, batch) == {"added": ["added"], "removed": ["dropped"], "retyped": []}
    assert sync_columns(target, batch).columns == batch.columns


def test_repeated_batch_key_is_refused(spark):
    require_unique(spark.createDataFrame([(1,), (None,), (None,)], "k int"), ["k"])
    with pytest.raises(ValueError):
        require_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])


def states(spark, *items):
    return spark.createDataFrame(list(items), "k string, v string, l array<string>, note string")


def test_history_life_cycle(spark):
    h = scd2_apply(None, states(spark, ("a", "1", ["x"], "n"), ("b", None, None, "n")), ["k"], ["v", "l"], T0)
    # a: array changes; b: NULL stays NULL, an untracked column changes; c appears
    h = scd2_apply(h, states(spark, ("a", "1", ["y"], "n"), ("b", None, None, "m"), ("c", "1", [], "n")), ["k"], ["v", "l"], T1)
    # a leaves
    h = scd2_apply(h, states(spark, ("b", None, None, "m"), ("c", "1", [], "n")), ["k"], ["v", "l"], T2)
    # a comes back
    h = scd2_apply(h, states(spark, ("a", "1", ["y"], "n"), ("b", None, None, "m"), ("c", "1", [], "n")), ["k"], ["v", "l"], T3)
    got = rows(h, "k", F.date_format("valid_from", "d"), F.date_format("valid_to", "d"), "note")
    assert got == sorted(
        [("a", "1", "2", "n"), ("a", "2", "3", "n"), ("a", "4", None, "n"), ("b", "1", None, "n"), ("c", "2", None, "n")],
        key=repr,
    )
    assert h.select("scd_id").distinct().count() == 5


def test_history_keeps_missing_keys_on_request(spark):
    h = scd2_apply(None, states(spark, ("a", "1", None, "n")), ["k"], ["v"], T0)
    h = scd2_apply(h, states(spark), ["k"], ["v"], T1, close_missing=False)
    assert h.filter("valid_to is null").count() == 1


def test_history_takes_new_columns(spark):
    h = scd2_apply(None, spark.createDataFrame([("a", 1)], "k string, v int"), ["k"], ["v"], T0)
    h = scd2_apply(h, spark.createDataFrame([("a", 1, 2)], "k string, v int, w int"), ["k"], ["v", "w"], T1)
    assert rows(h, "k", "w", F.col("valid_to").isNull()) == [("a", 2, True), ("a", None, False)]


def test_random_histories_have_contiguous_windows(spark):
    rng = random.Random(7)
    runs = [f"2024-02-{d:02d} 00:00:00" for d in range(1, 7)]
    h, seen = None, []
    for run in runs:
        state = {f"k{i}": str(rng.randint(0, 1)) for i in range(12) if rng.random() < 0.75}
        seen.append(state)
        h = scd2_apply(h, spark.createDataFrame(list(state.items()), "k string, v string"), ["k"], ["v"], run)
        h = spark.createDataFrame(h.collect(), h.schema)
    for i, run in enumerate(runs):
        at = h.filter((F.col("valid_from") <= F.lit(run).cast("timestamp")) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(run).cast("timestamp"))))
        assert dict(rows(at, "k", "v")) == seen[i]
    dim = scd2_dim(h, "k", "version")
    assert overlaps(dim, "k", "version").count() == 0
    assert dim.filter("is_current_record").groupBy("k").count().filter("count > 1").count() == 0
    assert dim.filter("effective_valid_from = timestamp '1900-01-01'").count() == dim.select("k").distinct().count()


def test_overlaps_against_brute_force(spark):
    rng = random.Random(3)
    data = []
    for i in range(300):
        start = rng.randint(1, 400)
        end = None if rng.random() < 0.1 else start + rng.randint(1, 90)
        # one key holds a third of all rows
        data.append((f"k{0 if i % 3 == 0 else i % 40}", f"v{i:03d}", start, end))
    to_ts = lambda c: F.timestamp_seconds(F.lit(1_700_000_000) + F.col(c) * 86_400)
    dim = spark.createDataFrame(data, "k string, v string, s int, e int").select(
        "k", "v", to_ts("s").alias("s"), to_ts("e").alias("e")
    )
    got = {r.version_key for r in overlaps(dim, "k", "v", "s", "e").collect()}
    big = 10**9
    want = {
        b[1]
        for b in data
        for a in data
        if a[0] == b[0] and (a[2], a[1]) < (b[2], b[1]) and b[2] < (a[3] or big) and a[2] < (b[3] or big)
    }
    assert got == want and got
