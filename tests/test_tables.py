"""Published tables: versions, touched buckets, replays, failures."""

import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators.history import scd2_apply
from tidemark.sources.tables import ConcurrentPublish, PublishedTable

FIRST = datetime(2000, 1, 1, tzinfo=timezone.utc)


def rows(df):
    return sorted(map(tuple, df.collect()))


def batch(spark, lo, hi, tag):
    return spark.range(lo, hi).select(
        F.col("id").alias("k"), F.lit(tag).alias("v"), F.timestamp_seconds(F.col("id")).alias("_loaded_at")
    )


def test_merge_and_mark(spark, folder):
    t = PublishedTable(spark, f"{folder}/t", ["k"], 8, "_loaded_at")
    assert t.read() is None and t.high_water(FIRST) == FIRST
    t.merge(batch(spark, 0, 100, "a"))
    t.merge(batch(spark, 90, 120, "b"))
    assert rows(t.read().select("k", "v")) == [(i, "a" if i < 90 else "b") for i in range(120)]
    assert t.high_water(FIRST) == datetime(1970, 1, 1, 0, 1, 59, tzinfo=timezone.utc)


def test_merge_rewrites_only_touched_buckets(spark, folder):
    t = PublishedTable(spark, f"{folder}/t", ["k"], 16)
    t.merge(batch(spark, 0, 500, "a"))
    before = t.manifest()["parts"]
    t.merge(batch(spark, 7, 8, "b"))
    after = t.manifest()["parts"]
    assert len(before) == 16 and sum(before[b] != after[b] for b in before) == 1
    assert t.read().filter("v = 'b'").count() == 1 and t.read().count() == 500


def test_replayed_batch_id_changes_nothing(spark, folder):
    t = PublishedTable(spark, f"{folder}/t", ["k"], 4)
    assert t.merge(batch(spark, 0, 10, "a"), batch_id=0)
    assert not t.merge(batch(spark, 0, 10, "z"), batch_id=0)
    assert t.merge(batch(spark, 5, 12, "b"), batch_id=1)
    assert {r.v for r in t.read().collect()} == {"a", "b"} and t.read().count() == 12


def test_overwrite_may_read_itself(spark, folder):
    t = PublishedTable(spark, f"{folder}/t")
    t.overwrite(batch(spark, 0, 10, "a"))
    t.overwrite(t.read().filter("k < 5").withColumn("v", F.lit("c")))
    assert rows(t.read().select("k", "v")) == [(i, "c") for i in range(5)]


def test_schema_changes_follow_the_batch(spark, folder):
    t = PublishedTable(spark, f"{folder}/t", ["k"], 4)
    t.merge(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k long, v string, gone int"))
    t.merge(spark.createDataFrame([(2, "B", 2.5)], "k long, v string, added double"))
    assert t.read().columns == ["k", "v", "added"]
    assert sorted(map(tuple, t.read().collect()), key=repr) == [(1, "a", None), (2, "B", 2.5)]
    # a new type rewrites every bucket
    t.merge(spark.createDataFrame([(3, "c", "x")], "k long, v string, added string"))
    assert dict(t.read().dtypes)["added"] == "string"
    assert sorted(map(tuple, t.read().collect()), key=repr) == [(1, "a", None), (2, "B", "2.5"), (3, "c", "x")]


def test_repeated_keys_are_never_published(spark, folder):
    t = PublishedTable(spark, f"{folder}/t", ["k"], 4)
    twice = batch(spark, 0, 3, "a").unionByName(batch(spark, 0, 3, "b"))
    with pytest.raises(ValueError):
        t.merge(twice)
    assert not t.exists()
    t.merge(batch(spark, 0, 3, "a"))
    with pytest.raises(ValueError):
        t.merge(twice)
    assert rows(t.read().select("k", "v")) == [(i, "a") for i in range(3)]


def test_empty_batch(spark, folder):
    t = PublishedTable(spark, f"{folder}/t", ["k"], 4)
    t.merge(batch(spark, 0, 0, "a"))
    assert t.read().count() == 0
    t.merge(batch(spark, 0, 3, "a"))
    t.merge(batch(spark, 0, 0, "a"))
    assert t.read().count() == 3


def test_second_writer_of_a_version_fails(spark, folder):
    t = PublishedTable(spark, f"{folder}/t", ["k"], 4)
    t.merge(batch(spark, 0, 3, "a"))
    with pytest.raises(ConcurrentPublish):
        t._commit(1, json.dumps({}))


def test_vacuum_keeps_what_is_in_use(spark, folder):
    t = PublishedTable(spark, f"{folder}/t", ["k"], 4)
    for tag in "abcd":
        t.merge(batch(spark, 0, 50, tag))
    assert t.vacuum(keep=1) == 3
    assert {r.v for r in t.read().collect()} == {"d"} and len(os.listdir(f"{folder}/t/data")) == 1


def test_a_removed_column_comes_back_empty(spark, folder):
    t = PublishedTable(spark, f"{folder}/t", ["k"], 8)
    full = spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("c"))
    t.merge(full)
    t.merge(full.filter("k = 1").drop("c"))
    t.merge(full.filter("k = 2"))
    assert t.read().filter("c is not null").count() == 1
    t.merge(full.filter("k = 1").drop("c"))
    t.merge(full.filter("k = 3").withColumn("c", F.lit(7)))
    assert [r.k for r in t.read().filter("c = 7").collect()] == [3] and t.read().count() == 100


def test_batches_are_counted_per_stream(spark, folder):
    t = PublishedTable(spark, f"{folder}/t", ["k"], 4)
    for i in range(3):
        assert t.merge(batch(spark, i, i + 1, "a"), batch_id=i, source="one")
    assert t.merge(batch(spark, 10, 11, "b"), batch_id=0, source="two")  # a new checkpoint
    assert not t.merge(batch(spark, 0, 1, "z"), batch_id=2, source="one")
    with pytest.raises(ValueError, match="batch 5"):
        t.merge(batch(spark, 20, 21, "c"), batch_id=5, source="one")
    assert rows(t.read().select("k")) == [(0,), (1,), (2,), (10,)]


def test_a_refused_batch_leaves_no_staging(spark, folder):
    t = PublishedTable(spark, f"{folder}/t", ["k"], 4)
    t.merge(batch(spark, 0, 3, "a"))
    with pytest.raises(ValueError):
        t.merge(batch(spark, 0, 3, "a").union(batch(spark, 0, 3, "b")))
    assert os.listdir(f"{folder}/t/_staging") == []


def test_history_rolls_open_versions_only(spark, folder):
    t = PublishedTable(spark, f"{folder}/t")
    row = lambda k, v: spark.createDataFrame([(k, v)], "k int, v string")
    now = lambda day: f"2025-01-0{day} 00:00:00"
    for day, v in ((1, "a"), (2, "b"), (3, "c")):
        before = (t.manifest() or {"parts": {}})["parts"]
        t.roll(lambda old: scd2_apply(old, row(1, v), ["k"], ["v"], now(day)), F.col("valid_to").isNull())
        after = t.manifest()["parts"]
        assert {p: f for p, f in before.items() if p != "open"}.items() <= after.items()
    assert sorted(after) == ["closed2", "closed3", "open"]
    assert [r.v for r in t.read().orderBy("valid_from").collect()] == ["a", "b", "c"]
    assert t.read(["open"]).count() == 1


def test_a_month_is_read_alone(spark, folder):
    t = PublishedTable(spark, f"{folder}/t", part_by=F.date_format("day", "yyyy-MM"))
    t.overwrite(spark.sql("select explode(sequence(date'2024-01-01', date'2024-04-30')) as day union all select null"))
    assert sorted(t.manifest()["parts"]) == ["2024-01", "2024-02", "2024-03", "2024-04", "none"]
    assert t.read(["2024-02"]).count() == 29 and t.read().count() == 122
    assert all("2024-02" in f for f in t.read(["2024-02"]).inputFiles())


def test_a_half_written_manifest_is_not_read(spark, folder):
    t = PublishedTable(spark, f"{folder}/t", ["k"], 4)
    t.merge(batch(spark, 0, 3, "a"))
    with open(f"{folder}/t/_manifests/0000000002.json", "w") as f:
        f.write('{"version": 2, "par')
    assert t.read().count() == 3


@pytest.mark.parametrize("torn", ["", '{"version": 2, "par'])
def test_a_crash_between_versions_blocks_nothing(spark, folder, torn):
    t = PublishedTable(spark, f"{folder}/t", ["k"], 4)
    t.merge(batch(spark, 0, 3, "a"))
    with open(f"{folder}/t/_manifests/0000000002.json", "w") as f:
        f.write(torn)
    assert t.merge(batch(spark, 2, 5, "b"))
    assert rows(t.read().select("k", "v")) == [(0, "a"), (1, "a"), (2, "b"), (3, "b"), (4, "b")]
    assert t.manifest()["version"] == 3
    with open(f"{folder}/t/_manifests/0000000004.json", "w") as f:
        f.write(torn)
    t.vacuum(keep=1)
    assert t.merge(batch(spark, 5, 6, "c")) and t.manifest()["version"] == 5
    assert t.read().count() == 6
    empty = PublishedTable(spark, f"{folder}/u", ["k"], 4)
    os.makedirs(f"{folder}/u/_manifests")
    open(f"{folder}/u/_manifests/0000000001.json", "w").close()
    assert not empty.exists() and empty.merge(batch(spark, 0, 2, "a")) and empty.read().count() == 2


def test_a_batch_of_one_month_rewrites_one_part(spark, folder):
    t = PublishedTable(spark, f"{folder}/t", ["k"], 4, part_by=F.date_format("day", "yyyy-MM"))
    day = lambda d: F.to_date(F.lit(d))
    months = [f"2024-{m:02d}" for m in range(1, 13)]
    year = spark.range(366).select(F.col("id").alias("k"), F.date_add(day("2024-01-01"), F.col("id").cast("int")).alias("day"))
    t.merge(year.withColumn("v", F.lit("old")))
    before = t.manifest()["parts"]
    assert sorted(before) == months
    t.merge(year.filter("k in (40, 45)").withColumn("v", F.lit("new")))  # February
    after = t.manifest()["parts"]
    assert [m for m in months if before[m] != after[m]] == ["2024-02"]
    # a row that moves leaves its old month, which is rewritten as well
    t.merge(year.filter("k = 40").select("k", day("2025-06-01").alias("day"), F.lit("moved").alias("v")))
    last = t.manifest()["parts"]
    assert [m for m in months if last[m] != after[m]] == ["2024-02"] and "2025-06" in last
    got = {r.k: (str(r.day)[:7], r.v) for r in t.read().collect()}
    assert len(got) == 366 and got[40] == ("2025-06", "moved") and got[45] == ("2024-02", "new")


def test_closed_parts_of_an_older_type_are_read_as_the_newer(spark, folder):
    t = PublishedTable(spark, f"{folder}/t")
    now = lambda day: f"2025-01-0{day} 00:00:00"
    steps = [
        spark.createDataFrame([("x", 1)], "k string, v int"),
        spark.createDataFrame([("x", 2)], "k string, v int"),
        spark.createDataFrame([("x", "2")], "k string, v string"),  # the same value in another type
        spark.createDataFrame([("x", "two")], "k string, v string"),
        spark.createDataFrame([("x", ["two"], 7)], "k string, v array<string>, w int"),
    ]
    for day, source in enumerate(steps, 1):
        t.roll(lambda old: scd2_apply(old, source, ["k"], ["v"], now(day)), F.col("valid_to").isNull())
    got = [r.v for r in t.read().orderBy("valid_from").collect()]
    assert got == ["1", "2", "two", '["two"]']
    assert t.read(["open"]).filter("w = 7").count() == 1
