"""Joins: same rows as the plain formulation, and plans that scale."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins
from tidemark.operators.history import backdate_first
from tidemark.operators.merge import merge_upsert


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def reviews(spark, n=400):
    return spark.range(n).select(
        F.col("id").alias("rid"),
        F.expr("case id % 4 when 0 then 'g2h' when 1 then 'h2g' when 2 then 'other' end").alias("role"),
        F.concat(F.lit("p"), (F.col("id") % 30).cast("string")).alias("a"),
        F.concat(F.lit("p"), (F.col("id") % 17).cast("string")).alias("b"),
    )


def people(spark):
    return spark.range(20).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("pid"), (F.col("id") * 10).alias("tag"))


def test_role_join_equals_or_join(spark):
    fact, dim = reviews(spark), people(spark)
    got = joins.role_join(fact, dim, "role", {"g2h": "a", "h2g": "b"}, "pid", ["tag"])
    cond = ((fact.role == "g2h") & (fact.a == dim.pid)) | ((fact.role == "h2g") & (fact.b == dim.pid))
    want = fact.join(dim, cond, "left").select(*got.columns)
    assert rows(got) == rows(want)
    assert "NestedLoop" not in _plan(got)


def test_lookup_keeps_null_and_unknown_keys_and_renames(spark):
    fact = spark.createDataFrame([(1, "a"), (2, None), (3, "zz"), (4, None)], "id int, k string")
    dim = spark.createDataFrame([("a", 7), (None, 8)], "k string, v int")
    got = joins.lookup_join(fact, dim, "k", "k", {"v": "w"})
    assert rows(got) == sorted([(1, "a", 7), (2, None, None), (3, "zz", None), (4, None, None)], key=repr)


def test_null_keys_are_spread_over_partitions(spark, folder, shuffled_joins):
    fact = spark.range(0, 4000, 1, 8).select(
        "id", F.lit(None).cast("string").alias("k"), F.current_timestamp().alias("at")
    )
    dim = people(spark).withColumn("effective_valid_from", F.current_timestamp()).withColumn(
        "valid_to", F.lit(None).cast("timestamp")
    )
    for name, got in {
        "lookup": joins.lookup_join(fact, dim, "k", "pid", ["tag"]),
        "asof": joins.asof_join(fact, dim, "k", "pid", "at", ["tag"]),
        "orphans": joins.orphans(fact, dim, "k", "pid"),
        "upsert": merge_upsert(fact.select("id", "k"), people(spark).select(F.col("tag").alias("id"), F.col("pid").alias("k")), ["k"]).filter("k is null"),
    }.items():
        got.withColumn("part", F.spark_partition_id()).write.parquet(f"{folder}/{name}")
        parts = spark.read.parquet(f"{folder}/{name}").groupBy("part").count().collect()
        sizes = [r["count"] for r in parts]
        assert sum(sizes) == 4000 and max(sizes) < 1000, name


def test_mixed_key_types_match_by_value(spark):
    fact = spark.range(6).select("id", F.col("id").cast("int").alias("k"))
    for kind in ("double", "decimal(10,2)", "bigint", "string"):
        dim = spark.range(4).select(F.col("id").cast("int").cast(kind).alias("k"), (F.col("id") * 10).alias("v"))
        got = joins.lookup_join(fact, dim, "k", "k", ["v"], hot=[("2", 3)])
        assert {r.id: r.v for r in got.collect()} == {0: 0, 1: 10, 2: 20, 3: 30, 4: None, 5: None}, kind
        assert sorted(r.id for r in joins.orphans(fact, dim, "k", "k").collect()) == [4, 5], kind


def test_unknown_roles_are_spread(spark, folder, shuffled_joins):
    fact = spark.range(0, 4000, 1, 8).select(F.lit("odd").alias("role"), F.col("id").alias("a"), F.col("id").alias("b"))
    found = spark.range(5).select("id", F.lit(True).alias("_found"))
    got = joins.role_join(fact, found, "role", {"x": "a"}, "id", ["_found"], spread_by=fact.columns)
    got.withColumn("part", F.spark_partition_id()).write.parquet(f"{folder}/roles")
    sizes = [r["count"] for r in spark.read.parquet(f"{folder}/roles").groupBy("part").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1000


def test_lookup_reads_only_needed_columns(spark, folder):
    spark.range(50).select("id", F.col("id").cast("string").alias("k"), F.lit("x").alias("wide")).write.parquet(f"{folder}/f")
    fact = spark.read.parquet(f"{folder}/f")
    got = joins.lookup_join(fact, people(spark), "k", "pid", ["tag"]).select("id", "tag")
    assert "wide" not in _plan(got)


def test_asof_never_multiplies_and_is_half_open(spark):
    dim = spark.sql(
        """select * from values ('x', 1, timestamp '2024-01-01', timestamp '2024-02-01'),
        ('x', 2, timestamp '2024-02-01', null), ('y', 1, timestamp '2024-01-01', timestamp '2024-01-05') as t(k, v, valid_from, valid_to)"""
    )
    fact = spark.sql(
        """select * from values (1, 'x', timestamp '2020-01-01'), (2, 'x', timestamp '2024-01-31 23:59:59'), (3, 'x', timestamp '2024-02-01'),
        (4, 'y', timestamp '2024-01-06'), (5, 'z', timestamp '2024-01-06'), (6, null, timestamp '2024-01-06'), (7, 'x', null) as t(id, k, at)"""
    )
    got = joins.asof_join(fact, backdate_first(dim, "k"), "k", "k", "at", ["v"])
    assert {r.id: r.v for r in got.collect()} == {1: 1, 2: 1, 3: 2, 4: None, 5: None, 6: None, 7: None}
    assert got.count() == 7 and "NestedLoop" not in _plan(got)


def test_hot_keys_are_bounded_and_sized(spark):
    fact = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 3000).cast("string")).alias("k"),
        F.lit(None).cast("string").alias("none"),
    )
    assert joins.hot_keys(fact, {"k": "k", "none": "none"}, width=90) == {"k": [("hot", 30)], "none": []}
    assert joins.hot_keys(fact, {"k": "k"}) == {"k": [("hot", 2)]}  # a third of the rows, 8 partitions
    assert joins.hot_keys(fact.limit(0), {"k": "k"}) == {"k": []}


@pytest.fixture()
def shuffled_joins(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in names:
        spark.conf.set(k, "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    for k in names:
        spark.conf.unset(k)


def test_hot_key_is_sliced_and_the_result_stays_whole(spark, folder, shuffled_joins):
    """A key with a third of all rows, joined by shuffle, ends up in many partitions."""
    fact = spark.range(0, 60000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.lit("2024-01-03").cast("timestamp").alias("at"),
    )
    dim = fact.select("k").distinct().select(
        "k",
        F.lit(1).alias("v"),
        F.lit("2024-01-01").cast("timestamp").alias("effective_valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )
    hot = joins.hot_keys(fact, {"k": "k"}, width=90)["k"]
    for name, got in {
        "asof": joins.asof_join(fact, dim, "k", "k", "at", ["v"], hot=hot),
        "lookup": joins.lookup_join(fact, dim, "k", "k", ["v"], hot=hot),
    }.items():
        got.withColumn("part", F.spark_partition_id()).write.parquet(f"{folder}/{name}")
        joined = spark.read.parquet(f"{folder}/{name}")
        rows_hot = joined.filter("k = 'hot' and v = 1")
        assert joined.count() == 60000 and joined.select("id").distinct().count() == 60000
        assert joined.filter("v is null").count() == 0
        sizes = [r["count"] for r in rows_hot.groupBy("part").count().collect()]
        assert sum(sizes) == 20000 and len(sizes) == 8 and max(sizes) < 10000


def test_orphans_null_handling(spark):
    child = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, fk string")
    parent = spark.createDataFrame([("a",), (None,)], "pk string")
    assert sorted(r.id for r in joins.orphans(child, parent, "fk", "pk").collect()) == [2, 3]
    assert [r.id for r in joins.orphans(child, parent, "fk", "pk", keep_null=False).collect()] == [2]


def test_mismatch_ignores_null(spark):
    left = spark.createDataFrame([(1, "a", "h1"), (2, "a", "h2"), (3, "a", None)], "id int, l string, h string")
    right = spark.createDataFrame([("a", "h1")], "l string, h string")
    assert [r.id for r in joins.mismatches(left, right, "l", "h", "h").collect()] == [2]


def test_asof_rows_do_not_multiply_with_versions(spark, shuffled_joins):
    """1000 versions of one key: the plan has no join in which each fact would meet them all."""
    dim = spark.range(1000).select(
        F.lit("hot").alias("k"),
        F.col("id").alias("v"),
        F.timestamp_seconds(F.col("id") * 60).alias("valid_from"),
        F.timestamp_seconds(F.col("id") * 60 + 60).alias("valid_to"),
    )
    fact = spark.range(30000).select("id", F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 2).alias("at"))
    got = joins.asof_join(fact, dim, "k", "k", "at", ["v"], "valid_from", hot=[("hot", 8)])
    assert got.filter(F.col("v") == F.floor(F.col("id") / 30)).count() == 30000
    plan = _plan(got)
    assert "SortMergeJoin" not in plan and "HashJoin [k" not in plan and "Window" in plan


def test_asof_of_malformed_versions(spark):
    dim = spark.sql(
        """select * from values ('x', 1, timestamp '2024-01-01', timestamp '2024-03-01'),
        ('x', 2, timestamp '2024-02-01', timestamp '2024-02-10'), ('x', 3, timestamp '2024-02-05', timestamp '2024-02-05'),
        ('x', 4, timestamp '2024-02-01', timestamp '2024-02-03'), (null, 5, timestamp '2024-01-01', null) as t(k, v, s, e)"""
    )
    fact = spark.sql(
        """select * from values (1, 'x', date '2024-02-02'), (2, 'x', date '2024-02-07'), (3, 'x', date '2024-02-20'),
        (4, null, date '2024-02-20'), (5, 'x', date '2024-02-05') as t(id, k, at)"""
    )
    got = joins.asof_join(fact, dim, "k", "k", "at", ["v"], "s", "e")
    # of overlapping versions the one begun last decides, and none holds after its end
    assert {r.id: r.v for r in got.collect()} == {1: 2, 2: 2, 3: None, 4: None, 5: 2}


def test_orphans_and_mismatches_cut_hot_keys(spark, folder, shuffled_joins):
    child = spark.range(0, 60000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.lit("h").alias("h")
    )
    parent = spark.range(100).select(F.concat(F.lit("p"), "id").alias("k"), F.lit("other").alias("h"))
    hot = joins.hot_keys(child, {"k": "k"}, width=90)["k"]
    known = parent.union(spark.createDataFrame([("hot", "g")], "k string, h string"))
    assert joins.orphans(child, known, "k", "k", hot=hot).count() == 40000
    found = joins.orphans(child, parent, "k", "k", hot=hot)
    differ = joins.mismatches(child, known, "k", "h", "h", hot=hot)
    for name, got, rows in (("orphans", found, 60000), ("mismatches", differ, 20000)):
        got.withColumn("part", F.spark_partition_id()).write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        sizes = [r["count"] for r in out.filter("k = 'hot'").groupBy("part").count().collect()]
        assert out.count() == rows and sum(sizes) == 20000 and len(sizes) == 8 and max(sizes) < 10000
