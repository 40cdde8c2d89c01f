"""Keep-latest: order, ties, hot keys, and reading above a mark."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators.latest import high_water, keep_latest, since
from tidemark.plans import layers
from tidemark.sources.schemas import RAW_COLUMNS as COLUMNS


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_null_order_value_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), ("b", 1, "p"), ("b", 2, "q")], "k string, t int, v string")
    got = {r.k: r.v for r in keep_latest(df, ["k"], ["t"]).collect()}
    assert got == {"a": "y", "b": "q"}


def test_result_is_independent_of_order_and_partitioning(spark):
    base = spark.range(3000).select(
        (F.col("id") % 50).alias("k"), (F.col("id") % 7).alias("t"), F.sha1(F.col("id").cast("string")).alias("v")
    )
    want = None
    for n, seed in ((1, 1), (5, 2), (13, 3)):
        df = base.repartition(n, F.rand(seed)).sortWithinPartitions(F.rand(seed))
        got = sorted(map(tuple, keep_latest(df, ["k"], ["t"]).collect()))
        assert want is None or got == want
        want = got
    assert len(want) == 50


def test_null_key_keeps_one_row(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k string, t int")
    assert keep_latest(df, ["k"], ["t"]).count() == 2


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") < 0).alias("k"), F.col("id").alias("t"))
    plan = _plan(keep_latest(df, ["k"], ["t"]))
    # printed top down: final limit, exchange, partial limit
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index(", Final") < plan.index("Exchange hashpartitioning") < plan.index(", Partial")


def test_since_filters_by_literal_and_rereads_boundary(spark, folder):
    path = f"{folder}/t"
    spark.sql("select explode(sequence(timestamp '2024-01-01', timestamp '2024-01-10', interval 1 day)) as t").write.parquet(path)
    df = spark.read.parquet(path)
    mark = high_water(df.filter("t <= timestamp '2024-01-05'"), "t", datetime(2000, 1, 1, tzinfo=timezone.utc))
    assert mark == datetime(2024, 1, 5, tzinfo=timezone.utc)
    newer = since(df, "t", mark)
    assert newer.count() == 6
    assert "PushedFilters: [IsNotNull(t), GreaterThanOrEqual(t,2024-01-05" in _plan(newer)


def test_high_water_default(spark):
    default = datetime(2000, 1, 1, tzinfo=timezone.utc)
    empty = spark.sql("select current_timestamp() as t where false")
    assert high_water(empty, "t", default) == default and high_water(None, "t", default) == default


@pytest.mark.parametrize("entity", sorted(layers.SILVER))
def test_silver_of_raw_is_silver_of_bronze_for_one_shuffle(spark, entity):
    key = layers.BRONZE[entity].keys[0]
    number = F.col("id")
    # spellings of a key, rows that tie in all times, and rows without key
    spelled = F.element_at(F.array(*map(F.lit, ("A-1", "a1", "BKG-1", "bkg_1", "A-2"))), (number % 5 + 1).cast("int"))
    names = [*COLUMNS[entity], *layers.LINEAGE]
    values = {x: F.concat(F.lit("1"), (F.hash("id", F.lit(x)) % 3).cast("string")) for x in names}
    values |= {
        key: F.when(number % 7 > 0, spelled),
        "calendar_date": F.when(number % 11 > 0, F.lit("2024-01-02")),
        "updated_at": F.when(number % 4 > 0, F.lit("2024-01-03T00:00:00Z")),
        "_stream_timestamp": F.when(number % 3 > 0, F.lit("2024-01-03T00:00:00Z")),
        "_loaded_at": F.timestamp_seconds(F.lit(1700000000) + number % 2),
    }
    raw = spark.range(400, numPartitions=5).select(*[values[x].alias(x) for x in names])
    got = layers.silver_of_raw(entity, raw)
    want = layers.silver(entity, layers.bronze(entity, raw))
    assert _plan(got).count("Exchange") == 1 < _plan(want).count("Exchange")
    assert got.schema == want.schema
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
