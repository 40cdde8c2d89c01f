"""Plan shape of every query: no nested loops over data, no Python, no wide scans."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemark.workload.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")

# one-row counts beside each other
ONE_ROW_CROSS = {"reconcile", "dq_report"}
# these run jobs while they are built; their result is a plain table scan
EAGER = {"land_scan", "land_prune", "raw_lineage", "bad_records", "incr_sink", "stream_ingest", "stream_upsert", "raw_incremental", "load_history"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_nested_loop_and_no_python(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    if name not in ONE_ROW_CROSS:
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert not re.search(r"Python|Pandas|Arrow", plan)


def test_session_rollup_shuffles_once(spark):
    plan = plan_of(contract.queries()["session_rollup"](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_min" in plan


def test_scans_read_only_what_is_asked(spark):
    plan = plan_of(contract.queries()["dup_keys"](spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


def test_filters_reach_the_scan(spark):
    plan = plan_of(contract.queries()["predicates"](spark, SF_DIR))
    assert re.search(r"PushedFilters: .*StringCon", plan)


def test_feeds_are_read_in_splits_that_sort_in_memory(spark, folder):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "128m")
        QUERIES["bronze_reviews"](spark, SF_DIR)
        assert spark.conf.get(name) == "8m"
    finally:
        spark.conf.set(name, before)


def test_widest_join_of_a_fact_comes_last(spark, monkeypatch):
    from tidemark.plans import gold

    called = []
    for name in ("lookup_join", "role_join", "current_join", "date_join"):
        join = getattr(gold, name)
        monkeypatch.setattr(gold, name, lambda *a, join=join, name=name, **k: (called.append(name), join(*a, **k))[1])
    rows = spark.sql(
        "select 'r' as review_id, 'b' as booking_id_clean, 'l' as listing_id, 'x' as reviewer_id, 'y' as reviewee_id, "
        "'guest_to_host' as review_type, true as is_public, timestamp '2024-01-01' as reviewed_at, 't' as review_text, "
        "'u' as response_text, " + ", ".join(f"1d as {r}" for r in gold.RATINGS)
    )
    listings = spark.sql(
        "select 'l' as listing_id, true as is_current_record, 'k' as listing_key, 'n' as listing_name, 'a' as room_type, "
        "'h' as neighborhood, 'c' as city"
    )
    hosts = spark.sql("select 'y' as host_id, true as is_current_record, 'hk' as host_key")
    guests = spark.sql("select 'x' as guest_id, 'gk' as guest_key")
    days = spark.sql("select date '2024-01-01' as full_date, 20240101 as date_key")
    fact = spark.sql("select 'b' as booking_id_clean, 'bk' as booking_key")
    out = gold.fct_reviews(rows, fact, listings, hosts, guests, days)
    assert out.select("listing_key", "host_key", "guest_key", "booking_key", "city").first() == ("k", "hk", "gk", "bk", "c")
    assert called == ["lookup_join", "role_join", "role_join", "current_join", "date_join"]


def test_feed_rows_are_dealt_evenly_however_few_row_groups_hold_them(spark, folder, monkeypatch):
    from tidemark.workload import adapters

    monkeypatch.setattr(adapters, "FEED_ROWS", 100)
    spark.sql(
        "select id as p_partkey, 'red blue' as p_name, 'b' as p_brand, 't' as p_type, cast(id % 9 as int) as p_size, "
        "cast(id as double) as p_retailprice from range(0, 950, 1, 1)"
    ).write.parquet(f"{folder}/part.parquet")
    spark.range(3).withColumnRenamed("id", "s_suppkey").write.parquet(f"{folder}/supplier.parquet")
    source = adapters.Source(spark, folder)
    feed = source.raw("listings", (0,))
    sizes = [r["n"] for r in feed.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 10 and sum(sizes) == 950 and max(sizes) < 200
    assert feed.select("listing_id").distinct().count() == 950
    assert "Exchange" not in plan_of(source.sql("select * from part"))
