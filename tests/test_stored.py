"""What stored models leave on disk."""

import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.session import shuffles_dropped
from tidemark.workload import models


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    files = manager.diskBlockManager().getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def left_of(spark, before):
    """New shuffle files, once those that are being deleted are gone."""
    for _ in range(40):
        new = shuffle_files(spark) - before
        if not new:
            break
        time.sleep(0.25)
    return new


def test_stored_model_leaves_no_shuffle_files(spark, folder):
    src = SimpleNamespace(spark=spark, sf_dir=folder)
    rows = spark.range(20_000).select((F.col("id") % 5_000).alias("k"), F.col("id").cast("string").alias("v"))
    before = shuffle_files(spark)
    made = models.stored(src, "left_on_disk", lambda: rows.groupBy("k").agg(F.max("v").alias("v")).repartition(4, "v"))
    assert not left_of(spark, before)
    assert made.count() == 5_000
    assert made.filter("k = 7").first().v == "7"  # the greatest text of 7, 5007, 10007, 15007


def test_hot_keys_leave_no_shuffle_files(spark, folder):
    src = SimpleNamespace(spark=spark, sf_dir=folder)
    events = spark.range(1_000).select(
        F.concat(F.lit("l"), (F.col("id") % 3).cast("string")).alias("listing_id"),
        F.concat(F.lit("g"), F.col("id").cast("string")).alias("guest_id"),
    )
    before = shuffle_files(spark)
    hot = models._hot(src, models.gold.event_hot_keys, events)
    assert {k for k, _ in hot["listing_id"]} == {"l0", "l1", "l2"} and hot["guest_id"] == []
    assert not left_of(spark, before)


def test_setting_is_put_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
        raise RuntimeError
    assert spark.conf.get(name) == before
