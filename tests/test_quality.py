"""Checks, the report and the gate."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as q
from tidemark.operators.audit import freshness
from tidemark.operators.shape import project_from_config, quarantine
from tidemark.plans.checks import all_checks


def tables(spark):
    return {
        "child": spark.createDataFrame([(1, "a", 1), (1, "b", 9), (None, None, 1), (2, "z", None)], "id int, fk string, n int"),
        "parent": spark.createDataFrame([("a",), ("b",)], "fk string"),
    }


def test_report_counts_exactly_the_planted_violations(spark):
    checks = [
        q.not_null("child", "id"),
        q.unique("child", "id"),
        q.accepted("child", "n", (1, 2)),
        q.fk("child", "fk", "parent", "fk"),
        q.rule("n_small", "child", F.col("n") > 5),
        q.unique("parent", "fk"),
    ]
    report = q.run_checks(checks, tables(spark))
    assert {r.check_name: r.violations for r in report.collect()} == {
        "not_null_child_id": 1,
        "unique_child_id": 1,
        "accepted_values_child_n": 1,
        "relationships_child_fk_parent": 1,
        "n_small": 1,
        "unique_parent_fk": 0,
    }
    with pytest.raises(q.QualityError, match="not_null_child_id=1"):
        q.gate(report)
    q.gate(report.filter("violations = 0"))


def test_row_checks_of_a_table_share_one_scan(spark, folder):
    spark.range(5).write.parquet(f"{folder}/t")
    t = {"t": spark.read.parquet(f"{folder}/t")}
    report = q.run_checks([q.not_null("t", "id"), q.rule("big", "t", F.col("id") > 3), q.accepted("t", "id", (0, 1))], t)
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_94_checks_with_distinct_names():
    layers = all_checks()
    assert {k: len(v) for k, v in layers.items()} == {"bronze": 14, "silver": 44, "gold": 36}
    assert len({c.name for v in layers.values() for c in v}) == 94


def test_e164_and_ranges(spark):
    df = spark.createDataFrame([("+16175551234", 5.0), ("+1617555123", 5.1), (None, None), ("16175551234", -0.1)], "p string, r double")
    assert df.filter(q.not_e164(F.col("p"))).count() == 2
    assert df.filter(q.out_of_range(["r"], 0, 5)).count() == 2


def test_quarantine_splits_without_loss(spark):
    df = spark.createDataFrame([(1, True), (2, None), (3, False)], "id int, bad boolean")
    clean, bad = quarantine(df, F.col("bad"), [(F.col("id") > 5, "high")], default="other")
    assert [r.id for r in clean.collect()] == [2, 3] and [r.quarantine_reason for r in bad.collect()] == ["other"]


def test_configured_projection_is_validated(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert project_from_config(df, ["b", "a"]).columns == ["b", "a"]
    for names in (["a", "zz"], ["a", "a"]):
        with pytest.raises(ValueError):
            project_from_config(df, names)


def test_freshness_states(spark):
    def at(ts):
        return spark.sql(f"select cast({ts} as timestamp) as _loaded_at")

    got = freshness(
        {"a": at("'2024-01-01 11:00:00'"), "b": at("'2024-01-01 09:00:00'"), "c": at("'2024-01-01 01:00:00'"), "d": at("null")},
        "2024-01-01 12:00:00",
    )
    assert {r.source_name: r.status for r in got.collect()} == {"a": "pass", "b": "warn", "c": "error", "d": "error"}
