"""Operational reports: freshness, row counts, load log, previews."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.shape import union_all


def _instant(ts: str | datetime | Column) -> Column:
    return ts if isinstance(ts, Column) else F.lit(ts).cast("timestamp")


def freshness(
    sources: Mapping[str, DataFrame],
    as_of: str | datetime | Column,
    mark_col: str = "_loaded_at",
    warn_hours: int = 2,
    error_hours: int = 8,
) -> DataFrame:
    """Per source: newest load, age in seconds at ``as_of``, pass / warn / error."""
    rows = [
        df.agg(F.max(F.col(mark_col).cast("timestamp")).alias("max_loaded_at")).select(
            F.lit(name).alias("source_name"), "max_loaded_at"
        )
        for name, df in sources.items()
    ]
    return _aged(union_all(rows), as_of, warn_hours, error_hours)


def freshness_by(
    loads: DataFrame,
    name_col: str,
    as_of: str | datetime | Column,
    mark_col: str = "_loaded_at",
    warn_hours: int = 2,
    error_hours: int = 8,
) -> DataFrame:
    """:func:`freshness` of every name that ``loads`` holds, from one grouping."""
    newest = loads.groupBy(F.col(name_col).alias("source_name")).agg(
        F.max(F.col(mark_col).cast("timestamp")).alias("max_loaded_at")
    )
    return _aged(newest, as_of, warn_hours, error_hours)


def _aged(newest: DataFrame, as_of, warn_hours: int, error_hours: int) -> DataFrame:
    age = F.unix_timestamp(_instant(as_of)) - F.unix_timestamp("max_loaded_at")
    status = (
        F.when(F.col("age_seconds").isNull() | (F.col("age_seconds") > error_hours * 3600), "error")
        .when(F.col("age_seconds") > warn_hours * 3600, "warn")
        .otherwise("pass")
    )
    return newest.withColumn("age_seconds", age).withColumn("status", status)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every table, in name order."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return union_all(rows).orderBy("table_name")


def load_log(
    landed: DataFrame,
    batch_id: int,
    file_col: str = "_source_file",
    bad_col: str = "_corrupt_record",
    time_col: str = "_loaded_at",
) -> DataFrame:
    """One row per loaded file: rows, unreadable rows, status."""
    bad = F.count_if(F.col(bad_col).isNotNull())
    return (
        landed.groupBy(F.col(file_col).alias("file_name"))
        .agg(
            F.max(time_col).alias("last_load_time"),
            F.count(F.lit(1)).alias("row_count"),
            bad.alias("error_count"),
        )
        .withColumn("batch_id", F.lit(batch_id))
        .withColumn(
            "status",
            F.when(F.col("error_count") == 0, "Loaded")
            .when(F.col("error_count") < F.col("row_count"), "Partially loaded")
            .otherwise("Load failed"),
        )
    )


def load_audit(log: DataFrame, since: str | datetime | Column, loaded_too: bool = False) -> DataFrame:
    """Log rows of the trailing window, newest first; by default only the troubled."""
    recent = log.filter(F.col("last_load_time") >= _instant(since))
    if not loaded_too:
        recent = recent.filter(F.col("status") != "Loaded")
    return recent.orderBy(F.col("last_load_time").desc(), "file_name")


def preview(df: DataFrame, cols: Sequence[str | Column], order: Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` rows by ``order``: planned as a distributed top-n."""
    return df.orderBy(*order).select(*cols).limit(n)
