"""Named queries and the DuckDB statements they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.session import tune_feeds
from tidemark.workload.adapters import Source

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Comparable columns: decimals as doubles, lists as JSON text."""
    out = []
    for f in df.schema:
        col = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            col = col.cast("double").alias(f.name)
        elif isinstance(f.dataType, T.ArrayType):
            col = F.to_json(col).alias(f.name)
        elif isinstance(f.dataType, T.TimestampNTZType):
            col = col.cast("timestamp").alias(f.name)
        out.append(col)
    return df.select(*out)


def query(name: str, oracle: str | None = None):
    """Register ``fn(source)`` under ``name``."""

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(Source(tune_feeds(spark), sf_dir)))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap
