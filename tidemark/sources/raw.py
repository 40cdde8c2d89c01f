"""RAW: every landed file once, as it was written, with its load time and its log.

One function appends a parsed batch, streamed or not: good rows to
``raw_<entity>`` by load date, unreadable lines to ``raw_bad``, and one row per
file to ``load_log``. The load time is stamped once, when the file is appended, so
reading again shows the same time, and incremental readers skip whole dates.

A load is stamped when it begins and logged when all its rows are stored, so two
loads may be logged in another order than their stamps tell. Readers therefore
remember which loads they have taken (:meth:`RawStore.pending`), not a time.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.audit import freshness_by, load_audit, load_log
from tidemark.session import path_exists, scratch
from tidemark.sources.landing import CORRUPT
from tidemark.sources.schemas import raw_schema

LOG_SCHEMA = (
    "file_name string, last_load_time timestamp, row_count long, error_count long, status string, "
    "load_date date, entity string, load string"
)
LOAD_SCHEMA = "load_date date, load string"
BAD_SCHEMA = "_source_file string, _loaded_at timestamp, _corrupt_record string, load_date date, entity string, load string"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint: another one for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


class RawStore:
    """RAW tables below ``root``; ``schemas`` overrides the columns of the known entities."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = schemas or {}

    def _columns(self, entity: str) -> T.StructType:
        return self.schemas.get(entity) or raw_schema(entity)

    def append(self, entity: str, landed: DataFrame, load_id: str) -> DataFrame:
        """Add the files of ``landed`` that no other load has logged; returns their good rows.

        ``load_id`` names one batch of one stream: the same batch once more
        replaces itself.
        """
        logged = self._stored("load_log", LOG_SCHEMA).filter(
            (F.col("entity") == entity) & (F.col("load") != load_id)
        )
        known = logged.select(F.col("file_name").alias("_source_file")).distinct()
        fresh = landed.join(known, "_source_file", "left_anti")
        good = fresh.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
        marks = {"load_date": F.to_date("_loaded_at"), "load": F.lit(load_id)}
        columns = [f.name for f in self._columns(entity)]
        rows = good.select(*columns, "_source_file", "_loaded_at").withColumns(marks)
        self._write(rows, f"raw_{entity}", ["load_date", "load"])
        named = {"load_date": marks["load_date"], "entity": F.lit(entity), "load": F.lit(load_id)}
        bad = fresh.filter(F.col(CORRUPT).isNotNull()).select("_source_file", "_loaded_at", CORRUPT)
        self._write(bad.withColumns(named), "raw_bad", ["load_date", "entity", "load"])
        # the log comes last: what it names is stored
        log = load_log(fresh, 0).drop("batch_id")
        named["load_date"] = F.to_date("last_load_time")
        self._write(log.withColumns(named), "load_log", ["load_date", "entity", "load"])
        return good

    def _write(self, df: DataFrame, name: str, parts: list[str]) -> None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*parts).parquet(f"{self.root}/{name}")

    def _stored(self, name: str, schema: str | T.StructType) -> DataFrame:
        path = f"{self.root}/{name}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def exists(self, entity: str) -> bool:
        return path_exists(self.spark, f"{self.root}/raw_{entity}")

    def read(
        self, entity: str, mark: datetime | None = None, loads: DataFrame | None = None
    ) -> DataFrame:
        """The rows of ``entity``, from ``mark`` on or of ``loads``; earlier load dates are not listed."""
        fields = [*self._columns(entity).fields, T.StructField("_source_file", T.StringType())]
        fields += [T.StructField("_loaded_at", T.TimestampType()), T.StructField("load_date", T.DateType())]
        rows = self._stored(f"raw_{entity}", T.StructType([*fields, T.StructField("load", T.StringType())]))
        if mark is not None:
            since = F.lit(mark).cast("timestamp")
            rows = rows.filter((F.col("load_date") >= F.to_date(since)) & (F.col("_loaded_at") >= since))
        if loads is not None:
            first = loads.agg(F.min("load_date")).first()[0]
            rows = rows.filter(F.col("load_date") >= F.lit(first).cast("date"))
            rows = rows.join(loads.select("load_date", "load"), ["load_date", "load"], "left_semi")
        return rows.drop("load_date", "load")

    def loads(self, entity: str) -> DataFrame:
        """(load_date, load, stamped) of every load of ``entity`` that the log names."""
        mine = self.log().filter(F.col("entity") == entity)
        return mine.groupBy("load_date", "load").agg(F.min("last_load_time").alias("stamped"))

    def pending(self, entity: str, reader: str) -> DataFrame:
        """The loads of ``entity`` that ``reader`` has not taken.

        Stored, so that a load which is logged meanwhile is not taken for read.
        """
        taken = self._stored(f"taken/{reader}", LOAD_SCHEMA)
        new = self.loads(entity).join(taken, ["load_date", "load"], "left_anti")
        path = scratch(self.spark, "pending")
        new.write.parquet(path)
        return self.spark.read.schema(new.schema).parquet(path)

    def take(self, reader: str, loads: DataFrame) -> None:
        """Remember that ``reader`` has stored the rows of ``loads``; call it after they are."""
        rows = loads.select("load_date", "load").coalesce(1)
        rows.write.mode("append").parquet(f"{self.root}/taken/{reader}")

    def bad_lines(self) -> DataFrame:
        return self._stored("raw_bad", BAD_SCHEMA)

    def log(self) -> DataFrame:
        return self._stored("load_log", LOG_SCHEMA)

    # ---- reports over what is stored -----------------------------------------
    def freshness(self, as_of, **limits) -> DataFrame:
        """Age and status of every source that was ever loaded."""
        return freshness_by(self.log(), "entity", as_of, "last_load_time", **limits)

    def row_counts(self) -> DataFrame:
        """(table_name, row_count) of the RAW tables, from the log: no table is read."""
        good = F.sum(F.col("row_count") - F.col("error_count"))
        return self.log().groupBy(F.concat(F.lit("raw_"), "entity").alias("table_name")).agg(
            good.alias("row_count")
        )

    def audit(self, since, loaded_too: bool = False) -> DataFrame:
        return load_audit(self.log(), since, loaded_too)
