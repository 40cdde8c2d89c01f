"""What a layer took in, run by run: the next layer reads this instead of whole tables.

Rows are stored by load date and by the run that took them in. Runs are numbered as
they commit, so a reader remembers the last run it has seen and lists only the folders
of later ones, whatever load times their rows bear. The rows of a run replace
themselves when the run is repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.latest import keep_latest
from tidemark.session import path_exists


class ChangeLog:
    """Change tables below ``root``, one per model."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def append(self, model: str, rows: DataFrame, run: int) -> DataFrame:
        """Store the rows of ``run``; returns them as stored, so that their plan runs once."""
        marked = rows.withColumns({"_load_date": F.to_date("_loaded_at"), "_run": F.lit(run).cast("long")})
        writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("_load_date", "_run").parquet(f"{self.root}/{model}")
        return self._stored(model, rows.schema).filter(F.col("_run") == run).select(*rows.columns)

    def _stored(self, model: str, schema: T.StructType) -> DataFrame:
        parts = [T.StructField("_load_date", T.DateType()), T.StructField("_run", T.LongType())]
        path = f"{self.root}/{model}"
        if not path_exists(self.spark, path):  # an empty first run writes no file
            return self.spark.createDataFrame([], T.StructType([*schema.fields, *parts]))
        return self.spark.read.schema(T.StructType([*schema.fields, *parts])).parquet(path)

    def exists(self, model: str) -> bool:
        return path_exists(self.spark, f"{self.root}/{model}")

    def after(
        self, model: str, schema: T.StructType, keys: Sequence[str], seen: int, upto: int
    ) -> DataFrame:
        """Rows of the runs above ``seen`` up to ``upto``, per key those of the last run."""
        rows = self._stored(model, schema)
        new = rows.filter((F.col("_run") > F.lit(seen)) & (F.col("_run") <= F.lit(upto)))
        return keep_latest(new, keys, ["_run"]).select(*schema.names)

    def seen(self, reader: str) -> int | None:
        """The last run that ``reader`` has stored, None when it is not known."""
        path = f"{self.root}/_seen/{reader}"
        if not path_exists(self.spark, path):
            return None
        return self.spark.read.schema("run long").parquet(path).agg(F.max("run")).first()[0]

    def saw(self, reader: str, run: int) -> None:
        """Remember ``run``. A crash in here forgets it: the reader then reads all again."""
        mark = self.spark.range(1).select(F.lit(run).cast("long").alias("run"))
        mark.write.mode("overwrite").parquet(f"{self.root}/_seen/{reader}")
