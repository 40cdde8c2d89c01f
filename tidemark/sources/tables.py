"""Parquet tables published version by version.

A publish writes new files beside the old ones and then moves one small manifest
into place that says which folder holds each part. Readers follow the newest
manifest, so they never see half a write, and a plan may read the table it
replaces. Parts are hash buckets of the key, values of a given column such as a
month (``part_by``), or the open and closed versions of a history
(:meth:`PublishedTable.roll`). A merge rewrites the parts its batch touches: with
``part_by`` those of the batch's own rows and of the stored rows they replace, so a
batch of one day leaves all other days alone. A part remembers the schema it was
written with and is cast when it is read.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.latest import high_water
from tidemark.operators.merge import merge_upsert, require_unique
from tidemark.operators.shape import schema_changes

_BUCKET = "_bucket"


class ConcurrentPublish(RuntimeError):
    """Another writer published the same version first."""


class PublishedTable:
    """One table below ``path``; ``keys`` make it mergeable."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str] = (),
        buckets: int = 64,
        mark_col: str | None = None,
        part_by: Column | None = None,
    ):
        self.part_by = part_by
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.buckets = buckets
        self.mark_col = mark_col
        jvm = spark.sparkContext._jvm
        self._hadoop_path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._hadoop_path(self.path).getFileSystem(conf)

    # ---- reading ------------------------------------------------------------
    def _manifest_versions(self) -> list[int]:
        folder = self._hadoop_path(f"{self.path}/_manifests")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self) -> dict | None:
        """The newest manifest, or None before the first publish."""
        for version in reversed(self._manifest_versions()):
            try:
                return self._load(version)
            except ValueError:  # still being written: the one before holds
                continue
        return None

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/_manifests/{version:010d}.json"

    def _load(self, version: int) -> dict:
        stream = self._fs.open(self._hadoop_path(self._manifest_path(version)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()

    def exists(self) -> bool:
        return self.manifest() is not None

    def next_version(self) -> int:
        """Above every version on disk, also one that a crash left torn."""
        return max(self._manifest_versions(), default=0) + 1

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Current contents, or those of some key buckets; None before the first publish."""
        now = self.manifest()
        return None if now is None else self._frame(now, buckets)

    def _frame(self, now: dict, buckets: Sequence[int] | None) -> DataFrame:
        schema = T.StructType.fromJson(now["schema"])
        parts = [p for p in now["parts"] if buckets is None or p in {str(b) for b in buckets}]
        written: dict[str, list[str]] = {}  # parts of one schema are one scan
        for p in parts:
            own = now.get("older", {}).get(p, now["schema"])
            written.setdefault(json.dumps(own), []).append(f"{self.path}/{now['parts'][p]}")
        if not written:
            return self.spark.createDataFrame([], schema)
        frames = []
        for own, folders in written.items():
            df = self.spark.read.schema(T.StructType.fromJson(json.loads(own))).parquet(*folders)
            frames.append(df if len(written) == 1 and df.schema == schema else _cast(df, schema))
        return reduce(DataFrame.unionAll, frames)

    def high_water(self, default: datetime) -> datetime:
        """Greatest ``mark_col`` ever published, from the manifest alone."""
        now = self.manifest()
        if now is None or now.get("mark") is None:
            return default
        return datetime.fromisoformat(now["mark"])

    # ---- writing ------------------------------------------------------------
    def overwrite(self, df: DataFrame, batch_id: int | None = None, source: str = "") -> bool:
        """Publish ``df`` as the whole table. False when the batch was published before."""
        now = self.manifest()
        if self._already(now, batch_id, source):
            return False
        self._publish(df, now, {}, batch_id, source)
        return True

    def roll(self, step, open_when: Column) -> None:
        """Apply ``step`` to the open rows alone and add what it closes.

        ``step`` gets the open rows (None before the first publish) and returns
        rows of which ``open_when`` stay open. Closed parts are neither read nor
        written again.
        """
        now = self.manifest()
        before = None if now is None else self._frame(now, ["open"])
        version = self.next_version()
        part = F.when(open_when, F.lit("open")).otherwise(F.lit(f"closed{version}"))
        kept = {b: p for b, p in (now or {"parts": {}})["parts"].items() if b != "open"}
        self._publish(step(before), now, kept, None, part=part)

    def merge(
        self,
        batch: DataFrame,
        batch_id: int | None = None,
        order_guard: str | None = None,
        source: str = "",
    ) -> bool:
        """Upsert ``batch`` by key. False when ``source`` published that batch before.

        Batches are counted per source (a stream's own id), so a new checkpoint
        begins a count of its own; a gap in a count raises.
        """
        now = self.manifest()
        if self._already(now, batch_id, source):
            return False
        if now is None:
            self._publish(batch, None, {}, batch_id, source, verify=True)
            return True
        # The batch is written once: its plan is not run again for the key check,
        # the list of touched buckets and the merge.
        staged_at = f"{self.path}/_staging/{_token(self.spark)}"
        try:
            batch.write.parquet(staged_at)
            staged = self.spark.read.schema(batch.schema).parquet(staged_at)
            require_unique(staged, self.keys)
            # at most `buckets` small integers, or the values of `part_by` in the batch
            touched = staged.select(self._bucket_of().alias("p"))
            if self.part_by is not None:
                stored = self._frame(now, None).select(*self.keys, self._bucket_of().alias("p"))
                touched = touched.union(stored.join(staged.select(*self.keys), self.keys, "left_semi").select("p"))
            touched = sorted(str(r[0]) for r in touched.distinct().collect())
            change = schema_changes(self._frame(now, []), staged)
            # a part that is kept would bring a removed column back when it is added again
            if change["retyped"] or change["removed"] or now["buckets"] != self.buckets:
                touched, kept = None, {}
            else:
                kept = {b: p for b, p in now["parts"].items() if b not in set(touched)}
            merged = merge_upsert(self._frame(now, touched), staged, self.keys, order_guard)
            self._publish(merged, now, kept, batch_id, source)
        finally:
            self._fs.delete(self._hadoop_path(staged_at), True)
        return True

    def vacuum(self, keep: int = 2) -> int:
        """Delete version folders that none of the last ``keep`` manifests use."""
        versions, whole = self._manifest_versions(), {}
        for v in reversed(versions):
            try:
                whole[v] = self._load(v)["parts"]
            except ValueError:  # torn by a crash
                continue
            if len(whole) == keep:
                break
        used = {part.rsplit("/", 1)[0] for parts in whole.values() for part in parts.values()}
        newest = max((p.split("/", 1)[1] for p in used), default="")
        removed = 0
        data = self._hadoop_path(f"{self.path}/data")
        for status in self._fs.listStatus(data) if self._fs.exists(data) else []:
            name = status.getPath().getName()
            # folders newer than every used one may belong to a running publish
            if f"data/{name}" not in used and name < newest:
                removed += bool(self._fs.delete(status.getPath(), True))
        for v in [v for v in versions if v < min(whole, default=0)]:
            self._fs.delete(self._hadoop_path(self._manifest_path(v)), False)
        return removed

    def has_batch(self, batch_id: int | None, source: str = "") -> bool:
        """Whether ``source`` published that batch before."""
        return self._already(self.manifest(), batch_id, source)

    def _already(self, now: dict | None, batch_id: int | None, source: str) -> bool:
        last = (now or {}).get("batches", {}).get(source)
        if batch_id is None or last is None:
            return False
        if batch_id > last + 1:
            raise ValueError(f"batch {batch_id} of {source or 'the feed'} follows batch {last}")
        return batch_id <= last

    def _bucket_of(self):
        if self.part_by is not None:
            return F.coalesce(self.part_by.cast("string"), F.lit("none"))
        if not self.keys:
            return F.lit(0)
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _publish(
        self,
        df: DataFrame,
        now: dict | None,
        kept: dict,
        batch_id: int | None,
        source: str = "",
        verify: bool = False,
        part: Column | None = None,
    ) -> None:
        version = self.next_version()
        folder = f"data/v{version:010d}-{_token(self.spark)}"
        # A rebalance evens out file sizes: small buckets share tasks, a large
        # bucket is divided over several.
        out = df.withColumn(_BUCKET, self._bucket_of() if part is None else part)
        if part is not None or self.keys or self.part_by is not None:
            out = out.hint("rebalance", F.col(_BUCKET))
        out.write.mode("error").partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        if verify:
            stored = self.spark.read.schema(df.schema).parquet(f"{self.path}/{folder}")
            require_unique(stored, self.keys)
        written = self._hadoop_path(f"{self.path}/{folder}")
        names = [s.getPath().getName() for s in self._fs.listStatus(written)]
        parts = dict(kept)
        for name in names:
            if name.startswith(f"{_BUCKET}="):
                parts[name.split("=", 1)[1]] = f"{folder}/{name}"
        record = {
            "version": version,
            "buckets": self.buckets,
            "parts": parts,
            "schema": df.schema.jsonValue(),
            "older": self._older(now, kept, df.schema.jsonValue()),
            "batches": {
                **(now or {}).get("batches", {}),
                **({source: batch_id} if batch_id is not None else {}),
            },
            "mark": self._mark(f"{self.path}/{folder}", df.schema, now),
        }
        self._commit(version, json.dumps(record))

    def _mark(self, folder: str, schema: T.StructType, now: dict | None) -> str | None:
        if self.mark_col is None:
            return None
        default = datetime.fromisoformat("0001-01-02T00:00:00+00:00")
        new = high_water(self.spark.read.schema(schema).parquet(folder), self.mark_col, default)
        old = (now or {}).get("mark")
        best = max(new, datetime.fromisoformat(old)) if old else new
        return None if best == default else best.isoformat()

    def _older(self, now: dict | None, kept: dict, schema: dict) -> dict:
        """The schemas of kept parts that differ from the table's."""
        before = {p: (now or {}).get("older", {}).get(p, (now or {}).get("schema")) for p in kept}
        return {p: s for p, s in before.items() if s != schema}

    def _commit(self, version: int, text: str) -> None:
        """Write the manifest aside and move it into place whole; of two writers, one fails."""
        final = self._hadoop_path(self._manifest_path(version))
        aside = self._hadoop_path(f"{self.path}/_manifests/.{version}-{_token(self.spark)}")
        stream = self._fs.create(aside, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        sc = self.spark.sparkContext
        files = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.getUri(), sc._jsc.hadoopConfiguration()
        )
        keep = sc._gateway.new_array(getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:  # without the overwrite option a name that is taken raises
            files.rename(aside, final, keep)
        except Exception as taken:
            self._fs.delete(aside, False)
            if self._fs.exists(final):
                raise ConcurrentPublish(f"{self.path} version {version}") from taken
            raise


def _cast(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns and types of ``schema``; a value that does not fit is NULL."""
    own = {f.name: f.dataType for f in df.schema}

    def column(f: T.StructField) -> Column:
        if f.name not in own:
            return F.lit(None).cast(f.dataType).alias(f.name)
        if own[f.name] == f.dataType:
            return F.col(f.name)
        nested = isinstance(own[f.name], (T.ArrayType, T.MapType, T.StructType))
        text = nested and isinstance(f.dataType, T.StringType)
        return (F.to_json(f.name) if text else F.col(f.name).try_cast(f.dataType)).alias(f.name)

    return df.select(*[column(f) for f in schema])


def _token(spark: SparkSession) -> str:
    return spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()[:8]

