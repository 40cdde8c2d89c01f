"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime-settable SQL options. Time zone and ANSI mode are needed for right
# results; the adaptive ones let Spark pick broadcast joins from measured sizes
# and split hot join partitions.
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Bounds what a Python worker holds of long texts at a time.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    # The JVM never compiles methods above 8000 bytes. Projections as wide as the
    # cleaning ones pass that as one fused method and would run interpreted;
    # below the limit Spark splits them into compilable ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# Bytes of a file that one task reads. The raw feeds are many times as wide in memory
# as their columns are on disk, and keep-latest sorts a task's rows before the
# shuffle: with Spark's 128 MB that sort grows with the file to several GB a task.
_FEED_SPLIT = "8m"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime options to ``spark`` and return it."""
    for name, value in _RUNTIME.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def tune_feeds(spark: SparkSession) -> SparkSession:
    """:func:`tune`, and splits small enough for sorting wide feeds in memory."""
    name = "spark.sql.files.maxPartitionBytes"
    if tune(spark).conf.get(name) != _FEED_SPLIT:
        spark.conf.set(name, _FEED_SPLIT)
    return spark


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries planned in this block delete their shuffle files as they end.

    Otherwise the files stay until the driver happens to collect its garbage, so
    disk grows with the sum of all queries. Only for frames that run once.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediates.

    The cluster names it in ``spark.checkpoint.dir``; without that setting it is
    below the warehouse, which executors reach as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


_SCRATCH: list[str] = []


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to scratch paths; frames over them end here."""
    while _SCRATCH:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def fingerprint(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of the files below ``folder``, as one digest."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files, seen = fs.listFiles(top, True), []
    while files.hasNext():
        f = files.next()
        seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
