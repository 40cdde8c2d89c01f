"""Continuous ingestion of landed files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.latest import keep_latest
from tidemark.sources.landing import CORRUPT, null_out, parse_lines, stamp_load
from tidemark.sources.raw import RawStore, stream_id
from tidemark.sources.tables import PublishedTable


def stream_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    checkpoint: str,
    on_batch: Callable[[DataFrame, int], None],
    interval: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Hand every landed file to ``on_batch`` once.

    Without ``interval`` the query takes what has landed and ends; with it
    (say ``"60 seconds"``) it keeps running. Bad lines come along with a filled
    ``_corrupt_record``.
    """
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    landed = null_out(stamp_load(parse_lines(reader.text(path), schema)))
    writer = landed.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def upsert_into(
    table: PublishedTable,
    order_cols: Sequence[str | Column],
    transform: Callable[[DataFrame], DataFrame] | None = None,
    tie_cols: Sequence[str | Column] | None = None,
    order_guard: str | None = None,
    checkpoint: str | None = None,
    raw: RawStore | None = None,
    entity: str = "",
) -> Callable[[DataFrame, int], None]:
    """A batch function: store the files in RAW, clean, keep the latest per key, merge.

    The table counts batches per stream, by the id in ``checkpoint``: a batch
    repeated after a failure changes nothing, and a new checkpoint loses none.
    With ``raw``, unreadable lines and the load log are stored in the same step.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        source = stream_id(spark, checkpoint) if checkpoint else ""
        if raw is not None:
            raw.append(entity, batch, f"{source}-{batch_id}")
        rows = batch.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
        if transform is not None:
            rows = transform(rows)
        latest = keep_latest(rows, table.keys, order_cols, tie_cols)
        table.merge(latest, batch_id=batch_id, order_guard=order_guard, source=source)

    return on_batch


def load_raw(
    spark: SparkSession,
    raw: RawStore,
    entity: str,
    path: str,
    schema: T.StructType,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Append what has landed below ``path`` to RAW, each file once; go on with ``interval``."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        raw.append(entity, batch, f"{stream_id(spark, checkpoint)}-{batch_id}")

    return stream_landing(spark, path, schema, checkpoint, on_batch, interval)
