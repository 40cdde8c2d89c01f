"""Streaming queries: the events, landed as JSON lines, ingested file by file."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tidemark.functions import clean as c
from tidemark.operators.latest import high_water
from tidemark.session import scratch
from tidemark.sources import schemas
from tidemark.sources.raw import RawStore
from tidemark.sources.tables import PublishedTable
from tidemark.streaming.ingest import load_raw, stream_landing, upsert_into
from tidemark.workload import adapters as a
from tidemark.workload import duck as d
from tidemark.workload.registry import query

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_FIELDS = "event_id event_type user_id seen_at revision".split()
# Every tenth event is delivered again, corrected, in a file of its own.
_DELIVERED = " union all ".join(
    f"select {a.spelled('EVT', 'event_id', f'event_id + {i}')} as event_id, {a.event_word()} as event_type, user_id, "
    f"{a.iso('ts')} as seen_at, {i} as revision from events {where}"
    for i, where in enumerate(("", "where event_id % 10 = 0"))
)
_CLEAN = (
    f"select {d.clean_id('event_id')} as event_id, {d.event_type('event_type')} as event_type, cast(user_id as string) as user_id, "
    f"cast(revision as string) as revision from ({_DELIVERED}) x"
)


def _land(src) -> str:
    path = scratch(src.spark, "feed")
    rows = src.sql(_DELIVERED)
    for i in (0, 1):
        rows.filter(F.col("revision") == i).write.mode("append").json(path)
    return path


@query(
    "stream_ingest",
    f"select event_id, event_type, cast(user_id as string) as user_id, seen_at, cast(revision as string) as revision from ({_DELIVERED}) x",
)
def stream_ingest(src):
    out = scratch(src.spark, "raw_events")

    def append(batch, batch_id: int) -> None:
        # the batch id names the folder: a repeated batch replaces itself
        batch.select(*_FIELDS).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    stream_landing(
        src.spark, _land(src), schemas.text_schema(_FIELDS), scratch(src.spark, "checkpoint"), append
    ).awaitTermination()
    return src.spark.read.parquet(out).select(*_FIELDS)


@query("stream_upsert", f"select event_id, event_type, user_id, revision from ({d.latest(f'({_CLEAN}) c', 'event_id', 'revision')}) r")
def stream_upsert(src):
    table = PublishedTable(src.spark, scratch(src.spark, "events_table"), ["event_id"], buckets=8)

    def tidy(batch):
        return batch.select(
            c.clean_id(F.col("event_id")).alias("event_id"),
            c.map_event_type(F.col("event_type")).alias("event_type"),
            "user_id",
            "revision",
        )

    checkpoint = scratch(src.spark, "checkpoint")
    stream_landing(
        src.spark,
        _land(src),
        schemas.text_schema(_FIELDS),
        checkpoint,
        upsert_into(table, ["revision"], tidy, order_guard="revision", checkpoint=checkpoint),
        max_files=12,
    ).awaitTermination()
    return table.read()


_SCHEMA = schemas.text_schema(_FIELDS)


@query(
    "raw_incremental",
    f"select event_id, event_type, cast(user_id as string) as user_id, cast(revision as string) as revision from ({_DELIVERED}) x where revision = 1",
)
def raw_incremental(src):
    """Two loads into RAW; the second reader takes only what came after the first."""
    raw = RawStore(src.spark, scratch(src.spark, "raw"), {"events": _SCHEMA})
    feed, checkpoint = scratch(src.spark, "feed"), scratch(src.spark, "checkpoint")
    rows, mark = src.sql(_DELIVERED), None
    for i in (0, 1):
        rows.filter(F.col("revision") == i).write.mode("append").json(feed)
        load_raw(src.spark, raw, "events", feed, _SCHEMA, checkpoint).awaitTermination()
        if mark is None:
            mark = high_water(raw.read("events"), "_loaded_at", _EPOCH) + timedelta(microseconds=1)
    return raw.read("events", mark).select("event_id", "event_type", "user_id", "revision")


# every seventh event arrives as a broken line; one file per type and kind of line
_LINES = (
    "select event_type as kind, case when event_id % 7 = 0 then '{broken' else concat('{\"event_id\": \"', cast(event_id as string), '\"}') end as value from events"
)


@query(
    "load_history",
    """select event_type as kind, count(*) as row_count, count(*) filter (where event_id % 7 = 0) as error_count,
  case when count(*) filter (where event_id % 7 = 0) = 0 then 'Loaded'
       when count(*) filter (where event_id % 7 = 0) < count(*) then 'Partially loaded' else 'Load failed' end as status
from events group by 1""",
)
def load_history(src):
    """The log that loading stores, beside the unreadable lines themselves."""
    raw = RawStore(src.spark, scratch(src.spark, "raw"), {"events": _SCHEMA})
    feed = scratch(src.spark, "feed")
    src.sql(_LINES).repartition("kind").write.partitionBy("kind").text(feed)
    load_raw(src.spark, raw, "events", feed, _SCHEMA, scratch(src.spark, "checkpoint")).awaitTermination()
    kind = F.regexp_extract("file_name", "kind=([^/]*)/", 1).alias("kind")
    return raw.log().select(kind, "row_count", "error_count", "status")
