"""Landing files, in batch and as a stream."""

import json
import os

from pyspark.sql import functions as F

from tidemark.operators.audit import load_audit, load_log
from tidemark.sources import landing, schemas
from tidemark.sources.tables import PublishedTable
from tidemark.streaming.ingest import stream_landing, upsert_into

SCHEMA = schemas.text_schema(["id", "price", "tags", "_stream_timestamp"])


def land(folder, name, lines):
    os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(b"\n".join(x if isinstance(x, bytes) else json.dumps(x).encode() for x in lines) + b"\n")


def test_fields_stay_text(spark, folder):
    land(folder, "a.json", [{"id": 1, "price": 1234.5, "tags": ["a", 1], "extra": 1}, {"id": "-1"}, {"id": "NULL", "price": ""}])
    good, bad = landing.read_landing(spark, folder, SCHEMA, as_of="2024-01-01 00:00:00")
    got = [tuple(r) for r in good.select("id", "price", "tags").collect()]
    assert got == [("1", "1234.5", '["a",1]'), ("-1", None, None), (None, None, None)]
    assert bad.count() == 0 and good.select("_source_file").first()[0].endswith("a.json")


def test_bad_lines_and_bytes(spark, folder):
    land(folder, "a.json", [{"id": "1"}, b'{"id": "2", ', b"not json", b"", b'{"id": "3\xff"}'])
    good, bad = landing.read_landing(spark, folder, SCHEMA)
    assert sorted(r.id for r in good.collect()) == ["1", "3�"]
    assert sorted(r[0] for r in bad.select(landing.CORRUPT).collect()) == ["not json", '{"id": "2", ']
    assert bad.count() == 2


def test_partition_folders_are_pruned(spark, folder):
    for day in (1, 2, 3):
        land(folder, f"year=2024/month=1/day={day}/a.json", [{"id": str(day)}])
    good, _ = landing.read_landing(spark, folder, SCHEMA, only=F.col("day") == 2)
    assert [r.id for r in good.collect()] == ["2"]
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_routing_covers_every_row(spark):
    df = spark.createDataFrame([(1, "host"), (2, "listing_event"), (3, "odd"), (4, None)], "id int, entity_type string")
    sinks = landing.route(df, "entity_type", schemas.ENTITY_TYPES)
    rest = landing.unrouted(df, "entity_type", schemas.ENTITY_TYPES)
    assert [r.id for r in sinks["listing_events"].collect()] == [2]
    assert sum(s.count() for s in sinks.values()) + rest.count() == 4


def test_load_log(spark, folder):
    land(folder, "good.json", [{"id": "1"}])
    land(folder, "half.json", [{"id": "1"}, b"{"])
    land(folder, "none.json", [b"{"])
    log = load_log(landing.read_with_status(spark, folder, SCHEMA, "2024-01-02 00:00:00"), batch_id=3)
    got = {r.file_name.rsplit("/", 1)[1]: (r.row_count, r.error_count, r.status) for r in log.collect()}
    assert got == {"good.json": (1, 0, "Loaded"), "half.json": (2, 1, "Partially loaded"), "none.json": (1, 1, "Load failed")}
    assert load_audit(log, "2024-01-01 00:00:00").count() == 2
    assert load_audit(log, "2024-01-03 00:00:00").count() == 0


def test_stream_takes_each_file_once_and_survives_a_replay(spark, folder):
    table = PublishedTable(spark, f"{folder}/table", ["id"], 4)
    seen = []
    step = upsert_into(table, ["_stream_timestamp"])

    def on_batch(batch, batch_id):
        seen.append(batch.count())
        step(batch, batch_id)
        step(batch, batch_id)  # a retry of the same batch

    def drain():
        stream_landing(spark, f"{folder}/feed", SCHEMA, f"{folder}/checkpoint", on_batch).awaitTermination()

    land(f"{folder}/feed", "1.json", [{"id": "a", "price": "1", "_stream_timestamp": "1"}, {"id": "a", "price": "2", "_stream_timestamp": "2"}, b"{"])
    drain()
    land(f"{folder}/feed", "2.json", [{"id": "a", "price": "3", "_stream_timestamp": "0"}, {"id": "b", "price": "9", "_stream_timestamp": "1"}])
    drain()
    drain()
    assert seen == [3, 2]
    # the later delivery wins although it is older
    assert sorted((r.id, r.price) for r in table.read().collect()) == [("a", "3"), ("b", "9")]
