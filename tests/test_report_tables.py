"""The tables that the quality report judges, and the dearest cleaner behind them."""

from datetime import datetime
from types import SimpleNamespace

from pyspark.sql import functions as F

from tidemark.functions import clean as c
from tidemark.plans import layers
from tidemark.workload import models

TEXTS = "event_id event_type listing_id guest_id session_id device_type os_version browser country_code search_query price_shown position_in_results event_timestamp _stream_timestamp _source_file".split()


def raw_events(spark):
    def row(event_id, kind, streamed, hour):
        values = dict.fromkeys(TEXTS, "1") | {"event_id": event_id, "event_type": kind, "_stream_timestamp": streamed}
        return [*values.values(), datetime(2024, 1, 1, hour)]

    rows = [
        row("EVT-1", "view", "2024-01-01T00:00:00Z", 1),
        row("evt1", "click", "2024-01-01T00:00:00Z", 1),  # ties with the other spelling
        row("EVT-1", "save", "2023-01-01T00:00:00Z", 2),
        row("EVT-2", "view", "2024-01-01T00:00:00Z", 1),
        row("EVT-2", "view", "2024-01-01T00:00:00Z", 1),
        row("EVT-3", "view", "2024-01-01T00:00:00Z", 1),
        row("EVT-3", "click", "bad", 1),
        row(None, "view", "bad", 1),
        row(None, "click", "bad", 1),
    ]
    kinds = ", ".join(f"{t} string" for t in TEXTS)
    return spark.createDataFrame(rows, f"{kinds}, _loaded_at timestamp")


def test_report_spells_out_a_feed_once(spark, monkeypatch):
    """Silver is made of the stored bronze table and holds the rows of one pass over the feed."""
    raw, asked, made = raw_events(spark), [], {}
    wanted = ("bronze_listing_events", "silver_listing_events")
    src = SimpleNamespace(spark=spark, raw=lambda entity, loads=None: asked.append(entity) or raw)

    def stored(src, name, build):
        if name in wanted and name not in made:
            made[name] = build()
        return made.get(name)

    monkeypatch.setattr(models, "stored", stored)
    models.all_tables(src)
    assert asked == ["listing_events"]
    found, straight = made[wanted[1]], layers.silver_of_raw("listing_events", raw)
    assert sorted(map(str, found.collect())) == sorted(map(str, straight.select(found.columns).collect()))
    assert found.count() == 4


def test_rating_is_the_number_that_a_cast_reads(spark):
    texts = [None, "", " ", ".", "..", "5.", ".5", "4,5", "4.5.1", "1,000.5", "3.2 stars", "0", "00.10", "1e5", "-3"]
    texts += ["+4", "٣", "n/a", "7.5f", "9" * 400, "0." + "3" * 60, "4.5\n", "4;5", "NaN", "Infinity"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.regexp_replace(F.translate("t", ",", "."), "[^0-9.]", "").try_cast("double")
    for r in df.select("t", c.parse_rating(F.col("t")).alias("found"), plain.alias("plain")).collect():
        assert r.found == r.plain, r
