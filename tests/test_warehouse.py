"""Two full refreshes over a small clean feed, and a gate that stops a third."""

import os
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import QualityError, run_checks
from tidemark.plans.checks import all_checks
from tidemark.plans.gold import OBT_BOOKING_COLS
from tidemark.plans.warehouse import MODELS, Warehouse
from tidemark.sources.calendar import date_dimension
from tidemark.sources.landing import CORRUPT, read_entity
from tidemark.sources.schemas import RAW_COLUMNS


def feed(spark, entity, loaded, *records):
    cols = [*RAW_COLUMNS[entity], "_stream_timestamp"]
    data = [tuple(r.get(c) for c in cols) for r in records]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))
    return df.withColumn("_loaded_at", F.lit(loaded).cast("timestamp")).withColumn("_source_file", F.lit(f"{entity}.json"))


def first(spark):
    at, ts = "2025-01-01 06:00:00", "2025-01-01T05:00:00Z"
    booking = dict(listing_id="L-1", guest_id="G-1", host_id="H-1", num_children="0", base_price="100", taxes="10", total_price="110", _stream_timestamp=ts)
    return {
        "hosts": feed(spark, "hosts", at, dict(host_id="H-1", host_name="ann", is_superhost="t", _stream_timestamp=ts), dict(host_id="h1", host_name="ann", is_superhost="t", _stream_timestamp="2024-12-31T00:00:00Z")),
        "listings": feed(spark, "listings", at, dict(listing_id="L-1", host_id="h1", room_type="Private Room", price_per_night="$100", minimum_nights="1", amenities="TV|WiFi", _stream_timestamp=ts)),
        "guests": feed(spark, "guests", at, dict(guest_id="G-1", guest_name="bo", guest_phone="617-555-1234", _stream_timestamp=ts), dict(guest_id="G-2", is_banned="yes", _stream_timestamp=ts)),
        "bookings": feed(
            spark, "bookings", at,
            dict(booking, booking_id="BKG-1", check_in_date="January 9th, 2025", check_out_date="01/12/2025", booking_status="Completed", payment_status="paid", booked_at="2025-01-01T00:00:00Z", updated_at="2025-01-01T00:00:00Z"),
            dict(booking, booking_id="BKG-2", check_in_date="2025-01-09", check_out_date="2025-01-02", booking_status="pending", booked_at="2025-01-01T00:00:00Z"),
            dict(booking, booking_id="BKG-3", guest_id="G-2", check_in_date="2025-02-09", check_out_date="2025-02-20", booking_status="pending", booked_at="2025-01-05T00:00:00Z"),
        ),
        "reviews": feed(
            spark, "reviews", at,
            dict(review_id="R-1", booking_id="bkg_1", listing_id="L1", reviewer_id="G1", reviewee_id="H1", review_type="guest_to_host", overall_rating="4,5", value_rating="90", is_public="t", reviewed_at="2025-01-13T00:00:00Z", _stream_timestamp=ts),
            dict(review_id="R-2", booking_id="bkg_1", listing_id="L1", reviewer_id="H1", reviewee_id="G1", review_type="host_to_guest", is_public="f", reviewed_at="2025-01-13T00:00:00Z", _stream_timestamp=ts),
        ),
        "availability_calendar": feed(spark, "availability_calendar", at, dict(listing_id="L1", calendar_date="2025-01-09", is_available="blocked", _stream_timestamp=ts)),
        "listing_events": feed(
            spark, "listing_events", at,
            *[dict(event_id=f"E-{i}", event_type=t, listing_id="L1", guest_id="G-1", session_id="s1", event_timestamp=f"2025-01-01T00:00:{20 + i}Z", _stream_timestamp=ts) for i, t in enumerate(("View", "click", "BookingStart"))],
        ),
    }


def second(spark, **change):
    at, ts = "2025-01-04 06:00:00", "2025-01-04T05:00:00Z"
    listing = dict(listing_id="l1", host_id="h1", room_type="private room", price_per_night="150", minimum_nights="1", amenities="TV, WiFi", _stream_timestamp=ts)
    return {"listings": feed(spark, "listings", at, dict(listing, **change))}


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    w = Warehouse(spark, str(tmp_path_factory.mktemp("house")), buckets=4)
    w.refresh(first(spark), "2025-01-02 00:00:00")
    w.refresh(second(spark), "2025-01-04 12:00:00")
    return w


def test_all_models_are_published_and_clean(spark, house):
    tables = house.tables()
    assert set(tables) == set(MODELS) and len(MODELS) == 25
    report = run_checks([c for layer in all_checks().values() for c in layer], tables)
    assert report.count() == 94 and report.filter("violations > 0").count() == 0


def test_canonical_dedup_and_history(house):
    assert house.read("bronze_hosts").count() == 2 and house.read("silver_hosts").count() == 1
    assert house.read("hosts_snapshot").count() == 1
    prices = {r.is_current_record: float(r.price_per_night) for r in house.read("gold_dim_listings").collect()}
    assert prices == {False: 100.0, True: 150.0}


def test_facts(house):
    facts = {r.booking_id_clean: r for r in house.read("gold_fct_bookings").collect()}
    assert set(facts) == {"BKG-1", "BKG-3"}
    one, three = facts["BKG-1"], facts["BKG-3"]
    assert (float(one.recognized_revenue), float(one.revenue_per_night), one.check_in_date) == (110.0, 36.67, date(2025, 1, 9))
    # the version valid when the booking was made
    assert (float(one.listed_price_at_booking), float(three.listed_price_at_booking)) == (100.0, 150.0)
    # a banned guest has no dimension row
    assert one.guest_key is not None and three.guest_key is None and three.is_long_stay
    assert [r.quarantine_reason for r in house.read("quarantine_invalid_bookings").collect()] == ["checkout_before_checkin"]
    review = house.read("gold_fct_reviews").collect()
    assert len(review) == 1 and review[0].host_key and review[0].guest_key and review[0].booking_key == one.booking_key
    assert (review[0].overall_rating, review[0].avg_sub_rating) == (4.5, 4.5)
    session = house.read("gold_fct_sessions").first()
    assert (session.session_duration_seconds, session.furthest_funnel_step, session.abandoned_after_booking_start) == (2, 5, True)
    assert house.read("gold_obt_bookings").columns == OBT_BOOKING_COLS and len(OBT_BOOKING_COLS) == 50


def test_a_violation_stops_what_follows(spark, house):
    before = house.table("listings_snapshot").manifest()["version"]
    with pytest.raises(QualityError, match="accepted_values_silver_listings_room_type=1"):
        house.refresh(second(spark, room_type="castle"), "2025-01-05 00:00:00")
    assert house.table("listings_snapshot").manifest()["version"] == before


def test_landed_files_stream_into_bronze(spark, folder):
    w = Warehouse(spark, f"{folder}/house", buckets=4)

    def deliver(day, *lines):
        where = f"{folder}/landing/host/year=2025/month=1/day={day}"
        os.makedirs(where)
        with open(f"{where}/part.json", "w") as f:
            f.write("\n".join(lines))
        w.ingest("hosts", f"{folder}/landing", f"{folder}/checkpoint").awaitTermination()

    host = '{"host_id": "H-%d", "host_name": "%s", "is_superhost": true, "_stream_timestamp": "2025-01-0%dT00:00:00Z"}'
    deliver(1, host % (1, "ann", 1), host % (1, "old", 0), host % (2, "bo", 1), "{broken")
    deliver(2, host % (1, "anna", 2))
    got = {r.host_id: (r.host_name, r.is_superhost) for r in w.read("bronze_hosts").collect()}
    assert got == {"H-1": ("anna", "true"), "H-2": ("bo", "true")}
    good, bad = read_entity(spark, f"{folder}/landing", "hosts", only=F.col("day") == 1)
    assert good.count() == 3 and bad.count() == 1


def test_a_stream_brings_loaded_files_into_bronze(spark, folder):
    """A file that load() logged before the stream reached it, with no refresh in between."""
    w = Warehouse(spark, f"{folder}/house", buckets=4)
    host = '{"host_id": "H-%d", "host_name": "ann", "is_superhost": true, "_stream_timestamp": "2025-01-01T00:00:00Z"}'

    def deliver(day, line):
        where = f"{folder}/landing/host/year=2025/month=1/day={day}"
        os.makedirs(where)
        with open(f"{where}/part.json", "w") as f:
            f.write(line)

    deliver(1, host % 1)
    w.load(f"{folder}/landing", f"{folder}/loads", ["hosts"])
    deliver(2, host % 2)
    w.ingest("hosts", f"{folder}/landing", f"{folder}/checkpoint").awaitTermination()
    w.run_bronze()
    assert sorted(r.host_id for r in w.read("bronze_hosts").collect()) == ["H-1", "H-2"]
    assert w.raw.read("hosts").count() == 2


def test_raw_is_loaded_once_and_read_by_date(spark, folder):
    w = Warehouse(spark, f"{folder}/house", buckets=4)
    host = '{"host_id": "H-%d", "host_name": "ann", "is_superhost": true, "_stream_timestamp": "2025-01-01T00:00:00Z"}'

    def deliver(day, *lines):
        where = f"{folder}/landing/host/year=2025/month=1/day={day}"
        os.makedirs(where)
        with open(f"{where}/part.json", "w") as f:
            f.write("\n".join(lines))

    deliver(1, host % 1, "{broken")
    w.load(f"{folder}/landing", f"{folder}/checkpoints", ["hosts"])
    first = w.raw.read("hosts").select("_loaded_at").collect()
    assert w.raw.read("hosts").select("_loaded_at").collect() == first
    w.load(f"{folder}/landing", f"{folder}/checkpoints", ["hosts"])
    w.load(f"{folder}/landing", f"{folder}/a-new-checkpoint", ["hosts"])  # the log knows the file
    assert w.raw.read("hosts").count() == 1 and w.raw.bad_lines().count() == 1
    assert [(r.row_count, r.error_count, r.status) for r in w.raw.log().collect()] == [(2, 1, "Partially loaded")]
    w.run_bronze()
    w.run_bronze()
    deliver(2, host % 2)
    w.load(f"{folder}/landing", f"{folder}/checkpoints", ["hosts"])
    w.run_bronze()
    assert w.read("bronze_hosts").count() == 2
    assert [tuple(r) for r in w.raw.row_counts().collect()] == [("raw_hosts", 2)]
    assert [r.status for r in w.raw.freshness(F.current_timestamp()).collect()] == ["pass"]
    assert w.raw.audit("2020-01-01 00:00:00").count() == 1
    plan = w.raw.read("hosts", first[0][0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan


def test_calendar(spark):
    dates = date_dimension(spark)
    assert dates.count() == 3288
    names = "date_key year month month_name quarter day_name is_weekend is_us_federal_holiday season"
    row = dates.filter("full_date = date'2025-11-27'").select(*names.split()).first()
    assert tuple(row) == (20251127, 2025, 11, "November", 4, "Thursday", False, True, "Fall")
    holidays = dates.filter("year = 2025 and is_us_federal_holiday").select(F.date_format("full_date", "MM-dd")).collect()
    assert sorted(r[0] for r in holidays) == "01-01 01-20 02-17 05-26 06-19 07-04 09-01 10-13 11-11 11-27 12-25".split()
    assert dates.filter("year = 2020 and is_us_federal_holiday").count() == 10


def test_silver_reads_only_new_load_dates(spark, folder):
    w = Warehouse(spark, f"{folder}/house", buckets=4)
    event = lambda i, at, t="View": dict(
        event_id=f"E-{i}", event_type=t, listing_id="L1", session_id="s1", event_timestamp=at, _stream_timestamp=at
    )
    for day in (1, 2, 3):
        at = f"2025-01-0{day} 06:00:00"
        rows = [event(10 * day + i, f"2025-0{day}-01T00:00:00Z") for i in range(3)]
        rows.append(event(99, "2025-06-01T00:00:00Z", ("View", "click", "search")[day - 1]))  # comes again
        w.run_bronze({"listing_events": feed(spark, "listing_events", at, *rows)})
        new = w.new_bronze("listing_events", day)
        if day > 1:
            plan = new._jdf.queryExecution().executedPlan().toString()
            assert re.search(r"PartitionFilters: \[isnotnull\(_run#\d+L?\), \(_run#\d+L? > %d\)" % (day - 1), plan)
            # the rows of the last run alone: nothing that silver has seen is read again
            assert new.count() == 4
        before = (w.table("silver_listing_events").manifest() or {"parts": {}})["parts"]
        w.run_silver(["listing_events"])
        after = w.table("silver_listing_events").manifest()["parts"]
        if day == 3:  # the months of the new rows and of the repeated row alone
            assert {m for m in after if before.get(m) != after[m]} == {"2025-03", "2025-06"}
    got = {r.event_id: r.event_type_clean for r in w.read("silver_listing_events").collect()}
    assert len(got) == 10
    whole = w.read("bronze_listing_events").count()
    version = w.table("silver_listing_events").manifest()["version"]
    w.run_silver(["listing_events"])  # nothing new, nothing written
    assert w.table("silver_listing_events").manifest()["version"] == version
    assert whole == 10 and w.read("silver_listing_events").count() == 10


def test_a_slow_load_is_neither_skipped_nor_wins(spark, folder):
    """A load that began before another one and was logged after it."""
    w = Warehouse(spark, f"{folder}/house", buckets=4)

    def land(load, stamp, *hosts):
        rows = [dict(host_id=h, host_name=n, is_superhost="t", _stream_timestamp="2025-01-01T00:00:00Z") for h, n in hosts]
        marks = {"_source_file": F.lit(load), CORRUPT: F.lit(None).cast("string")}
        w.raw.append("hosts", feed(spark, "hosts", stamp, *rows).withColumns(marks), load)

    def run():
        w.run_bronze()
        w.run_silver(["hosts"])
        return {r.host_id: r.host_name for r in w.read("bronze_hosts").collect()}

    land("one", "2025-01-01 06:00:00", ("H-1", "ann"))
    assert run() == {"H-1": "ann"}
    land("three", "2025-01-03 06:00:00", ("H-3", "cy"))
    assert run() == {"H-1": "ann", "H-3": "cy"}
    land("two", "2025-01-02 06:00:00", ("H-2", "bo"), ("H-3", "old"))
    assert [r.load for r in w.raw.pending("hosts", "bronze_hosts").collect()] == ["two"]
    assert run() == {"H-1": "ann", "H-2": "bo", "H-3": "cy"}
    silver = w.read("silver_hosts")
    assert silver.count() == 3 and silver.filter("lower(host_name) = 'old'").count() == 0
    versions = [w.table(f"{layer}_hosts").manifest()["version"] for layer in ("bronze", "silver")]
    run()  # nothing pending, nothing written
    assert [w.table(f"{layer}_hosts").manifest()["version"] for layer in ("bronze", "silver")] == versions


def test_a_batch_interrupted_before_its_load_was_taken(spark, folder):
    """A crash after the rows were stored: the load comes again and changes nothing."""
    w = Warehouse(spark, f"{folder}/house", buckets=4)
    row = dict(host_id="H-1", host_name="ann", is_superhost="t", _stream_timestamp="2025-01-01T00:00:00Z")
    marks = {CORRUPT: F.lit(None).cast("string")}
    w.raw.append("hosts", feed(spark, "hosts", "2025-01-01 06:00:00", row).withColumns(marks), "one")
    take, w.raw.take = w.raw.take, lambda reader, loads: 1 / 0
    with pytest.raises(ZeroDivisionError):
        w.run_bronze()
    w.raw.take = take
    w.run_bronze()
    w.run_silver(["hosts"])
    assert w.read("bronze_hosts").count() == 1 and w.read("silver_hosts").count() == 1
    assert w.raw.pending("hosts", "bronze_hosts").isEmpty()
