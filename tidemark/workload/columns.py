"""One query per column cleaner, each over a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from tidemark.functions import clean as c
from tidemark.workload import adapters as a
from tidemark.workload import duck as d
from tidemark.workload.registry import query


def _cleaner(
    name: str,
    source: str,
    key: str,
    outputs: dict[str, tuple[Callable[..., Column], str]],
) -> None:
    """Query ``name``: key plus the outputs {column: (Spark fn of the frame, DuckDB SQL)}."""
    oracle_cols = ", ".join(f"{sql} as {col}" for col, (_, sql) in outputs.items())

    @query(name, f"select {key}, {oracle_cols} from ({source}) x")
    def run(src):
        df = src.sql(source)
        return df.select(key, *[fn().alias(col) for col, (fn, _) in outputs.items()])


def _of(fn, *columns: str):
    return lambda: fn(*[F.col(x) for x in columns])


def _dbl(sql: str) -> str:
    return f"cast({sql} as double)"


_HOST = a.x_hosts((0,))
_LISTING = a.x_listings((0,))
_GUEST = a.x_guests()
_BOOKING = a.x_bookings((0,))
_REVIEW = a.x_reviews()
_EVENT = a._events(0)
_CAL = a.x_calendar()

_cleaner(
    "clean_id",
    f"select s_suppkey, {a.spelled('SUP', 's_suppkey', 's_suppkey')} as raw_id from supplier",
    "s_suppkey",
    {"host_id": (_of(c.clean_id, "raw_id"), d.clean_id("raw_id"))},
)
_cleaner(
    "clean_booking_id",
    f"select o_orderkey, case when o_orderkey % 40 = 0 then null when o_orderkey % 40 = 1 then 'BKG' else {a.booking_spelled('o_orderkey', 'o_orderkey')} end as raw_id from orders",
    "o_orderkey",
    {"booking_id_clean": (_of(c.clean_booking_id, "raw_id"), d.booking_id("raw_id"))},
)
_words = [f"' ' || {w} || ' '" for w in a.BOOLS[:5]] + a.BOOLS[5:] + ["'maybe'", "null"]
_cleaner(
    "clean_bool",
    f"select p_partkey, {a.by('p_partkey', _words)} as raw_flag from part",
    "p_partkey",
    {"flag": (_of(c.clean_bool, "raw_flag"), d.boolean("raw_flag"))},
)
_cleaner(
    "clean_availability",
    _CAL,
    "calendar_id",
    {
        "is_available": (
            _of(c.clean_availability, "is_available"),
            d.boolean("is_available", ["available"], ["blocked"]),
        )
    },
)
_prices = [
    a.money("p_retailprice"),
    f"'$' || {a.money('p_retailprice')}",
    "'$1,200.505'",
    "'120'",
    "'abc'",
    "'99999999999'",
    "null",
    f"' $' || {a.money('p_retailprice')} || ' '",
]
_cleaner(
    "clean_price",
    f"select p_partkey, {a.by('p_partkey', _prices)} as raw_price from part",
    "p_partkey",
    {"price": (_of(c.clean_price, "raw_price"), _dbl(d.price("raw_price")))},
)
_cleaner(
    "clean_money",
    f"select o_orderkey, case when o_orderkey % 9 = 0 then '$5' when o_orderkey % 11 = 0 then 'n/a' else {a.text('cast(o_totalprice as decimal(12,2))')} || '5' end as raw from orders",
    "o_orderkey",
    {"amount": (_of(c.clean_money, "raw"), _dbl(d.money("raw")))},
)
_pct = "(cast(l_quantity as int) + 50)"
_rates = [
    f"{a.text(_pct)} || '%'",
    f"'0.' || {a.text(_pct)}",
    a.text(_pct),
    f"{a.text(_pct)} || '.5'",
    "'1'",
    "'1%'",
    "'150'",
    "'n/a'",
    "null",
]
_cleaner(
    "clean_rate",
    f"select l_orderkey, l_linenumber, l_partkey, {a.by('l_orderkey + l_linenumber', _rates)} as raw from lineitem",
    "l_partkey",
    {"rate": (_of(c.clean_rate, "raw"), _dbl(d.rate("raw")))},
)
_cleaner(
    "clean_date",
    f"select o_orderkey, case when o_orderkey % 31 = 30 then '1995-02-30' when o_orderkey % 37 = 36 then null else {a.dirty_date('od', 'o_orderkey')} end as raw from (select o_orderkey, cast(o_orderdate as date) as od from orders) o",
    "o_orderkey",
    {"day": (_of(c.clean_date, "raw"), d.date("raw"))},
)
_cleaner(
    "clean_iso_date",
    f"select o_orderkey, case when o_orderkey % 5 = 0 then {a.dirty_date('od', 'o_orderkey')} when o_orderkey % 7 = 0 then '2001-13-01' else {a.text('od')} end as raw from (select o_orderkey, cast(o_orderdate as date) as od from orders) o",
    "o_orderkey",
    {"day": (_of(c.clean_iso_date, "raw"), d.iso_date("raw"))},
)
_cleaner(
    "clean_ts",
    f"select event_id, case when event_id % 9 = 0 then 'soon' when event_id % 11 = 0 then null else {a.iso('ts')} end as raw from events",
    "event_id",
    {"read_at": (_of(c.clean_ts, "raw"), d.ts("raw"))},
)
_cleaner(
    "bucket_response",
    _HOST,
    "host_id",
    {"bucket": (_of(c.bucket_response, "host_response_time"), d.response("host_response_time"))},
)
_lists = [
    """'["' || p_name || '", "' || p_brand || '", 5]'""",
    "p_name || '|' || p_brand",
    "p_name || ', ' || p_type",
    "p_brand",
    "'[]'",
    "'5'",
    "''",
    "null",
    """'["open'""",
]
_LIST_ROWS = f"select p_partkey, {a.by('p_partkey', _lists)} as raw from part"
_cleaner(
    "parse_list",
    _LIST_ROWS,
    "p_partkey",
    {"items": (_of(c.parse_list, "raw"), f"cast(to_json({d.parse_list('raw')}) as varchar)")},
)
_cleaner(
    "list_size",
    _LIST_ROWS,
    "p_partkey",
    {"n": (_of(c.list_size, "raw"), f"len({d.parse_list('raw')})")},
)
_cleaner(
    "clean_bathrooms",
    _LISTING,
    "listing_id",
    {"bathrooms": (_of(c.clean_bathrooms, "bathrooms"), _dbl(d.bathrooms("bathrooms")))},
)
_cleaner(
    "positive_int",
    _LISTING,
    "listing_id",
    {
        "minimum_nights": (_of(c.positive_int, "minimum_nights"), d.positive("minimum_nights")),
        "is_bad": (
            lambda: c.below(F.col("minimum_nights"), 0, inclusive=True),
            f"coalesce({d.integer('minimum_nights')} <= 0, false)",
        ),
        "beds": (_of(c.clean_int, "beds"), d.integer("beds")),
    },
)
_cleaner(
    "nonneg_int",
    _BOOKING,
    "booking_id",
    {
        "num_children": (_of(c.nonneg_int, "num_children"), d.nonneg("num_children")),
        "is_bad": (
            lambda: c.below(F.col("num_children"), 0),
            f"coalesce({d.integer('num_children')} < 0, false)",
        ),
    },
)
_cleaner(
    "position_fix",
    _EVENT,
    "event_id",
    {
        "position": (_of(c.position_fix, "position_in_results"), d.position("position_in_results")),
        "is_invalid": (
            _of(c.position_invalid, "position_in_results"),
            f"coalesce({d.integer('position_in_results')} = 0, false)",
        ),
    },
)
_cleaner(
    "clean_country",
    f"select n_nationkey, {a.by('n_nationkey', a.quoted(['US', ' usa', 'United States', 'United States of America ', 'x']) + ['lower(n_name)', 'null'])} as raw from nation",
    "n_nationkey",
    {"country": (_of(c.clean_country, "raw"), d.country("raw"))},
)
_codes = a.quoted(["US", "USA", "GBR", "CAN", "AUS", "DEU", "FRA", "JPN", "BRA", " us ", " USA", "gbr", "xx"]) + ["null"]
_cleaner(
    "iso3_to_2",
    f"select event_id, {a.by('event_id', _codes)} as raw from events",
    "event_id",
    {"country_code": (_of(c.iso3_to_2, "raw"), d.iso2("raw"))},
)
_suspect = f"coalesce({d.number('latitude')} < 0 and {d.number('longitude')} > 0, false)"
_cleaner(
    "swap_coords",
    _LISTING,
    "listing_id",
    {
        "lat": (
            lambda: c.swap_coords(F.col("latitude"), F.col("longitude"))[0],
            f"case when {_suspect} then {d.number('longitude')} else {d.number('latitude')} end",
        ),
        "lon": (
            lambda: c.swap_coords(F.col("latitude"), F.col("longitude"))[1],
            f"case when {_suspect} then {d.number('latitude')} else {d.number('longitude')} end",
        ),
        "is_suspect": (
            lambda: c.swap_coords(F.col("latitude"), F.col("longitude"))[2],
            _suspect,
        ),
    },
)
_cleaner(
    "rescale_rating",
    "select l_orderkey, l_linenumber, cast(cast(l_quantity as int) * 2 - 2 as string) as raw, l_partkey from lineitem",
    "l_partkey",
    {
        "rating": (
            lambda: c.rescale_rating(c.clean_double(F.col("raw"))),
            d.rescale(d.number("raw")),
        )
    },
)
_cleaner(
    "parse_rating",
    _REVIEW,
    "review_id",
    {
        "overall": (_of(c.parse_rating, "overall_rating"), d.parse_rating("overall_rating")),
        "value": (_of(c.parse_rating, "value_rating"), d.parse_rating("value_rating")),
    },
)
_cleaner(
    "null_text",
    "select doc_id, case doc_id % 9 when 0 then '' when 1 then '   ' when 2 then '.' when 3 then 'n/a' when 4 then ' None' when 5 then 'ok' when 6 then null when 7 then '  ' || text || '  ' else text end as raw from documents",
    "doc_id",
    {"cleaned": (_of(c.null_text, "raw"), d.null_text("raw"))},
)
_cleaner(
    "null_response",
    "select conv_id, turn, case (conv_id + turn) % 5 when 0 then ' ' when 1 then 'N/a' else text end as raw from conversations",
    "conv_id",
    {"cleaned": (_of(c.null_response, "raw"), d.null_response("raw"))},
)
_cleaner(
    "phone_e164",
    _GUEST,
    "guest_id",
    {"phone": (_of(c.phone_e164, "guest_phone"), d.phone("guest_phone"))},
)
_cleaner(
    "clean_gender",
    _GUEST,
    "guest_id",
    {"gender": (_of(c.clean_gender, "gender"), d.gender("gender"))},
)
_trips, _avg = d.integer("total_trips"), d.number("average_rating_as_guest")
GUEST_RATING_SQL = f"case when {_trips} <= 0 or ({_avg}) = 0 then null else {d.rounded(_avg)} end"
_cleaner(
    "guest_rating",
    _GUEST,
    "guest_id",
    {"rating": (_of(c.guest_rating, "average_rating_as_guest", "total_trips"), GUEST_RATING_SQL)},
)
_cleaner(
    "map_event_type",
    f"select event_id, {a.event_word()} as raw from events",
    "event_id",
    {
        "event_type_clean": (_of(c.map_event_type, "raw"), d.event_type("raw")),
        "is_mapped": (_of(c.event_type_known, "raw"), d.event_known("raw")),
    },
)
_cleaner(
    "clean_platform",
    f"select b.*, {a.by('length(booking_id)', a.quoted(['Mobile ', 'TABLET', 'desktop']))} as device from ({_BOOKING}) b",
    "booking_id",
    {
        "platform": (_of(c.clean_platform, "source_platform"), d.platform("source_platform")),
        "device": (_of(c.clean_device, "device"), d.low("device")),
    },
)
_cleaner(
    "split_os",
    "select p_partkey, case p_partkey % 5 when 0 then ' iPad OS 17 ' when 1 then 'Linux' when 2 then null else p_name end as raw from part",
    "p_partkey",
    {
        "os_name": (lambda: c.split_os(F.col("raw"))[0], d.os_name("raw")),
        "os_version": (lambda: c.split_os(F.col("raw"))[1], d.os_version("raw")),
    },
)
_cleaner(
    "clean_text",
    f"select c_custkey, {a.by('c_custkey', ['c_name', "upper(c_mktsegment) || '_' || lower(c_name)"])} || ' o''NEIL-van.der/berg x' as raw from customer",
    "c_custkey",
    {
        "title": (_of(c.title_text, "raw"), d.title("raw")),
        "lowered": (_of(c.lower_text, "raw"), d.low("raw")),
        "trimmed": (_of(F.trim, "raw"), "trim(raw)"),
    },
)
_DATED = (
    "select o_orderkey, o_totalprice, cast(o_orderdate as date) as d_in, "
    "case when o_orderkey % 13 = 12 then null when o_orderkey % 20 = 19 then cast(o_orderdate as date) + cast(-2 as int) "
    "else cast(o_orderdate as date) + cast(o_orderkey % 9 as int) end as d_out, "
    "cast(o_orderkey % 8 as string) as stated, cast(cast(o_totalprice as decimal(12,2)) as decimal(14,2)) as total, "
    "o_orderstatus as st, o_orderpriority from orders"
)
_cleaner(
    "date_valid",
    _DATED,
    "o_orderkey",
    {"is_date_valid": (_of(c.date_valid, "d_in", "d_out"), "coalesce(d_out >= d_in, false)")},
)
_cleaner(
    "nights",
    _DATED,
    "o_orderkey",
    {
        "nights": (_of(c.nights, "d_in", "d_out"), "datediff('day', d_in, d_out)"),
        "corrected": (
            _of(c.nights_differ, "stated", "d_in", "d_out"),
            f"coalesce({d.integer('stated')} <> datediff('day', d_in, d_out), false)",
        ),
    },
)
_parts = "base_price cleaning_fee_charged service_fee taxes".split()
_sum_sql = " + ".join(f"coalesce({d.money(p)}, 0)" for p in _parts)
_cleaner(
    "price_reconcile",
    _BOOKING,
    "booking_id",
    {
        "calculated_total_price": (
            lambda: c.component_total(*[c.clean_money(F.col(p)) for p in _parts]),
            _dbl(f"({_sum_sql})"),
        ),
        "is_price_mismatch": (
            lambda: c.price_mismatch(
                c.clean_money(F.col("total_price")),
                c.component_total(*[c.clean_money(F.col(p)) for p in _parts]),
            ),
            f"coalesce(abs({d.money('total_price')} - ({_sum_sql})) > 1.00, false)",
        ),
    },
)
_cleaner(
    "recognized_revenue",
    "select o_orderkey, case o_orderstatus when 'F' then 'completed' else 'pending' end as st, case when o_orderkey % 3 = 0 then null else 'paid' end as pay, cast(o_totalprice as decimal(12,2)) as total from orders",
    "o_orderkey",
    {
        "recognized_revenue": (
            _of(c.recognized_revenue, "st", "pay", "total"),
            "cast(case when st = 'completed' and pay = 'paid' then total else 0 end as double)",
        )
    },
)
_cleaner(
    "revenue_per_night",
    _DATED,
    "o_orderkey",
    {
        "revenue_per_night": (
            lambda: c.revenue_per_night(F.col("total"), c.nights(F.col("d_in"), F.col("d_out"))),
            d.rounded("(total / nullif(datediff('day', d_in, d_out), 0))"),
        )
    },
)
_LEAD = (
    "select o_orderkey, cast(o_orderdate as timestamp) as booked, case when o_orderkey % 13 = 0 then null else "
    "cast(o_orderdate as date) + cast(o_orderkey % 40 - 5 as int) end as d_in, o_orderkey % 14 as stay from orders"
)
_cleaner(
    "lead_time",
    _LEAD,
    "o_orderkey",
    {
        "lead_days": (_of(c.lead_days, "booked", "d_in"), "datediff('day', cast(booked as date), d_in)"),
        "is_last_minute": (
            lambda: c.flag(c.lead_days(F.col("booked"), F.col("d_in")) < 7),
            "coalesce(datediff('day', cast(booked as date), d_in) < 7, false)",
        ),
        "is_long_stay": (lambda: c.flag(F.col("stay") >= 7), "stay >= 7"),
    },
)
_cleaner(
    "surrogate_key",
    "select event_id, cast(event_id as string) as id, cast(ts as timestamp) as seen from events",
    "event_id",
    {
        "plain_key": (_of(c.surrogate_key, "id"), "md5(id)"),
        "version_key": (_of(c.version_key, "id", "seen"), f"md5(id || '|' || {d.key_time('seen')})"),
    },
)
_cleaner(
    "presence",
    _EVENT,
    "event_id",
    {
        "is_anonymous": (lambda: F.col("guest_id").isNull(), "guest_id is null"),
        "has_os": (_of(c.has_value, "os_version"), "os_version is not null"),
    },
)
