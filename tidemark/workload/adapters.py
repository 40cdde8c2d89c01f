"""Untidy marketplace feeds derived from the given tables.

Every adapter is one SQL text that Spark and DuckDB read alike, so a query and
its oracle start from the same rows. Each covers its whole source table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

MONTHS = "January,February,March,April,May,June,July,August,September,October,November,December"
# Load times of the two deliveries.
LOADS = ("1996-01-01 06:00:00", "1998-06-01 06:00:00")

N_PART = "(select count(*) from part)"
N_SUPPLIER = "(select count(*) from supplier)"
N_CUSTOMER = "(select count(*) from customer)"


def text(x: str) -> str:
    return f"cast({x} as string)"


def padded(x: str, width: int) -> str:
    return f"lpad(cast({x} as string), {width}, '0')"


def by(x: str, options: list[str]) -> str:
    """Option number ``x % len(options)``."""
    whens = " ".join(f"when {i} then {o}" for i, o in enumerate(options))
    return f"case ({x}) % {len(options)} {whens} end"


def quoted(words: str | list[str]) -> list[str]:
    return ["'" + w.replace("'", "''") + "'" for w in (words.split() if isinstance(words, str) else words)]


def spelled(prefix: str, number: str, variant: str) -> str:
    """An identifier in one of three spellings."""
    n = padded(number, 12)
    low = prefix.lower()
    return by(variant, [f"'{prefix}-' || {n}", f"'{prefix}' || {n}", f"'{low}-' || {n}"])


def booking_spelled(number: str, variant: str) -> str:
    n = text(f"100000 + {number}")
    return by(variant, [f"'BKG-' || {n}", f"'BKG' || {n}", f"'bkg_' || {n}"])


def dirty_date(d: str, variant: str) -> str:
    day = f"cast(day({d}) as int)"
    suffix = (
        f"case when {day} in (11, 12, 13) then 'th' when {day} % 10 = 1 then 'st' "
        f"when {day} % 10 = 2 then 'nd' when {day} % 10 = 3 then 'rd' else 'th' end"
    )
    us = f"{padded(f'month({d})', 2)} || '/' || {padded(f'day({d})', 2)} || '/' || {text(f'year({d})')}"
    natural = (
        f"split_part('{MONTHS}', ',', cast(month({d}) as int)) || ' ' || {text(f'day({d})')} || "
        f"{suffix} || ', ' || {text(f'year({d})')}"
    )
    return by(variant, [text(d), us, natural])


BOOLS = quoted("t f True False 1 0 Y N yes no")


def money(x: str) -> str:
    return text(f"cast({x} as decimal(10,2))")


def iso(ts: str) -> str:
    return f"replace(substr({text(ts)}, 1, 19), ' ', 'T') || 'Z'"


def stream_time(load: int, key: str) -> str:
    """Delivery time text; unreadable on some keys, on some others only at first."""
    at = f"'{LOADS[load][:10]}T05:' || {padded(f'({key}) % 60', 2)} || ':00Z'"
    bad = f"({key}) % 13 = 0" + (f" or ({key}) % 13 = 1" if load == 0 else "")
    return f"case when {bad} then 'bad' else {at} end"


def lineage(load: int, key: str, name: str) -> str:
    return (
        f"timestamp '{LOADS[load]}' as _loaded_at, {stream_time(load, key)} as _stream_timestamp, "
        f"'{name}/{load}.json' as _source_file"
    )


def _hosts(load: int) -> str:
    k = "s_suppkey"
    rate = f"(70 + {k} % 31)"
    accept = f"(60 + ({k} + case when {k} % 5 = 1 then {load} else 0 end) % 41)"
    extra = f"case when {k} % 7 = 2 and {load} = 1 then 1 else 0 end"
    lists = by(
        f"{k} + {load}",
        [
            f"""'["email", "phone"' || case when {extra} = 1 then ', "linkedin"' else '' end || ']'""",
            f"'email|phone' || case when {extra} = 1 then '|linkedin' else '' end",
            f"'email, phone' || case when {extra} = 1 then ', linkedin' else '' end",
        ],
    )
    name = "s_name || ' o''neil-smith'"
    times = [
        *quoted(["within an hour", "1 hour", "within a day", "24 hours", "Same Day"]),
        "'a few days or more'",
        "null",
    ]
    return f"""
select {spelled("SUP", k, f"{k} + {load}")} as host_id,
  {by(k, [f"'  ' || {name}", f"upper({name})", f"lower({name}) || ' '"])} as host_name,
  ' ' || s_name || '@Example.COM ' as host_email,
  {dirty_date("since", k)} as host_since,
  '  Nation ' || {text("s_nationkey")} || ' ' as host_location,
  {by(k, times)} as host_response_time,
  case when {k} % 20 = 0 then null else {by(k, [f"{text(rate)} || '%'", f"case when {rate} = 100 then '1.0' else '0.' || {text(rate)} end", text(rate), "'n/a'"])} end as host_response_rate,
  {by(k, [f"{text(accept)} || '%'", f"{text(accept)} || '.5'"])} as host_acceptance_rate,
  {by(k, BOOLS)} as is_superhost,
  {text(f"{k} % 4")} as host_listings_count,
  {text(f"{k} % 6")} as host_total_listings_count,
  case when {k} % 29 = 28 then null else {lists} end as host_verifications,
  {by(f"{k} + 3", [*BOOLS, "'maybe'"])} as host_identity_verified,
  {lineage(load, k, "host")}
from (select *, date '2015-01-01' + cast(s_suppkey % 2000 as int) as since from supplier) s"""


def _listings(load: int) -> str:
    k = "p_partkey"
    price = f"cast(p_retailprice as decimal(10,2)) + case when {k} % 3 = 0 then 100 * {load} else 0 end"
    w1, w2 = "split_part(p_name, ' ', 1)", "split_part(p_name, ' ', 2)"
    amenities = by(
        f"{k} + {load}",
        [
            f"""'["' || {w1} || '", "' || {w2} || '", "WiFi"]'""",
            f"{w1} || '|' || {w2} || '|WiFi'",
            f"{w1} || ', ' || {w2} || ', WiFi'",
        ],
    )
    lat = f"'42.' || {padded(f'{k} % 1000', 3)}"
    lon = f"'-71.' || {padded(f'({k} * 7) % 1000', 3)}"
    scores = [text(f"{k} % 101"), f"'4.' || {padded(f'{k} % 100', 2)}", "'0'", "null", "'4.5x'"]
    score_cols = ",\n  ".join(
        f"{by(f'{k} + {i}', scores)} as review_scores_{n}"
        for i, n in enumerate("rating cleanliness checkin communication location value".split())
    )
    return f"""
select {spelled("PRT", k, f"{k} + {load}")} as listing_id,
  {spelled("SUP", f"({k} % {N_SUPPLIER})", k)} as host_id,
  '  ' || p_name || ' ' as listing_name,
  p_brand || ' ' || p_type as listing_description,
  upper(p_type) as property_type,
  {by(k, quoted(["Entire home/apt", "PRIVATE ROOM", " shared room", "Hotel Room"]))} as room_type,
  {text("p_size % 8 + 1")} as accommodates,
  {by(k, ["'1.5'", "'2.5 baths'", "' Shared'", "null", "'n/a'"])} as bathrooms,
  case when {k} % 5 = 0 then null else {text("p_size % 4")} end as bedrooms,
  {text("p_size % 5")} || '.5' as beds,
  case when {k} % 31 = 30 then null when {k} % 37 = 36 then '[]' else {amenities} end as amenities,
  {by(k, [money(price), f"'$' || {money(price)}", f"' $1,' || {padded(f'{k} % 1000', 3)} || '.505 '"])} as price_per_night,
  case when {k} % 10 = 9 then null when {k} % 11 = 10 then 'abc' when {k} % 41 = 40 then '99999999999' else {text(f"{k} % 90")} end as cleaning_fee,
  case when {k} % 20 = 0 then '-1' when {k} % 21 = 0 then '0' else {text(f"1 + {k} % 5")} end as minimum_nights,
  '30' as maximum_nights,
  {by(k, quoted(["Flexible", " moderate", "STRICT "]))} as cancellation_policy,
  {by(f"{k} + 5", BOOLS)} as instant_bookable,
  ' Back Bay ' as neighborhood,
  {by(k, quoted(["new york", " BOSTON", "winston-salem ", "st. louis"]))} as city,
  {by(k, quoted(["US", "usa ", "United States", "united states of america", "fr "]))} as country,
  case when {k} % 50 = 49 then 'x' when {k} % 20 = 3 then {lon} else {lat} end as latitude,
  case when {k} % 20 = 3 then {lat} else {lon} end as longitude,
  {score_cols},
  {text(f"{k} % 200")} as number_of_reviews,
  {dirty_date("seen", f"{k} + 1")} as last_review_date,
  {lineage(load, k, "listing")}
from (select *, date '1995-03-01' + cast(p_partkey % 900 as int) as seen from part) p"""


def x_hosts(loads=(0, 1)) -> str:
    return " union all ".join(_hosts(i) for i in loads)


def x_listings(loads=(0, 1)) -> str:
    return " union all ".join(_listings(i) for i in loads)


def x_guests() -> str:
    k = "c_custkey"
    n = "num"
    a, b, d = f"substr({n}, 1, 3)", f"substr({n}, 4, 3)", f"substr({n}, 7, 4)"
    phones = [
        f"'(' || {a} || ') ' || {b} || '-' || {d}",
        f"{a} || '-' || {b} || '-' || {d}",
        f"'+1' || {n}",
        f"{a} || '.' || {b} || '.' || {d}",
        f"substr({n}, 1, 9)",
        f"'2' || {n}",
        "null",
    ]
    genders = quoted("M Male male MALE F Female female Other other Non-binary x")
    nations = quoted(["US", "USA", "United States", "united states", "United States of America", "de", " GB"])
    return f"""
select {spelled("CUS", k, k)} as guest_id,
  {by(k, ["'  ' || c_name || ' van-dyke'", "upper(c_name)", "lower(c_name)"])} as guest_name,
  ' ' || c_name || '@Mail.ORG' as guest_email,
  {by(k, phones)} as guest_phone,
  {dirty_date("born", k)} as date_of_birth,
  {dirty_date("joined", f"{k} + 2")} as guest_since,
  {by(k, [*nations, "null"])} as nationality,
  {by(k, [*genders, "null"])} as gender,
  ' ' || lower(c_mktsegment) || ' ' as preferred_language,
  {by(k, BOOLS)} as verified_id,
  case when {k} % 33 = 0 then '-1' when {k} % 7 = 0 then '0' else {text(f"{k} % 12")} end as total_trips,
  {by(k, ["'0.0'", f"'4.' || {padded(f'{k} % 100', 2)}", "'3.5'", "null"])} as average_rating_as_guest,
  case when {k} % 50 = 0 then 'Y' when {k} % 49 = 0 then null else 'no' end as is_banned,
  {lineage(0, k, "guest")}
from (select *, cast(6170000000 + c_custkey as string) as num,
        date '1960-01-01' + cast(c_custkey % 9000 as int) as born,
        date '1994-01-01' + cast(c_custkey % 300 as int) as joined from customer) c"""


def _bookings(load: int) -> str:
    k = "o_orderkey"
    listing = f"({k} % {N_PART})"
    host = f"(({k} % {N_PART} + case when {k} % 50 = 49 then 1 else 0 end) % {N_SUPPLIER})"
    stay = f"(1 + {k} % 14)"
    first = f"case when {k} % 20 = 19 then d_in + cast({stay} as int) else d_in end"
    last = f"case when {k} % 20 = 19 or {k} % 23 = 22 then d_in else d_in + cast({stay} as int) end"
    status = f"case when {load} = 1 or o_orderstatus = 'F' then 'completed' when o_orderstatus = 'O' then 'confirmed' else 'pending' end"
    platforms = quoted(["web", "Web ", "desktop", "mobile_ios", "Mobile iOS", "mobile_android", "api", "Smart TV"])
    service = f"case when {k} % 17 = 16 then null else {money('tp * 0.1')} end"
    where = "" if load == 0 else f"where {k} % 4 = 1"
    return f"""
select {booking_spelled(k, f"{k} + {load}")} as booking_id,
  {spelled("PRT", listing, k)} as listing_id,
  {spelled("CUS", f"({k} % {N_CUSTOMER})", f"{k} + 1")} as guest_id,
  {spelled("SUP", host, f"{k} + 2")} as host_id,
  case when {k} % 37 = 36 then '1995-02-30' else {dirty_date(f"({first})", k)} end as check_in_date,
  case when {k} % 41 = 40 then null else {dirty_date(f"({last})", f"{k} + 1")} end as check_out_date,
  {text(f"{stay} + case when {k} % 7 = 0 then 1 else 0 end")} as nights_count,
  {text(f"1 + {k} % 5")} as num_guests,
  '1' as num_adults,
  case when {k} % 33 = 32 then '-1' else {text(f"{k} % 5")} end as num_children,
  '0' as num_infants,
  {by(k, [status, f"upper({status})", f"' ' || {status}"])} as booking_status,
  case when {status} = 'completed' then case when {k} % 10 = 9 then 'Refunded' else 'PAID ' end else 'pending' end as payment_status,
  {text(f"tp + case when {k} % 9 = 8 then 5 when {k} % 9 = 7 then 0.5 else 0 end")} as total_price,
  {money("tp * 0.7")} as base_price,
  {money("tp * 0.1")} as cleaning_fee_charged,
  {service} as service_fee,
  case when {k} % 19 = 18 then '$12' else {money("tp * 0.1")} end as taxes,
  ' late arrival ' as special_requests,
  {text("cast(o_orderdate as date)")} || 'T10:00:00Z' as booked_at,
  {text(f"cast(o_orderdate as date) + cast({load} as int)")} || 'T12:30:00Z' as updated_at,
  {by(k, platforms)} as source_platform,
  case when {k} % 6 = 0 then ' SAVE10 ' else null end as promo_code,
  null as cancellation_reason,
  {lineage(load, k, "booking")}
from (select *, cast(o_totalprice as decimal(12,2)) as tp,
        cast(o_orderdate as date) + cast(o_orderkey % 45 - 3 as int) as d_in from orders {where}) o"""


def x_bookings(loads=(0, 1)) -> str:
    return " union all ".join(_bookings(i) for i in loads)


def x_reviews() -> str:
    q = "cast(l_quantity as int)"
    listing = f"(l_orderkey % {N_PART})"
    guest = spelled("CUS", f"(l_orderkey % {N_CUSTOMER})", "l_linenumber")
    host = spelled("SUP", f"({listing} % {N_SUPPLIER})", "l_linenumber")

    def rating(i: int) -> str:
        v = f"({q} + {i})"
        return by(
            f"l_linenumber + {i}",
            [
                f"{text(f'1 + {v} % 4')} || '.5'",
                f"'4,' || {text(f'{v} % 10')}",
                text(f"{v} % 50 * 2 + 1"),
                f"'3.' || {text(f'{v} % 10')} || ' stars'",
                "'0'",
                "'4.5.1'",
            ],
        )

    names = "overall cleanliness accuracy communication checkin location value".split()
    ratings = ",\n  ".join(f"{rating(i)} as {n}_rating" for i, n in enumerate(names))
    texts = [*quoted(["Great stay", "", "   ", ".", "N/A", "None", " ok"]), "null", "' so-so '"]
    stamp = (
        f"substr({text('l_shipdate')}, 1, 10) || 'T10:' || {padded(f'{q} % 60', 2)} || ':' || "
        f"{padded('l_suppkey % 60', 2)} || '.' || {padded('l_partkey % 1000000', 6)} || 'Z'"
    )
    toward_host = "l_linenumber % 2 = 0"
    return f"""
select {by("l_linenumber", [f"'REV-' || {padded('l_orderkey', 12)} || '-' || {text('l_linenumber')}", f"'rev' || {padded('l_orderkey', 12)} || {text('l_linenumber')}"])} as review_id,
  {booking_spelled("l_orderkey", "l_linenumber")} as booking_id,
  {spelled("PRT", listing, "l_linenumber")} as listing_id,
  case when {toward_host} then {guest} else {host} end as reviewer_id,
  case when {toward_host} then {host} else {guest} end as reviewee_id,
  case when {toward_host} then 'guest_to_host ' else 'host_to_guest' end as review_type,
  {ratings},
  {by(q, texts)} as review_text,
  {by(q, ["' Thanks '", "'n/a'", "''", "null"])} as response_text,
  {by("l_orderkey + l_linenumber", [*BOOLS, "'maybe'", "'t'"])} as is_public,
  {iso("l_shipdate")} as reviewed_at,
  timestamp '{LOADS[0]}' as _loaded_at, {stamp} as _stream_timestamp, 'review/0.json' as _source_file
from lineitem"""


def x_calendar() -> str:
    k = "l_orderkey"
    flags = [*BOOLS, "'Available'", "'blocked'", "'?'"]
    price = money("l_extendedprice")
    stamp = (
        f"'1996-01-01T05:' || {padded('l_suppkey % 60', 2)} || ':' || {padded('l_linenumber', 2)} || '.' || "
        f"{padded(f'{k} % 1000000', 6)} || 'Z'"
    )
    return f"""
select 'CAL-' || {text(k)} || '-' || {text("l_linenumber")} as calendar_id,
  {spelled("PRT", "l_partkey", k)} as listing_id,
  substr({text("l_shipdate")}, 1, 10) as calendar_date,
  {by(k, flags)} as is_available,
  {by(k, [f"'$' || {price}", price, "null"])} as price_on_date,
  {text("l_linenumber")} as minimum_nights_override,
  null as maximum_nights_override,
  ' note ' || l_returnflag || ' ' as notes,
  timestamp '{LOADS[0]}' as _loaded_at, {stamp} as _stream_timestamp, 'calendar/0.json' as _source_file
from lineitem"""


def event_word() -> str:
    k = "event_id"
    views = by(k, quoted("view View page_view VIEW"))
    clicks = by(k, quoted("click Listing_Click wishlist_add impression SearchImpression"))
    begun = by(k, quoted("booking_start BookingStart"))
    done = by(k, quoted("booking_confirmed BookingComplete bookingconfirmed"))
    return (
        f"case event_type when 'view' then {views} when 'click' then {clicks} "
        f"when 'signup' then {begun} when 'purchase' then {done} else upper(event_type) end"
    )


def _events(copy: int) -> str:
    k = "event_id"
    systems = [*quoted(["iOS 16.2", "macOS Ventura", " iPad OS 17 ", "Linux"]), "null"]
    countries = quoted(["USA", "us ", "GBR", "xx", "de"])
    where = "" if copy == 0 else f"where {k} % 10 = 0"
    return f"""
select {spelled("EVT", k, f"{k} + {copy}")} as event_id,
  {event_word()} as event_type,
  {spelled("PRT", f"({k} % {N_PART})", k)} as listing_id,
  case when {k} % 3 = 0 then null else {spelled("CUS", f"(user_id % {N_CUSTOMER})", k)} end as guest_id,
  ' ' || {text("user_id")} || '-' || substr({text("ts")}, 1, 10) as session_id,
  {by(k, quoted([" Mobile", "DESKTOP", "tablet ", "TV"]))} as device_type,
  {by(k, systems)} as os_version,
  ' Firefox ' as browser,
  {by(k, countries)} as country_code,
  ' beach ' as search_query,
  '$' || {money("value")} as price_shown,
  case when {k} % 25 = 24 then 'n/a' else {text(f"{k} % 21")} end as position_in_results,
  {iso("ts")} as event_timestamp,
  cast(ts as timestamp) as _loaded_at,
  substr({iso("ts")}, 1, 18) || '{copy}Z' as _stream_timestamp,
  'event/{copy}.json' as _source_file
from events {where}"""


def x_events() -> str:
    return " union all ".join(_events(i) for i in (0, 1))


RAW = {
    "hosts": x_hosts,
    "listings": x_listings,
    "guests": x_guests,
    "bookings": x_bookings,
    "reviews": x_reviews,
    "availability_calendar": x_calendar,
    "listing_events": x_events,
}

WINDOWS = (("1996-01-01", "1998-01-01"), ("1998-01-01", "2000-01-01"), ("2000-01-01", None))


def x_versions(table: str = "part", key: str = "p_partkey", amount: str = "p_retailprice") -> str:
    """One to three versions per key, each ten percent dearer than the last."""
    parts = []
    for i, (start, end) in enumerate(WINDOWS):
        until = f"timestamp '{end} 00:00:00'" if end else "cast(null as timestamp)"
        parts.append(
            f"select {key} as entity_id, {i} as version_no, "
            f"cast(cast({amount} as decimal(10,2)) * {10 + i} / 10 as decimal(12,2)) as amount, "
            f"timestamp '{start} 00:00:00' as valid_from, {until} as valid_to "
            f"from {table} where {key} % 3 >= {i}"
        )
    return " union all ".join(parts)


RUNS = ("1996-01-01 00:00:00", "1997-01-01 00:00:00", "1998-01-01 00:00:00")


def x_hist_batch(b: int) -> str:
    """Supplier state at run ``b``: some balances change, some keys are absent."""
    change = " + ".join(f"case when s_suppkey % 5 = {i} then 10 else 0 end" for i in range(1, b + 1)) or "0"
    return (
        f"select s_suppkey, s_name, s_nationkey, "
        f"cast(cast(s_acctbal as decimal(12,2)) + {change} as decimal(12,2)) as acctbal "
        f"from supplier where s_suppkey % 17 <> {b + 3}"
    )


# The table whose rows a feed spells out.
FEED_OF = {
    "hosts": "supplier",
    "listings": "part",
    "guests": "customer",
    "bookings": "orders",
    "reviews": "lineitem",
    "availability_calendar": "lineitem",
    "listing_events": "events",
}
# Rows of that table in one task. Feed rows are many times as wide, and keep-latest
# sorts those of a task: read as they lie, a row group is one task, however large.
FEED_ROWS = 100_000


class Source:
    """The given tables of one folder, read when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._known: set[str] = set()
        self._dealt: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def dealt(self, name: str) -> DataFrame:
        """The table, dealt evenly over tasks of ``FEED_ROWS`` rows by their places in the files."""
        if name not in self._dealt:
            rows = self.table(name)
            tasks = -(-rows.count() // FEED_ROWS)
            if tasks > 1:
                placed = rows.withColumn("_place", F.col("_metadata.row_index"))
                rows = placed.repartition(tasks, "_place").drop("_place")
            self._dealt[name] = rows
        return self._dealt[name]

    def sql(self, text: str) -> DataFrame:
        """Run an adapter text over temp views of the tables it names."""
        for name in set(re.findall(r"\b(?:from|join)\s+(\w+)", text)) & set(BASE_TABLES):
            if name not in self._known:
                self.table(name).createOrReplaceTempView(name)
                self._known.add(name)
        return self.spark.sql(text)

    def raw(self, entity: str, loads=None) -> DataFrame:
        text = RAW[entity]() if loads is None else RAW[entity](loads)
        name = FEED_OF[entity]
        self.dealt(name).createOrReplaceTempView(name)
        self._known.add(name)
        out = self.sql(text)
        self._known.remove(name)  # other texts read the table as it lies
        return out
