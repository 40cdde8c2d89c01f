"""One query per operator, over the given tables and the feeds derived from them."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import clean as c
from tidemark.operators import audit, history, joins, quality, rollup, shape
from tidemark.operators.latest import high_water, keep_latest, since
from tidemark.operators.merge import merge_upsert, repeated_keys
from tidemark.session import scratch
from tidemark.sources import calendar, landing, schemas
from tidemark.sources.tables import PublishedTable
from tidemark.workload import adapters as a
from tidemark.workload import duck as d
from tidemark.workload.registry import query

FIRST = datetime(1900, 1, 1, tzinfo=timezone.utc)


# ---- sources and sinks ------------------------------------------------------
_FEED = (
    "select event_id, user_id, event_type, cast(cast(value as decimal(10,2)) as string) as value, props, "
    f"{a.iso('ts')} as event_timestamp, cast(year(ts) as int) as year, cast(month(ts) as int) as month, "
    "cast(day(ts) as int) as day from events"
)
_FEED_COLS = "event_id user_id event_type value props event_timestamp".split()
_FEED_TEXT = (
    "select cast(event_id as string) as event_id, cast(user_id as string) as user_id, event_type, "
    "cast(cast(value as decimal(10,2)) as string) as value, props, "
    f"{a.iso('ts')} as event_timestamp from events"
)


def _land(src, partitioned: bool = False) -> str:
    """Write the events as landed JSON lines below the shared folder."""
    path = scratch(src.spark, "landing")
    writer = src.sql(_FEED).write
    if partitioned:
        writer = writer.partitionBy(*landing.PARTITIONS)
    writer.json(path)
    return path


def _feed_schema():
    return schemas.text_schema(_FEED_COLS)


@query("land_scan", _FEED_TEXT)
def land_scan(src):
    good, _ = landing.read_landing(src.spark, _land(src), _feed_schema())
    return good.select(*_FEED_COLS)


@query("raw_project", "select event_id, json_extract_string(props, '$.k') as k, json_extract_string(props, '$.none') as none from events")
def raw_project(src):
    rows = src.table("events").select("event_id", "props")
    return landing.project_text(rows, "props", ["k", "none"]).drop("props")


@query("raw_lineage", "select cast(event_id as string) as event_id, true as has_file, true as has_load_time from events")
def raw_lineage(src):
    good, _ = landing.read_landing(src.spark, _land(src), _feed_schema())
    return good.select(
        "event_id",
        F.col("_source_file").endswith(".json").alias("has_file"),
        F.col("_loaded_at").isNotNull().alias("has_load_time"),
    )


_TOKENS = (
    "select doc_id, case doc_id % 7 when 0 then 'NULL' when 1 then 'null' when 2 then '' "
    "when 3 then 'Null' else text end as text, lang from documents"
)


@query("null_tokens", f"select doc_id, case when text in ('NULL', 'null', '') then null else text end as text, lang from ({_TOKENS}) x")
def null_tokens(src):
    return landing.null_out(src.sql(_TOKENS))


@query(
    "bad_records",
    "select case when event_id % 10 = 3 then 'bad' else 'good' end as outcome, count(*) as n from events group by 1",
)
def bad_records(src):
    lines = src.sql(_FEED).select(
        F.when(F.col("event_id") % 10 == 3, F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "x')))
        .otherwise(F.to_json(F.struct(*_FEED_COLS)))
        .alias("value")
    )
    path = scratch(src.spark, "broken")
    lines.write.text(path)
    good, bad = landing.read_landing(src.spark, path, _feed_schema())
    both = good.select(F.lit("good").alias("outcome"), "_source_file").unionByName(
        bad.select(F.lit("bad").alias("outcome"), "_source_file")
    )
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("land_prune", f"select * from ({_FEED_TEXT}) where substr(event_timestamp, 1, 10) between '2024-01-05' and '2024-01-09'")
def land_prune(src):
    only = (F.col("year") == 2024) & (F.col("month") == 1) & F.col("day").between(5, 9)
    good, _ = landing.read_landing(src.spark, _land(src, True), _feed_schema(), only=only)
    return good.select(*_FEED_COLS)


_SINKS = {"view": "browsing", "click": "browsing", "signup": "accounts", "purchase": "sales"}


@query(
    "route_entities",
    "select event_id, case when event_type in ('view', 'click') then 'browsing' when event_type = 'signup' then 'accounts' "
    "when event_type = 'purchase' then 'sales' else 'unrouted' end as sink from events",
)
def route_entities(src):
    events = src.table("events").select("event_id", "event_type")
    sinks = landing.route(events, "event_type", _SINKS)
    sinks["unrouted"] = landing.unrouted(events, "event_type", _SINKS)
    return shape.union_all([df.select("event_id", F.lit(name).alias("sink")) for name, df in sinks.items()])


@query(
    "incr_sink",
    "select o_orderkey, o_totalprice, case when o_orderdate >= (select max(o_orderdate) from orders where o_orderdate < "
    "timestamp '1999-01-01') then 'second' else 'first' end as load from orders",
)
def incr_sink(src):
    orders = src.table("orders").select(
        "o_orderkey", "o_totalprice", F.col("o_orderdate").cast("timestamp").alias("_loaded_at")
    )
    table = PublishedTable(src.spark, scratch(src.spark, "orders"), ["o_orderkey"], 8, "_loaded_at")
    early = orders.filter(F.col("_loaded_at") < F.lit("1999-01-01").cast("timestamp"))
    table.merge(early.withColumn("load", F.lit("first")))
    later = since(orders, "_loaded_at", table.high_water(FIRST))
    table.merge(later.withColumn("load", F.lit("second")))
    return table.read().drop("_loaded_at")


_DAYS_SQL = """
with b as (select cast(min(o_orderdate) as date) as lo, cast(max(o_orderdate) as date) as hi from orders),
days as (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as full_date from b),
p as (select *, year(full_date) as y, month(full_date) as m, day(full_date) as dd, isodow(full_date) as w from days)
select full_date, y * 10000 + m * 100 + dd as date_key, y as year, m as month, monthname(full_date) as month_name,
  quarter(full_date) as quarter, dayname(full_date) as day_name, w >= 6 as is_weekend,
  (m = 1 and dd = 1) or (m = 1 and w = 1 and dd between 15 and 21) or (m = 2 and w = 1 and dd between 15 and 21)
  or (m = 5 and w = 1 and dd >= 25) or (m = 6 and dd = 19 and y >= 2021) or (m = 7 and dd = 4)
  or (m = 9 and w = 1 and dd <= 7) or (m = 10 and w = 1 and dd between 8 and 14) or (m = 11 and dd = 11)
  or (m = 11 and w = 4 and dd between 22 and 28) or (m = 12 and dd = 25) as is_us_federal_holiday,
  case when m in (12, 1, 2) then 'Winter' when m <= 5 then 'Spring' when m <= 8 then 'Summer' else 'Fall' end as season
from p"""


def order_days(src) -> DataFrame:
    day = F.to_date("o_orderdate")
    bounds = src.table("orders").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    return calendar.expand_dates(bounds)


@query("dim_date", _DAYS_SQL)
def dim_date(src):
    return order_days(src)


@query("schema_sync", "select p_partkey, p_name, case when p_partkey % 2 = 0 then p_brand end as p_brand from part")
def schema_sync(src):
    part = src.table("part")
    stored = part.select("p_partkey", "p_name", "p_size")
    batch = part.filter(F.col("p_partkey") % 2 == 0).select("p_partkey", "p_name", "p_brand")
    return merge_upsert(stored, batch, ["p_partkey"])


_AS_OF = "2024-01-31 01:50:00"


@query(
    "freshness",
    f"""
with m as (select event_type as source_name, max(ts) as max_loaded_at from events group by 1
  union all select 'orders', max(o_orderdate) from orders)
select source_name, max_loaded_at, datediff('second', max_loaded_at, timestamp '{_AS_OF}') as age_seconds,
  case when datediff('second', max_loaded_at, timestamp '{_AS_OF}') > 8 * 3600 then 'error'
    when datediff('second', max_loaded_at, timestamp '{_AS_OF}') > 2 * 3600 then 'warn' else 'pass' end as status from m""",
)
def freshness(src):
    events = src.table("events").select(F.col("event_type").alias("name"), F.col("ts").alias("_loaded_at"))
    orders = src.table("orders").select(F.lit("orders").alias("name"), F.col("o_orderdate").alias("_loaded_at"))
    return audit.freshness_by(shape.union_all([events, orders]), "name", _AS_OF)


_AUDITED = "customer events lineitem nation orders part supplier".split()


@query(
    "row_count_audit",
    " union all ".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in _AUDITED),
)
def row_count_audit(src):
    return audit.row_counts({t: src.table(t) for t in _AUDITED})


@query(
    "load_audit",
    """
with l as (select substr(cast(ts as string), 1, 10) as file_name, max(ts) as last_load_time, count(*) as row_count,
  count(*) filter (where event_type = 'error' and user_id % 5 = 0 and day(ts) % 4 = 1) as error_count from events group by 1)
select *, 7 as batch_id, case when error_count = 0 then 'Loaded' when error_count < row_count then 'Partially loaded'
  else 'Load failed' end as status
from l where last_load_time >= timestamp '2024-01-10 00:00:00' and error_count > 0""",
)
def load_audit(src):
    landed = src.sql(
        "select substr(cast(ts as string), 1, 10) as _source_file, ts as _loaded_at, case when event_type = 'error' "
        "and user_id % 5 = 0 and day(ts) % 4 = 1 then 'broken' end as _corrupt_record from events"
    )
    return audit.load_audit(audit.load_log(landed, batch_id=7), "2024-01-10 00:00:00")


@query(
    "preview",
    "select o_orderkey, o_orderstatus, o_totalprice * 0.7 + o_totalprice * 0.3 as calc_total from orders order by o_orderkey limit 10",
)
def preview(src):
    total = F.col("o_totalprice") * F.lit(0.7) + F.col("o_totalprice") * F.lit(0.3)
    return audit.preview(
        src.table("orders"), ["o_orderkey", "o_orderstatus", total.alias("calc_total")], ["o_orderkey"]
    )


# ---- projections and predicates ---------------------------------------------
@query("role_project", "select p_partkey as listing_id, p_retailprice as listed_price_at_booking, p_type as type_at_booking from part")
def role_project(src):
    roles = {"p_partkey": "listing_id", "p_retailprice": "listed_price_at_booking", "p_type": "type_at_booking"}
    return shape.rename_project(src.table("part"), roles)


_GUEST_FLAGS = (
    "select c_custkey as guest_id, c_name as guest_name, case when c_custkey % 50 = 0 then true "
    "when c_custkey % 49 = 0 then null else false end as is_banned from customer"
)


@query("dim_guests", f"select md5(cast(guest_id as varchar)) as guest_key, * from ({_GUEST_FLAGS}) where not coalesce(is_banned, false)")
def dim_guests(src):
    guests = src.sql(_GUEST_FLAGS).filter(~c.flag(F.col("is_banned")))
    return guests.withColumn("guest_key", c.surrogate_key(F.col("guest_id").cast("string")))


@query(
    "hwm_filter",
    "select event_id, event_type from events where ts >= (select max(ts) from events where event_id % 100 < 50 and ts < timestamp '2024-01-15')",
)
def hwm_filter(src):
    events = src.table("events")
    stored = events.filter((F.col("event_id") % 100 < 50) & (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")))
    mark = high_water(stored, "ts", FIRST)
    at_utc = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return since(at_utc, "ts", mark).select("event_id", "event_type")


@query(
    "dq_flags",
    "select o_orderkey, coalesce(o_totalprice > 250000 and o_orderpriority <> '5-LOW', false) as is_big_urgent, "
    "coalesce(nullif(o_orderstatus, 'P') = 'F', false) as is_final from orders",
)
def dq_flags(src):
    urgent = (F.col("o_totalprice") > 250000) & (F.col("o_orderpriority") != "5-LOW")
    final = F.nullif(F.col("o_orderstatus"), F.lit("P")) == "F"
    return src.table("orders").select(
        "o_orderkey", c.flag(urgent).alias("is_big_urgent"), c.flag(final).alias("is_final")
    )


_CODES = f"select event_id, {a.event_word()} as word from events"


@query("funnel_step", f"select event_id, {d.funnel(d.event_type('word'))} as step from ({_CODES}) x")
def funnel_step(src):
    code = c.map_event_type(F.col("word"))
    return src.sql(_CODES).select("event_id", c.funnel_step(code).alias("step"))


@query(
    "predicates",
    "select p_partkey, p_name from part where p_size not between 10 and 20 and p_name like '%ring%' and "
    "p_type in ('ECONOMY', 'STANDARD', 'PROMO') and p_brand <> 'Brand#2' and regexp_matches(p_brand, '^Brand#[0-9]+$')",
)
def predicates(src):
    keep = (
        ~F.col("p_size").between(10, 20)
        & F.col("p_name").like("%ring%")
        & F.col("p_type").isin("ECONOMY", "STANDARD", "PROMO")
        & (F.col("p_brand") != "Brand#2")
        & F.col("p_brand").rlike("^Brand#[0-9]+$")
    )
    return src.table("part").filter(keep).select("p_partkey", "p_name")


# ---- joins ------------------------------------------------------------------
_PART_VERSIONS = a.x_versions()
_SUPPLIER_VERSIONS = a.x_versions("supplier", "s_suppkey", "s_acctbal")
_ORDER_FACT = (
    f"select o_orderkey, o_orderkey % {a.N_PART} as listing, o_orderkey % {a.N_SUPPLIER} as host, "
    "cast(o_orderdate as timestamp) as booked_at from orders"
)


def _asof_oracle(versions: str, key: str) -> str:
    return f"""
with v as (select *, case when row_number() over (partition by entity_id order by valid_from) = 1 then timestamp '1900-01-01'
  else valid_from end as eff from ({versions}) x)
select o.o_orderkey, v.version_no, cast(v.amount as double) as amount from ({_ORDER_FACT}) o left join v
on o.{key} = v.entity_id and o.booked_at >= v.eff and o.booked_at < coalesce(v.valid_to, timestamp '9999-12-31')"""


def _asof(src, versions: str, key: str) -> DataFrame:
    dim = history.backdate_first(src.sql(versions), "entity_id")
    out = joins.asof_join(src.sql(_ORDER_FACT), dim, key, "entity_id", "booked_at", ["version_no", "amount"])
    return out.select("o_orderkey", "version_no", "amount")


@query("asof_listing", _asof_oracle(_PART_VERSIONS, "listing"))
def asof_listing(src):
    return _asof(src, _PART_VERSIONS, "listing")


@query("asof_host", _asof_oracle(_SUPPLIER_VERSIONS, "host"))
def asof_host(src):
    return _asof(src, _SUPPLIER_VERSIONS, "host")


_ORDER_GUEST = "select o_orderkey, case when o_orderkey % 3 = 0 then null else o_custkey + 3 end as guest_id from orders"


@query(
    "join_guest",
    f"select o_orderkey, guest_id, c_name, c_mktsegment as segment from ({_ORDER_GUEST}) o left join customer on guest_id = c_custkey",
)
def join_guest(src):
    cols = {"c_name": "c_name", "c_mktsegment": "segment"}
    return joins.lookup_join(src.sql(_ORDER_GUEST), src.table("customer"), "guest_id", "c_custkey", cols)


@query(
    "join_date",
    f"with dd as ({_DAYS_SQL}) select o_orderkey, date_key, day_name, season from orders left join dd on "
    "cast(o_orderdate as date) + 30 = full_date",
)
def join_date(src):
    orders = src.table("orders").select("o_orderkey", F.date_add("o_orderdate", 30).alias("check_in"))
    out = joins.date_join(orders, order_days(src), "check_in", ["date_key", "day_name", "season"])
    return out.drop("check_in")


_EVENT_FACT = f"select event_id, event_id % {a.N_PART} as listing from events"


@query(
    "join_current",
    f"select event_id, version_no, cast(amount as double) as amount from ({_EVENT_FACT}) e left join "
    f"(select * from ({_PART_VERSIONS}) x where valid_to is null) v on listing = entity_id",
)
def join_current(src):
    dim = src.sql(_PART_VERSIONS).withColumn("is_current_record", F.col("valid_to").isNull())
    out = joins.current_join(src.sql(_EVENT_FACT), dim, "listing", "entity_id", ["version_no", "amount"])
    return out.drop("listing")


_ROLE_FACT = """
select l_orderkey, l_linenumber, l_extendedprice,
  case l_linenumber % 3 when 0 then 'guest_to_host' when 1 then 'host_to_guest' else 'other' end as role,
  case when l_linenumber % 3 = 0 then l_orderkey % 2000 else l_suppkey end as reviewer,
  case when l_linenumber % 3 = 0 then l_suppkey else l_orderkey % 2000 end as reviewee from lineitem"""


@query(
    "role_join",
    f"""select r.l_orderkey, r.l_linenumber, r.l_extendedprice, s.s_name, c.c_name from ({_ROLE_FACT}) r
left join supplier s on (role = 'guest_to_host' and reviewee = s_suppkey) or (role = 'host_to_guest' and reviewer = s_suppkey)
left join customer c on (role = 'guest_to_host' and reviewer = c_custkey) or (role = 'host_to_guest' and reviewee = c_custkey)""",
)
def role_join(src):
    hosts = {"guest_to_host": "reviewee", "host_to_guest": "reviewer"}
    guests = {"guest_to_host": "reviewer", "host_to_guest": "reviewee"}
    j = joins.role_join(src.sql(_ROLE_FACT), src.table("supplier"), "role", hosts, "s_suppkey", ["s_name"])
    j = joins.role_join(j, src.table("customer"), "role", guests, "c_custkey", ["c_name"])
    return j.select("l_orderkey", "l_linenumber", "l_extendedprice", "s_name", "c_name")


@query(
    "review_booking",
    "select l_orderkey, l_linenumber, l_partkey, o_orderstatus, o_totalprice from lineitem left join orders on l_orderkey + 50 = o_orderkey",
)
def review_booking(src):
    lines = src.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.lookup_join(
        lines, src.table("orders"), F.col("l_orderkey") + 50, "o_orderkey", ["o_orderstatus", "o_totalprice"]
    )


_EVENT_DAYS = _DAYS_SQL.replace("o_orderdate", "ts").replace("from orders", "from events")


@query(
    "join_event_date",
    f"with dd as ({_EVENT_DAYS}) select event_id, date_key, is_weekend from events left join dd on cast(ts as date) = full_date",
)
def join_event_date(src):
    events = src.table("events")
    day = F.to_date("ts")
    bounds = events.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    out = joins.date_join(events.select("event_id", "ts"), calendar.expand_dates(bounds), "ts", ["date_key", "is_weekend"])
    return out.drop("ts")


_HOSTED = (
    f"select o_orderkey, o_custkey % {a.N_PART} as listing, case when o_orderkey % 11 = 0 then null "
    f"when o_orderkey % 7 = 0 then 0 else o_custkey % {a.N_PART} % {a.N_SUPPLIER} end as host from orders"
)
_OWNED = f"select p_partkey as listing, p_partkey % {a.N_SUPPLIER} as host from part"


@query(
    "host_mismatch",
    f"select o_orderkey, o.listing, o.host from ({_HOSTED}) o join ({_OWNED}) p on o.listing = p.listing where o.host <> p.host",
)
def host_mismatch(src):
    return joins.mismatches(src.sql(_HOSTED), src.sql(_OWNED), "listing", "host", "host")


_CHILD = (
    "select l_orderkey * 10 + l_linenumber as line_id, case when l_orderkey % 9 = 0 then null else l_orderkey + 500 end as fk from lineitem"
)


# One order holds a third of the lines, others have no key.
_SKEWED = """select l_orderkey * 10 + l_linenumber as line_id, l_quantity,
  case when l_linenumber % 3 = 0 then 1 when l_linenumber % 5 = 0 then null else l_orderkey end as fk, l_shipdate as at from lineitem"""
_VERSIONS = """select o_orderkey as k, 1 as version, o_orderdate as starts, o_orderdate + interval 60 days as ends from orders
union all select o_orderkey, 2, o_orderdate + interval 60 days, null from orders"""


@query(
    "asof_hot_key",
    f"""select f.line_id, f.fk, v.version from ({_SKEWED}) f left join ({_VERSIONS}) v
on f.fk = v.k and f.at >= v.starts and (v.ends is null or f.at < v.ends)""",
)
def asof_hot_key(src):
    fact, dim = src.sql(_SKEWED), src.sql(_VERSIONS)
    hot = joins.hot_keys(fact, {"fk": "fk"})["fk"]
    return joins.asof_join(fact, dim, "fk", "k", "at", ["version"], "starts", "ends", hot=hot).select(
        "line_id", "fk", "version"
    )


# One key has a version for every day on which orders came in, thousands in all.
_DAILY = f"""select 1 as k, year(d) * 10000 + month(d) * 100 + day(d) as version, d as starts, d + interval 1 day as ends
from (select distinct cast(o_orderdate as timestamp) as d from orders) x
union all select k, version, cast(starts as timestamp), cast(ends as timestamp) from ({_VERSIONS}) y where k <> 1"""


@query(
    "asof_many_versions",
    f"""select f.line_id, f.fk, v.version from ({_SKEWED}) f left join ({_DAILY}) v
on f.fk = v.k and f.at >= v.starts and (v.ends is null or f.at < v.ends)""",
)
def asof_many_versions(src):
    fact, dim = src.sql(_SKEWED), src.sql(_DAILY)
    hot = joins.hot_keys(fact, {"fk": "fk"})["fk"]
    return joins.asof_join(fact, dim, "fk", "k", "at", ["version"], "starts", "ends", hot=hot).select(
        "line_id", "fk", "version"
    )


@query(
    "orphans_hot_key",
    f"select line_id, fk from ({_SKEWED}) x left join (select o_orderkey from orders where o_orderkey % 2 = 1) o "
    "on fk = o_orderkey where o_orderkey is null",
)
def orphans_hot_key(src):
    child = src.sql(_SKEWED).select("line_id", "fk")
    odd = src.table("orders").filter("o_orderkey % 2 = 1")
    hot = joins.hot_keys(child, {"fk": "fk"})["fk"]
    return joins.orphans(child, odd, "fk", "o_orderkey", hot=hot)


@query(
    "lookup_mixed_types",
    f"select f.line_id, f.fk, o.o_totalprice from ({_SKEWED}) f left join orders o on f.fk = o.o_orderkey",
)
def lookup_mixed_types(src):
    fact = src.sql(_SKEWED)
    orders = src.table("orders").withColumn("k", F.col("o_orderkey").cast("decimal(20,2)"))
    hot = joins.hot_keys(fact, {"fk": "fk"})["fk"]
    return joins.lookup_join(fact, orders, "fk", "k", ["o_totalprice"], hot=hot).select("line_id", "fk", "o_totalprice")


@query("orphans", f"select line_id, fk from ({_CHILD}) x left join orders on fk = o_orderkey where o_orderkey is null")
def orphans(src):
    return joins.orphans(src.sql(_CHILD), src.table("orders"), "fk", "o_orderkey")


@query(
    "role_check",
    f"""select l_orderkey, l_linenumber, l_extendedprice from (
  select *, case when role = 'guest_to_host' then reviewer else reviewee end as guest,
         case when role = 'guest_to_host' then reviewee else reviewer end as host
  from ({_ROLE_FACT}) f where role <> 'other') named
where not exists (select 1 from customer where c_custkey = named.guest)
   or not exists (select 1 from supplier where s_suppkey = named.host)""",
)
def role_check(src):
    parties = {
        "guest_to_host": {"guests": "reviewer", "hosts": "reviewee"},
        "host_to_guest": {"hosts": "reviewer", "guests": "reviewee"},
    }
    dims = {"guests": (src.table("customer"), "c_custkey"), "hosts": (src.table("supplier"), "s_suppkey")}
    out = joins.role_violations(src.sql(_ROLE_FACT), "role", parties, dims)
    return out.select("l_orderkey", "l_linenumber", "l_extendedprice")


_LAPPED = (
    "select cast(entity_id as string) as entity_id, cast(entity_id as string) || '/' || cast(version_no as string) as version_key, "
    "case when entity_id % 7 = 2 and version_no = 1 then timestamp '1997-06-01 00:00:00' else valid_from end as eff, "
    f"valid_to from ({_PART_VERSIONS}) v"
)


@query(
    "scd_overlap",
    f"""with v as ({_LAPPED})
select b.entity_id, b.version_key, b.eff as starts_at, max(coalesce(p.valid_to, timestamp '9999-12-31')) as covered_until
from v p join v b on p.entity_id = b.entity_id and (p.eff, p.version_key) < (b.eff, b.version_key)
  and p.eff < coalesce(b.valid_to, timestamp '9999-12-31') and b.eff < coalesce(p.valid_to, timestamp '9999-12-31')
group by 1, 2, 3""",
)
def scd_overlap(src):
    return history.overlaps(src.sql(_LAPPED), "entity_id", "version_key", "eff", "valid_to")


@query(
    "reconcile",
    "select count(*) as all_orders, count(*) filter (where o_orderstatus = 'F') as finished, count(*) filter (where o_orderstatus = 'O') "
    "as open_orders, false as reconciles from orders",
)
def reconcile(src):
    orders = src.table("orders")
    parts = {
        "finished": orders.filter(F.col("o_orderstatus") == "F"),
        "open_orders": orders.filter(F.col("o_orderstatus") == "O"),
    }
    return rollup.reconcile_counts(orders, parts, "all_orders")


# ---- aggregations -----------------------------------------------------------
_STEPPED = (
    "select event_id, cast(user_id as string) || '-' || substr(cast(ts as string), 1, 10) as session_id, cast(ts as timestamp) as ts, "
    "case when event_id % 3 = 0 then null else cast(user_id as string) end as guest_id, "
    f"{a.padded(f'event_id % {a.N_PART}', 12)} as listing_id, {d.event_type(a.event_word())} as code from events"
)
_STEPS = list(c.FUNNEL_STEPS)
_ROLLUP_SQL = (
    "select session_id, min(ts) as session_started_at, max(ts) as session_ended_at, min(guest_id) as guest_id, "
    "min(listing_id) as listing_id, count(*) as event_count, max(" + d.funnel("code") + ") as furthest_funnel_step, "
    + ", ".join(f"count_if(code = '{s}') > 0 as had_{s}" for s in _STEPS)
    + f" from ({_STEPPED}) e group by session_id"
)


def sessions(src) -> DataFrame:
    return rollup.session_rollup(
        src.sql(_STEPPED), "session_id", "ts", "code", c.FUNNEL_STEPS, ["guest_id", "listing_id"]
    )


@query("session_rollup", _ROLLUP_SQL)
def session_rollup(src):
    return sessions(src)


@query(
    "session_metrics",
    "select session_id, datediff('second', session_started_at, session_ended_at) as session_duration_seconds, "
    f"had_booking_start and not had_booking_complete as abandoned_after_booking_start from ({_ROLLUP_SQL}) s",
)
def session_metrics(src):
    return rollup.session_metrics(sessions(src)).select(
        "session_id", "session_duration_seconds", "abandoned_after_booking_start"
    )


_CHAIN = ("view", "click", "booking_start", "booking_complete")
_GAPS = " or ".join(f"had_{b} > had_{a}" for a, b in zip(_CHAIN, _CHAIN[1:]))


@query("funnel_check", f"select session_id from ({_ROLLUP_SQL}) s where {_GAPS}")
def funnel_check(src):
    from tidemark.plans.checks import FUNNEL_CHAIN

    return rollup.funnel_gaps(sessions(src), FUNNEL_CHAIN).select("session_id")


@query("dup_keys", "select l_orderkey, l_linenumber, count(*) as cnt from lineitem group by 1, 2 having count(*) > 1")
def dup_keys(src):
    return repeated_keys(src.table("lineitem"), ["l_orderkey", "l_linenumber"])


_RATED = "select l_orderkey, l_linenumber, l_partkey, nullif(l_quantity, 10) as a, nullif(l_tax, 0) as b, nullif(l_discount, 0) as c from lineitem"


@query(
    "avg_present",
    "select l_orderkey, l_linenumber, l_partkey, "
    + d.rounded(
        "((0.0::double + coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)) / nullif((a is not null)::int + (b is not null)::int + (c is not null)::int, 0))",
        1,
    )
    + f" as mean from ({_RATED}) x",
)
def avg_present(src):
    mean = c.mean_present(F.col("a"), F.col("b"), F.col("c"), scale=1)
    return src.sql(_RATED).select("l_orderkey", "l_linenumber", "l_partkey", mean.alias("mean"))


# ---- keep latest ------------------------------------------------------------
_LINE_COLS = "l_orderkey l_linenumber l_partkey l_suppkey l_extendedprice l_shipdate".split()
_STAMPED = (
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, case when l_partkey % 13 = 0 then null "
    "else cast(l_shipdate as timestamp) end as seen, cast(l_shipdate as date) as day from lineitem"
)
_TIES = "l_partkey l_suppkey l_extendedprice".split()


@query(
    "dedup_latest",
    d.latest(f"({_STAMPED}) x", "l_orderkey, l_linenumber", "seen; l_partkey; l_suppkey; l_extendedprice"),
)
def dedup_latest(src):
    return keep_latest(src.sql(_STAMPED), ["l_orderkey", "l_linenumber"], ["seen"], _TIES)


@query(
    "dedup_composite",
    d.latest(f"({_STAMPED}) x", "l_partkey, day", "seen; l_orderkey; l_linenumber; l_suppkey; l_extendedprice"),
)
def dedup_composite(src):
    ties = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    return keep_latest(src.sql(_STAMPED), ["l_partkey", "day"], ["seen"], ties)


_TWICE = " union all ".join(
    f"select o_orderkey, {p} as pass, o_orderstatus, case when o_orderkey % 13 = {p} then 'bad' else "
    f"{a.text(f'cast(o_orderdate as date) + cast((o_orderkey % 5) * {p} as int)')} || 'T00:00:00Z' end as updated_at, "
    f"'{a.LOADS[p][:10]}T00:00:00Z' as streamed, timestamp '{a.LOADS[p]}' as loaded from orders"
    for p in (0, 1)
)


@query("dedup_bookings", d.latest(f"({_TWICE}) x", "o_orderkey", f"{d.ts('updated_at')}; {d.ts('streamed')}; loaded"))
def dedup_bookings(src):
    order = [c.clean_ts(F.col("updated_at")), c.clean_ts(F.col("streamed")), F.col("loaded")]
    return keep_latest(src.sql(_TWICE), ["o_orderkey"], order)


_SPELLINGS = " union all ".join(
    f"select {a.spelled('SUP', 's_suppkey', f's_suppkey + {p}')} as host_id, s_name, {p} as pass, "
    f"timestamp '{a.RUNS[p]}' as loaded from supplier"
    for p in (0, 1, 2)
)
_CANONICAL = f"select {d.clean_id('host_id')} as host_id, s_name, pass, loaded from ({_SPELLINGS}) s"


@query("dedup_canonical", d.latest(f"({_CANONICAL}) x", "host_id", "loaded"))
def dedup_canonical(src):
    cleaned = src.sql(_SPELLINGS).withColumn("host_id", c.clean_id(F.col("host_id")))
    return keep_latest(cleaned, ["host_id"], ["loaded"])


@query(
    "backdate_first",
    f"""select entity_id, version_no, cast(amount as double) as amount, valid_from, valid_to, case when row_number() over
(partition by entity_id order by valid_from) = 1 then timestamp '1900-01-01' else valid_from end as effective_valid_from
from ({_PART_VERSIONS}) v""",
)
def backdate_first(src):
    return history.backdate_first(src.sql(_PART_VERSIONS), "entity_id")


# ---- state ------------------------------------------------------------------
_CUT = "timestamp '1999-01-01 00:00:00'"
_TARGET = f"select o_orderkey, o_totalprice, 'old' as origin from orders where o_orderdate < {_CUT} or o_orderkey % 3 = 0"
_BATCH = f"select o_orderkey, o_totalprice + 1 as o_totalprice, 'new' as origin from orders where o_orderdate >= {_CUT}"
_MERGED = f"select * from ({_TARGET}) t where o_orderkey not in (select o_orderkey from ({_BATCH}) b) union all select * from ({_BATCH}) b2"


@query("merge_upsert", _MERGED)
def merged(src):
    return merge_upsert(src.sql(_TARGET), src.sql(_BATCH), ["o_orderkey"])


@query("replay", _MERGED)
def replay(src):
    batch = src.sql(_BATCH)
    once = merge_upsert(src.sql(_TARGET), batch, ["o_orderkey"])
    return merge_upsert(once, batch, ["o_orderkey"])


_SLOTS = "select l_partkey, cast(l_shipdate as date) as day, max(l_extendedprice) as price, {0} as load from lineitem where {1} group by 1, 2"
_SLOT_OLD = _SLOTS.format(1, "l_linenumber <= 5")
_SLOT_NEW = _SLOTS.format(2, "l_linenumber >= 5")


@query(
    "merge_composite",
    f"select t.* from ({_SLOT_OLD}) t anti join ({_SLOT_NEW}) b on t.l_partkey = b.l_partkey and t.day = b.day "
    f"union all select * from ({_SLOT_NEW}) b2",
)
def merge_composite(src):
    return merge_upsert(src.sql(_SLOT_OLD), src.sql(_SLOT_NEW), ["l_partkey", "day"])


@query("merge_append", "select event_id, event_type, case when event_id % 100 >= 40 then 2 else 1 end as load from events")
def merge_append(src):
    events = src.table("events").select("event_id", "event_type")
    first = events.filter(F.col("event_id") % 100 < 60).withColumn("load", F.lit(1))
    again = events.filter(F.col("event_id") % 100 >= 40).withColumn("load", F.lit(2))
    return merge_upsert(first, again, ["event_id"])


@query(
    "late_rows",
    "select o_orderkey, case when o_orderkey % 2 = 1 then o_orderdate when o_orderkey % 4 = 0 then o_orderdate + interval 5 day "
    "else o_orderdate end as updated_at, case when o_orderkey % 4 = 0 then 'late' else 'stored' end as origin from orders",
)
def late_rows(src):
    orders = src.table("orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("updated_at"))
    even = orders.filter(F.col("o_orderkey") % 2 == 0)
    shift = F.when(F.col("o_orderkey") % 4 == 0, F.expr("interval 5 days")).otherwise(F.expr("interval -5 days"))
    batch = even.withColumn("updated_at", F.col("updated_at") + shift).withColumn("origin", F.lit("late"))
    stored = orders.withColumn("origin", F.lit("stored"))
    return merge_upsert(stored, batch, ["o_orderkey"], order_guard="updated_at")


_HIST_COLS = ["s_name", "s_nationkey", "acctbal"]


def _stack_oracle(close_missing: bool) -> str:
    """History from the stacked batches: a version opens where a state differs from the run before."""
    runs = " union all ".join(f"select {i} as run, timestamp '{t}' as run_ts" for i, t in enumerate(a.RUNS))
    states = " union all ".join(f"select {i} as run, * from ({a.x_hist_batch(i)}) h{i}" for i in range(len(a.RUNS)))
    grid = f"""
with runs as ({runs}), states as ({states}), keys as (select distinct s_suppkey from states),
grid as (select k.s_suppkey, r.run, r.run_ts, s.s_name, s.s_nationkey, s.acctbal, s.run is not null as present
  from keys k cross join runs r left join states s on s.s_suppkey = k.s_suppkey and s.run = r.run)"""
    if close_missing:
        marked = """, marked as (select *, present and (not coalesce(lag(present) over w, false)
  or lag(acctbal) over w is distinct from acctbal) as opens, not present as closes from grid
  window w as (partition by s_suppkey order by run))"""
    else:
        marked = """, seen as (select * from grid where present), marked as (select *, lag(run) over w is null
  or lag(acctbal) over w is distinct from acctbal as opens, false as closes from seen
  window w as (partition by s_suppkey order by run))"""
    return grid + marked + """, cuts as (select * from marked where opens or closes)
select s_suppkey, s_name, s_nationkey, cast(acctbal as double) as acctbal,
  md5(s_suppkey || '|' || strftime(run_ts, '%Y-%m-%d %H:%M:%S.%f')) as scd_id, run_ts as updated_at, run_ts as valid_from, valid_to
from (select *, lead(run_ts) over (partition by s_suppkey order by run) as valid_to from cuts) z where opens"""


def _apply_batches(src, close_missing: bool) -> DataFrame:
    stored = None
    for i, run_ts in enumerate(a.RUNS):
        stored = history.scd2_apply(
            stored, src.sql(a.x_hist_batch(i)), ["s_suppkey"], _HIST_COLS, run_ts, close_missing
        )
    return stored


@query("scd2_snapshot", _stack_oracle(False))
def scd2_snapshot(src):
    return _apply_batches(src, close_missing=False)


@query("scd2_deletes", _stack_oracle(True))
def scd2_deletes(src):
    return _apply_batches(src, close_missing=True)


_VERSION_STARTS = f"select cast(entity_id as string) as entity_id, version_no, amount, valid_from, valid_to from ({_PART_VERSIONS}) v"


def _dim_oracle(versions: str, key_name: str) -> str:
    return f"""select md5(entity_id || '|' || {d.key_time('valid_from')}) as {key_name}, entity_id, version_no,
cast(amount as double) as amount, valid_from, valid_to, case when row_number() over (partition by entity_id order by valid_from) = 1
then timestamp '1900-01-01' else valid_from end as effective_valid_from, valid_to is null as is_current_record
from (select cast(entity_id as string) as entity_id, version_no, amount, valid_from, valid_to from ({versions}) v) x"""


def _dim(src, versions: str, key_name: str) -> DataFrame:
    text = src.sql(versions).withColumn("entity_id", F.col("entity_id").cast("string"))
    return history.scd2_dim(text, "entity_id", key_name)


@query("dim_listings", _dim_oracle(_PART_VERSIONS, "listing_key"))
def dim_listings(src):
    return _dim(src, _PART_VERSIONS, "listing_key")


@query("dim_hosts", _dim_oracle(_SUPPLIER_VERSIONS, "host_key"))
def dim_hosts(src):
    return _dim(src, _SUPPLIER_VERSIONS, "host_key")


# ---- quality ----------------------------------------------------------------
_FACTS = (
    "select o_orderkey, case when o_orderkey % 12 = 5 then null else o_custkey end as guest, case when o_orderkey % 10 = 4 then "
    "o_orderkey - 1 else o_orderkey end as booking, o_orderstatus, case when o_orderstatus = 'F' then 'completed' else 'confirmed' end as st, "
    "case when o_orderkey % 15 = 2 then 0 else o_totalprice end as revenue, cast(o_orderdate as date) as d_in, "
    "cast(o_orderdate as date) + cast(o_orderkey % 9 - 1 as int) as d_out from orders"
)


def _check_rows(src, check: quality.Check, cols: list[str], **extra: str) -> DataFrame:
    tables = {"facts": src.sql(_FACTS), **{k: src.sql(v) for k, v in extra.items()}}
    return check.rows(tables).select(*cols)


@query("check_not_null", f"select o_orderkey from ({_FACTS}) x where guest is null")
def check_not_null(src):
    return _check_rows(src, quality.not_null("facts", "guest"), ["o_orderkey"])


@query("check_unique", f"select booking, count(*) as cnt from ({_FACTS}) x where booking is not null group by 1 having count(*) > 1")
def check_unique(src):
    return _check_rows(src, quality.unique("facts", "booking"), ["booking", "cnt"])


@query("check_accepted", f"select o_orderkey, o_orderstatus from ({_FACTS}) x where o_orderstatus not in ('O', 'F')")
def check_accepted(src):
    return _check_rows(src, quality.accepted("facts", "o_orderstatus", ("O", "F")), ["o_orderkey", "o_orderstatus"])


@query(
    "check_fk",
    f"select guest from ({_FACTS}) x where guest is not null and guest not in (select c_custkey from customer where c_custkey % 40 <> 7)",
)
def check_fk(src):
    parents = "select c_custkey from customer where c_custkey % 40 <> 7"
    return _check_rows(src, quality.fk("facts", "guest", "parents", "c_custkey"), ["guest"], parents=parents)


_PHONES = (
    "select c_custkey, case when c_custkey % 9 = 0 then '617-555-0100' when c_custkey % 11 = 0 then null else '+1' || "
    "cast(6170000000 + c_custkey as string) end as phone from customer"
)


@query("check_e164", f"select c_custkey, phone from ({_PHONES}) x where phone is not null and not regexp_full_match(phone, '\\+1[0-9]{{10}}')")
def check_e164(src):
    check = quality.rule("phone", "phones", quality.not_e164(F.col("phone")))
    return _check_rows(src, check, ["c_custkey", "phone"], phones=_PHONES)


_SCORES = "select l_orderkey, l_linenumber, l_partkey, l_quantity / 9 as a, nullif(l_discount * 60, 0) as b from lineitem"


@query("check_ratings", f"select l_orderkey, l_linenumber, l_partkey from ({_SCORES}) x where a not between 0 and 5 or b not between 0 and 5")
def check_ratings(src):
    check = quality.rule("ratings", "scores", quality.out_of_range(["a", "b"], 0, 5))
    return _check_rows(src, check, ["l_orderkey", "l_linenumber", "l_partkey"], scores=_SCORES)


@query(
    "check_fact_rules",
    f"select 'dates' as rule, o_orderkey from ({_FACTS}) x where d_out < d_in union all "
    f"select 'revenue', o_orderkey from ({_FACTS}) y where st = 'completed' and (revenue is null or revenue <= 0)",
)
def check_fact_rules(src):
    tables = {"facts": src.sql(_FACTS)}
    unpaid = (F.col("st") == "completed") & (F.col("revenue").isNull() | (F.col("revenue") <= 0))
    checks = [
        quality.rule("dates", "facts", F.col("d_out") < F.col("d_in")),
        quality.rule("revenue", "facts", unpaid),
    ]
    return shape.union_all([k.rows(tables).select(F.lit(k.name).alias("rule"), "o_orderkey") for k in checks])
