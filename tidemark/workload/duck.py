"""The same semantics spelled in DuckDB SQL, for the oracle statements."""

from __future__ import annotations


def quoted(words) -> str:
    return ", ".join("'" + str(w).replace("'", "''") + "'" for w in words)


def strip(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, '{pattern}', '{by}', 'g')"


def digits(x: str) -> str:
    return strip(x, "[^0-9]")


def clean_id(x: str) -> str:
    return f"lower({strip(x, '[^a-zA-Z0-9]')})"


def booking_id(x: str) -> str:
    return f"('BKG-' || {digits(x)})"


def low(x: str) -> str:
    return f"lower(trim({x}))"


TITLE_SET = r"\s!?@\"^#$&~_,.:;+\-*%/|\\\[\](){}<>"


def title(x: str) -> str:
    piece = f"regexp_extract_all(lower(trim({x})), '[^{TITLE_SET}]*[{TITLE_SET}]?')"
    return f"array_to_string(list_transform({piece}, lambda s: upper(s[1]) || s[2:]), '')"


def boolean(x: str, yes=(), no=()) -> str:
    return (
        f"case when {low(x)} in ('t','true','1','y','yes'{''.join(f', {quoted([w])}' for w in yes)}) then true "
        f"when {low(x)} in ('f','false','0','n','no'{''.join(f', {quoted([w])}' for w in no)}) then false end"
    )


def integer(x: str) -> str:
    return f"cast(try_cast({x} as decimal(38,0)) as bigint)"


def number(x: str) -> str:
    return f"case when regexp_full_match({x}, '\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*') then try_cast({x} as double) end"


def money(x: str) -> str:
    return f"try_cast({x} as decimal(10,2))"


def price(x: str) -> str:
    return money(strip(f"trim({x})", "[$,]"))


def rate(x: str) -> str:
    v = f"try_cast(replace(trim({x}), '%', '') as decimal(10,4))"
    share = f"(case when {v} > 1 then cast({v} / 100.0 as decimal(12,6)) else cast({v} as decimal(12,6)) end)"
    return f"(case when {share} is null then null when {share} > 1 then 1.00 else round({share}, 2) end)"


def bathrooms(x: str) -> str:
    return f"case when {low(x)} = 'shared' then 0.5 else try_cast({strip(f'trim({x})', '[^0-9.]')} as decimal(5,1)) end"


def positive(x: str) -> str:
    return f"case when {integer(x)} <= 0 then null else {integer(x)} end"


def nonneg(x: str) -> str:
    return f"case when {integer(x)} < 0 then null else {integer(x)} end"


def position(x: str) -> str:
    return f"nullif({integer(x)}, 0)"


def rounded(x: str, scale: int = 2) -> str:
    """Round a double half up on its decimal form."""
    return f"cast(round(cast({x} as decimal(18,10)), {scale}) as double)"


def parse_rating(x: str) -> str:
    return f"try_cast({strip(f'replace({x}, chr(44), chr(46))', '[^0-9.]')} as double)"


def rescale(v: str) -> str:
    return (
        f"case when ({v}) is null or ({v}) = 0 then null when ({v}) > 5 then {rounded(f'({v}) / 20.0')} "
        f"else {rounded(v)} end"
    )


def date(x: str) -> str:
    plain = strip(x, "([0-9])(st|nd|rd|th),?", "\\1")
    formats = ["%Y-%m-%d", "%m/%d/%Y", "%B %d %Y"]
    return "coalesce(" + ", ".join(f"cast(try_strptime({plain}, '{f}') as date)" for f in formats) + ")"


def iso_date(x: str) -> str:
    return f"cast(try_strptime({x}, '%Y-%m-%d') as date)"


def ts(x: str) -> str:
    return f"try_cast({x} as timestamp)"


def response(x: str) -> str:
    t = f"lower({x})"
    return (
        f"case when {t} like '%within an hour%' or {t} = '1 hour' then 'within_1_hour' "
        f"when {t} like '%within a day%' or {t} in ('24 hours', 'same day') then 'within_day' "
        f"when {t} like '%few days%' then 'few_days' end"
    )


def country(x: str) -> str:
    t = f"upper(trim({x}))"
    return f"case when {t} in ('US', 'USA', 'UNITED STATES', 'UNITED STATES OF AMERICA') then 'US' else {t} end"


ISO3 = {"USA": "US", "GBR": "GB", "CAN": "CA", "AUS": "AU", "DEU": "DE", "FRA": "FR", "JPN": "JP", "BRA": "BR"}


def iso2(x: str) -> str:
    whens = " ".join(f"when '{a}' then '{b}'" for a, b in ISO3.items())
    return f"case {x} {whens} else upper(trim({x})) end"


def gender(x: str) -> str:
    t = f"upper(trim({x}))"
    return (
        f"case when {t} in ('M', 'MALE') then 'M' when {t} in ('F', 'FEMALE') then 'F' "
        f"when {t} in ('OTHER', 'NON-BINARY') then 'Other' else 'Unknown' end"
    )


def event_type(x: str) -> str:
    t = f"lower({x})"
    return (
        f"case when {t} in ('view', 'page_view') then 'view' "
        f"when {t} in ('click', 'listing_click') then 'click' "
        f"when {t} in ('favourite', 'favorite', 'save', 'wishlist_add') then 'save' "
        f"when {t} in ('booking_start', 'bookingstart') then 'booking_start' "
        f"when {t} in ('booking_complete', 'bookingcomplete', 'booking_confirmed', 'bookingconfirmed') then 'booking_complete' "
        f"when {t} in ('search_impression', 'searchimpression', 'impression') then 'search_impression' "
        f"else {t} end"
    )


def event_known(x: str) -> str:
    words = (
        "view page_view click listing_click favourite favorite save wishlist_add booking_start "
        "booking_complete booking_confirmed searchimpression search_impression impression "
        "bookingstart bookingcomplete"
    ).split()
    return f"coalesce(lower({x}) in ({quoted(words)}), false)"


def funnel(x: str) -> str:
    return (
        f"case {x} when 'search_impression' then 1 when 'view' then 2 when 'click' then 3 "
        f"when 'save' then 4 when 'booking_start' then 5 when 'booking_complete' then 6 end"
    )


def platform(x: str) -> str:
    t = low(x)
    squeezed = strip(t, "[^a-z0-9]")
    return (
        f"case when {t} in ('web', 'desktop') then 'web' when {squeezed} = 'mobileios' then 'mobile_ios' "
        f"when {squeezed} = 'mobileandroid' then 'mobile_android' else {t} end"
    )


def os_name(x: str) -> str:
    return f"split_part(trim({x}), ' ', 1)"


def os_version(x: str) -> str:
    return f"case when trim({x}) like '% %' then substr(trim({x}), length({os_name(x)}) + 2) end"


def phone(x: str) -> str:
    d = digits(x)
    return (
        f"case when length({d}) = 10 then '+1' || {d} "
        f"when length({d}) = 11 and {d} like '1%' then '+' || {d} end"
    )


def parse_list(x: str) -> str:
    return (
        f"case when {x} like '[%' and json_valid({x}) then from_json({x}, '[\"varchar\"]') "
        f"when {x} like '{{%' and json_valid({x}) then [{x}] "
        f"when contains({x}, '|') then string_split({x}, '|') else string_split({x}, ', ') end"
    )


def null_text(x: str) -> str:
    t = f"trim({x})"
    return f"case when {t} = '.' or upper({t}) in ('N/A', 'NONE') or length({t}) < 3 then null else {t} end"


def null_response(x: str) -> str:
    t = f"trim({x})"
    return f"case when {t} = '' or upper({t}) = 'N/A' then null else {t} end"


def latest(src: str, keys: str, order: str) -> str:
    """Newest row per key; every order entry puts NULL first."""
    wanted = ", ".join(f"{o} desc nulls first" for o in order.split(";"))
    return (
        f"select * exclude (rn) from (select *, row_number() over (partition by {keys} "
        f"order by {wanted}) as rn from {src}) where rn = 1"
    )


def key_time(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"
