"""Cleaning expressions: every function maps Columns to Columns.

All of them stay inside generated JVM code and never raise on bad text: a value
that cannot be read becomes NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# ---- fixed values -----------------------------------------------------------
TRUE_WORDS = ("t", "true", "1", "y", "yes")
FALSE_WORDS = ("f", "false", "0", "n", "no")
US_NAMES = ("US", "USA", "UNITED STATES", "UNITED STATES OF AMERICA")
ISO3_TO_ISO2 = {
    "USA": "US",
    "GBR": "GB",
    "CAN": "CA",
    "AUS": "AU",
    "DEU": "DE",
    "FRA": "FR",
    "JPN": "JP",
    "BRA": "BR",
}
EVENT_SPELLINGS = {
    "view": ("view", "page_view"),
    "click": ("click", "listing_click"),
    "save": ("favourite", "favorite", "save", "wishlist_add"),
    "booking_start": ("booking_start", "bookingstart"),
    "booking_complete": (
        "booking_complete",
        "bookingcomplete",
        "booking_confirmed",
        "bookingconfirmed",
    ),
    "search_impression": ("search_impression", "searchimpression", "impression"),
}
# Translated like the others, yet reported as not mapped.
UNREPORTED_SPELLINGS = ("bookingconfirmed",)
FUNNEL_STEPS = {
    "search_impression": 1,
    "view": 2,
    "click": 3,
    "save": 4,
    "booking_start": 5,
    "booking_complete": 6,
}
GENDER_WORDS = {
    "M": ("M", "MALE"),
    "F": ("F", "FEMALE"),
    "Other": ("OTHER", "NON-BINARY"),
}
DATE_FORMATS = ("yyyy-MM-dd", "M/d/yyyy", "MMMM d yyyy")
ORDINAL_SUFFIX = r"(?<=[0-9])(st|nd|rd|th),?"
TITLE_BREAKS = r"[\t\n\r\f!?@\"^#$&~_,.:;+\-*%/|\\\[\](){}<>]"
KEY_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# -----------------------------------------------------------------------------

_NUMERIC = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_BREAK_MARK = "\u0001 "


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def flag(condition: Column) -> Column:
    """Condition with unknown counted as false."""
    return F.coalesce(condition, F.lit(False))


# ---- identifiers and keys ---------------------------------------------------
def clean_id(x: Column) -> Column:
    # \P{Alnum} is [^a-zA-Z0-9], which Java matches several times slower
    return F.lower(F.regexp_replace(x, r"\P{Alnum}", ""))


def clean_booking_id(x: Column) -> Column:
    return F.concat(F.lit("BKG-"), digits(x))


def surrogate_key(x: Column) -> Column:
    return F.md5(x)


def version_key(x: Column, started: Column, sep: str = "|") -> Column:
    return F.md5(F.concat(x, F.lit(sep), F.date_format(started, KEY_TIME_FORMAT)))


# ---- text -------------------------------------------------------------------
def lower_text(x: Column) -> Column:
    return F.lower(F.trim(x))


def title_text(x: Column) -> Column:
    """Trim and capitalise every word; words also end at punctuation.

    ``initcap`` only knows blanks, so a marked blank is put behind each
    other separator first and taken out afterwards.
    """
    spaced = F.regexp_replace(F.trim(x), f"({TITLE_BREAKS})", "$1" + _BREAK_MARK)
    return F.replace(F.initcap(spaced), F.lit(_BREAK_MARK), F.lit(""))


def null_tokens(x: Column, tokens: Sequence[str] = ("NULL", "null", "")) -> Column:
    return F.when(~x.isin(*tokens), x)


def null_text(x: Column) -> Column:
    """Review text: drop placeholders and anything under three characters."""
    t = F.trim(x)
    filler = (t == ".") | F.upper(t).isin("N/A", "NONE") | (F.length(t) < 3)
    return F.when(~filler, t)


def null_response(x: Column) -> Column:
    t = F.trim(x)
    return F.when((t != "") & (F.upper(t) != "N/A"), t)


def has_value(x: Column) -> Column:
    return x.isNotNull()


# ---- booleans ---------------------------------------------------------------
def clean_bool(
    x: Column, also_true: Sequence[str] = (), also_false: Sequence[str] = ()
) -> Column:
    word = lower_text(x)
    return F.when(word.isin(*TRUE_WORDS, *also_true), True).when(
        word.isin(*FALSE_WORDS, *also_false), False
    )


def clean_availability(x: Column) -> Column:
    return clean_bool(x, also_true=("available",), also_false=("blocked",))


# ---- numbers ----------------------------------------------------------------
def clean_int(x: Column) -> Column:
    """Whole number, halves rounded away from zero."""
    return x.try_cast("decimal(38,0)").try_cast("bigint")


def clean_double(x: Column) -> Column:
    """Plain or scientific notation only (a Java type suffix does not count)."""
    return F.when(x.rlike(_NUMERIC), x.try_cast("double"))


def clean_money(x: Column) -> Column:
    return x.try_cast("decimal(10,2)")


def clean_price(x: Column) -> Column:
    return clean_money(F.translate(F.trim(x), "$,", ""))


def rate_number(x: Column) -> Column:
    return F.replace(F.trim(x), F.lit("%"), F.lit("")).try_cast("decimal(10,4)")


def rate_share(v: Column) -> Column:
    """Share in 0..1 of a number that may be a percentage; capped at 1."""
    share = F.when(v > 100, F.lit(100)).when(v > 1, v).otherwise(v * F.lit(100))
    return F.round(share / F.lit(100), 2).cast("decimal(10,2)")


def clean_rate(x: Column) -> Column:
    """Share from ``98%``, ``98`` or ``0.98``."""
    return rate_share(rate_number(x))


def clean_bathrooms(x: Column) -> Column:
    count = F.regexp_replace(F.trim(x), "[^0-9.]", "").try_cast("decimal(5,1)")
    return F.when(lower_text(x) == "shared", F.lit("0.5").cast("decimal(5,1)")).otherwise(count)


def positive_int(x: Column) -> Column:
    n = clean_int(x)
    return F.when(n > 0, n)


def nonneg_int(x: Column) -> Column:
    n = clean_int(x)
    return F.when(n >= 0, n)


def position_fix(x: Column) -> Column:
    n = clean_int(x)
    return F.when(n != 0, n)


def below(x: Column, bound: int, inclusive: bool = False) -> Column:
    """Flag for a count under ``bound`` (or equal to it)."""
    n = clean_int(x)
    return flag(n <= bound if inclusive else n < bound)


def position_invalid(x: Column) -> Column:
    return flag(clean_int(x) == 0)


def parse_rating(x: Column) -> Column:
    t = F.regexp_replace(F.replace(x, F.lit(","), F.lit(".")), "[^0-9.]", "")
    # text of digits and points is no number only then; a failing cast costs an exception
    points = F.length(t) - F.length(F.replace(t, F.lit("."), F.lit("")))
    return F.when((points < 2) & ~t.isin("", "."), t.try_cast("double"))


def rescale_rating(v: Column) -> Column:
    """0..5 rating from a 0..5 or 0..100 number; zero means no rating."""
    scaled = F.when(v > 5, v / F.lit(20.0)).otherwise(v)
    return F.when(v != 0, F.round(scaled, 2))


def guest_rating(rating: Column, trips: Column) -> Column:
    v = clean_double(rating)
    unrated = flag(clean_int(trips) <= 0) | flag(v == 0)
    return F.when(~unrated, F.round(v, 2))


def repair_coords(a: Column, b: Column) -> tuple[Column, Column, Column]:
    """(latitude, longitude, suspect) with exchanged pairs put right."""
    swapped = flag((a < 0) & (b > 0))
    return (
        F.when(swapped, b).otherwise(a),
        F.when(swapped, a).otherwise(b),
        swapped,
    )


def swap_coords(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    return repair_coords(clean_double(lat), clean_double(lon))


# ---- dates and times --------------------------------------------------------
def strip_ordinals(x: Column, pattern: str = ORDINAL_SUFFIX) -> Column:
    """``March 4th, 2025`` to ``March 4 2025``."""
    return F.regexp_replace(x, pattern, "")


def read_date(plain: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that fits. One is tried only where its separator occurs."""
    tries = []
    for f in formats:
        separator = next(ch for ch in f if not ch.isalpha())
        tries.append(F.when(plain.contains(separator), F.try_to_date(plain, f)))
    return F.coalesce(*tries)


def clean_date(
    x: Column,
    formats: Sequence[str] = DATE_FORMATS,
    ordinal_pattern: str = ORDINAL_SUFFIX,
) -> Column:
    return read_date(strip_ordinals(x, ordinal_pattern), formats)


def clean_iso_date(x: Column) -> Column:
    return F.try_to_date(x, "yyyy-MM-dd")


def clean_ts(x: Column) -> Column:
    return x.try_cast("timestamp")


def date_valid(start: Column, end: Column) -> Column:
    return flag(end >= start)


def nights(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def nights_differ(stated: Column, start: Column, end: Column) -> Column:
    return flag(clean_int(stated) != nights(start, end))


def lead_days(booked: Column, start: Column) -> Column:
    return F.datediff(start, F.to_date(booked))


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


# ---- vocabularies -----------------------------------------------------------
def bucket_response(x: Column) -> Column:
    t = F.lower(x)
    return (
        F.when(t.contains("within an hour") | (t == "1 hour"), "within_1_hour")
        .when(t.contains("within a day") | t.isin("24 hours", "same day"), "within_day")
        .when(t.contains("few days"), "few_days")
    )


def clean_country(x: Column) -> Column:
    t = F.upper(F.trim(x))
    return F.when(t.isin(*US_NAMES), "US").otherwise(t)


def iso3_to_2(x: Column) -> Column:
    out = F.upper(F.trim(x))
    for three, two in ISO3_TO_ISO2.items():
        out = F.when(x == three, two).otherwise(out)
    return out


def clean_gender(x: Column) -> Column:
    t = F.upper(F.trim(x))
    out = F.lit("Unknown")
    for code, words in GENDER_WORDS.items():
        out = F.when(t.isin(*words), code).otherwise(out)
    return out


def map_event_type(x: Column) -> Column:
    t = F.lower(x)
    out = t
    for code, words in EVENT_SPELLINGS.items():
        out = F.when(t.isin(*words), code).otherwise(out)
    return out


def event_type_known(x: Column) -> Column:
    words = [
        w
        for group in EVENT_SPELLINGS.values()
        for w in group
        if w not in UNREPORTED_SPELLINGS
    ]
    return flag(F.lower(x).isin(*words))


def funnel_step(code: Column) -> Column:
    out = F.lit(None).cast("int")
    for name, step in FUNNEL_STEPS.items():
        out = F.when(code == name, step).otherwise(out)
    return out


def clean_platform(x: Column) -> Column:
    t = lower_text(x)
    squeezed = F.regexp_replace(t, "[^a-z0-9]", "")
    return (
        F.when(t.isin("web", "desktop"), "web")
        .when(squeezed == "mobileios", "mobile_ios")
        .when(squeezed == "mobileandroid", "mobile_android")
        .otherwise(t)
    )


def clean_device(x: Column) -> Column:
    return lower_text(x)


def split_os(x: Column) -> tuple[Column, Column]:
    """(name, version): the first word, and what follows it if anything does."""
    t = F.trim(x)
    name = F.split_part(t, F.lit(" "), F.lit(1))
    rest = F.substr(t, F.length(name) + 2)
    return name, F.when(t.contains(" "), rest)


def us_e164(d: Column) -> Column:
    """E.164 form of a string of digits."""
    return F.when(F.length(d) == 10, F.concat(F.lit("+1"), d)).when(
        (F.length(d) == 11) & d.startswith("1"), F.concat(F.lit("+"), d)
    )


def phone_e164(x: Column) -> Column:
    return us_e164(digits(x))


# ---- lists ------------------------------------------------------------------
def parse_list(x: Column) -> Column:
    """String array from a JSON array, ``a|b`` or ``a, b``; a JSON object is one element."""
    split = F.when(x.contains("|"), F.split(x, r"\|")).otherwise(F.split(x, ", "))
    as_json = F.when(F.trim(x).startswith("["), F.from_json(x, "array<string>"))
    is_object = F.trim(x).startswith("{") & F.from_json(x, "map<string,string>").isNotNull()
    return F.coalesce(as_json, F.when(is_object, F.array(x)), split)


def list_size(x: Column) -> Column:
    return F.array_size(parse_list(x))


# ---- booking money ----------------------------------------------------------
def component_total(*parts: Column) -> Column:
    """Sum of already typed amounts, missing ones counted as zero."""
    zero = F.lit(0).cast("decimal(10,2)")
    total = F.coalesce(parts[0], zero)
    for part in parts[1:]:
        total = total + F.coalesce(part, zero)
    return total.cast("decimal(14,2)")


def price_mismatch(total: Column, component_sum: Column) -> Column:
    return flag(F.abs(total - component_sum) > F.lit("1.00").cast("decimal(10,2)"))


def recognized_revenue(status: Column, payment: Column, total: Column) -> Column:
    earned = (status == "completed") & (payment == "paid")
    return F.when(earned, total).otherwise(F.lit(0).cast("decimal(14,2)"))


def revenue_per_night(total: Column, night_count: Column) -> Column:
    per = total / F.nullif(night_count, F.lit(0))
    return F.round(per, 2).cast("decimal(14,2)")


def mean_present(*cols: Column, scale: int = 2) -> Column:
    """Mean of the non-null values in one row; NULL when all are missing."""
    total, count = F.lit(0.0), F.lit(0)
    for c in cols:
        total = total + F.coalesce(c.cast("double"), F.lit(0.0))
        count = count + c.isNotNull().cast("int")
    # rounded as a decimal: the sum of doubles may sit a hair under a half
    mean = (total / F.nullif(count, F.lit(0))).cast("decimal(28,10)")
    return F.round(mean, scale).cast("double")
