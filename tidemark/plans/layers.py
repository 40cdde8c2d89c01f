"""The marketplace models: bronze and silver of seven entities, quarantine, snapshots.

Models are plain functions from frames to frames.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import clean as c
from tidemark.operators.history import scd2_apply
from tidemark.operators.latest import keep_latest, newest, one_of, places, since
from tidemark.operators.shape import quarantine

LINEAGE = ("_loaded_at", "_stream_timestamp", "_source_file")


def _streamed() -> Column:
    return c.clean_ts(F.col("_stream_timestamp"))


@dataclass(frozen=True)
class Layer:
    """Keys and newest-first order of one deduplicated table."""

    keys: tuple[str, ...]
    newest_by: tuple[str, ...] = ()

    def order(self) -> list[Column]:
        return [*[c.clean_ts(F.col(x)) for x in self.newest_by], _streamed(), F.col("_loaded_at")]

    def latest(self, df: DataFrame) -> DataFrame:
        return keep_latest(df, self.keys, self.order())


BRONZE = {
    "hosts": Layer(("host_id",)),
    "listings": Layer(("listing_id",)),
    "guests": Layer(("guest_id",)),
    "bookings": Layer(("booking_id",), ("updated_at",)),
    "reviews": Layer(("review_id",)),
    "availability_calendar": Layer(("listing_id", "calendar_date")),
    "listing_events": Layer(("event_id",)),
}
SILVER = {
    **BRONZE,
    "bookings": Layer(("booking_id_clean",), ("updated_at",)),
}


def bronze(entity: str, raw: DataFrame, mark: datetime | None = None) -> DataFrame:
    """Latest raw row per raw key, of rows loaded at or after ``mark``."""
    return BRONZE[entity].latest(since(raw, "_loaded_at", mark))


def silver(entity: str, bronze_rows: DataFrame, mark: datetime | None = None) -> DataFrame:
    """Cleaned and typed rows, latest per canonical key."""
    cleaned = _CLEANERS[entity](since(bronze_rows, "_loaded_at", mark))
    return SILVER[entity].latest(cleaned)


# How a canonical key is read from a raw row; any other is an identifier of the same name.
_KEYS = {
    "booking_id_clean": (c.clean_booking_id, "booking_id"),
    "calendar_date": (c.clean_iso_date, "calendar_date"),
}


def silver_of_raw(entity: str, raw: DataFrame) -> DataFrame:
    """The rows of ``silver(entity, bronze(entity, raw))``, for one shuffle instead of two.

    Both layers order by the same times, and all spellings of a key share its
    canonical form. So what is newest by these times within the canonical key holds
    the row that both choose in the end; ties are settled as they do, first within the raw
    key by the raw row, then by the cleaned one.
    """
    columns = raw.columns
    keys = [fn(F.col(x)) for fn, x in (_KEYS.get(k, (c.clean_id, k)) for k in SILVER[entity].keys)]
    latest = one_of(newest(raw, keys, BRONZE[entity].order()), BRONZE[entity].keys, columns)
    cleaned = _CLEANERS[entity](latest)
    columns = [x for x in cleaned.columns if x not in places(cleaned)]
    return one_of(cleaned, (), columns).select(columns)


# ---- silver column lists ----------------------------------------------------
# Values that several expressions use are parsed into `_name` columns first, so
# that they are computed once per row.
def _apply(fn, *names: str) -> list[Column]:
    return [fn(F.col(n)).alias(n) for n in names]


def _trimmed(*names: str) -> list[Column]:
    return _apply(F.trim, *names)


def _parse(df: DataFrame, fns: dict[Callable[[Column], Column], Sequence[str]]) -> DataFrame:
    """Add ``_name = fn(name)`` for every name."""
    return df.withColumns({f"_{n}": fn(F.col(n)) for fn, names in fns.items() for n in names})


def _finish(fn, *names: str) -> list[Column]:
    """``fn`` of the parsed column, under the plain name."""
    return [fn(F.col(f"_{n}")).alias(n) for n in names]


def _lineage(df: DataFrame) -> list[str]:
    """Lineage, and where ``silver_of_raw`` has placed the row."""
    return [*LINEAGE, *places(df)]


def _same(x: Column) -> Column:
    return x


def clean_hosts(df: DataFrame) -> DataFrame:
    rates = ("host_response_rate", "host_acceptance_rate")
    counts = ("host_listings_count", "host_total_listings_count")
    df = _parse(df, {c.strip_ordinals: ["host_since"], c.rate_number: rates, c.clean_int: counts})
    lost_count = (F.col(f"_{counts[0]}") == 0) & (F.col(f"_{counts[1]}") > 0)
    return df.select(
        *_apply(c.clean_id, "host_id"),
        *_apply(c.title_text, "host_name"),
        *_apply(c.lower_text, "host_email"),
        *_finish(c.read_date, "host_since"),
        *_apply(c.bucket_response, "host_response_time"),
        *_finish(c.rate_share, *rates),
        *_apply(c.clean_bool, "is_superhost", "host_identity_verified"),
        *_finish(_same, *counts),
        c.flag(lost_count).alias("has_listings_count_discrepancy"),
        *_apply(c.parse_list, "host_verifications"),
        *_trimmed("host_location"),
        *_lineage(df),
    )


SCORES = tuple(
    f"review_scores_{part}"
    for part in ("rating", "cleanliness", "checkin", "communication", "location", "value")
)


def clean_listings(df: DataFrame) -> DataFrame:
    df = _parse(
        df,
        {
            c.clean_double: ["latitude", "longitude", *SCORES],
            c.parse_list: ["amenities"],
            c.strip_ordinals: ["last_review_date"],
        },
    )
    latitude, longitude, suspect = c.repair_coords(F.col("_latitude"), F.col("_longitude"))
    return df.select(
        *_apply(c.clean_id, "listing_id", "host_id"),
        *_trimmed("listing_name", "listing_description"),
        *_apply(c.lower_text, "room_type", "property_type"),
        *_apply(c.clean_int, "accommodates", "beds", "bedrooms"),
        *_apply(c.clean_bathrooms, "bathrooms"),
        *_apply(c.clean_price, "price_per_night", "cleaning_fee"),
        *_apply(c.positive_int, "minimum_nights"),
        *_apply(c.clean_int, "maximum_nights"),
        *_apply(c.lower_text, "cancellation_policy"),
        *_apply(c.clean_bool, "instant_bookable"),
        F.col("_amenities").alias("amenities_array"),
        F.array_size("_amenities").alias("amenity_count"),
        *_trimmed("neighborhood"),
        *_apply(c.title_text, "city"),
        *_apply(c.clean_country, "country"),
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        suspect.alias("is_coords_suspect"),
        *_finish(c.rescale_rating, *SCORES),
        *_apply(c.clean_int, "number_of_reviews"),
        *_finish(c.read_date, "last_review_date"),
        c.below(F.col("minimum_nights"), 0, inclusive=True).alias("is_data_quality_issue"),
        *_lineage(df),
    )


def clean_guests(df: DataFrame) -> DataFrame:
    trips = F.col("total_trips")
    df = _parse(df, {c.digits: ["guest_phone"], c.strip_ordinals: ["date_of_birth", "guest_since"]})
    return df.select(
        *_apply(c.clean_id, "guest_id"),
        *_apply(c.title_text, "guest_name"),
        *_apply(c.lower_text, "guest_email"),
        *_finish(c.us_e164, "guest_phone"),
        *_finish(c.read_date, "date_of_birth", "guest_since"),
        c.clean_country(F.col("nationality")).alias("nationality_iso2"),
        *_apply(c.clean_gender, "gender"),
        *_trimmed("preferred_language"),
        *_apply(c.clean_bool, "verified_id", "is_banned"),
        *_apply(c.nonneg_int, "total_trips"),
        c.guest_rating(F.col("average_rating_as_guest"), trips).alias("average_rating_as_guest"),
        c.below(trips, 0).alias("is_data_quality_issue"),
        *_lineage(df),
    )


COMPONENTS = ("base_price", "cleaning_fee_charged", "service_fee", "taxes")


def clean_bookings(df: DataFrame) -> DataFrame:
    prices = ("total_price", *COMPONENTS)
    df = _parse(df, {c.strip_ordinals: ["check_in_date", "check_out_date"], c.clean_money: prices})
    parsed = df.withColumns(
        {
            "_in": c.read_date(F.col("_check_in_date")),
            "_out": c.read_date(F.col("_check_out_date")),
        }
    )
    start, end = F.col("_in"), F.col("_out")
    summed = c.component_total(*[F.col(f"_{p}") for p in COMPONENTS])
    bad_children = c.below(F.col("num_children"), 0)
    return parsed.select(
        c.clean_booking_id(F.col("booking_id")).alias("booking_id_clean"),
        F.col("booking_id").alias("booking_id_raw"),
        *_apply(c.clean_id, "listing_id", "guest_id", "host_id"),
        start.alias("check_in_date"),
        end.alias("check_out_date"),
        c.date_valid(start, end).alias("is_date_valid"),
        c.clean_int(F.col("nights_count")).alias("nights_count_raw"),
        c.nights(start, end).alias("calculated_nights"),
        c.nights_differ(F.col("nights_count"), start, end).alias("nights_count_corrected"),
        *_apply(c.clean_int, "num_guests", "num_adults", "num_infants"),
        *_apply(c.nonneg_int, "num_children"),
        *_apply(c.lower_text, "booking_status", "payment_status"),
        *_apply(c.clean_platform, "source_platform"),
        *_trimmed("promo_code", "cancellation_reason", "special_requests"),
        *_finish(_same, *prices),
        summed.alias("calculated_total_price"),
        c.price_mismatch(F.col("_total_price"), summed).alias("is_price_mismatch"),
        *_apply(c.clean_ts, "booked_at", "updated_at"),
        (bad_children | c.flag(end < start)).alias("is_data_quality_issue"),
        *_lineage(df),
    )


RATINGS = tuple(
    f"{part}_rating"
    for part in (
        "overall",
        "cleanliness",
        "accuracy",
        "communication",
        "checkin",
        "location",
        "value",
    )
)


def clean_reviews(df: DataFrame) -> DataFrame:
    df = _parse(df, {c.parse_rating: RATINGS})
    return df.select(
        *_apply(c.clean_id, "review_id"),
        c.clean_booking_id(F.col("booking_id")).alias("booking_id_clean"),
        *_apply(c.clean_id, "listing_id", "reviewer_id", "reviewee_id"),
        *_trimmed("review_type"),
        *_finish(c.rescale_rating, *RATINGS),
        *_apply(c.null_text, "review_text"),
        *_apply(c.null_response, "response_text"),
        *_apply(c.clean_bool, "is_public"),
        *_apply(c.clean_ts, "reviewed_at"),
        *_lineage(df),
    )


def clean_calendar(df: DataFrame) -> DataFrame:
    return df.select(
        *_apply(c.clean_id, "listing_id"),
        *_apply(c.clean_iso_date, "calendar_date"),
        *_apply(c.clean_availability, "is_available"),
        *_apply(c.clean_price, "price_on_date"),
        *_apply(c.clean_int, "minimum_nights_override", "maximum_nights_override"),
        *_trimmed("notes"),
        *_lineage(df),
    )


def clean_events(df: DataFrame) -> DataFrame:
    os_name, os_version = c.split_os(F.col("os_version"))
    kind = F.col("event_type")
    return df.select(
        *_apply(c.clean_id, "event_id"),
        c.map_event_type(kind).alias("event_type_clean"),
        c.event_type_known(kind).alias("is_event_type_mapped"),
        *_apply(c.clean_id, "listing_id", "guest_id"),
        *_trimmed("session_id"),
        *_apply(c.clean_device, "device_type"),
        os_name.alias("os_name"),
        os_version.alias("os_version_clean"),
        *_trimmed("browser"),
        *_apply(c.iso3_to_2, "country_code"),
        *_trimmed("search_query"),
        *_apply(c.clean_price, "price_shown"),
        *_apply(c.position_fix, "position_in_results"),
        c.position_invalid(F.col("position_in_results")).alias("is_position_invalid"),
        F.col("guest_id").isNull().alias("is_anonymous"),
        *_apply(c.clean_ts, "event_timestamp"),
        *_lineage(df),
    )


_CLEANERS = {
    "hosts": clean_hosts,
    "listings": clean_listings,
    "guests": clean_guests,
    "bookings": clean_bookings,
    "reviews": clean_reviews,
    "availability_calendar": clean_calendar,
    "listing_events": clean_events,
}


# ---- quarantine -------------------------------------------------------------
def split_bookings(bookings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined) silver bookings."""
    start, end = F.col("check_in_date"), F.col("check_out_date")
    return quarantine(
        bookings,
        ~F.col("is_date_valid") | F.col("is_data_quality_issue"),
        [
            (start.isNull() | end.isNull(), "unparseable_date"),
            (end < start, "checkout_before_checkin"),
            (F.col("num_children").isNull() & F.col("is_data_quality_issue"), "invalid_guest_count"),
        ],
        default="other_quality_issue",
    )


def quarantine_invalid_bookings(bookings: DataFrame) -> DataFrame:
    return split_bookings(bookings)[1]


# ---- snapshots --------------------------------------------------------------
# The columns whose change opens a new version.
TRACKED = {
    "hosts": (
        "host_name host_email host_since host_response_time host_response_rate "
        "host_acceptance_rate is_superhost host_identity_verified host_listings_count "
        "host_total_listings_count has_listings_count_discrepancy host_verifications "
        "host_location"
    ).split(),
    "listings": (
        "host_id listing_name listing_description room_type property_type accommodates "
        "bathrooms bedrooms beds price_per_night cleaning_fee minimum_nights maximum_nights "
        "cancellation_policy instant_bookable amenities_array amenity_count neighborhood "
        "city country latitude longitude is_coords_suspect review_scores_rating "
        "review_scores_cleanliness review_scores_checkin review_scores_communication "
        "review_scores_location review_scores_value number_of_reviews last_review_date "
        "is_data_quality_issue"
    ).split(),
}


def snapshot(
    entity: str, history: DataFrame | None, silver_rows: DataFrame, run_ts: str | datetime
) -> DataFrame:
    """History of ``hosts`` or ``listings`` after one more snapshot."""
    keys: Sequence[str] = SILVER[entity].keys
    return scd2_apply(history, silver_rows, keys, TRACKED[entity], run_ts)
