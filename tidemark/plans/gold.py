"""Gold models: three dimensions, four facts and the wide booking table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import clean as c
from tidemark.operators.history import scd2_dim
from tidemark.operators.joins import (
    HotKeys,
    asof_join,
    current_join,
    date_join,
    hot_keys,
    lookup_join,
    role_join,
    role_key,
)
from tidemark.operators.rollup import session_metrics, session_rollup
from tidemark.operators.shape import project_from_config
from tidemark.plans.layers import RATINGS, TRACKED

VERSION = ["scd_id", "valid_from", "valid_to", "updated_at", "effective_valid_from", "is_current_record"]

# Columns of the wide booking table, in order.
OBT_BOOKING_COLS = (
    "booking_id_clean booking_status payment_status source_platform promo_code booked_at "
    "check_in_date check_out_date calculated_nights num_guests num_adults num_children "
    "base_price cleaning_fee_charged service_fee taxes calculated_total_price "
    "revenue_per_night is_last_minute_booking is_long_stay booking_lead_days "
    "is_price_mismatch listing_name room_type property_type neighborhood city country "
    "listed_price_at_booking cancellation_policy_at_booking instant_bookable_at_booking "
    "amenity_count host_name is_superhost_at_booking response_rate_at_booking "
    "listings_count_at_booking guest_name nationality_iso2 gender total_trips "
    "average_rating_as_guest verified_id year month month_name quarter day_name is_weekend "
    "is_us_federal_holiday season"
).split()

GUEST_COLS = "guest_name nationality_iso2 gender total_trips average_rating_as_guest verified_id".split()
DATE_COLS = "year month month_name quarter day_name is_weekend is_us_federal_holiday season".split()


def dim_guests(guests: DataFrame) -> DataFrame:
    """Guests that are not banned; an unknown flag does not ban."""
    shown = [x for x in guests.columns if x not in ("is_data_quality_issue", "_stream_timestamp", "_source_file")]
    kept = guests.filter(~c.flag(F.col("is_banned")))
    return kept.select(c.surrogate_key(F.col("guest_id")).alias("guest_key"), *shown)


def _versions(history: DataFrame, entity: str, key: str, key_name: str) -> DataFrame:
    dim = scd2_dim(history, key, key_name)
    return dim.select(key_name, key, *TRACKED[entity], *VERSION)


def dim_hosts(history: DataFrame) -> DataFrame:
    return _versions(history, "hosts", "host_id", "host_key")


def dim_listings(history: DataFrame) -> DataFrame:
    return _versions(history, "listings", "listing_id", "listing_key")


LISTING_AT_BOOKING = {
    "listing_key": "listing_key",
    "listing_name": "listing_name",
    "room_type": "room_type",
    "property_type": "property_type",
    "neighborhood": "neighborhood",
    "city": "city",
    "country": "country",
    "price_per_night": "listed_price_at_booking",
    "cancellation_policy": "cancellation_policy_at_booking",
    "instant_bookable": "instant_bookable_at_booking",
    "amenity_count": "amenity_count",
}
HOST_AT_BOOKING = {
    "host_key": "host_key",
    "host_name": "host_name",
    "is_superhost": "is_superhost_at_booking",
    "host_response_rate": "response_rate_at_booking",
    "host_listings_count": "listings_count_at_booking",
}


NO_HOT_KEYS: Mapping[str, HotKeys] = {}
REVIEW_HOST = {"guest_to_host": "reviewee_id", "host_to_guest": "reviewer_id"}
REVIEW_GUEST = {"guest_to_host": "reviewer_id", "host_to_guest": "reviewee_id"}


def booking_hot_keys(bookings: DataFrame) -> dict[str, HotKeys]:
    """Overfull join keys of stored silver bookings, for ``fct_bookings(hot=...)``."""
    return hot_keys(bookings, {k: k for k in ("listing_id", "host_id", "guest_id")})


def review_hot_keys(reviews: DataFrame) -> dict[str, HotKeys]:
    return hot_keys(
        reviews,
        {
            "booking_id_clean": "booking_id_clean",
            "listing_id": "listing_id",
            "host_id": role_key("review_type", REVIEW_HOST),
            "guest_id": role_key("review_type", REVIEW_GUEST),
        },
    )


def event_hot_keys(events: DataFrame) -> dict[str, HotKeys]:
    return hot_keys(events, {k: k for k in ("listing_id", "guest_id")})


def fct_bookings(
    bookings: DataFrame,
    listings: DataFrame,
    hosts: DataFrame,
    guests: DataFrame,
    dim_date: DataFrame,
    days: int | None = None,
    hot: Mapping[str, HotKeys] = NO_HOT_KEYS,
) -> DataFrame:
    """Valid bookings with the listing and host versions of the booking time."""
    valid = bookings.filter(F.col("is_date_valid"))
    # the join that adds the most columns comes last: its columns are shuffled once
    j = lookup_join(valid, guests, "guest_id", "guest_id", ["guest_key"], hot=hot.get("guest_id", ()))
    versions = (("host_id", hosts, HOST_AT_BOOKING), ("listing_id", listings, LISTING_AT_BOOKING))
    for key, dim, cols in versions:
        j = asof_join(j, dim, key, key, "booked_at", cols, hot=hot.get(key, ()))
    j = date_join(j, dim_date, "check_in_date", {"date_key": "check_in_date_key"}, days)
    total, stay = F.col("calculated_total_price"), F.col("calculated_nights")
    lead = c.lead_days(F.col("booked_at"), F.col("check_in_date"))
    plain = (
        "listing_key host_key guest_key check_in_date_key booking_id_clean booking_id_raw "
        "check_in_date check_out_date calculated_nights booking_status payment_status "
        "source_platform promo_code cancellation_reason num_guests num_adults num_children "
        "num_infants base_price cleaning_fee_charged service_fee taxes calculated_total_price"
    ).split()
    context = [x for x in LISTING_AT_BOOKING.values() if x != "listing_key"]
    context += [x for x in HOST_AT_BOOKING.values() if x != "host_key"]
    return j.select(
        c.surrogate_key(F.col("booking_id_clean")).alias("booking_key"),
        *plain,
        total.alias("gross_booking_value"),
        c.recognized_revenue(F.col("booking_status"), F.col("payment_status"), total).alias(
            "recognized_revenue"
        ),
        c.revenue_per_night(total, stay).alias("revenue_per_night"),
        "is_price_mismatch",
        "nights_count_corrected",
        *context,
        "booked_at",
        "updated_at",
        lead.alias("booking_lead_days"),
        c.flag(lead < 7).alias("is_last_minute_booking"),
        c.flag(stay >= 7).alias("is_long_stay"),
    )


def fct_reviews(
    reviews: DataFrame,
    bookings: DataFrame,
    listings: DataFrame,
    hosts: DataFrame,
    guests: DataFrame,
    dim_date: DataFrame,
    days: int | None = None,
    hot: Mapping[str, HotKeys] = NO_HOT_KEYS,
) -> DataFrame:
    """Public reviews. Of ``bookings`` only booking_id_clean and booking_key are read."""
    public = reviews.filter(F.col("is_public"))
    current_hosts = hosts.filter(F.col("is_current_record"))
    key = "booking_id_clean"
    j = lookup_join(public, bookings, key, key, ["booking_key"], hot=hot.get(key, ()))
    for dim, roles, key, found in (
        (current_hosts, REVIEW_HOST, "host_id", "host_key"),
        (guests, REVIEW_GUEST, "guest_id", "guest_key"),
    ):
        j = role_join(j, dim, "review_type", roles, key, [found], hot=hot.get(key, ()))
    # the join that adds the most columns comes last: its columns are shuffled once
    shown = ["listing_key", "listing_name", "room_type", "neighborhood", "city"]
    key = "listing_id"
    j = current_join(j, listings, key, key, shown, hot=hot.get(key, ()))
    j = date_join(j, dim_date, "reviewed_at", {"date_key": "reviewed_date_key"}, days)
    sub_ratings = [F.col(r) for r in RATINGS if r != "overall_rating"]
    return j.select(
        c.surrogate_key(F.col("review_id")).alias("review_key"),
        *"listing_key host_key guest_key booking_key reviewed_date_key".split(),
        *"review_id booking_id_clean review_type".split(),
        *RATINGS,
        c.mean_present(*sub_ratings).alias("avg_sub_rating"),
        "review_text",
        "response_text",
        c.has_value(F.col("review_text")).alias("has_review_text"),
        c.has_value(F.col("response_text")).alias("has_response"),
        *"is_public reviewed_at listing_name room_type neighborhood city".split(),
    )


def fct_listing_events(
    events: DataFrame,
    listings: DataFrame,
    guests: DataFrame,
    dim_date: DataFrame,
    days: int | None = None,
    hot: Mapping[str, HotKeys] = NO_HOT_KEYS,
) -> DataFrame:
    shown = {
        "listing_key": "listing_key",
        "listing_name": "listing_name",
        "room_type": "room_type",
        "neighborhood": "neighborhood",
        "city": "city",
        "price_per_night": "current_listing_price",
    }
    listing, guest = "listing_id", "guest_id"
    j = lookup_join(events, guests, guest, guest, ["guest_key"], hot=hot.get(guest, ()))
    j = current_join(j, listings, listing, listing, shown, hot=hot.get(listing, ()))
    j = date_join(j, dim_date, "event_timestamp", {"date_key": "event_date_key"}, days)
    return j.select(
        c.surrogate_key(F.col("event_id")).alias("event_key"),
        *"listing_key guest_key event_date_key event_id session_id event_type_clean".split(),
        *"is_event_type_mapped device_type os_name os_version_clean browser".split(),
        *"country_code search_query price_shown position_in_results".split(),
        *"is_position_invalid is_anonymous".split(),
        c.funnel_step(F.col("event_type_clean")).alias("funnel_step"),
        *"listing_name room_type neighborhood city current_listing_price".split(),
        "event_timestamp",
        "_loaded_at",
    )


def fct_sessions(
    events: DataFrame,
    listings: DataFrame,
    guests: DataFrame,
    dim_date: DataFrame,
    days: int | None = None,
    hot: Mapping[str, HotKeys] = NO_HOT_KEYS,
) -> DataFrame:
    """One row per session, rolled up before any dimension is joined."""
    rolled = session_rollup(
        events,
        "session_id",
        "event_timestamp",
        "event_type_clean",
        c.FUNNEL_STEPS,
        carry_min=["guest_id", "listing_id"],
    )
    listing, guest = "listing_id", "guest_id"
    j = session_metrics(rolled)
    j = current_join(j, listings, listing, listing, ["listing_key"], hot=hot.get(listing, ()))
    j = lookup_join(j, guests, guest, guest, ["guest_key"], hot=hot.get(guest, ()))
    j = date_join(j, dim_date, "session_started_at", {"date_key": "session_date_key"}, days)
    return j.select(
        c.surrogate_key(F.col("session_id")).alias("session_key"),
        *"session_id listing_key guest_key session_date_key".split(),
        *"session_started_at session_ended_at session_duration_seconds".split(),
        *"event_count furthest_funnel_step".split(),
        *[f"had_{step}" for step in c.FUNNEL_STEPS],
        "abandoned_after_booking_start",
    )


def obt_bookings(
    fact: DataFrame,
    guests: DataFrame,
    dim_date: DataFrame,
    columns: Sequence[str] = OBT_BOOKING_COLS,
    days: int | None = None,
    hot: Mapping[str, HotKeys] = NO_HOT_KEYS,
) -> DataFrame:
    """Wide booking table; ``columns`` is the configuration."""
    key = "guest_key"
    j = lookup_join(fact, guests, key, key, GUEST_COLS, hot=hot.get(key, ()))
    j = date_join(j, dim_date, "check_in_date", DATE_COLS, days)
    return project_from_config(j, columns)
