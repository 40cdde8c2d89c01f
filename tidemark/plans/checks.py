"""The data-quality checks of the three layers, as configuration.

Table names are the model names. Each layer's list is what must hold before the
next layer is built.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.clean import FUNNEL_STEPS
from tidemark.operators.history import overlaps
from tidemark.operators.joins import mismatches, orphans, role_violations
from tidemark.operators.merge import repeated_keys
from tidemark.operators.quality import (
    Check,
    accepted,
    fk,
    not_e164,
    not_null,
    out_of_range,
    relation,
    rule,
    unique,
)
from tidemark.operators.rollup import funnel_gaps, reconcile_counts
from tidemark.plans.layers import RATINGS

# Accepted vocabularies.
ROOM_TYPES = ("entire home/apt", "private room", "shared room", "hotel room")
GENDERS = ("M", "F", "Other", "Unknown")
BOOKING_STATUSES = ("pending", "confirmed", "completed", "cancelled", "rejected", "no_show")
REVIEW_TYPES = ("guest_to_host", "host_to_guest")

FUNNEL_CHAIN = ("view", "click", "booking_start", "booking_complete")
REVIEW_PARTIES = {
    "guest_to_host": {"guests": "reviewer_id", "hosts": "reviewee_id"},
    "host_to_guest": {"hosts": "reviewer_id", "guests": "reviewee_id"},
}


def _identified(table: str, *columns: str) -> list[Check]:
    return [make(table, col) for col in columns for make in (not_null, unique)]


def _nonnull(table: str, *columns: str) -> list[Check]:
    return [not_null(table, col) for col in columns]


def _parented(table: str, column: str, parent: str) -> list[Check]:
    """Not-null foreign key into the parent's column of the same name."""
    return [not_null(table, column), fk(table, column, parent, column)]


def bronze_checks() -> list[Check]:
    out: list[Check] = []
    for table, key in {
        "bronze_hosts": "host_id",
        "bronze_listings": "listing_id",
        "bronze_guests": "guest_id",
        "bronze_bookings": "booking_id",
        "bronze_reviews": "review_id",
        "bronze_listing_events": "event_id",
    }.items():
        out += _identified(table, key)
    return out + _nonnull("bronze_availability_calendar", "listing_id", "calendar_date")


def _duplicates(table: str, key: str) -> Check:
    return relation(f"no_duplicates_{table}", table, lambda t: repeated_keys(t[table], [key]))


def host_mismatch(t):
    return mismatches(t["silver_bookings"], t["silver_listings"], "listing_id", "host_id", "host_id")


def review_orphans(t):
    return orphans(
        t["silver_reviews"], t["silver_bookings"], "booking_id_clean", "booking_id_clean"
    )


def review_roles(t):
    dims = {"guests": (t["silver_guests"], "guest_id"), "hosts": (t["silver_hosts"], "host_id")}
    return role_violations(t["silver_reviews"], "review_type", REVIEW_PARTIES, dims)


def silver_checks() -> list[Check]:
    truth = (True, False)
    return [
        *_identified("silver_hosts", "host_id"),
        accepted("silver_hosts", "is_superhost", truth),
        *_identified("silver_listings", "listing_id"),
        accepted("silver_listings", "instant_bookable", truth),
        accepted("silver_listings", "room_type", ROOM_TYPES),
        *_identified("silver_guests", "guest_id"),
        accepted("silver_guests", "gender", GENDERS),
        *_identified("silver_bookings", "booking_id_clean"),
        accepted("silver_bookings", "booking_status", BOOKING_STATUSES),
        *_parented("silver_bookings", "listing_id", "silver_listings"),
        *_parented("silver_bookings", "host_id", "silver_hosts"),
        *_parented("silver_bookings", "guest_id", "silver_guests"),
        *_identified("silver_reviews", "review_id"),
        accepted("silver_reviews", "is_public", truth),
        not_null("silver_reviews", "review_type"),
        accepted("silver_reviews", "review_type", REVIEW_TYPES),
        *_parented("silver_reviews", "listing_id", "silver_listings"),
        *_parented("silver_availability_calendar", "listing_id", "silver_listings"),
        not_null("silver_availability_calendar", "calendar_date"),
        accepted("silver_availability_calendar", "is_available", truth),
        *_identified("silver_listing_events", "event_id"),
        accepted("silver_listing_events", "event_type_clean", tuple(FUNNEL_STEPS)),
        *_parented("silver_listing_events", "listing_id", "silver_listings"),
        *_identified("quarantine_invalid_bookings", "booking_id_clean"),
        not_null("quarantine_invalid_bookings", "quarantine_reason"),
        _duplicates("silver_hosts", "host_id"),
        _duplicates("silver_listings", "listing_id"),
        relation(
            "booking_host_matches_listing",
            "silver_bookings",
            host_mismatch,
            ["listing_id", "host_id"],
        ),
        relation(
            "reviews_reference_bookings", "silver_reviews", review_orphans, ["booking_id_clean"]
        ),
        relation(
            "review_roles_valid",
            "silver_reviews",
            review_roles,
            ["review_type", "reviewer_id", "reviewee_id"],
        ),
        rule("guest_phone_e164", "silver_guests", not_e164(F.col("guest_phone"))),
    ]


def dispositions(t):
    undated = t["quarantine_invalid_bookings"].filter(~F.col("is_date_valid"))
    parts = {"valid_gold_count": t["gold_fct_bookings"], "invalid_quarantine_count": undated}
    return reconcile_counts(t["silver_bookings"], parts, "silver_count")


def version_overlaps(t):
    listings = overlaps(t["gold_dim_listings"], "listing_id", "listing_key")
    hosts = overlaps(t["gold_dim_hosts"], "host_id", "host_key")
    return listings.withColumn("entity_type", F.lit("listing")).unionByName(
        hosts.withColumn("entity_type", F.lit("host"))
    )


def unpaid_completed():
    paid = F.col("recognized_revenue")
    return (F.col("booking_status") == "completed") & (paid.isNull() | (paid <= 0))


def gold_checks() -> list[Check]:
    steps = tuple(FUNNEL_STEPS.values())
    return [
        *_identified("gold_dim_hosts", "host_key"),
        not_null("gold_dim_hosts", "host_id"),
        *_identified("gold_dim_listings", "listing_key"),
        not_null("gold_dim_listings", "listing_id"),
        *_identified("gold_dim_guests", "guest_key"),
        not_null("gold_dim_guests", "guest_id"),
        *_identified("gold_fct_bookings", "booking_key"),
        not_null("gold_fct_bookings", "booking_id_clean"),
        *_parented("gold_fct_bookings", "listing_key", "gold_dim_listings"),
        *_parented("gold_fct_bookings", "host_key", "gold_dim_hosts"),
        *_nonnull("gold_fct_bookings", "calculated_total_price", "calculated_nights"),
        *_identified("gold_fct_reviews", "review_key"),
        *_identified("gold_fct_listing_events", "event_key"),
        accepted("gold_fct_listing_events", "funnel_step", steps),
        *_identified("gold_fct_sessions", "session_key", "session_id"),
        accepted("gold_fct_sessions", "furthest_funnel_step", steps),
        *_identified("gold_obt_bookings", "booking_id_clean"),
        rule("completed_revenue_positive", "gold_fct_bookings", unpaid_completed()),
        rule(
            "booking_dates_valid",
            "gold_fct_bookings",
            F.col("check_out_date") < F.col("check_in_date"),
        ),
        relation(
            "booking_disposition_reconciles",
            "silver_bookings",
            lambda t: dispositions(t).filter(~F.col("reconciles")),
        ),
        rule("ratings_in_range", "silver_reviews", out_of_range(RATINGS, 0, 5)),
        relation("scd_windows_do_not_overlap", "gold_dim_listings", version_overlaps),
        relation(
            "session_funnel_consistent",
            "gold_fct_sessions",
            lambda t: funnel_gaps(t["gold_fct_sessions"], FUNNEL_CHAIN),
        ),
    ]


def all_checks() -> dict[str, list[Check]]:
    return {"bronze": bronze_checks(), "silver": silver_checks(), "gold": gold_checks()}
