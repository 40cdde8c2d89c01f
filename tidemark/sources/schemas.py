"""Raw feed layouts: business columns of the seven entities, all text.

Fixed values: names and order of the delivered fields.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_COLUMNS = {
    "hosts": (
        "host_id host_name host_email host_since host_location host_response_time "
        "host_response_rate host_acceptance_rate is_superhost host_listings_count "
        "host_total_listings_count host_verifications host_identity_verified"
    ).split(),
    "listings": (
        "listing_id host_id listing_name listing_description property_type room_type "
        "accommodates bathrooms bedrooms beds amenities price_per_night cleaning_fee "
        "minimum_nights maximum_nights cancellation_policy instant_bookable neighborhood "
        "city country latitude longitude review_scores_rating review_scores_cleanliness "
        "review_scores_checkin review_scores_communication review_scores_location "
        "review_scores_value number_of_reviews last_review_date"
    ).split(),
    "guests": (
        "guest_id guest_name guest_email guest_phone date_of_birth guest_since nationality "
        "gender preferred_language verified_id total_trips average_rating_as_guest is_banned"
    ).split(),
    "bookings": (
        "booking_id listing_id guest_id host_id check_in_date check_out_date nights_count "
        "num_guests num_adults num_children num_infants booking_status payment_status "
        "total_price base_price cleaning_fee_charged service_fee taxes special_requests "
        "booked_at updated_at source_platform promo_code cancellation_reason"
    ).split(),
    "reviews": (
        "review_id booking_id listing_id reviewer_id reviewee_id review_type overall_rating "
        "cleanliness_rating accuracy_rating communication_rating checkin_rating "
        "location_rating value_rating review_text response_text is_public reviewed_at"
    ).split(),
    "availability_calendar": (
        "calendar_id listing_id calendar_date is_available price_on_date "
        "minimum_nights_override maximum_nights_override notes"
    ).split(),
    "listing_events": (
        "event_id event_type listing_id guest_id session_id device_type os_version browser "
        "country_code search_query price_shown position_in_results event_timestamp"
    ).split(),
}

# entity_type in the feed -> entity
ENTITY_TYPES = {
    "host": "hosts",
    "listing": "listings",
    "guest": "guests",
    "booking": "bookings",
    "review": "reviews",
    "availability_calendar": "availability_calendar",
    "listing_event": "listing_events",
}

# entity -> folder its files land in
LANDING_FOLDERS = {
    "hosts": "host",
    "listings": "listing",
    "guests": "guest",
    "bookings": "booking",
    "reviews": "review",
    "availability_calendar": "availability_calendar",
    "listing_events": "listing_events",
}


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def raw_schema(entity: str) -> T.StructType:
    """Reader schema of one entity: its columns and the stream timestamp."""
    return text_schema([*RAW_COLUMNS[entity], "_stream_timestamp"])
