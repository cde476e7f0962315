"""Value domains of the event contract.

Fixed values: these must equal the upstream contract for results to match.
"""

# --- fixed values -----------------------------------------------------------
VALID_VARIANTS = ["control", "treatment"]

VALID_BEHAVIOR_EVENTS = [
    "page_view",
    "product_view",
    "add_to_cart",
    "checkout_started",
    "payment_failed",
    "purchase",
    "refund",
]

# funnel position of each behavior event (1-based, in the order above)
FUNNEL_ORDER = {
    "page_view": 1,
    "product_view": 2,
    "add_to_cart": 3,
    "checkout_started": 4,
    "payment_failed": 5,
    "purchase": 6,
    "refund": 7,
}

EXPOSURE_TOPIC = "experiment_exposures"
BEHAVIOR_TOPIC = "user_events"

QUARANTINE_INVALID_EXPOSURE = "invalid_exposure_record"
QUARANTINE_MULTI_VARIANT = "user_assigned_to_multiple_variants"
QUARANTINE_INVALID_BEHAVIOR = "invalid_behavior_record"

PURCHASE = "purchase"
REFUND = "refund"
# ---------------------------------------------------------------------------

PARTITION_COLUMNS = ["year", "month", "day"]
USER_KEY = ["experiment_id", "user_id"]

# --- fixed values: data-quality check catalog --------------------------------
# (check_name, table_name, threshold, description) in reporting order; the
# status rule of each check is in operators.quality.
QUALITY_CHECKS = [
    ("silver_exposures_has_rows", "exposures", "> 0", "Silver exposures should contain at least one record."),
    ("silver_behavior_has_rows", "behavior", "> 0", "Silver behavior should contain at least one record."),
    ("exposures_user_id_not_null", "exposures", "0", "Every exposure record must have a user_id."),
    ("exposures_event_id_not_null", "exposures", "0", "Every exposure record must have an event_id."),
    ("exposures_valid_variant", "exposures", "0", "assigned_variant must be control or treatment."),
    ("exposures_event_id_unique", "exposures", "0", "Exposure event_id should be unique after Silver deduplication."),
    ("user_assigned_to_single_variant", "exposures", "0", "A user should not be assigned to multiple variants in one experiment."),
    ("behavior_user_id_not_null", "behavior", "0", "Every behavior record must have a user_id."),
    ("behavior_event_id_not_null", "behavior", "0", "Every behavior record must have an event_id."),
    ("behavior_valid_event_name", "behavior", "0", "event_name must be one of the approved funnel events."),
    ("behavior_event_id_unique", "behavior", "0", "Behavior event_id should be unique after Silver deduplication."),
    ("purchase_revenue_valid", "behavior", "0", "Purchase events must have non-negative revenue_gbp."),
    ("refund_amount_valid", "behavior", "0", "Refund events must have non-negative refund_gbp."),
    ("behavior_has_matching_exposure", "behavior", "0 preferred", "Behavior events should normally have a matching exposure."),
    ("exposure_event_time_not_in_future", "exposures", "0", "Exposure timestamps should not be in the future."),
    ("behavior_event_time_not_in_future", "behavior", "0", "Behavior timestamps should not be in the future."),
]
QUALITY_LAYER = "silver"
# ---------------------------------------------------------------------------
