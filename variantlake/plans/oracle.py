"""DuckDB SQL restating each step independently, for the correctness gate.

The views ``customer nation orders events`` are registered by the checker. Every
query is ``WITH <all base CTEs> SELECT ...``. The CTEs follow the upstream job's
own formulation (OR-of-invalid rules, ``count(DISTINCT ..)``, inner + anti joins),
not our Spark plan, so the two implementations check each other.

Output conventions shared with ``plans.compare``: event-time timestamps as
``yyyy-MM-dd HH:mm:ss`` text, the Kafka ingestion time as epoch seconds, struct
columns flattened to ``<struct>_<field>``, query-time stamps left out.
"""

from __future__ import annotations

from variantlake.sources.fixtures import APP_VERSION, BEHAVIOR_SQL, EXPOSURES_SQL, INGEST_EPOCH


def r2(expr: str) -> str:
    """Spark's round(x, 2) (HALF_UP on the decimal text of the double) in DuckDB."""
    return f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


EXPOSURE_JSON = (
    "CAST(to_json(struct_pack(event_type := 'exposure', event_id := event_id, experiment_id := experiment_id, "
    "user_id := user_id, session_id := session_id, assigned_variant := assigned_variant, device := device, "
    f"country := country, traffic_source := traffic_source, app_version := '{APP_VERSION}', "
    "event_time := event_time)) AS VARCHAR)"
)
PROPS = (
    "struct_pack(page := page, is_bot := is_bot, revenue_gbp := revenue_gbp, "
    "failure_reason := failure_reason, refund_gbp := refund_gbp)"
)
BEHAVIOR_JSON = (
    "CAST(to_json(struct_pack(event_type := 'behavior', event_id := event_id, experiment_id := experiment_id, "
    "user_id := user_id, session_id := 'sb' || substr(event_id, 2), event_name := event_name, "
    "device := CAST(NULL AS VARCHAR), country := CAST(NULL AS VARCHAR), traffic_source := CAST(NULL AS VARCHAR), "
    f"app_version := '{APP_VERSION}', event_time := event_time, properties := {PROPS})) AS VARCHAR)"
)


def _envelope_cols(topic: str) -> str:
    return f"""user_id AS kafka_key,
    CAST({INGEST_EPOCH} + ingest_seq AS BIGINT) AS kafka_ingestion_timestamp,
    '{topic}' AS topic,
    CAST(CAST(substr(event_id, 2) AS BIGINT) % 3 AS INTEGER) AS "partition",
    CAST(substr(event_id, 2) AS BIGINT) * 64 + ingest_seq AS "offset",
    TRY_CAST(event_time AS TIMESTAMP) AS event_timestamp,
    CAST(year(TRY_CAST(event_time AS TIMESTAMP)) AS INTEGER) AS year,
    CAST(month(TRY_CAST(event_time AS TIMESTAMP)) AS INTEGER) AS month,
    CAST(day(TRY_CAST(event_time AS TIMESTAMP)) AS INTEGER) AS day"""


EXPOSURE_VALID = (
    "event_id IS NOT NULL AND user_id IS NOT NULL AND experiment_id IS NOT NULL "
    "AND assigned_variant IN ('control', 'treatment') AND event_timestamp IS NOT NULL"
)
EXPOSURE_INVALID = (
    "event_id IS NULL OR user_id IS NULL OR experiment_id IS NULL OR assigned_variant IS NULL "
    "OR NOT assigned_variant IN ('control', 'treatment') OR event_timestamp IS NULL"
)
EVENTS_IN = "('page_view', 'product_view', 'add_to_cart', 'checkout_started', 'payment_failed', 'purchase', 'refund')"
BEHAVIOR_VALID = (
    "event_id IS NOT NULL AND user_id IS NOT NULL AND experiment_id IS NOT NULL "
    f"AND event_name IN {EVENTS_IN} AND event_timestamp IS NOT NULL AND is_bot = false "
    "AND (event_name <> 'purchase' OR (revenue_gbp IS NOT NULL AND revenue_gbp >= 0)) "
    "AND (event_name <> 'refund' OR (refund_gbp IS NOT NULL AND refund_gbp >= 0))"
)
BEHAVIOR_INVALID = (
    "event_id IS NULL OR user_id IS NULL OR experiment_id IS NULL OR event_name IS NULL "
    f"OR NOT event_name IN {EVENTS_IN} OR event_timestamp IS NULL "
    "OR (event_name = 'purchase' AND (revenue_gbp IS NULL OR revenue_gbp < 0)) "
    "OR (event_name = 'refund' AND (refund_gbp IS NULL OR refund_gbp < 0))"
)
DEDUP_ORDER = 'kafka_ingestion_timestamp ASC NULLS FIRST, topic ASC NULLS FIRST, "partition" ASC NULLS FIRST, "offset" ASC NULLS FIRST'
def funnel_case(column: str = "event_name") -> str:
    return (
        f"CASE {column} WHEN 'page_view' THEN 1 WHEN 'product_view' THEN 2 WHEN 'add_to_cart' THEN 3 "
        "WHEN 'checkout_started' THEN 4 WHEN 'payment_failed' THEN 5 WHEN 'purchase' THEN 6 WHEN 'refund' THEN 7 END"
    )

BASE_CTES = f"""
fx_exposures AS ({EXPOSURES_SQL.format(customer="customer", nation="nation")}),
fx_behavior AS ({BEHAVIOR_SQL.format(orders="orders")}),
bronze_exposures AS (
  SELECT 'exposure' AS event_type, event_id, experiment_id, user_id, session_id, assigned_variant, device, country,
    traffic_source, '{APP_VERSION}' AS app_version, event_time, {EXPOSURE_JSON} AS kafka_value,
    {_envelope_cols("experiment_exposures")}
  FROM fx_exposures),
bronze_behavior AS (
  SELECT 'behavior' AS event_type, event_id, experiment_id, user_id, 'sb' || substr(event_id, 2) AS session_id,
    event_name, CAST(NULL AS VARCHAR) AS device, CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS traffic_source,
    '{APP_VERSION}' AS app_version, event_time, {PROPS} AS properties, {BEHAVIOR_JSON} AS kafka_value,
    {_envelope_cols("user_events")}
  FROM fx_behavior),
enriched_exposures AS (SELECT *, false AS is_bot FROM bronze_exposures),
valid_exposures AS (SELECT * FROM enriched_exposures WHERE {EXPOSURE_VALID}),
invalid_exposures AS (
  SELECT *, 'invalid_exposure_record' AS quarantine_reason FROM enriched_exposures WHERE {EXPOSURE_INVALID}),
dedup_exposures AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {DEDUP_ORDER}) AS rn FROM valid_exposures)
  WHERE rn = 1),
multi_variant_users AS (
  SELECT experiment_id, user_id FROM dedup_exposures GROUP BY experiment_id, user_id
  HAVING count(DISTINCT assigned_variant) > 1),
conflicted_exposures AS (
  SELECT d.*, 'user_assigned_to_multiple_variants' AS quarantine_reason
  FROM dedup_exposures d JOIN multi_variant_users m ON d.experiment_id = m.experiment_id AND d.user_id = m.user_id),
silver_exposures AS (
  SELECT d.* FROM dedup_exposures d ANTI JOIN multi_variant_users m
  ON d.experiment_id = m.experiment_id AND d.user_id = m.user_id),
quarantine_exposures AS (
  SELECT * FROM invalid_exposures UNION ALL BY NAME SELECT * FROM conflicted_exposures),
flat_behavior AS (
  SELECT * EXCLUDE (properties), properties.page AS page_url, COALESCE(properties.is_bot, false) AS is_bot,
    properties.revenue_gbp AS revenue_gbp, properties.refund_gbp AS refund_gbp,
    properties.failure_reason AS failure_reason
  FROM bronze_behavior),
valid_behavior AS (SELECT * FROM flat_behavior WHERE {BEHAVIOR_VALID}),
bot_behavior AS (
  SELECT * FROM flat_behavior WHERE is_bot AND NOT ({BEHAVIOR_INVALID})),
invalid_behavior AS (
  SELECT *, 'invalid_behavior_record' AS quarantine_reason FROM flat_behavior WHERE {BEHAVIOR_INVALID}),
silver_behavior AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {DEDUP_ORDER}) AS rn FROM valid_behavior)
  WHERE rn = 1),
user_purchases AS (
  SELECT experiment_id, user_id, count(DISTINCT event_id) AS purchase_count,
    {r2("sum(revenue_gbp)")} AS purchase_revenue_gbp, min(event_timestamp) AS first_purchase_timestamp
  FROM silver_behavior WHERE event_name = 'purchase' GROUP BY experiment_id, user_id),
user_refunds AS (
  SELECT experiment_id, user_id, count(DISTINCT event_id) AS refund_count,
    {r2("sum(refund_gbp)")} AS refund_amount_gbp
  FROM silver_behavior WHERE event_name = 'refund' GROUP BY experiment_id, user_id),
exposure_outcomes AS (
  SELECT e.*, CASE WHEN p.purchase_count IS NOT NULL THEN 1 ELSE 0 END AS converted,
    COALESCE(p.purchase_count, 0) AS purchase_count, COALESCE(r.refund_count, 0) AS refund_count,
    COALESCE(p.purchase_revenue_gbp, 0.0) AS purchase_revenue_gbp,
    COALESCE(r.refund_amount_gbp, 0.0) AS refund_amount_gbp,
    COALESCE(p.purchase_revenue_gbp, 0.0) - COALESCE(r.refund_amount_gbp, 0.0) AS net_revenue_gbp
  FROM silver_exposures e
  LEFT JOIN user_purchases p ON e.experiment_id = p.experiment_id AND e.user_id = p.user_id
  LEFT JOIN user_refunds r ON e.experiment_id = r.experiment_id AND e.user_id = r.user_id),
exposed_users AS (
  SELECT experiment_id, user_id, min(assigned_variant) AS assigned_variant
  FROM silver_exposures GROUP BY experiment_id, user_id),
user_stages AS (SELECT DISTINCT experiment_id, user_id, event_name FROM silver_behavior),
exposure_counts AS (
  SELECT experiment_id, assigned_variant, count(DISTINCT user_id) AS exposed_users
  FROM exposed_users GROUP BY experiment_id, assigned_variant)
"""


def with_base(select: str, extra_ctes: str = "") -> str:
    """``WITH <base CTEs>[, <extra CTEs>] <select>``."""
    ctes = BASE_CTES.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{select.strip()}\n"


def metrics_select(source: str) -> str:
    """Experiment metrics over an exposure-outcomes relation (one row per exposure or per user)."""
    return f"""
SELECT *, {r2("converted_users / exposed_users * 100")} AS conversion_rate_pct,
  {r2("net_revenue_gbp / exposed_users")} AS revenue_per_exposed_user_gbp,
  CASE WHEN converted_users > 0 THEN {r2("gross_revenue_gbp / converted_users")} ELSE 0.0 END AS avg_order_value_gbp
FROM (
  SELECT experiment_id, assigned_variant, count(DISTINCT user_id) AS exposed_users,
    CAST(COALESCE(sum(converted), 0) AS BIGINT) AS converted_users,
    CAST(COALESCE(sum(purchase_count), 0) AS BIGINT) AS total_purchases,
    CAST(COALESCE(sum(refund_count), 0) AS BIGINT) AS total_refunds,
    COALESCE({r2("sum(purchase_revenue_gbp)")}, 0.0) AS gross_revenue_gbp,
    COALESCE({r2("sum(refund_amount_gbp)")}, 0.0) AS refunds_gbp,
    COALESCE({r2("sum(net_revenue_gbp)")}, 0.0) AS net_revenue_gbp
  FROM {source} GROUP BY experiment_id, assigned_variant)
"""


# comparable column lists -------------------------------------------------------

# partition values (NULL for rows without an event time) as text, as in the
# directory names: a NULL-able integer column is typed differently by the two
# engines' pandas conversions, text is not
DATE_PARTS = "CAST(year AS VARCHAR) AS year, CAST(month AS VARCHAR) AS month, CAST(day AS VARCHAR) AS day"

_PARSED = (
    "event_type, event_id, experiment_id, user_id, session_id, device, country, traffic_source, app_version, "
    'event_time, kafka_key, kafka_value, kafka_ingestion_timestamp, topic, "partition", "offset"'
)
_TIME = f"{ts('event_timestamp')} AS event_timestamp, {DATE_PARTS}"
_COMMON = f"{_PARSED}, {_TIME}"
_PROPS = (
    "properties.page AS properties_page, properties.is_bot AS properties_is_bot, "
    "properties.revenue_gbp AS properties_revenue_gbp, properties.failure_reason AS properties_failure_reason, "
    "properties.refund_gbp AS properties_refund_gbp"
)
# after JSON parsing only (no event-time columns yet)
PARSED_EXPOSURE_COLS = f"assigned_variant, {_PARSED}"
PARSED_BEHAVIOR_COLS = f"event_name, {_PARSED}, {_PROPS}"
# Bronze as stored
BRONZE_EXPOSURE_COLS = f"assigned_variant, {_COMMON}"
BRONZE_BEHAVIOR_COLS = f"event_name, {_COMMON}, {_PROPS}"
SILVER_EXPOSURE_COLS = BRONZE_EXPOSURE_COLS + ", is_bot"
SILVER_BEHAVIOR_COLS = f"event_name, {_COMMON}, page_url, is_bot, revenue_gbp, refund_gbp, failure_reason"
# flattened from a Bronze without the properties struct: typed NULLs, is_bot false
NO_PROPERTIES_BEHAVIOR_COLS = (
    f"event_name, {_COMMON}, CAST(NULL AS VARCHAR) AS page_url, false AS is_bot, CAST(NULL AS DOUBLE) AS revenue_gbp, "
    "CAST(NULL AS DOUBLE) AS refund_gbp, CAST(NULL AS VARCHAR) AS failure_reason"
)
