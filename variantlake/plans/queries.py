"""Registered queries: one per operator, each with its DuckDB oracle.

Every query starts from the driver's tables (``customer nation orders events``)
through the Bronze fixtures, runs the operator under test on Spark and returns a
``comparable`` projection. ``QUERIES[name](spark, sf_dir)`` is lazy unless the
operator itself is a write (streaming / lake queries run their write and return
a read of the result).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantlake.functions.domains import PARTITION_COLUMNS, QUALITY_CHECKS, QUALITY_LAYER, VALID_BEHAVIOR_EVENTS
from variantlake.functions.expressions import funnel_order as _funnel_order
from variantlake.operators import gold, quality, silver
from variantlake.plans import incremental, incremental_gold, jobs
from variantlake.plans import oracle as O
from variantlake.plans.compare import comparable
from variantlake.sources import fixtures, versions
from variantlake.sources import kafka as K
from variantlake.sources.lake import read_table, scratch_dir, table_path, write_table
from variantlake.sources.schemas import (
    BEHAVIOR_JSON_SCHEMA,
    BRONZE_BEHAVIOR_SCHEMA,
    BRONZE_EXPOSURES_SCHEMA,
    ENVELOPE_SCHEMA,
    EXPOSURE_JSON_SCHEMA,
    QUALITY_RESULTS_SCHEMA,
    QUARANTINE_BEHAVIOR_SCHEMA,
    QUARANTINE_EXPOSURES_SCHEMA,
    SILVER_BEHAVIOR_SCHEMA,
    SILVER_EXPOSURES_SCHEMA,
)
from variantlake.streaming.bronze import behavior_stream, exposures_stream

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# --- shared inputs ----------------------------------------------------------------


def bronze_e(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.bronze_exposures(spark, sf)


def bronze_b(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.bronze_behavior(spark, sf)


def silver_e(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_exposures(bronze_e(spark, sf))[0]


def silver_b(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_behavior(bronze_b(spark, sf))[0]


def _sel(cols: str, source: str) -> str:
    return O.with_base(f"SELECT {cols} FROM {source}")


# --- step 1-2: exposures -----------------------------------------------------------


@register("silver_enrich_exposures", _sel(O.SILVER_EXPOSURE_COLS, "enriched_exposures"))
def q_enrich(spark, sf):
    return comparable(silver.enrich_exposures(bronze_e(spark, sf)))


@register(
    "silver_is_bot_default",
    O.with_base(
        "SELECT event_id, topic, false AS is_bot FROM bronze_exposures "
        "UNION ALL SELECT event_id, topic, COALESCE(properties.is_bot, false) AS is_bot FROM bronze_behavior"
    ),
)
def q_is_bot(spark, sf):
    absent = silver.normalise_is_bot(bronze_e(spark, sf).select("event_id", "topic"))
    present = silver.normalise_is_bot(
        bronze_b(spark, sf).select("event_id", "topic", F.col("properties.is_bot").cast("string").alias("is_bot"))
    )
    return absent.unionByName(present)


@register("silver_valid_exposures", _sel(O.SILVER_EXPOSURE_COLS, "valid_exposures"))
def q_valid_exposures(spark, sf):
    return comparable(silver.valid_exposures(silver.enrich_exposures(bronze_e(spark, sf))))


@register(
    "silver_quarantine_invalid_exposures",
    _sel(O.SILVER_EXPOSURE_COLS + ", quarantine_reason", "invalid_exposures"),
)
def q_invalid_exposures(spark, sf):
    return comparable(silver.invalid_exposures(silver.enrich_exposures(bronze_e(spark, sf))))


@register("silver_dedup_exposures", _sel(O.SILVER_EXPOSURE_COLS, "dedup_exposures"))
def q_dedup_exposures(spark, sf):
    enriched = silver.enrich_exposures(bronze_e(spark, sf))
    return comparable(silver.dedup_keep_first(silver.valid_exposures(enriched)))


@register("multi_variant_users", _sel("experiment_id, user_id", "multi_variant_users"))
def q_multi_variant(spark, sf):
    enriched = silver.enrich_exposures(bronze_e(spark, sf))
    return silver.multi_variant_users(silver.dedup_keep_first(silver.valid_exposures(enriched)))


@register(
    "silver_conflicted_exposures",
    _sel(O.SILVER_EXPOSURE_COLS + ", quarantine_reason", "conflicted_exposures"),
)
def q_conflicted(spark, sf):
    enriched = silver.enrich_exposures(bronze_e(spark, sf))
    flagged = silver.flag_conflicts(silver.dedup_keep_first(silver.valid_exposures(enriched)))
    return comparable(silver.conflicted_exposures(flagged))


@register("silver_exposures", _sel(O.SILVER_EXPOSURE_COLS, "silver_exposures"))
def q_silver_exposures(spark, sf):
    return comparable(silver_e(spark, sf))


@register(
    "silver_quarantine_exposures",
    _sel(O.SILVER_EXPOSURE_COLS + ", quarantine_reason", "quarantine_exposures"),
)
def q_quarantine_exposures(spark, sf):
    return comparable(silver.silver_exposures(bronze_e(spark, sf))[1])


# --- step 3: behavior ----------------------------------------------------------------


@register("silver_flatten_behavior", _sel(O.SILVER_BEHAVIOR_COLS, "flat_behavior"))
def q_flatten(spark, sf):
    return comparable(silver.flatten_behavior(bronze_b(spark, sf)))


@register("silver_flatten_no_properties", _sel(O.NO_PROPERTIES_BEHAVIOR_COLS, "bronze_behavior"))
def q_flatten_no_props(spark, sf):
    return comparable(silver.flatten_behavior(bronze_b(spark, sf).drop("properties")))


@register("silver_valid_behavior", _sel(O.SILVER_BEHAVIOR_COLS, "valid_behavior"))
def q_valid_behavior(spark, sf):
    return comparable(silver.valid_behavior(silver.flatten_behavior(bronze_b(spark, sf))))


@register("silver_bot_filter", _sel(O.SILVER_BEHAVIOR_COLS, "bot_behavior"))
def q_bots(spark, sf):
    return comparable(silver.bot_behavior(silver.flatten_behavior(bronze_b(spark, sf))))


@register(
    "silver_quarantine_behavior",
    _sel(O.SILVER_BEHAVIOR_COLS + ", quarantine_reason", "invalid_behavior"),
)
def q_quarantine_behavior(spark, sf):
    return comparable(silver.silver_behavior(bronze_b(spark, sf))[1])


@register("silver_dedup_behavior", _sel(O.SILVER_BEHAVIOR_COLS, "silver_behavior"))
def q_silver_behavior(spark, sf):
    return comparable(silver_b(spark, sf))


# --- step 1 + 4: gold ----------------------------------------------------------------


@register("gold_experiment_metrics", O.with_base(O.metrics_select("exposure_outcomes")))
def q_experiment_metrics(spark, sf):
    return comparable(gold.experiment_metrics(silver_e(spark, sf), silver_b(spark, sf)))


_PER_USER = O.with_base(
    O.metrics_select(
        """(
  SELECT u.experiment_id, u.user_id, u.assigned_variant,
    CASE WHEN p.purchase_count IS NOT NULL THEN 1 ELSE 0 END AS converted,
    COALESCE(p.purchase_count, 0) AS purchase_count, COALESCE(r.refund_count, 0) AS refund_count,
    COALESCE(p.purchase_revenue_gbp, 0.0) AS purchase_revenue_gbp,
    COALESCE(r.refund_amount_gbp, 0.0) AS refund_amount_gbp,
    COALESCE(p.purchase_revenue_gbp, 0.0) - COALESCE(r.refund_amount_gbp, 0.0) AS net_revenue_gbp
  FROM exposed_users u
  LEFT JOIN user_purchases p ON u.experiment_id = p.experiment_id AND u.user_id = p.user_id
  LEFT JOIN user_refunds r ON u.experiment_id = r.experiment_id AND u.user_id = r.user_id)"""
    )
)


@register("gold_experiment_metrics_per_user", _PER_USER)
def q_experiment_metrics_per_user(spark, sf):
    return comparable(gold.experiment_metrics(silver_e(spark, sf), silver_b(spark, sf), one_row_per_user=True))


@register(
    "gold_user_purchases",
    _sel(
        f"experiment_id, user_id, purchase_count, purchase_revenue_gbp, "
        f"{O.ts('first_purchase_timestamp')} AS first_purchase_timestamp",
        "user_purchases",
    ),
)
def q_user_purchases(spark, sf):
    return comparable(gold.user_purchases(silver_b(spark, sf)))


@register("gold_user_refunds", _sel("experiment_id, user_id, refund_count, refund_amount_gbp", "user_refunds"))
def q_user_refunds(spark, sf):
    return comparable(gold.user_refunds(silver_b(spark, sf)))


@register(
    "gold_user_outcomes",
    O.with_base(
        f"""
SELECT COALESCE(p.experiment_id, r.experiment_id) AS experiment_id, COALESCE(p.user_id, r.user_id) AS user_id,
  p.purchase_count IS NOT NULL AS has_purchase, COALESCE(p.purchase_count, 0) AS purchase_count,
  p.purchase_revenue_gbp, {O.ts('p.first_purchase_timestamp')} AS first_purchase_timestamp,
  COALESCE(r.refund_count, 0) AS refund_count, r.refund_amount_gbp
FROM user_purchases p FULL OUTER JOIN user_refunds r ON p.experiment_id = r.experiment_id AND p.user_id = r.user_id
"""
    ),
)
def q_user_outcomes(spark, sf):
    return comparable(gold.user_outcomes(silver_b(spark, sf)))


@register("gold_exposed_users", _sel("experiment_id, user_id, assigned_variant", "exposed_users"))
def q_exposed_users(spark, sf):
    return gold.exposed_users(silver_e(spark, sf))


@register("gold_user_stages", _sel("experiment_id, user_id, event_name", "user_stages"))
def q_user_stages(spark, sf):
    return gold.user_stages(silver_b(spark, sf))


@register("gold_exposure_counts", _sel("experiment_id, assigned_variant, exposed_users", "exposure_counts"))
def q_exposure_counts(spark, sf):
    return gold.exposure_counts(gold.exposed_users(silver_e(spark, sf)))


@register(
    "gold_funnel_metrics",
    O.with_base(
        f"""
SELECT f.experiment_id, f.assigned_variant, f.event_name, f.users_reached_stage, c.exposed_users,
  {O.r2("f.users_reached_stage / c.exposed_users * 100")} AS stage_rate_pct,
  {O.funnel_case("f.event_name")} AS funnel_order
FROM (
  SELECT * FROM (
    SELECT u.experiment_id, u.assigned_variant, s.event_name, count(DISTINCT u.user_id) AS users_reached_stage
    FROM exposed_users u LEFT JOIN user_stages s ON u.experiment_id = s.experiment_id AND u.user_id = s.user_id
    GROUP BY u.experiment_id, u.assigned_variant, s.event_name)
  WHERE event_name IS NOT NULL) f
LEFT JOIN exposure_counts c ON f.experiment_id = c.experiment_id AND f.assigned_variant = c.assigned_variant
"""
    ),
)
def q_funnel(spark, sf):
    return comparable(gold.funnel_metrics(silver_e(spark, sf), silver_b(spark, sf)))


@register(
    "gold_segment_metrics",
    O.with_base(
        f"""
SELECT *, {O.r2("converted_users / exposed_users * 100")} AS conversion_rate_pct FROM (
  SELECT experiment_id, assigned_variant, country, traffic_source, device,
    count(DISTINCT user_id) AS exposed_users, CAST(sum(converted) AS BIGINT) AS converted_users,
    {O.r2("sum(purchase_revenue_gbp)")} AS revenue_gbp
  FROM exposure_outcomes GROUP BY experiment_id, assigned_variant, country, traffic_source, device)
"""
    ),
)
def q_segments(spark, sf):
    return comparable(gold.segment_metrics(silver_e(spark, sf), silver_b(spark, sf)))


def _dup_ids(source: str) -> str:
    return f"(SELECT count(*) FROM (SELECT event_id FROM {source} GROUP BY event_id HAVING count(*) > 1))"


_ORPHANS = (
    "(SELECT count(*) FROM silver_behavior b ANTI JOIN (SELECT DISTINCT experiment_id, user_id FROM silver_exposures) e "
    "ON b.experiment_id = e.experiment_id AND b.user_id = e.user_id)"
)


@register(
    "gold_health_summary",
    O.with_base(
        f"""
SELECT metric_name, CAST(metric_value AS BIGINT) AS metric_value FROM (
  SELECT 'silver_exposure_rows' AS metric_name, (SELECT count(*) FROM silver_exposures) AS metric_value
  UNION ALL SELECT 'silver_behavior_rows', (SELECT count(*) FROM silver_behavior)
  UNION ALL SELECT 'duplicate_exposure_event_ids', {_dup_ids("silver_exposures")}
  UNION ALL SELECT 'duplicate_behavior_event_ids', {_dup_ids("silver_behavior")}
  UNION ALL SELECT 'behavior_without_matching_exposure', {_ORPHANS})
"""
    ),
)
def q_health(spark, sf):
    return comparable(gold.health_summary(silver_e(spark, sf), silver_b(spark, sf)))


# --- step 5: quality ----------------------------------------------------------------


def _quality_sql(exp: str, beh: str) -> str:
    observed = {
        "silver_exposures_has_rows": f"(SELECT count(*) FROM {exp})",
        "silver_behavior_has_rows": f"(SELECT count(*) FROM {beh})",
        "exposures_user_id_not_null": f"(SELECT count(*) FROM {exp} WHERE user_id IS NULL)",
        "exposures_event_id_not_null": f"(SELECT count(*) FROM {exp} WHERE event_id IS NULL)",
        "exposures_valid_variant": f"(SELECT count(*) FROM {exp} WHERE NOT assigned_variant IN ('control', 'treatment'))",
        "exposures_event_id_unique": _dup_ids(exp),
        "user_assigned_to_single_variant": (
            f"(SELECT count(*) FROM (SELECT experiment_id, user_id FROM {exp} GROUP BY experiment_id, user_id "
            "HAVING count(DISTINCT assigned_variant) > 1))"
        ),
        "behavior_user_id_not_null": f"(SELECT count(*) FROM {beh} WHERE user_id IS NULL)",
        "behavior_event_id_not_null": f"(SELECT count(*) FROM {beh} WHERE event_id IS NULL)",
        "behavior_valid_event_name": f"(SELECT count(*) FROM {beh} WHERE NOT event_name IN {O.EVENTS_IN})",
        "behavior_event_id_unique": _dup_ids(beh),
        "purchase_revenue_valid": (
            f"(SELECT count(*) FROM {beh} WHERE event_name = 'purchase' AND (revenue_gbp IS NULL OR revenue_gbp < 0))"
        ),
        "refund_amount_valid": (
            f"(SELECT count(*) FROM {beh} WHERE event_name = 'refund' AND (refund_gbp IS NULL OR refund_gbp < 0))"
        ),
        "behavior_has_matching_exposure": (
            f"(SELECT count(*) FROM {beh} b ANTI JOIN (SELECT DISTINCT experiment_id, user_id FROM {exp}) e "
            "ON b.experiment_id = e.experiment_id AND b.user_id = e.user_id)"
        ),
        "exposure_event_time_not_in_future": (
            f"(SELECT count(*) FROM {exp} WHERE event_timestamp > CAST(current_timestamp AS TIMESTAMP))"
        ),
        "behavior_event_time_not_in_future": (
            f"(SELECT count(*) FROM {beh} WHERE event_timestamp > CAST(current_timestamp AS TIMESTAMP))"
        ),
    }
    rows = []
    for name, table, threshold, desc in QUALITY_CHECKS:
        if name.endswith("_has_rows"):
            status = "CASE WHEN v > 0 THEN 'PASS' ELSE 'FAIL' END"
        elif name == "behavior_has_matching_exposure":
            status = "CASE WHEN v > 0 THEN 'WARN' ELSE 'PASS' END"
        else:
            status = "CASE WHEN v = 0 THEN 'PASS' ELSE 'FAIL' END"
        rows.append(
            f"SELECT '{name}' AS check_name, '{QUALITY_LAYER}' AS layer, '{table}' AS table_name, "
            f"{status} AS status, CAST(v AS DOUBLE) AS observed_value, '{threshold}' AS threshold, "
            f"'{desc}' AS description FROM (SELECT {observed[name]} AS v)"
        )
    return O.with_base("\nUNION ALL ".join(rows))


@register("quality_checks", _quality_sql("silver_exposures", "silver_behavior"))
def q_quality(spark, sf):
    return comparable(quality.run_checks(silver_e(spark, sf), silver_b(spark, sf)))


@register("quality_checks_raw", _quality_sql("enriched_exposures", "flat_behavior"))
def q_quality_raw(spark, sf):
    enriched = silver.enrich_exposures(bronze_e(spark, sf))
    flat = silver.flatten_behavior(bronze_b(spark, sf))
    return comparable(quality.run_checks(enriched, flat))


@register("duplicate_exposure_ids", O.with_base(f"SELECT {_dup_ids('bronze_exposures')} AS duplicate_ids"))
def q_dup_exposures(spark, sf):
    return quality.duplicate_key_count(bronze_e(spark, sf))


@register("duplicate_behavior_ids", O.with_base(f"SELECT {_dup_ids('bronze_behavior')} AS duplicate_ids"))
def q_dup_behavior(spark, sf):
    return quality.duplicate_key_count(bronze_b(spark, sf))


@register(
    "orphan_behavior",
    O.with_base(
        f"SELECT {O.SILVER_BEHAVIOR_COLS} FROM silver_behavior b ANTI JOIN silver_exposures e "
        "ON b.experiment_id = e.experiment_id AND b.user_id = e.user_id"
    ),
)
def q_orphans(spark, sf):
    return comparable(gold.orphan_behavior(silver_b(spark, sf), silver_e(spark, sf)))


# --- step 6: ingest, batch form ------------------------------------------------------


_ENVELOPE_COLS = 'kafka_key, kafka_value, kafka_ingestion_timestamp, topic, "partition", "offset"'


@register(
    "bronze_envelope_decode",
    O.with_base(
        f"SELECT {_ENVELOPE_COLS} FROM bronze_exposures UNION ALL SELECT {_ENVELOPE_COLS} FROM bronze_behavior"
    ),
)
def q_envelope_decode(spark, sf):
    envelopes = fixtures.exposure_envelopes(spark, sf).unionByName(fixtures.behavior_envelopes(spark, sf))
    return comparable(K.decode_envelope(envelopes))


@register("bronze_parse_exposures", _sel(O.PARSED_EXPOSURE_COLS, "bronze_exposures"))
def q_parse_exposures(spark, sf):
    return comparable(K.parse_json(K.decode_envelope(fixtures.exposure_envelopes(spark, sf)), EXPOSURE_JSON_SCHEMA))


@register("bronze_parse_behavior", _sel(O.PARSED_BEHAVIOR_COLS, "bronze_behavior"))
def q_parse_behavior(spark, sf):
    return comparable(K.parse_json(K.decode_envelope(fixtures.behavior_envelopes(spark, sf)), BEHAVIOR_JSON_SCHEMA))


@register(
    "events_props_json",
    "SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, "
    "TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k FROM events",
)
def q_events_props(spark, sf):
    """The JSON parse step on the ``events`` table's ``props`` text (schema ``k INT``)."""
    events = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet")
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.from_json("props", "k INT").getField("k").alias("props_k"),
    )


_TIME_PARTS = f"topic, event_id, event_time, {O.ts('event_timestamp')} AS event_timestamp, {O.DATE_PARTS}"


@register(
    "bronze_event_time_parts",
    O.with_base(f"SELECT {_TIME_PARTS} FROM bronze_exposures UNION ALL SELECT {_TIME_PARTS} FROM bronze_behavior"),
)
def q_event_time_parts(spark, sf):
    cols = ["topic", "event_id", "event_time", "event_timestamp", *PARTITION_COLUMNS]
    e = K.exposures_bronze(fixtures.exposure_envelopes(spark, sf)).select(*cols)
    b = K.behavior_bronze(fixtures.behavior_envelopes(spark, sf)).select(*cols)
    return comparable(e.unionByName(b))


_IN_DOMAIN = f"event_name IN {O.EVENTS_IN}"


@register(
    "scalar_semantics",
    O.with_base(
        f"""
SELECT event_id, CAST({O.funnel_case()} AS VARCHAR) AS funnel_order, {O.r2("revenue_gbp / 3")} AS revenue_third,
  CAST({_IN_DOMAIN} AS VARCHAR) AS in_domain, CAST(NOT ({_IN_DOMAIN}) AS VARCHAR) AS not_in_domain,
  CAST(revenue_gbp >= 0 AS VARCHAR) AS revenue_non_negative, COALESCE(revenue_gbp, refund_gbp, 0.0) AS amount_or_zero,
  CASE WHEN event_name = 'purchase' THEN 1 ELSE 0 END AS is_purchase
FROM flat_behavior
"""
    ),
)
def q_scalar_semantics(spark, sf):
    """round HALF_UP, map lookup miss -> NULL, three-valued IN / NOT IN / comparisons, coalesce."""
    flat = silver.flatten_behavior(bronze_b(spark, sf))
    in_domain = F.col("event_name").isin(VALID_BEHAVIOR_EVENTS)
    # NULL-able integer / boolean results are compared as text (see plans.compare)
    return flat.select(
        "event_id",
        _funnel_order("event_name").cast("string").alias("funnel_order"),
        F.round(F.col("revenue_gbp") / 3, 2).alias("revenue_third"),
        in_domain.cast("string").alias("in_domain"),
        (~in_domain).cast("string").alias("not_in_domain"),
        (F.col("revenue_gbp") >= 0).cast("string").alias("revenue_non_negative"),
        F.coalesce("revenue_gbp", "refund_gbp", F.lit(0.0)).alias("amount_or_zero"),
        F.when(F.col("event_name") == "purchase", 1).otherwise(0).alias("is_purchase"),
    )


# --- step 7: streaming and lake ------------------------------------------------------


def stage_topic(envelopes: DataFrame, path: str) -> None:
    """Stand-in for a Kafka topic: envelope rows as Parquet files.

    A live topic receives records in (roughly) event-time order, so one stretch of
    it covers a few event dates. The fixture rows carry random dates over years, so
    the files are cut by range of event time to keep that property; otherwise every
    ingest task would write one small file per date of the whole fixture. The offset
    is part of the range, so one date (or all rows without one) can span files. There is
    a range for each core of the cluster, and a file holds a million rows at most.
    """
    event_time = F.get_json_object(F.col("value").cast("string"), "$.event_time")
    ranges = envelopes.sparkSession.sparkContext.defaultParallelism
    staged = envelopes.repartitionByRange(ranges, event_time, "offset")
    staged.write.mode("overwrite").option("maxRecordsPerFile", 1_000_000).parquet(path)


def _stream_into_lake(spark: SparkSession, sf: str, entity: str) -> str:
    """Stage envelopes as files, run the Bronze stream over them (availableNow), return the lake base."""
    run = scratch_dir(spark, f"stream-{entity}")
    envelopes = fixtures.exposure_envelopes if entity == "exposures" else fixtures.behavior_envelopes
    staged = f"{run}topic/{entity}/"
    stage_topic(envelopes(spark, sf), staged)
    source = spark.readStream.schema(ENVELOPE_SCHEMA).parquet(staged)
    start = exposures_stream if entity == "exposures" else behavior_stream
    q = start(spark, f"{run}lake", source=source, trigger="availableNow")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"bronze {entity} stream failed: {q.exception()}")
    return f"{run}lake"


@register("bronze_stream_exposures", _sel(O.BRONZE_EXPOSURE_COLS, "bronze_exposures"))
def q_stream_exposures(spark, sf):
    base = _stream_into_lake(spark, sf, "exposures")
    return comparable(read_table(spark, table_path(base, "bronze", "exposures"), BRONZE_EXPOSURES_SCHEMA))


@register("bronze_stream_behavior", _sel(O.BRONZE_BEHAVIOR_COLS, "bronze_behavior"))
def q_stream_behavior(spark, sf):
    base = _stream_into_lake(spark, sf, "behavior")
    return comparable(read_table(spark, table_path(base, "bronze", "behavior"), BRONZE_BEHAVIOR_SCHEMA))


@register(
    "bronze_late_partition",
    O.with_base(
        """
SELECT CAST(year AS VARCHAR) AS year, CAST(month AS VARCHAR) AS month, CAST(day AS VARCHAR) AS day,
  count(*) AS rows, min(event_time) AS min_event_time, max(event_time) AS max_event_time,
  count(*) FILTER (WHERE epoch(CAST(event_time AS TIMESTAMP)) < kafka_ingestion_timestamp) AS late_rows
FROM bronze_behavior GROUP BY year, month, day
"""
    ),
)
def q_late_partition(spark, sf):
    """Streamed behavior per event-date partition (read back from the directories):
    events older than their ingestion time land in their own event-date partition."""
    base = _stream_into_lake(spark, sf, "behavior")
    bronze = read_table(spark, table_path(base, "bronze", "behavior"), BRONZE_BEHAVIOR_SCHEMA)
    event_epoch = F.unix_timestamp(F.concat(F.col("event_time"), F.lit(" UTC")), "yyyy-MM-dd HH:mm:ss z")
    return comparable(
        bronze.groupBy(*PARTITION_COLUMNS).agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("event_time").alias("min_event_time"),
            F.max("event_time").alias("max_event_time"),
            F.count_if(event_epoch < F.unix_timestamp("kafka_ingestion_timestamp")).alias("late_rows"),
        )
    )


@register(
    "dynamic_partition_overwrite",
    O.with_base(
        """
SELECT CAST(year AS VARCHAR) AS year, CAST(month AS VARCHAR) AS month, CAST(day AS VARCHAR) AS day,
  2 AS version, n AS rows FROM v2
UNION ALL
SELECT CAST(year AS VARCHAR) AS year, CAST(month AS VARCHAR) AS month, CAST(day AS VARCHAR) AS day,
  1 AS version, n AS rows FROM v1 WHERE NOT EXISTS (
  SELECT 1 FROM v2 WHERE v2.year IS NOT DISTINCT FROM v1.year AND v2.month IS NOT DISTINCT FROM v1.month
    AND v2.day IS NOT DISTINCT FROM v1.day)
""",
        extra_ctes="""
v1 AS (SELECT year, month, day, count(*) AS n FROM enriched_exposures GROUP BY year, month, day),
v2 AS (SELECT year, month, day, count(*) AS n FROM silver_exposures GROUP BY year, month, day)
""",
    ),
)
def q_dynamic_overwrite(spark, sf):
    """Write all enriched exposures (version 1), then Silver (version 2) with dynamic
    partition overwrite: only event dates present in Silver are replaced, the rest
    (e.g. the NULL-date partition) keep version 1."""
    path = scratch_dir(spark, "dpo") + "exposures/"
    enriched = silver.enrich_exposures(bronze_e(spark, sf))
    write_table(enriched.withColumn("version", F.lit(1)), path, PARTITION_COLUMNS)
    write_table(silver_e(spark, sf).withColumn("version", F.lit(2)), path, PARTITION_COLUMNS, dynamic=True)
    return comparable(
        spark.read.parquet(path).groupBy(*PARTITION_COLUMNS, "version").agg(F.count(F.lit(1)).alias("rows"))
    )


@register("gold_write_roundtrip", O.with_base(O.metrics_select("exposure_outcomes")))
def q_gold_roundtrip(spark, sf):
    """Gold experiment metrics written as an unpartitioned Parquet table and read back."""
    path = scratch_dir(spark, "gold") + "experiment_metrics/"
    write_table(gold.experiment_metrics(silver_e(spark, sf), silver_b(spark, sf)), path)
    return comparable(spark.read.parquet(path))


# --- upstream parity: Bronze without properties.refund_gbp ----------------

_LEGACY_CTES = f"""
legacy_flat AS (SELECT * REPLACE (CAST(NULL AS DOUBLE) AS refund_gbp) FROM flat_behavior),
legacy_silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {O.DEDUP_ORDER}) AS rn
    FROM legacy_flat WHERE {O.BEHAVIOR_VALID})
  WHERE rn = 1)"""


def _legacy_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze behavior as written with the upstream schema, whose properties struct has no refund field."""
    return bronze_b(spark, sf).withColumn("properties", F.col("properties").dropFields("refund_gbp"))


@register(
    "silver_behavior_refund_field_absent",
    O.with_base(f"SELECT {O.SILVER_BEHAVIOR_COLS} FROM legacy_silver", extra_ctes=_LEGACY_CTES),
)
def q_legacy_silver_behavior(spark, sf):
    """With the upstream Bronze schema every refund carries a NULL amount and is quarantined."""
    return comparable(silver.silver_behavior(_legacy_bronze(spark, sf))[0])


_LEGACY_METRICS = O.with_base(
    O.metrics_select("legacy_outcomes"),
    extra_ctes=_LEGACY_CTES
    + f""",
legacy_purchases AS (
  SELECT experiment_id, user_id, count(DISTINCT event_id) AS purchase_count,
    {O.r2("sum(revenue_gbp)")} AS purchase_revenue_gbp
  FROM legacy_silver WHERE event_name = 'purchase' GROUP BY experiment_id, user_id),
legacy_refunds AS (
  SELECT experiment_id, user_id, count(DISTINCT event_id) AS refund_count,
    {O.r2("sum(refund_gbp)")} AS refund_amount_gbp
  FROM legacy_silver WHERE event_name = 'refund' GROUP BY experiment_id, user_id),
legacy_outcomes AS (
  SELECT e.*, CASE WHEN p.purchase_count IS NOT NULL THEN 1 ELSE 0 END AS converted,
    COALESCE(p.purchase_count, 0) AS purchase_count, COALESCE(r.refund_count, 0) AS refund_count,
    COALESCE(p.purchase_revenue_gbp, 0.0) AS purchase_revenue_gbp,
    COALESCE(r.refund_amount_gbp, 0.0) AS refund_amount_gbp,
    COALESCE(p.purchase_revenue_gbp, 0.0) - COALESCE(r.refund_amount_gbp, 0.0) AS net_revenue_gbp
  FROM silver_exposures e
  LEFT JOIN legacy_purchases p ON e.experiment_id = p.experiment_id AND e.user_id = p.user_id
  LEFT JOIN legacy_refunds r ON e.experiment_id = r.experiment_id AND e.user_id = r.user_id)""",
)


@register("gold_experiment_metrics_refund_field_absent", _LEGACY_METRICS)
def q_legacy_metrics(spark, sf):
    """Gold as upstream produced it: no refund reaches Silver, so refunds are 0."""
    behavior = silver.silver_behavior(_legacy_bronze(spark, sf))[0]
    return comparable(gold.experiment_metrics(silver_e(spark, sf), behavior))


# --- the events table through the file-stream source and the Bronze sink ----------------


@register(
    "events_stream_props",
    "SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, "
    "TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k, "
    "CAST(year(ts) AS VARCHAR) AS year, CAST(month(ts) AS VARCHAR) AS month, CAST(day(ts) AS VARCHAR) AS day "
    "FROM events",
)
def q_events_stream(spark, sf):
    """``events`` files as a stream source: parse ``props`` (schema ``k INT``), add the
    event-date columns and write through the Bronze file sink (availableNow); read back."""
    from variantlake.streaming.bronze import start_bronze_stream

    run = scratch_dir(spark, "stream-events")
    path = f"{sf.rstrip('/')}/events.parquet"
    # the file source takes a folder or a pattern; this one matches the table, be it a file or a folder
    source = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[t]")
    parsed = source.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.from_json("props", "k INT").getField("k").alias("props_k"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
    )
    q = start_bronze_stream(parsed, f"{run}sink/", f"{run}checkpoint/", trigger="availableNow")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"events stream failed: {q.exception()}")
    return comparable(spark.read.parquet(f"{run}sink/"))


# --- the jobs themselves, over a lake of their own -----------------------------------------

# (application id, sf_dir) -> base of the lake that the jobs were run on
_LAKES: dict[tuple[str, str], str] = {}


def job_lake(spark: SparkSession, sf: str) -> str:
    """Base of a lake below the checkpoint folder: both topics streamed into Bronze, then
    the Silver, quality and Gold jobs run; once per session and scale."""
    key = (spark.conf.get("spark.app.id", "") or str(id(spark)), sf.rstrip("/"))
    if key in _LAKES:
        return _LAKES[key]
    run = scratch_dir(spark, "jobs")
    lake = f"{run}lake"
    for entity, build, start in (
        ("exposures", fixtures.exposure_envelopes, exposures_stream),
        ("behavior", fixtures.behavior_envelopes, behavior_stream),
    ):
        stage_topic(build(spark, sf), f"{run}topic/{entity}")
        q = start(spark, lake, source=spark.readStream.schema(ENVELOPE_SCHEMA).parquet(f"{run}topic/{entity}"), trigger="availableNow")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"bronze {entity} stream failed: {q.exception()}")
    jobs.build_silver(spark, lake)
    jobs.run_quality(spark, lake)
    jobs.build_gold(spark, lake)
    _LAKES[key] = lake
    return lake


def _job_table(name: str, same_as: str, layer: str, table: str, schema=None) -> None:
    """Register the written table of a job, held against the oracle of the lazy query."""

    def run(spark, sf):
        return comparable(read_table(spark, table_path(job_lake(spark, sf), layer, table), schema))

    register(name, ORACLE[same_as])(run)


_job_table("job_silver_exposures", "silver_exposures", "silver", "exposures", SILVER_EXPOSURES_SCHEMA)
_job_table("job_silver_behavior", "silver_dedup_behavior", "silver", "behavior", SILVER_BEHAVIOR_SCHEMA)
_job_table("job_quarantine_exposures", "silver_quarantine_exposures", "quarantine", "exposures", QUARANTINE_EXPOSURES_SCHEMA)
_job_table("job_quarantine_behavior", "silver_quarantine_behavior", "quarantine", "behavior", QUARANTINE_BEHAVIOR_SCHEMA)
_job_table("job_quality_results", "quality_checks", "gold", "data_quality_results", QUALITY_RESULTS_SCHEMA)
_job_table("job_gold_experiment_metrics", "gold_experiment_metrics", "gold", "experiment_metrics")
_job_table("job_gold_funnel_metrics", "gold_funnel_metrics", "gold", "funnel_metrics")
_job_table("job_gold_segment_metrics", "gold_segment_metrics", "gold", "segment_metrics")
_job_table("job_gold_health", "gold_health_summary", "gold", "data_health_summary")


# --- Silver kept up to date over several runs ---------------------------------------------

# (application id, sf_dir) -> base of a lake whose Bronze arrived in parts
_UPDATED: dict[tuple[str, str], str] = {}
ARRIVALS = 2


def updated_lake(spark: SparkSession, sf: str) -> str:
    """Base of a lake whose Bronze rows arrived in parts, dealt by their position, with an incremental
    Silver run after each: retries come before their originals, and conflicts arise over runs."""
    key = (spark.conf.get("spark.app.id", "") or str(id(spark)), sf.rstrip("/"))
    if key in _UPDATED:
        return _UPDATED[key]
    lake = scratch_dir(spark, "updated")
    part = F.pmod(F.xxhash64("topic", "partition", "offset"), F.lit(ARRIVALS))
    for i in range(ARRIVALS):
        for entity, bronze in (("exposures", bronze_e(spark, sf)), ("behavior", bronze_b(spark, sf))):
            write_table(bronze.where(part == i), table_path(lake, "bronze", entity), PARTITION_COLUMNS, mode="append")
        incremental.update_silver(spark, lake)
    _UPDATED[key] = lake
    return lake


def _updated_table(name: str, same_as: str, layer: str, entity: str) -> None:
    """Register a published table after all runs, held against the oracle of one build over all of Bronze."""

    def run(spark, sf):
        return comparable(incremental.read_published(spark, updated_lake(spark, sf), layer, entity))

    register(name, ORACLE[same_as])(run)


_updated_table("incremental_silver_exposures", "silver_exposures", "silver", "exposures")
_updated_table("incremental_silver_behavior", "silver_dedup_behavior", "silver", "behavior")
_updated_table("incremental_quarantine_exposures", "silver_quarantine_exposures", "quarantine", "exposures")
_updated_table("incremental_quarantine_behavior", "silver_quarantine_behavior", "quarantine", "behavior")


@register("incremental_gold_experiment", ORACLE["gold_experiment_metrics"])
def incremental_gold_experiment(spark, sf):
    return comparable(gold.experiment_metrics(*jobs.read_silver(spark, updated_lake(spark, sf))))


def _updated_gold(name: str, same_as: str) -> None:
    """Register a Gold table kept up to date from changed users, held against the oracle of one build."""

    def run(spark, sf):
        lake = updated_lake(spark, sf)
        if versions.current(spark, lake, incremental_gold.GOLD) is None:
            for version in range(1, ARRIVALS + 1):  # as it would have been run after each arrival
                incremental_gold.update_gold(spark, lake, silver=version)
        return comparable(incremental_gold.read_gold(spark, lake, name))

    register(f"incremental_state_{name}", ORACLE[same_as])(run)


for _name in ("experiment_metrics", "funnel_metrics", "segment_metrics"):
    _updated_gold(_name, f"gold_{_name}")


# --- malformed input and ingestion ties ------------------------------------------------------

# one envelope value per order: well-formed, bad or zoned times, broken JSON, a wrong-typed
# leaf, an empty object, no value
_ID = """'{"event_id":"b' || CAST(o_orderkey AS STRING) || '"'"""
MALFORMED = f"""CASE o_orderkey % 8
  WHEN 0 THEN {_ID} || ',"event_time":"1995-01-02 03:04:05.678901"}}'
  WHEN 1 THEN {_ID} || ',"event_time":"not a time"}}'
  WHEN 2 THEN {_ID} || ',"event_time":"1995-01-02T03:04:05.123456+02:00"}}'
  WHEN 3 THEN {_ID} || ', '
  WHEN 4 THEN {_ID} || ',"event_time":"1995-01-02 03:04:05","properties":{{"revenue_gbp":"dear","page":"/p"}}}}'
  WHEN 5 THEN {_ID} || ',"event_time":"1995-01-02T03:04:05Z"}}'
  WHEN 6 THEN '{{}}' END"""


@register(
    "bronze_malformed_input",
    f"""
WITH rows AS (SELECT o_orderkey AS k, {MALFORMED} AS kafka_value FROM orders),
parsed AS (
  SELECT k, json_extract_string(v, '$.event_id') AS event_id, json_extract_string(v, '$.event_time') AS event_time,
    json_extract_string(v, '$.properties.page') AS page
  FROM (SELECT k, CASE WHEN json_valid(kafka_value) THEN kafka_value END AS v FROM rows))
SELECT k, event_id, event_time, page, CAST(NULL AS DOUBLE) AS revenue_gbp,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_timestamp, CAST(year(ts) AS VARCHAR) AS year
FROM (
  SELECT *, CASE WHEN regexp_matches(event_time, '(Z|[+-][0-9][0-9]:[0-9][0-9])$')
    THEN make_timestamp(epoch_us(TRY_CAST(event_time AS TIMESTAMPTZ))) ELSE TRY_CAST(event_time AS TIMESTAMP) END AS ts
  FROM parsed)
""",
)
def q_malformed(spark, sf):
    """Bad times, broken JSON and wrong-typed leaves become NULLs; times keep their microseconds
    (a time with an offset is compared in UTC, one without as it stands)."""
    orders = spark.read.parquet(f"{sf.rstrip('/')}/orders.parquet")
    empty = {name: F.lit(None).cast("string").alias(name) for name in K.ENVELOPE_COLUMNS}
    rows = orders.select(*({**empty, "kafka_value": F.expr(MALFORMED).alias("kafka_value"), "offset": F.col("o_orderkey").alias("offset")}.values()))
    bronze = K.add_event_time(K.parse_json(rows, BEHAVIOR_JSON_SCHEMA))
    zoned = F.col("event_time").rlike(r"(Z|[+-]\d\d:\d\d)$")
    at = F.when(zoned, F.to_utc_timestamp("event_timestamp", F.current_timezone())).otherwise(F.col("event_timestamp"))
    return bronze.select(
        F.col("offset").alias("k"),
        "event_id",
        "event_time",
        F.col("properties.page").alias("page"),
        F.col("properties.revenue_gbp").alias("revenue_gbp"),
        F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_timestamp"),
        F.col("year").cast("string").alias("year"),
    )


_TIED = """
tied AS (
  SELECT event_id, "offset", row_number() OVER (PARTITION BY event_id ORDER BY topic, "partition", "offset") AS rn
  FROM valid_behavior)"""


@register("silver_dedup_ingestion_ties", O.with_base('SELECT event_id, "offset" FROM tied WHERE rn = 1', extra_ctes=_TIED))
def q_dedup_ties(spark, sf):
    """All rows ingested in the same instant: the Kafka position decides which one stays, both by
    the window and by the job's narrow decision."""
    at_once = bronze_b(spark, sf).withColumn("kafka_ingestion_timestamp", F.timestamp_seconds(F.lit(0)))
    valid = silver.valid_behavior(silver.flatten_behavior(at_once))
    by_window = silver.dedup_keep_first(valid).select("event_id", "offset")
    by_lookup = silver.keep_first(valid, silver.repeated_ids(valid), tied=False).select("event_id", "offset")
    return by_window.intersectAll(by_lookup)
