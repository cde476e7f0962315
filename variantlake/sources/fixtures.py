"""Bronze test inputs derived from the driver's TPC-H-style tables.

``customer`` (one exposure per customer), ``nation`` (country) and ``orders``
(behavior events) are turned into exposure and behavior events with injected
defects (NULL ids/variants/times/amounts, out-of-domain values, retry duplicates,
repeated exposures, variant conflicts, orphans, bots). The SQL text is a template
shared by Spark (``spark.sql`` with DataFrame arguments) and the DuckDB oracle
(table names), so both engines start from identical rows.

The rows are then wrapped into Kafka envelopes (JSON value, key, topic,
partition, offset, ingestion time) so that the whole Bronze ingest path runs on
them, batch or streaming.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantlake.functions.domains import BEHAVIOR_TOPIC, EXPOSURE_TOPIC
from variantlake.sources.kafka import behavior_bronze, exposures_bronze
from variantlake.sources.lake import scratch_dir

# Ingestion time of a fixture row: this epoch second plus its ``ingest_seq``.
INGEST_EPOCH = 915148800
APP_VERSION = "4.1.0"

EXPOSURES_SQL = """
WITH c AS (
  SELECT c_custkey AS k, 'u' || CAST(c_custkey AS STRING) AS uid, 'EXP_' || CAST(c_custkey % 2 AS STRING) AS xid,
    CASE WHEN c_custkey % 53 = 0 THEN 'holdout' WHEN c_custkey % 59 = 0 THEN NULL
         WHEN c_custkey % 4 < 2 THEN 'control' ELSE 'treatment' END AS v,
    CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE c_mktsegment END AS device, c_nationkey
  FROM {customer}),
r AS (
  SELECT 'x' || CAST(k AS STRING) AS event_id, xid AS experiment_id, CASE WHEN k % 97 = 0 THEN NULL ELSE uid END AS user_id,
    v AS assigned_variant, device, c_nationkey, k, 0 AS lag_s FROM c
  UNION ALL SELECT 'x' || CAST(k AS STRING), xid, uid, v, device, c_nationkey, k, 30 FROM c WHERE k % 10 = 3
  UNION ALL SELECT 'd' || CAST(k AS STRING), xid, uid, v, device, c_nationkey, k, 1 FROM c WHERE k % 11 = 4
  UNION ALL SELECT 'm' || CAST(k AS STRING), xid, uid, CASE v WHEN 'control' THEN 'treatment' ELSE 'control' END,
    device, c_nationkey, k, 2 FROM c WHERE k % 37 = 5)
SELECT event_id, experiment_id, user_id, 's' || CAST(k AS STRING) AS session_id, assigned_variant, device, n_name AS country,
  CASE k % 5 WHEN 0 THEN 'organic' WHEN 1 THEN 'paid_search' WHEN 2 THEN 'email' WHEN 3 THEN 'affiliate' ELSE 'direct' END AS traffic_source,
  CASE WHEN k % 61 = 0 THEN NULL ELSE '1995-01-0' || CAST(k % 9 + 1 AS STRING) || ' 00:00:00' END AS event_time,
  lag_s AS ingest_seq
FROM r JOIN {nation} ON c_nationkey = n_nationkey
"""

BEHAVIOR_SQL = """
WITH o AS (
  SELECT o_orderkey AS k, 'u' || CAST(o_custkey AS STRING) AS uid, 'EXP_' || CAST(o_custkey % 2 AS STRING) AS xid,
    o_totalprice, o_orderdate,
    CASE WHEN o_orderkey % 47 = 0 THEN 'unknown' WHEN o_orderkey % 7 = 0 THEN 'page_view' WHEN o_orderkey % 7 = 1 THEN 'product_view'
         WHEN o_orderkey % 7 = 2 THEN 'add_to_cart' WHEN o_orderkey % 7 = 3 THEN 'checkout_started'
         WHEN o_orderkey % 7 = 4 THEN 'payment_failed' WHEN o_orderkey % 7 = 5 THEN 'purchase' ELSE 'refund' END AS ev
  FROM {orders}),
r AS (
  SELECT k, uid, xid, o_totalprice, o_orderdate, ev, 0 AS lag_s FROM o
  UNION ALL SELECT k, uid, xid, o_totalprice, o_orderdate, ev, 5 FROM o WHERE k % 20 = 9)
SELECT 'b' || CAST(k AS STRING) AS event_id, xid AS experiment_id, CASE WHEN k % 101 = 0 THEN NULL ELSE uid END AS user_id,
  ev AS event_name, CASE WHEN k % 103 = 0 THEN NULL ELSE CAST(o_orderdate AS STRING) END AS event_time,
  k % 50 = 7 AS is_bot,
  CASE WHEN ev = 'purchase' THEN CASE WHEN k % 41 = 0 THEN NULL WHEN k % 43 = 0 THEN -o_totalprice ELSE o_totalprice END END AS revenue_gbp,
  CASE WHEN ev = 'refund' THEN CASE WHEN k % 39 = 0 THEN NULL ELSE FLOOR(o_totalprice) / 10 END END AS refund_gbp,
  CASE WHEN ev = 'payment_failed' THEN CASE k % 3 WHEN 0 THEN 'card_declined' WHEN 1 THEN 'network_error' ELSE '3ds_timeout' END END AS failure_reason,
  '/' || REPLACE(ev, '_', '-') AS page,
  lag_s AS ingest_seq
FROM r
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def exposure_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        EXPOSURES_SQL,
        customer=_table(spark, sf_dir, "customer"),
        nation=_table(spark, sf_dir, "nation"),
    )


def behavior_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BEHAVIOR_SQL, orders=_table(spark, sf_dir, "orders"))


def _envelope(rows: DataFrame, topic: str, payload) -> DataFrame:
    # numeric part of the event id: distinct (partition, offset) per envelope row
    seq = F.substring("event_id", 2, 1 << 30).cast("long")
    return rows.select(
        F.col("user_id").cast("binary").alias("key"),
        F.to_json(payload, {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (seq % 3).cast("int").alias("partition"),
        (seq * 64 + F.col("ingest_seq")).cast("long").alias("offset"),
        F.timestamp_seconds(F.lit(INGEST_EPOCH) + F.col("ingest_seq")).alias("timestamp"),
    )


def exposure_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.struct(
        F.lit("exposure").alias("event_type"),
        "event_id",
        "experiment_id",
        "user_id",
        "session_id",
        "assigned_variant",
        "device",
        "country",
        "traffic_source",
        F.lit(APP_VERSION).alias("app_version"),
        "event_time",
    )
    return _envelope(exposure_rows(spark, sf_dir), EXPOSURE_TOPIC, payload)


def behavior_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.struct("page", "is_bot", "revenue_gbp", "failure_reason", "refund_gbp")
    payload = F.struct(
        F.lit("behavior").alias("event_type"),
        "event_id",
        "experiment_id",
        "user_id",
        F.concat(F.lit("sb"), F.substring("event_id", 2, 1 << 30)).alias("session_id"),
        "event_name",
        F.lit(None).cast("string").alias("device"),
        F.lit(None).cast("string").alias("country"),
        F.lit(None).cast("string").alias("traffic_source"),
        F.lit(APP_VERSION).alias("app_version"),
        "event_time",
        props.alias("properties"),
    )
    return _envelope(behavior_rows(spark, sf_dir), BEHAVIOR_TOPIC, payload)


# (application id, sf_dir, entity) -> path of the materialised Bronze table
_BRONZE_TABLES: dict[tuple[str, str, str], str] = {}


def _materialised(spark: SparkSession, sf_dir: str, entity: str, build) -> DataFrame:
    """Bronze is a stored table, as in the lake: the fixture is ingested once per
    session and scale (decode + parse + time columns, written as Parquet under the
    shared checkpoint folder) and every query scans that table.

    Reading stored columns also keeps the Silver validity filter a Parquet-pushed
    predicate; applied straight to the parsing projection, the optimizer would
    inline ``from_json`` once per referenced field.
    """
    key = (spark.conf.get("spark.app.id", "") or str(id(spark)), sf_dir.rstrip("/"), entity)
    path = _BRONZE_TABLES.get(key)
    if path is not None:
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            pass
    path = scratch_dir(spark, f"fixture-bronze-{entity}")
    build().write.mode("overwrite").parquet(path)
    _BRONZE_TABLES[key] = path
    return spark.read.parquet(path)


def bronze_exposures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze exposures as the ingest would have written them (a stored table)."""
    return _materialised(spark, sf_dir, "exposures", lambda: exposures_bronze(exposure_envelopes(spark, sf_dir)))


def bronze_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _materialised(spark, sf_dir, "behavior", lambda: behavior_bronze(behavior_envelopes(spark, sf_dir)))
