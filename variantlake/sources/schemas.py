"""Explicit schemas for every lake table.

Bronze is parsed with a fixed schema (unknown JSON fields are dropped, missing
ones become NULL); Silver/quarantine/Gold are read back with the same explicit
schemas so that an empty partitioned table still has a schema.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


ENVELOPE_SCHEMA = StructType(
    [
        StructField("key", BinaryType(), True),
        StructField("value", BinaryType(), True),
        StructField("topic", StringType(), True),
        StructField("partition", IntegerType(), True),
        StructField("offset", LongType(), True),
        StructField("timestamp", TimestampType(), True),
    ]
)

EXPOSURE_JSON_SCHEMA = StructType(
    _strings(
        "event_type",
        "event_id",
        "experiment_id",
        "user_id",
        "session_id",
        "assigned_variant",
        "device",
        "country",
        "traffic_source",
        "app_version",
        "event_time",
    )
)

# ``refund_gbp`` is read when the producer sends it; an older Bronze without the
# field simply yields NULL (see operators.silver.flatten_behavior).
PROPERTIES_SCHEMA = StructType(
    [
        StructField("page", StringType(), True),
        StructField("is_bot", BooleanType(), True),
        StructField("revenue_gbp", DoubleType(), True),
        StructField("failure_reason", StringType(), True),
        StructField("refund_gbp", DoubleType(), True),
    ]
)

BEHAVIOR_JSON_SCHEMA = StructType(
    _strings(
        "event_type",
        "event_id",
        "experiment_id",
        "user_id",
        "session_id",
        "event_name",
        "device",
        "country",
        "traffic_source",
        "app_version",
        "event_time",
    )
    + [StructField("properties", PROPERTIES_SCHEMA, True)]
)

KAFKA_COLUMNS = [
    StructField("kafka_key", StringType(), True),
    StructField("kafka_value", StringType(), True),
    StructField("kafka_ingestion_timestamp", TimestampType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
]
EVENT_TIME_COLUMNS = [
    StructField("event_timestamp", TimestampType(), True),
    StructField("year", IntegerType(), True),
    StructField("month", IntegerType(), True),
    StructField("day", IntegerType(), True),
]

BRONZE_EXPOSURES_SCHEMA = StructType(list(EXPOSURE_JSON_SCHEMA.fields) + KAFKA_COLUMNS + EVENT_TIME_COLUMNS)
BRONZE_BEHAVIOR_SCHEMA = StructType(list(BEHAVIOR_JSON_SCHEMA.fields) + KAFKA_COLUMNS + EVENT_TIME_COLUMNS)

SILVER_EXPOSURES_SCHEMA = StructType(
    list(BRONZE_EXPOSURES_SCHEMA.fields)
    + [
        StructField("processing_timestamp", TimestampType(), True),
        StructField("is_bot", BooleanType(), True),
    ]
)
SILVER_BEHAVIOR_SCHEMA = StructType(
    [f for f in BRONZE_BEHAVIOR_SCHEMA.fields if f.name != "properties"]
    + [
        StructField("processing_timestamp", TimestampType(), True),
        StructField("page_url", StringType(), True),
        StructField("is_bot", BooleanType(), True),
        StructField("revenue_gbp", DoubleType(), True),
        StructField("refund_gbp", DoubleType(), True),
        StructField("failure_reason", StringType(), True),
    ]
)


def with_reason(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField("quarantine_reason", StringType(), True)])


QUARANTINE_EXPOSURES_SCHEMA = with_reason(SILVER_EXPOSURES_SCHEMA)
QUARANTINE_BEHAVIOR_SCHEMA = with_reason(SILVER_BEHAVIOR_SCHEMA)

QUALITY_RESULTS_SCHEMA = StructType(
    _strings("check_name", "layer", "table_name", "status")
    + [StructField("observed_value", DoubleType(), True)]
    + _strings("threshold", "description")
    + [StructField("checked_at", TimestampType(), True)]
)
