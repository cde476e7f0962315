"""Bronze ingest steps: Kafka envelope -> typed, time-partitioned rows.

Each step is a pure ``DataFrame -> DataFrame`` function, so the same code runs on
a streaming DataFrame (``readStream``) and on a batch one (tests, back-fills).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from variantlake.functions.expressions import parse_event_time
from variantlake.sources.schemas import BEHAVIOR_JSON_SCHEMA, EXPOSURE_JSON_SCHEMA

ENVELOPE_COLUMNS = ["kafka_key", "kafka_value", "kafka_ingestion_timestamp", "topic", "partition", "offset"]


def kafka_source(
    spark: SparkSession,
    brokers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Streaming Kafka source for one topic (needs the spark-sql-kafka connector).

    ``max_offsets_per_trigger`` bounds a micro-batch, so a backlog (or a restart
    from early offsets) is worked off in batches of bounded size instead of one
    huge first batch. Extra ``options`` (security settings, ...) pass through.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def decode_envelope(df: DataFrame) -> DataFrame:
    """key/value bytes -> strings; keep the ingestion time and the (topic, partition, offset) position."""
    return df.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("kafka_value"),
        F.col("timestamp").alias("kafka_ingestion_timestamp"),
        "topic",
        "partition",
        "offset",
    )


def parse_json(df: DataFrame, schema: StructType) -> DataFrame:
    """Parse ``kafka_value`` with a fixed schema and flatten it in front of the envelope columns.

    PERMISSIVE parsing: malformed text gives all-NULL fields, a wrong-typed leaf gives a
    NULL leaf; the raw text stays in ``kafka_value``.
    """
    data = F.from_json(F.col("kafka_value"), schema).alias("data")
    return df.select(data, *ENVELOPE_COLUMNS).select("data.*", *ENVELOPE_COLUMNS)


def add_event_time(df: DataFrame) -> DataFrame:
    """event_timestamp from ``event_time`` plus year/month/day partition columns.

    A NULL or unparsable time gives NULL parts (the ``__HIVE_DEFAULT_PARTITION__``
    directory on write); late events simply land in their own event-date partition.
    """
    ts = parse_event_time("event_time")
    return df.withColumn("event_timestamp", ts).withColumns(
        {
            "year": F.year("event_timestamp"),
            "month": F.month("event_timestamp"),
            "day": F.dayofmonth("event_timestamp"),
        }
    )


def envelope_to_bronze(envelopes: DataFrame, schema: StructType) -> DataFrame:
    return add_event_time(parse_json(decode_envelope(envelopes), schema))


def exposures_bronze(envelopes: DataFrame) -> DataFrame:
    return envelope_to_bronze(envelopes, EXPOSURE_JSON_SCHEMA)


def behavior_bronze(envelopes: DataFrame) -> DataFrame:
    return envelope_to_bronze(envelopes, BEHAVIOR_JSON_SCHEMA)


def reparse_bronze(bronze: DataFrame, schema: StructType) -> DataFrame:
    """Rebuild Bronze columns from the raw ``kafka_value`` it keeps, with a newer schema.

    E.g. Bronze written before ``properties.refund_gbp`` was in the schema still
    holds the refund amounts in its JSON text; re-parsing recovers them without
    re-reading the topic. Narrow (projection only).
    """
    return add_event_time(parse_json(bronze.select(*ENVELOPE_COLUMNS), schema))
