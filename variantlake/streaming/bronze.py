"""Structured Streaming: Kafka topic -> Bronze Parquet, partitioned by event date.

The query is stateless and map-only (decode, parse, derive time columns), in
append mode: no watermark or state is needed, a late event simply lands in its
own event-date partition. The file sink plus the checkpoint give exactly-once
output (files are committed through ``_spark_metadata``); a restart resumes from
the checkpointed offsets and re-emits nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from variantlake.functions.domains import BEHAVIOR_TOPIC, EXPOSURE_TOPIC, PARTITION_COLUMNS
from variantlake.sources.kafka import behavior_bronze, exposures_bronze, kafka_source
from variantlake.sources.lake import table_path

DEFAULT_TRIGGER = "10 seconds"


def start_bronze_stream(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str = DEFAULT_TRIGGER,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start an append-mode Parquet sink partitioned by year/month/day.

    ``trigger`` is a processing-time interval (e.g. ``"10 seconds"``) or
    ``"availableNow"`` (process what is there, then stop - for back-fills/tests).
    """
    writer = (
        bronze.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*PARTITION_COLUMNS)
        .outputMode("append")
    )
    if query_name:
        writer = writer.queryName(query_name)
    if trigger == "availableNow":
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def _entity_stream(
    spark: SparkSession,
    base: str,
    entity: str,
    topic: str,
    to_bronze,
    brokers: str | None,
    source: DataFrame | None,
    starting_offsets: str,
    trigger: str,
    max_offsets_per_trigger: int | None,
    options: dict[str, str] | None,
) -> StreamingQuery:
    if source is None:
        if not brokers:
            raise ValueError("either a Kafka broker list or a streaming source DataFrame is required")
        source = kafka_source(spark, brokers, topic, starting_offsets, max_offsets_per_trigger, options)
    return start_bronze_stream(
        to_bronze(source),
        table_path(base, "bronze", entity),
        table_path(base, "checkpoints", f"bronze/{entity}"),
        trigger,
        query_name=f"bronze_{entity}",
    )


def exposures_stream(
    spark: SparkSession,
    base: str,
    brokers: str | None = None,
    source: DataFrame | None = None,
    starting_offsets: str = "latest",
    trigger: str = DEFAULT_TRIGGER,
    max_offsets_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """``experiment_exposures`` topic (or any stream with the Kafka envelope schema) -> bronze/exposures.

    ``max_offsets_per_trigger`` bounds a micro-batch; ``options`` (security settings, ...)
    pass through to the Kafka source.
    """
    return _entity_stream(
        spark, base, "exposures", EXPOSURE_TOPIC, exposures_bronze, brokers, source, starting_offsets, trigger, max_offsets_per_trigger, options
    )


def behavior_stream(
    spark: SparkSession,
    base: str,
    brokers: str | None = None,
    source: DataFrame | None = None,
    starting_offsets: str = "latest",
    trigger: str = DEFAULT_TRIGGER,
    max_offsets_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """``user_events`` topic (or any stream with the Kafka envelope schema) -> bronze/behavior; options as ``exposures_stream``."""
    return _entity_stream(
        spark, base, "behavior", BEHAVIOR_TOPIC, behavior_bronze, brokers, source, starting_offsets, trigger, max_offsets_per_trigger, options
    )
