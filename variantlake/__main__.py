"""Command line: ``python -m variantlake <job> --base <lake URI> [options]``.

Jobs: ``ingest-exposures`` / ``ingest-behavior`` (Kafka -> Bronze stream, runs
until stopped), ``silver``, ``quality``, ``gold``, ``batch`` (the three batch
jobs in order: Silver, quality, Gold), and ``update`` / ``update-gold`` (Silver and Gold
kept up to date from new files only). The lake base and the Kafka
brokers fall back to ``$S3_LAKE_PATH`` and ``$KAFKA_BROKER``. The session comes from
``SparkSession.builder.getOrCreate()``, so master, resources and cluster settings
are whatever ``spark-submit`` / ``spark-defaults`` provide.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="variantlake")
    p.add_argument("job", choices=["ingest-exposures", "ingest-behavior", "silver", "update", "update-gold", "quality", "gold", "batch"])
    p.add_argument(
        "--base",
        default=os.environ.get("S3_LAKE_PATH"),
        help="lake base URI (s3a://..., file://..., or a path); default: $S3_LAKE_PATH",
    )
    p.add_argument(
        "--brokers",
        default=os.environ.get("KAFKA_BROKER", "localhost:9092"),
        help="Kafka bootstrap servers (ingest jobs); default: $KAFKA_BROKER or localhost:9092",
    )
    p.add_argument(
        "--envelope-path",
        help="ingest from Parquet files with the Kafka envelope schema (e.g. an archived topic) instead of Kafka",
    )
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--max-offsets-per-trigger", type=int)
    p.add_argument("--trigger", default="10 seconds", help='processing-time interval or "availableNow"')
    p.add_argument("--reparse", action="store_true", help="rebuild Bronze behavior from its stored JSON text (silver)")
    p.add_argument("--full-refresh", action="store_true", help="static overwrite (silver)")
    p.add_argument("--rebuild", action="store_true", help="handle all of the input again (update, update-gold)")
    p.add_argument("--show", action="store_true", help="print the written tables (quality, gold)")
    a = p.parse_args(argv)
    if not a.base:
        p.error("--base (or $S3_LAKE_PATH) is required")

    spark = SparkSession.builder.appName(f"variantlake-{a.job}").getOrCreate()
    from variantlake.plans import jobs
    from variantlake.sources.kafka import kafka_source
    from variantlake.streaming.bronze import behavior_stream, exposures_stream

    if a.job.startswith("ingest-"):
        from variantlake.functions.domains import BEHAVIOR_TOPIC, EXPOSURE_TOPIC

        exposures = a.job == "ingest-exposures"
        if a.envelope_path:
            from variantlake.sources.schemas import ENVELOPE_SCHEMA

            source = spark.readStream.schema(ENVELOPE_SCHEMA).parquet(a.envelope_path)
        else:
            source = kafka_source(
                spark,
                a.brokers,
                EXPOSURE_TOPIC if exposures else BEHAVIOR_TOPIC,
                a.starting_offsets,
                a.max_offsets_per_trigger,
            )
        start = exposures_stream if exposures else behavior_stream
        start(spark, a.base, source=source, trigger=a.trigger).awaitTermination()
    elif a.job == "silver":
        print(json.dumps(jobs.build_silver(spark, a.base, a.full_refresh, a.reparse)))
    elif a.job == "update":  # new Bronze files only, published as a checked version
        from variantlake.plans.incremental import update_silver

        print(json.dumps(update_silver(spark, a.base, a.rebuild)))
    elif a.job == "update-gold":  # new Silver folders only, from the published versions
        from variantlake.plans.incremental_gold import update_gold

        print(json.dumps(update_gold(spark, a.base, a.rebuild)))
    elif a.job == "quality":
        jobs.run_quality(spark, a.base, show=a.show)
    elif a.job == "gold":
        print(json.dumps(jobs.build_gold(spark, a.base, show=a.show)))
    else:  # the daily batch: Silver, then quality, then Gold
        report = jobs.build_silver(spark, a.base, a.full_refresh, a.reparse)
        jobs.run_quality(spark, a.base, show=a.show)
        print(json.dumps({"silver": report, "gold": jobs.build_gold(spark, a.base, show=a.show)}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
