"""Batch job runners: Bronze -> Silver, Silver -> quality results, Silver -> Gold.

Each runner reads its inputs from the lake, calls the lazy operators and writes
its outputs; any scheduler can call them. They take a caller-owned
``SparkSession`` and never stop it. Written row counts come from ``Observation``
metrics collected in each write's final stage, so no output is counted in a
second pass.

A missing input is an error before anything is written. What several writes share
(repeated ids, conflicted users, user outcomes) is a written table under the shared
checkpoint folder: a lost executor costs its running tasks only. Independent writes of
one runner are submitted as concurrent jobs.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from variantlake.functions.domains import PARTITION_COLUMNS
from variantlake.functions.expressions import behavior_is_valid
from variantlake.operators import gold, quality, silver
from variantlake.sources import versions
from variantlake.sources.kafka import reparse_bronze
from variantlake.sources.lake import read_table, scratch_dir, table_path, write_table
from variantlake.sources.schemas import (
    BEHAVIOR_JSON_SCHEMA,
    BRONZE_BEHAVIOR_SCHEMA,
    BRONZE_EXPOSURES_SCHEMA,
    SILVER_BEHAVIOR_SCHEMA,
    SILVER_EXPOSURES_SCHEMA,
)


def _concurrently(*actions):
    """Run independent Spark actions as concurrent jobs; return their results in order.

    Each action is its own job, so independent writes (e.g. Silver and quarantine)
    share the cluster instead of queueing; the first error is re-raised.
    """
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        futures = [pool.submit(a) for a in actions]
        return [f.result() for f in futures]


def _input_counts(df: DataFrame, **metrics: Column) -> dict[str, int]:
    """Row count (plus extra count metrics) of a job input, as one aggregate.

    Counts of written rows come from ``Observation``s in the write's final stage.
    Input counts are not observed: an observation inside a shuffle-map stage is
    applied again when that stage re-runs after an executor loss, whereas an
    aggregate stays exact. A bare row count reads only Parquet footers.
    """
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]).first()
    return {k: int(v or 0) for k, v in row.asDict().items()}


def _decided(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder, and read again."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"job-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _first_rows(valid: DataFrame, name: str) -> tuple[DataFrame, int]:
    """De-duplicated rows of ``valid`` and the number of rows removed, counted by itself."""
    repeated = _decided(silver.repeated_ids(valid), f"repeated-{name}")
    counts = repeated.agg(F.sum(F.col("rows") - 1).alias("removed"), F.max("copies").alias("copies"), F.count(F.lit(1)).alias("ids")).first()
    first = silver.keep_first(valid, repeated, tied=(counts["copies"] or 0) > 1, held=counts["ids"])
    return first, int(counts["removed"] or 0)


def _check_conserved(entity: str, report: dict[str, int]) -> None:
    """Every Bronze row is in exactly one output, or was counted as removed."""
    parts = [f"silver_{entity}", f"quarantine_{entity}", f"duplicates_removed_{entity}"]
    if entity == "behavior":
        parts.append("valid_bots_dropped")
    found = sum(report[p] for p in parts)
    if found != report[f"bronze_{entity}"]:
        raise RuntimeError(f"{entity}: {report[f'bronze_{entity}']} Bronze rows, but {found} in {', '.join(parts)}: {report}")


def _check_apart(spark: SparkSession, base: str, entity: str) -> None:
    """No stored row is in Silver and in quarantine at once."""
    position = ["topic", "partition", "offset", "event_id"]
    schema = SILVER_EXPOSURES_SCHEMA if entity == "exposures" else SILVER_BEHAVIOR_SCHEMA
    held = [read_table(spark, table_path(base, layer, entity), schema).select(*position) for layer in ("silver", "quarantine")]
    both = held[0].join(held[1], on=position, how="left_semi").limit(1).count()
    if both:
        raise RuntimeError(
            f"{entity}: a row is in Silver and in quarantine; an event date that no longer has rows in one of them "
            "keeps its old files under dynamic overwrite: run with full_refresh"
        )


def build_silver(spark: SparkSession, base: str, full_refresh: bool = False, reparse: bool = False) -> dict[str, int]:
    """Bronze -> Silver + quarantine for both entities; returns row counts.

    De-duplication and conflicts are global rules, so all of Bronze is read.
    Partitioned writes use dynamic overwrite (only the event dates present in the
    output are replaced) unless ``full_refresh``. ``reparse`` rebuilds Bronze behavior
    from the stored JSON text first, for a Bronze written before ``refund_gbp`` was
    in its schema. Per entity: bronze = silver + quarantine + duplicates removed
    (+ valid bots); each part is counted by itself and a difference is an error.
    """
    for entity in ("exposures", "behavior"):
        if versions.current(spark, base, entity) is not None:
            raise ValueError(f"{entity} of this lake is published in versions; use update_silver (with rebuild for all of Bronze)")
    dynamic = not full_refresh
    report: dict[str, int] = {}
    bronze_e = read_table(spark, table_path(base, "bronze", "exposures"), BRONZE_EXPOSURES_SCHEMA)
    bronze_b = read_table(spark, table_path(base, "bronze", "behavior"), BRONZE_BEHAVIOR_SCHEMA)
    if reparse:
        bronze_b = reparse_bronze(bronze_b, BEHAVIOR_JSON_SCHEMA)

    def write(df: DataFrame, layer: str, entity: str) -> int:
        return write_table(df, table_path(base, layer, entity), PARTITION_COLUMNS, dynamic=dynamic, count_rows=True)

    # exposures: repeated ids and conflicted users are decided on narrow columns; each
    # output is then one scan of the full rows with two small lookups
    enriched = silver.enrich_exposures(bronze_e)
    flat = silver.flatten_behavior(bronze_b)
    (first_e, report["duplicates_removed_exposures"]), (first_b, report["duplicates_removed_behavior"]) = _concurrently(
        lambda: _first_rows(silver.valid_exposures(enriched), "exposures"),
        lambda: _first_rows(silver.valid_behavior(flat), "behavior"),
    )
    conflicts = _decided(silver.multi_variant_users(first_e), "conflicts")
    flagged = silver.flag_conflicts(first_e, conflicts, held=conflicts.count())
    quarantined = silver.quarantine_union(silver.invalid_exposures(enriched), silver.conflicted_exposures(flagged))
    (
        report["silver_exposures"],
        report["quarantine_exposures"],
        report["silver_behavior"],
        report["quarantine_behavior"],
        counts_e,
        counts_b,
    ) = _concurrently(
        lambda: write(silver.clean_exposures(flagged), "silver", "exposures"),
        lambda: write(quarantined, "quarantine", "exposures"),
        lambda: write(first_b, "silver", "behavior"),
        lambda: write(silver.invalid_behavior(flat), "quarantine", "behavior"),
        lambda: _input_counts(bronze_e),
        lambda: _input_counts(flat, bots=F.count_if(behavior_is_valid() & F.col("is_bot"))),
    )
    report["bronze_exposures"], report["bronze_behavior"] = counts_e["rows"], counts_b["rows"]
    report["valid_bots_dropped"] = counts_b["bots"]
    for entity in ("exposures", "behavior"):
        _check_conserved(entity, report)
        _check_apart(spark, base, entity)
    return report


def read_silver(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """Silver of both entities: the newest published version where there is one, else the plain tables."""

    def read(entity: str, schema: StructType) -> DataFrame:
        held = versions.current(spark, base, entity)
        if held is not None:
            return versions.read_version(spark, base, entity, "silver", schema, held)
        return read_table(spark, table_path(base, "silver", entity), schema)

    return read("exposures", SILVER_EXPOSURES_SCHEMA), read("behavior", SILVER_BEHAVIOR_SCHEMA)


def run_quality(spark: SparkSession, base: str, as_of: Column | None = None, show: bool = False) -> DataFrame:
    """All 16 checks in one job, written to gold/data_quality_results; returns the written table.

    Failing checks do not raise: the results are data.
    """
    exposures, behavior = read_silver(spark, base)
    path = table_path(base, "gold", "data_quality_results")
    write_table(quality.run_checks(exposures, behavior, as_of), path)
    out = spark.read.parquet(path)
    if show:
        out.show(truncate=False)
    return out


def build_gold(spark: SparkSession, base: str, show: bool = False) -> dict[str, str]:
    """Silver -> the four Gold tables; returns their paths.

    Experiment and segment metrics share one exposure x user-outcome join, written
    once. Each table is computed once and written; a preview reads the written
    table, so shown and stored values are the same.
    """
    exposures, behavior = read_silver(spark, base)
    paths = {
        name: table_path(base, "gold", name)
        for name in ("experiment_metrics", "funnel_metrics", "segment_metrics", "data_health_summary")
    }
    outcomes = _decided(gold.exposure_outcomes(exposures, behavior), "outcomes")
    _concurrently(
        lambda: write_table(gold.experiment_metrics_from(outcomes), paths["experiment_metrics"]),
        lambda: write_table(gold.segment_metrics_from(outcomes), paths["segment_metrics"]),
        lambda: write_table(gold.funnel_metrics(exposures, behavior), paths["funnel_metrics"]),
        lambda: write_table(gold.health_summary(exposures, behavior), paths["data_health_summary"]),
    )
    if show:
        for name in ("experiment_metrics", "funnel_metrics"):
            spark.read.parquet(paths[name]).show(truncate=False)
    return paths
