"""End to end on sf0.001: stream ingest -> Silver -> quality -> Gold, through the lake."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from variantlake.operators import gold, silver
from variantlake.plans import jobs
from variantlake.plans.queries import stage_topic
from variantlake.sources import fixtures
from variantlake.sources.kafka import add_event_time
from variantlake.sources.lake import table_path
from variantlake.sources.schemas import BRONZE_BEHAVIOR_SCHEMA, BRONZE_EXPOSURES_SCHEMA, ENVELOPE_SCHEMA
from variantlake.streaming.bronze import behavior_stream, exposures_stream


def _stage_topics(spark, root):
    for entity, build in (("exposures", fixtures.exposure_envelopes), ("behavior", fixtures.behavior_envelopes)):
        stage_topic(build(spark, SF_SMALL), f"{root}/topic/{entity}")


def _ingest(spark, root, lake):
    for entity, start in (("exposures", exposures_stream), ("behavior", behavior_stream)):
        src = spark.readStream.schema(ENVELOPE_SCHEMA).parquet(f"{root}/topic/{entity}")
        q = start(spark, lake, source=src, trigger="availableNow")
        q.awaitTermination()
        assert q.exception() is None


@pytest.fixture(scope="module")
def built_lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("e2e"))
    lake = root + "/lake/"
    _stage_topics(spark, root)
    _ingest(spark, root, lake)
    report = jobs.build_silver(spark, lake)
    return root, lake, report


def test_silver_counts_and_conservation(built_lake):
    _, _, r = built_lake
    assert r["bronze_exposures"] == 183 and r["silver_exposures"] == 151
    assert r["quarantine_exposures"] == 10 + 8 and r["duplicates_removed_exposures"] == 14
    assert r["bronze_behavior"] == 1575 and r["silver_behavior"] == 1397
    assert r["quarantine_behavior"] == 80 and r["valid_bots_dropped"] == 28
    assert r["duplicates_removed_behavior"] == 70
    assert r["bronze_behavior"] == (
        r["silver_behavior"] + r["quarantine_behavior"] + r["duplicates_removed_behavior"] + r["valid_bots_dropped"]
    )


def test_stream_restart_adds_nothing(spark, built_lake):
    root, lake, _ = built_lake
    before = spark.read.parquet(table_path(lake, "bronze", "exposures")).count()
    _ingest(spark, root, lake)
    assert spark.read.parquet(table_path(lake, "bronze", "exposures")).count() == before == 183


def test_stream_equals_batch(spark, built_lake):
    _, lake, _ = built_lake
    cols = ["event_id", "user_id", "assigned_variant", "kafka_value", "offset", "year", "month", "day"]
    streamed = spark.read.parquet(table_path(lake, "bronze", "exposures")).select(*cols)
    batch = fixtures.bronze_exposures(spark, SF_SMALL).select(*cols)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_quality_and_gold_from_the_lake(spark, built_lake):
    _, lake, _ = built_lake
    checks = {r.check_name: (r.status, r.observed_value) for r in jobs.run_quality(spark, lake).collect()}
    assert len(checks) == 16
    assert checks["silver_exposures_has_rows"] == ("PASS", 151.0)
    assert checks["behavior_has_matching_exposure"] == ("WARN", 120.0)
    assert all(s == "PASS" for n, (s, _) in checks.items() if n not in ("behavior_has_matching_exposure",))

    paths = jobs.build_gold(spark, lake)
    written = spark.read.parquet(paths["experiment_metrics"]).drop("metric_generated_at")
    exposures = silver.silver_exposures(fixtures.bronze_exposures(spark, SF_SMALL))[0]
    behavior = silver.silver_behavior(fixtures.bronze_behavior(spark, SF_SMALL))[0]
    direct = gold.experiment_metrics(exposures, behavior).drop("metric_generated_at")
    assert sorted(written.collect()) == sorted(direct.collect())
    health = {r.metric_name: r.metric_value for r in spark.read.parquet(paths["data_health_summary"]).collect()}
    assert health == {
        "silver_exposure_rows": 151,
        "silver_behavior_rows": 1397,
        "duplicate_exposure_event_ids": 0,
        "duplicate_behavior_event_ids": 0,
        "behavior_without_matching_exposure": 120,
    }
    assert spark.read.parquet(paths["funnel_metrics"]).filter(F.col("funnel_order").isNull()).count() == 0


def test_silver_rerun_is_idempotent(spark, built_lake):
    _, lake, _ = built_lake
    again = jobs.build_silver(spark, lake)
    assert spark.read.parquet(table_path(lake, "silver", "exposures")).count() == again["silver_exposures"] == 151
    assert spark.read.parquet(table_path(lake, "quarantine", "behavior")).count() == 80


def test_cli_runs_quality_and_gold(spark, built_lake, capsys):
    from variantlake.__main__ import main

    _, lake, _ = built_lake
    assert main(["quality", "--base", lake]) == 0
    assert main(["gold", "--base", lake]) == 0
    assert "experiment_metrics" in capsys.readouterr().out
    assert spark.read.parquet(table_path(lake, "gold", "data_quality_results")).count() == 16


def test_upstream_bronze_schema_quarantines_every_refund(spark):
    import __spark_entry__ as E

    rows = E.queries()["gold_experiment_metrics_refund_field_absent"](spark, SF_SMALL).collect()
    assert rows and all(r.total_refunds == 0 and r.refunds_gbp == 0.0 for r in rows)
    assert all(r.net_revenue_gbp == r.gross_revenue_gbp for r in rows)


def test_processing_time_trigger_stream(spark, tmp_path):
    root = str(tmp_path)
    stage_topic(fixtures.exposure_envelopes(spark, SF_SMALL), f"{root}/topic/exposures")
    src = spark.readStream.schema(ENVELOPE_SCHEMA).parquet(f"{root}/topic/exposures")
    q = exposures_stream(spark, f"{root}/lake", source=src, trigger="1 second")
    try:
        q.processAllAvailable()
        assert q.isActive and q.lastProgress is not None
    finally:
        q.stop()
    assert spark.read.parquet(table_path(f"{root}/lake", "bronze", "exposures")).count() == 183


def _empty_bronze(spark, lake):
    for entity, schema in (("exposures", BRONZE_EXPOSURES_SCHEMA), ("behavior", BRONZE_BEHAVIOR_SCHEMA)):
        spark.createDataFrame([], schema).write.parquet(table_path(lake, "bronze", entity))


def test_jobs_on_an_empty_lake(spark, tmp_path):
    lake = str(tmp_path / "empty") + "/"
    _empty_bronze(spark, lake)
    report = jobs.build_silver(spark, lake)
    assert report["silver_exposures"] == 0 and report["bronze_behavior"] == 0
    checks = {r.check_name: (r.status, r.observed_value) for r in jobs.run_quality(spark, lake).collect()}
    assert checks["silver_exposures_has_rows"] == ("FAIL", 0.0)
    assert checks["behavior_has_matching_exposure"] == ("PASS", 0.0)
    paths = jobs.build_gold(spark, lake)
    assert spark.read.parquet(paths["experiment_metrics"]).count() == 0
    health = {r.metric_name: r.metric_value for r in spark.read.parquet(paths["data_health_summary"]).collect()}
    assert set(health.values()) == {0}


def test_a_missing_input_is_an_error_and_erases_nothing(spark, built_lake, tmp_path):
    _, lake, _ = built_lake
    import shutil

    kept = str(tmp_path / "lake") + "/"
    for layer in ("silver", "quarantine"):
        shutil.copytree(f"{lake}{layer}", f"{kept}{layer}")
    before = sorted(str(f) for f in (tmp_path / "lake").rglob("*.parquet"))
    with pytest.raises(AnalysisException):
        jobs.build_silver(spark, kept, full_refresh=True)
    assert sorted(str(f) for f in (tmp_path / "lake").rglob("*.parquet")) == before
    nowhere = str(tmp_path / "nowhere") + "/"
    with pytest.raises(AnalysisException):
        jobs.run_quality(spark, nowhere)
    with pytest.raises(AnalysisException):
        jobs.build_gold(spark, nowhere)
    assert not (tmp_path / "nowhere").exists()


def _bronze_rows(spark, lake, rows):
    """A small Bronze: (event_id, user_id, variant, event_time, offset, ingestion second)."""
    _empty_bronze(spark, lake)
    df = spark.createDataFrame(rows, "event_id string, user_id string, assigned_variant string, event_time string, offset long, s long")
    df = df.select(
        "*",
        F.lit("EXP").alias("experiment_id"),
        F.timestamp_seconds("s").alias("kafka_ingestion_timestamp"),
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
    )
    df = add_event_time(df.drop("s"))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in BRONZE_EXPOSURES_SCHEMA if f.name not in df.columns]
    df.select("*", *missing).select(*BRONZE_EXPOSURES_SCHEMA.fieldNames()).write.mode("append").parquet(
        table_path(lake, "bronze", "exposures")
    )


def test_conflict_over_two_dates_is_never_in_silver(spark, tmp_path):
    lake = str(tmp_path / "lake") + "/"
    _bronze_rows(
        spark,
        lake,
        [
            ("1", "a", "control", "2026-01-01 10:00:00", 1, 1),
            ("2", "a", "treatment", "2026-01-02 10:00:00", 2, 2),
            ("3", "b", "control", "2026-01-02 11:00:00", 3, 3),
            ("3", "b", "control", "2026-01-02 11:00:00", 4, 3),  # retry in the same second: the offset decides
            ("4", "c", "control", "2026-01-03 11:00:00", 5, 5),
            ("4", "c", "control", "2026-01-03 11:00:00", 5, 5),  # the same position stored twice
        ],
    )
    report = jobs.build_silver(spark, lake)
    silver_rows = spark.read.parquet(table_path(lake, "silver", "exposures"))
    assert sorted((r.event_id, r.offset) for r in silver_rows.collect()) == [("3", 3), ("4", 5)]
    held = spark.read.parquet(table_path(lake, "quarantine", "exposures"))
    assert sorted(r.event_id for r in held.collect()) == ["1", "2"]
    assert report["duplicates_removed_exposures"] == 2
    assert jobs.build_silver(spark, lake) == report


def test_a_lost_row_is_noticed(spark, tmp_path, monkeypatch):
    lake = str(tmp_path / "lake") + "/"
    _bronze_rows(spark, lake, [(str(i), f"u{i}", "control", "2026-01-01 10:00:00", i, i) for i in range(9)])
    whole = silver.keep_first
    monkeypatch.setattr(silver, "keep_first", lambda df, *a, **k: whole(df, *a, **k).filter("offset <> 7"))
    with pytest.raises(RuntimeError, match="Bronze rows"):
        jobs.build_silver(spark, lake)
    monkeypatch.undo()
    assert jobs.build_silver(spark, lake)["silver_exposures"] == 9


def test_a_row_in_silver_and_quarantine_is_noticed(spark, tmp_path):
    lake = str(tmp_path / "lake") + "/"
    _bronze_rows(spark, lake, [("1", "a", "control", "2026-01-01 10:00:00", 1, 1)])
    jobs.build_silver(spark, lake)
    df = spark.read.parquet(table_path(lake, "bronze", "exposures")).limit(1)
    row = df.withColumns({"event_id": F.lit("2"), "assigned_variant": F.lit("treatment"), "offset": F.lit(2).cast("long")})
    row = add_event_time(row.withColumn("event_time", F.lit("2026-01-02 10:00:00")).drop("event_timestamp", "year", "month", "day"))
    row.select(*BRONZE_EXPOSURES_SCHEMA.fieldNames()).write.mode("append").parquet(table_path(lake, "bronze", "exposures"))
    # Silver has no row left for the first date, so its old files would stay
    with pytest.raises(RuntimeError, match="full_refresh"):
        jobs.build_silver(spark, lake)
    assert jobs.build_silver(spark, lake, full_refresh=True)["silver_exposures"] == 0


def test_old_bronze_gets_its_refunds_back(spark, tmp_path):
    lake = str(tmp_path / "old") + "/"
    _empty_bronze(spark, lake)
    bronze = fixtures.bronze_behavior(spark, SF_SMALL).filter("year = 1995 AND month = 3")
    refunds = silver.valid_behavior(silver.flatten_behavior(bronze)).filter("event_name = 'refund'").select("event_id").distinct().count()
    old = bronze.withColumn("properties", F.col("properties").dropFields("refund_gbp"))
    old.write.mode("overwrite").parquet(table_path(lake, "bronze", "behavior"))

    def stored():
        return spark.read.parquet(table_path(lake, "silver", "behavior")).filter("event_name = 'refund'").count()

    jobs.build_silver(spark, lake)
    assert refunds > 0 and stored() == 0
    jobs.build_silver(spark, lake, full_refresh=True, reparse=True)
    assert stored() == refunds


def test_cli_ingest_from_envelope_files(spark, tmp_path):
    from variantlake.__main__ import main

    root = str(tmp_path)
    stage_topic(fixtures.behavior_envelopes(spark, SF_SMALL), f"{root}/topic/behavior")
    args = ["ingest-behavior", "--base", f"{root}/lake", "--envelope-path", f"{root}/topic/behavior"]
    assert main(args + ["--trigger", "availableNow"]) == 0
    assert spark.read.parquet(table_path(f"{root}/lake", "bronze", "behavior")).count() == 1575


def test_concurrent_actions_keep_order_and_raise(spark):
    assert jobs._concurrently(lambda: spark.range(3).count(), lambda: spark.range(5).count()) == [3, 5]
    with pytest.raises(Exception):
        jobs._concurrently(lambda: spark.range(1).count(), lambda: spark.sql("SELECT * FROM no_such_table").count())


def test_cli_batch_runs_silver_quality_gold(spark, tmp_path, capsys):
    import json

    from variantlake.__main__ import main

    root = str(tmp_path)
    for entity, build, start in (
        ("exposures", fixtures.exposure_envelopes, exposures_stream),
        ("behavior", fixtures.behavior_envelopes, behavior_stream),
    ):
        stage_topic(build(spark, SF_SMALL), f"{root}/topic/{entity}")
        q = start(spark, f"{root}/lake", source=spark.readStream.schema(ENVELOPE_SCHEMA).parquet(f"{root}/topic/{entity}"),
                  trigger="availableNow")
        q.awaitTermination()
    assert main(["batch", "--base", f"{root}/lake"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["silver"]["silver_exposures"] == 151
    assert spark.read.parquet(table_path(f"{root}/lake", "gold", "data_quality_results")).count() == 16
    assert spark.read.parquet(out["gold"]["experiment_metrics"]).count() == 4
