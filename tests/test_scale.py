"""Plan-level checks for the skew rules: one user / event id may hold a third of all rows.

Hot keys must be cut down map-side (partial aggregation / partial window limit)
before a shuffle, so no join or window partition receives a third of the rows.
AQE's size-based skew split is not relied on: a key-only shuffle of one hot key
compresses to almost nothing and is not detected as skewed. Small AQE thresholds
and no broadcasts keep the plans shuffle-based.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from variantlake.operators import gold, quality, silver

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "32",
}
N = 300_000


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_user(id_col):
    return F.when(id_col % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), (id_col % 20000).cast("string")))


def _exposures(spark):
    ids = spark.range(N)
    return ids.select(
        F.concat(F.lit("x"), F.col("id").cast("string")).alias("event_id"),
        F.lit("EXP").alias("experiment_id"),
        _hot_user(F.col("id")).alias("user_id"),
        F.when(F.col("id") % 2 == 0, "control").otherwise("treatment").alias("assigned_variant"),
        F.lit("GB").alias("country"),
        F.lit("organic").alias("traffic_source"),
        F.lit("ios").alias("device"),
    )


def _behavior(spark):
    ids = spark.range(N)
    return ids.select(
        F.concat(F.lit("b"), F.col("id").cast("string")).alias("event_id"),
        F.lit("EXP").alias("experiment_id"),
        _hot_user(F.col("id") + 7).alias("user_id"),
        F.when(F.col("id") % 4 == 0, "purchase").otherwise("page_view").alias("event_name"),
        F.lit(10.0).alias("revenue_gbp"),
        F.lit(None).cast("double").alias("refund_gbp"),
        F.lit(dt.datetime(2026, 1, 1)).alias("event_timestamp"),
    )


def _final_plan(df) -> str:
    df._jdf.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return plan


def test_exposure_outcome_join_has_no_hot_key(spark, skew_conf):
    exposures, behavior = _exposures(spark), _behavior(spark)
    outcomes = gold.exposure_outcomes(exposures, behavior)
    # the hot user (a third of all exposure rows) reaches the join as one row per variant
    per_key = outcomes.groupBy("experiment_id", "user_id").count().agg(F.max("count")).first()[0]
    assert per_key <= 2
    # weighting by exposure_rows equals the row-by-row join of the upstream formulation
    naive = (
        exposures.join(gold.user_purchases(behavior), ["experiment_id", "user_id"], "left")
        .groupBy("experiment_id", "assigned_variant")
        .agg(
            F.sum(F.when(F.col("purchase_count").isNotNull(), 1).otherwise(0)).alias("converted_users"),
            F.sum(F.coalesce("purchase_count", F.lit(0))).alias("total_purchases"),
            F.round(F.sum(F.coalesce("purchase_revenue_gbp", F.lit(0.0))), 2).alias("gross_revenue_gbp"),
        )
    )
    got = gold.experiment_metrics(exposures, behavior).select(
        "experiment_id", "assigned_variant", "converted_users", "total_purchases", "gross_revenue_gbp"
    )
    assert sorted(got.collect()) == sorted(naive.collect())


def test_orphan_anti_join_has_unique_keys(spark, skew_conf):
    exposures, behavior = _exposures(spark).filter(F.col("user_id") != "u5"), _behavior(spark)
    users = gold.orphan_users(behavior, exposures)
    assert users.count() == users.select("experiment_id", "user_id").distinct().count()
    naive = behavior.join(exposures.select("experiment_id", "user_id"), ["experiment_id", "user_id"], "left_anti")
    rows = gold.orphan_behavior(behavior, exposures)
    naive = naive.select(*rows.columns)
    assert rows.exceptAll(naive).count() == 0 and naive.exceptAll(rows).count() == 0
    assert gold.orphan_count(behavior, exposures).first()[0] == naive.count() > 0


def test_quality_orphan_check_matches_row_level_anti_join(spark, skew_conf):
    exposures = _exposures(spark).withColumn("event_timestamp", F.lit(None).cast("timestamp"))
    exposures = exposures.filter(F.col("user_id") != "u5")
    behavior = _behavior(spark)
    checks = {r.check_name: r.observed_value for r in quality.run_checks(exposures, behavior).collect()}
    naive = behavior.join(exposures.select("experiment_id", "user_id"), ["experiment_id", "user_id"], "left_anti")
    assert checks["behavior_has_matching_exposure"] == float(naive.count())


def test_hot_event_id_is_cut_map_side(spark, skew_conf):
    # every third row is a retry of the same event id
    df = _exposures(spark).withColumn(
        "event_id", F.when(F.monotonically_increasing_id() % 3 == 0, F.lit("hot")).otherwise(F.col("event_id"))
    ).withColumn("kafka_ingestion_timestamp", F.lit(dt.datetime(2026, 1, 1)))
    out = silver.dedup_keep_first(df)
    plan = _final_plan(out)
    partial = plan.find("WindowGroupLimit")
    assert "Partial" in plan and partial != -1
    assert out.filter(F.col("event_id") == "hot").count() == 1


def _stored(spark, tmp_path, df):
    """``df`` as a stored table with two experiments: no key is a literal that the optimizer could fold away."""
    path = str(tmp_path / "stored")
    df.withColumns(
        {
            "experiment_id": F.when(F.hash("user_id") % 2 == 0, "EXP_0").otherwise("EXP_1"),
            "kafka_ingestion_timestamp": F.timestamp_seconds(F.lit(1) + F.monotonically_increasing_id() % 7),
            "topic": F.lit("t"),
            "partition": F.lit(0),
            "offset": F.monotonically_increasing_id(),
        }
    ).write.parquet(path)
    return spark.read.parquet(path)


def _largest_share(df):
    """Rows of the largest task that ``df`` ends in, as a share of all (AQE leaves the partitions alone here)."""
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    return max(sizes) / sum(sizes)


@pytest.fixture()
def no_skew_split(spark, skew_conf):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")


@pytest.mark.parametrize("decided_before", [False, True])
def test_conflict_join_spreads_a_hot_user_of_stored_rows(spark, no_skew_split, tmp_path, decided_before):
    # nearly every user is in conflict, and the hot user holds a third of the rows
    rows = _stored(spark, tmp_path, _exposures(spark))
    conflicts = None
    if decided_before:
        silver.multi_variant_users(rows).write.parquet(str(tmp_path / "conflicts"))
        conflicts = spark.read.parquet(str(tmp_path / "conflicts"))
    flagged = silver.flag_conflicts(rows, conflicts)
    assert "Broadcast" not in _final_plan(flagged)
    assert _largest_share(flagged) < 0.12
    assert silver.conflicted_exposures(flagged).filter("user_id = 'hot'").count() == N // 3


def test_keep_first_spreads_a_hot_id_and_moves_rows_once(spark, no_skew_split, tmp_path):
    hot = F.when(F.col("event_id").endswith("0") | F.col("event_id").endswith("5"), F.lit("hot"))
    rows = _stored(spark, tmp_path, _exposures(spark).withColumn("event_id", F.coalesce(hot, F.substring("event_id", 1, 5))))
    repeated = silver.repeated_ids(rows)
    repeated.write.parquet(str(tmp_path / "repeated"))
    repeated = spark.read.parquet(str(tmp_path / "repeated"))
    first = silver.keep_first(rows, repeated, tied=False)
    plan = _final_plan(first)
    assert "Window" not in plan and "Broadcast" not in plan
    expected = silver.dedup_keep_first(rows)
    assert first.exceptAll(expected).count() == 0 and expected.exceptAll(first).count() == 0
    joined = silver.salted_left_join(rows, repeated.select("event_id", "first"), ["event_id"], F.col("offset"))
    assert _largest_share(joined) < 0.12


def test_validity_filters_reach_the_scan(spark, tmp_path):
    from variantlake.sources.schemas import BRONZE_BEHAVIOR_SCHEMA, BRONZE_EXPOSURES_SCHEMA

    for schema, valid in (
        (BRONZE_EXPOSURES_SCHEMA, lambda b: silver.valid_exposures(silver.enrich_exposures(b))),
        (BRONZE_BEHAVIOR_SCHEMA, lambda b: silver.valid_behavior(silver.flatten_behavior(b))),
    ):
        path = str(tmp_path / schema.fieldNames()[5])
        spark.createDataFrame([], schema).write.parquet(path)
        plan = valid(spark.read.schema(schema).parquet(path))._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters: [") :].split("]")[0]
        assert "IsNotNull(event_id)" in pushed and "In(" in pushed


def test_quality_takes_four_scans(spark, tmp_path):
    timed = _exposures(spark).withColumn("event_timestamp", F.lit(None).cast("timestamp"))
    timed.limit(50).write.parquet(str(tmp_path / "e"))
    _behavior(spark).limit(50).write.parquet(str(tmp_path / "b"))
    checks = quality.run_checks(spark.read.parquet(str(tmp_path / "e")), spark.read.parquet(str(tmp_path / "b")))
    assert checks._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 4


def test_gold_tables_come_in_their_order(spark, tmp_path):
    exposures = _exposures(spark).withColumns(
        {
            "experiment_id": F.when(F.hash("event_id") % 2 == 0, "EXP_0").otherwise("EXP_1"),
            "device": F.when(F.hash("event_id") % 3 == 0, F.lit(None)).otherwise(F.lit("ios")),
        }
    )
    behavior = _behavior(spark).withColumn("experiment_id", F.when(F.hash("event_id") % 2 == 0, "EXP_0").otherwise("EXP_1"))

    def keys(df, *names):
        return [tuple((r[n] is not None, r[n]) for n in names) for r in df.collect()]  # NULLs first

    for found in (
        keys(gold.experiment_metrics(exposures, behavior), "experiment_id", "assigned_variant"),
        keys(gold.funnel_metrics(exposures, behavior), "experiment_id", "assigned_variant", "funnel_order"),
        keys(gold.segment_metrics(exposures, behavior), *gold.SEGMENT_COLUMNS),
    ):
        assert len(found) >= 4 and found == sorted(found)


def test_orphan_join_stays_above_the_pre_aggregation(spark, skew_conf):
    """The optimizer pushes semi/anti joins below an aggregate on their keys; the orphan
    join must keep joining pre-aggregated rows (one per user), not raw behavior rows."""
    plan = gold.orphan_count(_behavior(spark), _exposures(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan
    lines = plan.splitlines()
    at = next(k for k, line in enumerate(lines) if "Join LeftOuter" in line)
    indent = lines[at].index("Join")
    children = [line[indent + 3 :] for line in lines[at + 1 :] if line[indent : indent + 3] in (":- ", "+- ")]
    assert len(children) == 2 and all(child.startswith("Aggregate") for child in children)


def test_rebalanced_write_splits_a_hot_date(spark, skew_conf, tmp_path):
    from variantlake.sources.lake import write_table

    ids = spark.range(N)
    hot = F.col("id") % 3 == 0
    df = ids.select(
        F.lit(2026).alias("year"),
        F.lit(1).alias("month"),
        F.when(hot, F.lit(1)).otherwise((F.col("id") % 27 + 2).cast("int")).alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    # cold dates (~0.6 MB each) below the advisory size, the hot date (~8 MB) above it;
    # AQE can split a partition at most once per map task
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    path = str(tmp_path / "t")
    assert write_table(df, path, ["year", "month", "day"], count_rows=True) == N

    def files(day):
        d = tmp_path / "t" / "year=2026" / "month=1" / f"day={day}"
        return [f for f in d.iterdir() if f.suffix == ".parquet"]

    # the hot date (a third of the rows) is written by several tasks, a cold date by one
    assert len(files(1)) > 1
    assert len(files(3)) == 1


def test_a_hot_orphan_user_is_dealt_to_many_tasks(spark, no_skew_split, tmp_path):
    # the hot user of the behavior rows has no exposure, so a third of all rows are orphans of one key
    behavior = _stored(spark, tmp_path, _behavior(spark))
    hot = behavior.groupBy("experiment_id", "user_id").count().orderBy(F.desc("count")).first()
    exposures = _exposures(spark).filter(F.col("user_id") != hot.user_id)
    rows = gold.orphan_behavior(behavior, exposures).filter(F.col("user_id") == hot.user_id)
    assert rows.count() == hot["count"] > behavior.count() / 4
    held = rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(held) > 1 and max(r["count"] for r in held) < 0.7 * hot["count"]


@pytest.mark.parametrize("held", [20_000, 3])
def test_count_of_a_written_lookup_decides_on_its_broadcast(spark, tmp_path, held):
    # 20,000 rows are some 100 KB of Parquet, far below the threshold; their copies are not
    lookup = spark.range(held).select(F.concat(F.lit("b"), "id").alias("event_id"), F.col("id").alias("first"))
    lookup.write.parquet(str(tmp_path / "lookup"))
    lookup = spark.read.parquet(str(tmp_path / "lookup"))
    rows = spark.range(2 * held).select(F.when(F.col("id") % 7 > 0, F.concat(F.lit("b"), "id")).alias("event_id"), F.col("id").alias("offset"))
    joined = silver.salted_left_join(rows, lookup, ["event_id"], F.col("offset"), held)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
        found = {(r.event_id, r.offset, r.first) for r in joined.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("BroadcastHashJoin" in plan) == (held == 3) and ("SortMergeJoin" in plan) == (held > 3)
    ids = range(2 * held)
    assert found == {(f"b{i}" if i % 7 else None, i, i if i % 7 and i < held else None) for i in ids} and joined.count() == 2 * held


def test_silver_job_broadcasts_no_large_written_lookup(spark, monkeypatch, tmp_path):
    seen = []
    join = silver.salted_left_join

    def noted(rows, lookup, on, spread, held=None):
        seen.append((held, lookup.count()))
        return join(rows, lookup, on, spread, held)

    monkeypatch.setattr(silver, "salted_left_join", noted)
    from variantlake.plans import jobs
    from variantlake.sources import fixtures
    from variantlake.sources.lake import table_path

    lake = str(tmp_path / "lake")
    fixtures.bronze_exposures(spark, "/root/testdata/sf0.001").write.parquet(table_path(lake, "bronze", "exposures"))
    fixtures.bronze_behavior(spark, "/root/testdata/sf0.001").write.parquet(table_path(lake, "bronze", "behavior"))
    jobs.build_silver(spark, lake)
    assert len(seen) == 3 and all(held == rows for held, rows in seen)


def test_incremental_silver_broadcasts_no_large_written_lookup(spark, monkeypatch, tmp_path):
    from variantlake.operators import state
    from variantlake.plans import incremental
    from variantlake.sources import fixtures

    seen = []
    join = silver.salted_left_join

    def noted(rows, lookup, on, spread, held=None):
        seen.append((held, lookup.count()))
        return join(rows, lookup, on, spread, held)

    monkeypatch.setattr(silver, "salted_left_join", noted)
    monkeypatch.setattr(state, "salted_left_join", noted)
    bronze = fixtures.bronze_exposures(spark, "/root/testdata/sf0.001")
    late = F.col("offset") % 2 == 0  # first rows come second
    for number, part in enumerate((bronze.where(~late), bronze.where(late))):
        incremental.apply_batch(spark, str(tmp_path / "lake"), incremental.EXPOSURES, part, "e", number)
    assert len(seen) >= 6 and all(held == rows for held, rows in seen)
