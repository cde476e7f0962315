"""Scalar, formula and lake semantics (golden values)."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from variantlake.functions.expressions import funnel_order, pct
from variantlake.operators import gold
from variantlake.sources.lake import read_table, write_table


def test_round_is_half_up(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.125,)], "x double")
    assert [r.r for r in df.select(F.round("x", 2).alias("r")).collect()] == [1.01, 2.68, 0.13]


def test_funnel_order_and_map_miss(spark):
    df = spark.createDataFrame([("page_view",), ("refund",), ("z",), (None,)], "event_name string")
    assert [r.o for r in df.select(funnel_order().alias("o")).collect()] == [1, 7, None, None]


def _outcomes(spark, exposed, converted_revenue, purchases_per_user, variant):
    """One exposure row per user; the first users converted with the given revenues/purchase counts."""
    rows = []
    for i in range(exposed):
        if i < len(converted_revenue):
            rows.append(("EXP", f"{variant}{i}", variant, 1, purchases_per_user[i], 0, converted_revenue[i], 0.0))
        else:
            rows.append(("EXP", f"{variant}{i}", variant, 0, 0, 0, 0.0, 0.0))
    df = spark.createDataFrame(
        rows,
        "experiment_id string, user_id string, assigned_variant string, converted int, purchase_count int, "
        "refund_count int, purchase_revenue_gbp double, refund_amount_gbp double",
    )
    return df.withColumns(
        {
            "net_revenue_gbp": F.col("purchase_revenue_gbp") - F.col("refund_amount_gbp"),
            "exposure_rows": F.lit(1).cast("long"),
        }
    )


def test_experiment_metric_formulas_match_recorded_run(spark):
    control = _outcomes(spark, 939, [83.89] * 36 + [83.76], [1] * 36 + [3], "control")
    treatment = _outcomes(spark, 984, [102.77] * 109 + [103.0], [1] * 99 + [2] * 11, "treatment")
    rows = {r.assigned_variant: r for r in gold.experiment_metrics_from(control.unionByName(treatment)).collect()}
    c, t = rows["control"], rows["treatment"]
    assert (c.exposed_users, c.converted_users, c.total_purchases, c.gross_revenue_gbp) == (939, 37, 39, 3103.8)
    assert (c.net_revenue_gbp, c.conversion_rate_pct, c.revenue_per_exposed_user_gbp, c.avg_order_value_gbp) == (
        3103.8, 3.94, 3.31, 83.89)
    assert (t.exposed_users, t.converted_users, t.total_purchases, t.gross_revenue_gbp) == (984, 110, 121, 11304.93)
    assert (t.net_revenue_gbp, t.conversion_rate_pct, t.revenue_per_exposed_user_gbp, t.avg_order_value_gbp) == (
        11304.93, 11.18, 11.49, 102.77)
    assert c.total_refunds == 0 and c.refunds_gbp == 0.0


def test_funnel_stage_rates_match_recorded_run(spark):
    reached = [(939, v) for v in (278, 223, 161, 124, 39, 36)] + [(984, v) for v in (275, 231, 175, 118, 35, 109)]
    df = spark.createDataFrame(reached, "exposed long, reached long")
    got = [r.p for r in df.select(pct("reached", "exposed").alias("p")).collect()]
    assert got == [29.61, 23.75, 17.15, 13.21, 4.15, 3.83, 27.95, 23.48, 17.78, 11.99, 3.56, 11.08]


def test_dynamic_overwrite_keeps_untouched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1, "a"), (2, "b")], "p int, v string"), path, ["p"])
    write_table(spark.createDataFrame([(1, "new")], "p int, v string"), path, ["p"])
    got = {r.p: r.v for r in spark.read.parquet(path).collect()}
    assert got == {1: "new", 2: "b"}
    write_table(spark.createDataFrame([(1, "full")], "p int, v string"), path, ["p"], dynamic=False)
    assert {r.p: r.v for r in spark.read.parquet(path).collect()} == {1: "full"}


def test_null_partition_value_round_trips(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([(None, "x"), (3, "y")], "p int, v string"), path, ["p"])
    assert (tmp_path / "t" / "p=__HIVE_DEFAULT_PARTITION__").is_dir()
    assert sorted((r.p is None, r.v) for r in spark.read.parquet(path).collect()) == [(False, "y"), (True, "x")]


def test_empty_table_reads_as_no_rows_and_a_missing_one_raises(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    df = read_table(spark, str(tmp_path / "empty"), "a int, b string")
    assert df.count() == 0 and df.columns == ["a", "b"]
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_table(spark, str(tmp_path / "nothing"), "a int, b string")


def test_write_observes_row_count(spark, tmp_path):
    n = write_table(spark.range(123).withColumn("p", F.col("id") % 3), str(tmp_path / "t"), ["p"], count_rows=True)
    assert n == 123
