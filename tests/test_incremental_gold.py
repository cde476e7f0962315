"""Incremental Gold: any sequence of Silver versions equals one build; only new folders are read."""

from __future__ import annotations

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from variantlake.operators import gold, gold_state
from variantlake.plans import incremental, incremental_gold
from variantlake.sources import versions

BUILDS = {"experiment_metrics": gold.experiment_metrics, "funnel_metrics": gold.funnel_metrics, "segment_metrics": gold.segment_metrics}
EVENTS = ["product_view", "add_to_cart", "checkout_started", "purchase", "purchase", "refund"]


def put(spark, lake, entity, rows, dates=()):
    """Publish a Silver version: ``rows`` (dicts) replace what lies on their days and on ``dates``."""
    spec = incremental.ENTITIES[entity]
    held = versions.current(spark, lake, entity)
    known = set(spec.silver.fieldNames())
    values = [tuple((r | {"year": 2026, "month": 1}).get(n) for n in spec.silver.fieldNames()) for r in rows]
    assert all(set(r) <= known for r in rows)
    df = spark.createDataFrame(values, spec.silver).withColumn("target", F.lit("silver"))
    run = f"r{held.version + 1 if held else 1}"
    staged = versions.stage(df, lake, entity, run)[0] if rows else []
    gone = {*dates, *(r["day"] for r in rows)}
    folders = [f for f in (held.folders if held else []) if f.day not in gone] + staged
    versions.publish(spark, lake, entity, held, epoch="e", batch=0, folders=folders, states=[], report={})


def exposure(i, user, variant="control", day=1, device="web", country="GB"):
    return {"event_id": f"e{i}", "experiment_id": "X", "user_id": user, "assigned_variant": variant, "device": device, "country": country, "day": day}


def event(i, user, name, day=1, revenue=None, refund=None):
    at = datetime.datetime(2026, 1, day)
    row = {"event_id": f"b{i}", "experiment_id": "X", "user_id": user, "event_name": name, "event_timestamp": at, "day": day}
    return row | {"revenue_gbp": revenue, "refund_gbp": refund}


def same_as_build(spark, lake, names=tuple(BUILDS)):
    tables = [incremental.read_published(spark, lake, "silver", e) for e in ("exposures", "behavior")]
    for name in names:
        drop = "metric_generated_at"
        got, expected = (sorted(map(str, t.drop(drop).collect())) for t in (incremental_gold.read_gold(spark, lake, name), BUILDS[name](*tables)))
        assert got == expected, name
        assert incremental_gold.read_gold(spark, lake, name).columns == BUILDS[name](*tables).columns
    return len(got)


@pytest.mark.parametrize("seed", [1])
def test_any_sequence_of_versions_equals_one_build(spark, tmp_path, seed, monkeypatch):
    monkeypatch.setattr(incremental_gold, "MERGE_STATES", 2)
    rng = random.Random(seed)
    lake, n = str(tmp_path), 0
    for step in range(3):
        for entity in ("exposures", "behavior"):
            days = rng.sample([1, 2, 3, 4], 4 if step == 0 else 2 if rng.random() < 0.7 else 0)
            rows = []
            for day in days:
                for _ in range(rng.randint(0, 9)):
                    n, user = n + 1, rng.choice("abcdefghij")
                    if entity == "exposures":  # a user may be in two variants or segments here
                        rows.append(exposure(n, user, rng.choice(["control", "treatment"]), day, rng.choice(["web", None]), rng.choice(["GB", "DE"])))
                    else:
                        name = rng.choice(EVENTS)
                        amounts = {"purchase": {"revenue": rng.choice([0.1, 0.2, 19.99, 7.0012])}, "refund": {"refund": rng.choice([0.3, 5.0])}}
                        rows.append(event(n, user, name, day, **amounts.get(name, {})))
            put(spark, lake, entity, rows, days)
        incremental_gold.update_gold(spark, lake)
        same_as_build(spark, lake)
    assert len(versions.current(spark, lake, "gold").states) == 1


def test_updates_equal_a_rebuild_to_the_last_digit(spark, tmp_path):
    """Half cents, where the order of a sum decides the rounding: what was added must be what is taken away."""
    rng = random.Random(8)
    lake = str(tmp_path)
    put(spark, lake, "exposures", [exposure(i, u, day=1 + i % 2) for i, u in enumerate("abcab")])
    for step in range(3):
        rows = [event(100 * step + i, rng.choice("abc"), "purchase", rng.randint(1, 5), rng.choice([0.005, 7.005, 0.1, 0.2, 1e-3])) for i in range(25)]
        put(spark, lake, "behavior", rows if step != 1 else [r for r in rows if r["day"] < 3])
        incremental_gold.update_gold(spark, lake)
    updated = [incremental_gold.read_gold(spark, lake, n).drop("metric_generated_at").collect() for n in BUILDS]
    incremental_gold.update_gold(spark, lake, rebuild=True)
    assert updated == [incremental_gold.read_gold(spark, lake, n).drop("metric_generated_at").collect() for n in BUILDS]


def spoil(lake, spark, entity):
    """Break every published file of an entity; whoever opens one fails."""
    for f in versions.current(spark, lake, entity).folders:
        folder = versions.folder_path(lake, entity, f)
        for name in os.listdir(folder):
            if name.endswith(".parquet"):
                with open(os.path.join(folder, name), "wb") as out:
                    out.write(b"spoiled")


def test_only_new_folders_are_read_and_vanished_ones_need_no_read(spark, tmp_path):
    lake = str(tmp_path)
    put(spark, lake, "exposures", [exposure(1, "a", day=1), exposure(2, "b", "treatment", day=2), exposure(3, "c", day=3)])
    put(spark, lake, "behavior", [event(1, "a", "purchase", 1, 10.0), event(2, "b", "purchase", 2, 20.0), event(3, "c", "product_view", 3)])
    incremental_gold.update_gold(spark, lake)
    spoil(lake, spark, "exposures")
    spoil(lake, spark, "behavior")
    put(spark, lake, "behavior", [event(4, "c", "purchase", 4, 5.5)], dates=[1])  # the purchase of a is gone
    path = incremental_gold.update_gold(spark, lake)["experiment_metrics"]
    found = {r.assigned_variant: (r.exposed_users, r.converted_users, r.gross_revenue_gbp) for r in spark.read.parquet(path).collect()}
    assert found == {"control": (2, 1, 5.5), "treatment": (1, 1, 20.0)}
    assert versions.current(spark, lake, "gold").report["folders_read"] == 1
    changed = spark.read.parquet(incremental_gold._state_path(lake, versions.current(spark, lake, "gold").states[-1], "changed_users"))
    assert sorted(r.user_id for r in changed.collect()) == ["a", "c"]


def test_same_silver_publishes_nothing_and_variants_vanish(spark, tmp_path):
    lake = str(tmp_path)
    put(spark, lake, "exposures", [exposure(1, "a"), exposure(2, "b", "treatment", day=2)])
    put(spark, lake, "behavior", [])
    incremental_gold.update_gold(spark, lake)
    incremental_gold.update_gold(spark, lake)
    assert versions.current(spark, lake, "gold").version == 1
    put(spark, lake, "exposures", [], dates=[2])
    incremental_gold.update_gold(spark, lake)
    assert [r.assigned_variant for r in incremental_gold.read_gold(spark, lake, "experiment_metrics").collect()] == ["control"]
    assert incremental_gold.read_gold(spark, lake, "experiment_metrics", version=1).count() == 2
    incremental_gold.update_gold(spark, lake, rebuild=True)
    assert versions.current(spark, lake, "gold").version == 3 and same_as_build(spark, lake) == 1


def test_a_lost_driver_is_made_good(spark, tmp_path, monkeypatch):
    lake = str(tmp_path)
    put(spark, lake, "exposures", [exposure(1, "a")])
    put(spark, lake, "behavior", [event(1, "a", "purchase", 1, 3.0)])
    incremental_gold.update_gold(spark, lake)
    put(spark, lake, "behavior", [event(2, "a", "refund", 2, refund=1.0)])
    publish = versions.publish
    for publishes in (False, True):

        def die(*a, publishes=publishes, **k):
            if publishes:
                publish(*a, **k)
            raise RuntimeError("driver lost")

        monkeypatch.setattr(versions, "publish", die)
        with pytest.raises(RuntimeError, match="driver lost"):
            incremental_gold.update_gold(spark, lake)
        monkeypatch.undo()
    path = incremental_gold.update_gold(spark, lake)["experiment_metrics"]
    assert spark.read.parquet(path).first().net_revenue_gbp == 2.0
    assert versions.current(spark, lake, "gold").version == 2 and same_as_build(spark, lake) == 1


def test_a_summary_that_misses_rows_publishes_nothing(spark, tmp_path, monkeypatch):
    lake = str(tmp_path)
    put(spark, lake, "exposures", [exposure(1, "a"), exposure(2, "b")])
    put(spark, lake, "behavior", [])
    summary, schema = incremental_gold.DAYS["exposures"]
    monkeypatch.setitem(incremental_gold.DAYS, "exposures", (lambda rows: summary(rows.where("user_id <> 'b'")), schema))
    with pytest.raises(RuntimeError, match="nothing was published"):
        incremental_gold.update_gold(spark, lake)
    assert versions.current(spark, lake, "gold") is None


def test_odd_amounts_come_and_go(spark, tmp_path):
    lake = str(tmp_path)
    nan, inf = float("nan"), float("inf")
    put(spark, lake, "exposures", [exposure(1, "a"), exposure(2, "b", "treatment"), exposure(3, "c", "holdout")])
    put(spark, lake, "behavior", [event(1, "a", "purchase", 1, nan), event(2, "b", "purchase", 1, inf), event(3, "c", "purchase", 1, inf), event(4, "c", "refund", 1, refund=inf)])
    incremental_gold.update_gold(spark, lake)
    assert same_as_build(spark, lake) == 3
    put(spark, lake, "behavior", [event(5, "a", "purchase", 1, 2.0), event(6, "b", "purchase", 1, 4.0)])
    incremental_gold.update_gold(spark, lake)
    assert same_as_build(spark, lake) == 3
    put(spark, lake, "behavior", [event(7, "a", "purchase", 2, 1e25)])
    with pytest.raises(Exception, match="does not fit"):
        incremental_gold.update_gold(spark, lake)


def test_null_keys_empty_and_missing_silver(spark, tmp_path):
    lake = str(tmp_path)
    with pytest.raises(ValueError, match="update_silver"):
        incremental_gold.update_gold(spark, lake)
    put(spark, lake, "exposures", [])
    put(spark, lake, "behavior", [])
    incremental_gold.update_gold(spark, lake)
    assert same_as_build(spark, lake) == 0
    put(spark, lake, "exposures", [exposure(1, "a") | {"experiment_id": None}, exposure(2, "b")])
    incremental_gold.update_gold(spark, lake)
    put(spark, lake, "behavior", [event(1, "a", "purchase", 1, 1.0) | {"experiment_id": None}, event(2, "b", "purchase", 1, 1.0)])
    incremental_gold.update_gold(spark, lake)
    same_as_build(spark, lake)
    assert gold_state.CELLS.count(",") > 10
