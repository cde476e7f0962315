"""Silver and quality semantics on literal rows."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from variantlake.functions.expressions import exposure_is_valid
from variantlake.operators import gold, quality, silver

EXPOSURE_COLS = (
    "event_id string, experiment_id string, user_id string, assigned_variant string, event_time string, "
    "kafka_ingestion_timestamp timestamp, topic string, partition int, offset long, country string, "
    "traffic_source string, device string"
)
T0 = dt.datetime(2026, 1, 1)


def _exp(spark, rows):
    full = [r + (None,) * (12 - len(r)) for r in rows]
    return spark.createDataFrame(full, EXPOSURE_COLS)


def test_dedup_keeps_earliest_and_breaks_ties_by_offset(spark):
    rows = [
        ("e1", "x", "u", "control", "2026-01-01", T0 + dt.timedelta(seconds=5), "t", 0, 1),
        ("e1", "x", "u", "control", "2026-01-01", T0, "t", 0, 9),
        ("e1", "x", "u", "control", "2026-01-01", T0, "t", 0, 3),
        ("e2", "x", "u", "control", "2026-01-01", T0, "t", 1, 4),
    ]
    out = silver.dedup_keep_first(_exp(spark, rows)).collect()
    assert sorted((r.event_id, r.offset) for r in out) == [("e1", 3), ("e2", 4)]


def test_dedup_plan_limits_before_the_shuffle(spark):
    plan = silver.dedup_keep_first(_exp(spark, []))._jdf.queryExecution().executedPlan().toString()
    # partial WindowGroupLimit runs map-side, ahead of the exchange on event_id
    assert "WindowGroupLimit" in plan


def test_conflicted_users_are_quarantined_whole(spark):
    rows = [
        ("a1", "x", "u1", "control", "2026-01-01", T0, "t", 0, 1),
        ("a2", "x", "u1", "treatment", "2026-01-01", T0, "t", 0, 2),
        ("a3", "x", "u2", "control", "2026-01-01", T0, "t", 0, 3),
        ("a4", "x", "u2", "control", "2026-01-01", T0, "t", 0, 4),
        ("a5", "x", None, "control", "2026-01-01", T0, "t", 0, 5),
        ("a6", "x", "u3", "holdout", "2026-01-01", T0, "t", 0, 6),
        ("a7", "x", "u4", None, "2026-01-01", T0, "t", 0, 7),
        ("a8", "x", "u5", "control", "not a time", T0, "t", 0, 8),
    ]
    clean, quarantine = silver.silver_exposures(_exp(spark, rows))
    assert sorted(r.event_id for r in clean.collect()) == ["a3", "a4"]
    reasons = {r.event_id: r.quarantine_reason for r in quarantine.collect()}
    assert reasons == {
        "a1": "user_assigned_to_multiple_variants",
        "a2": "user_assigned_to_multiple_variants",
        "a5": "invalid_exposure_record",
        "a6": "invalid_exposure_record",
        "a7": "invalid_exposure_record",
        "a8": "invalid_exposure_record",
    }


@settings(max_examples=25, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from([None, "e1", "e2"]),
            st.sampled_from([None, "x"]),
            st.sampled_from([None, "u"]),
            st.sampled_from([None, "control", "treatment", "other"]),
            st.sampled_from([None, "2026-01-01", "bad"]),
        ),
        max_size=12,
    )
)
def test_valid_and_invalid_partition_every_row(spark, rows):
    df = _exp(spark, rows).withColumn("event_timestamp", F.try_to_timestamp("event_time"))
    n_valid = df.filter(exposure_is_valid()).count()
    n_invalid = df.filter(~exposure_is_valid()).count()
    assert n_valid + n_invalid == len(rows)


BEHAVIOR_COLS = (
    "event_id string, experiment_id string, user_id string, event_name string, event_time string, "
    "kafka_ingestion_timestamp timestamp, topic string, partition int, offset long, "
    "properties struct<page:string, is_bot:boolean, revenue_gbp:double, failure_reason:string>"
)


def test_behavior_rules_bots_and_missing_refund_field(spark):
    def props(bot=False, rev=None):
        return ("/p", bot, rev, None)

    rows = [
        ("b1", "x", "u", "purchase", "2026-01-01", T0, "t", 0, 1, props(rev=10.0)),
        ("b2", "x", "u", "purchase", "2026-01-01", T0, "t", 0, 2, props(rev=-1.0)),
        ("b3", "x", "u", "purchase", "2026-01-01", T0, "t", 0, 3, props(rev=None)),
        ("b4", "x", "u", "page_view", "2026-01-01", T0, "t", 0, 4, props(bot=True)),
        ("b5", "x", "u", "unknown", "2026-01-01", T0, "t", 0, 5, props(bot=True)),
        ("b6", "x", "u", "refund", "2026-01-01", T0, "t", 0, 6, props()),
        ("b7", "x", "u", "page_view", "2026-01-01", T0, "t", 0, 7, None),
    ]
    bronze = spark.createDataFrame(rows, BEHAVIOR_COLS)
    clean, quarantine = silver.silver_behavior(bronze)
    assert sorted(r.event_id for r in clean.collect()) == ["b1", "b7"]
    # the struct has no refund_gbp field: refunds carry NULL and are quarantined
    assert sorted(r.event_id for r in quarantine.collect()) == ["b2", "b3", "b5", "b6"]
    # a valid bot (b4) is dropped, not quarantined
    assert [r.event_id for r in silver.bot_behavior(silver.flatten_behavior(bronze)).collect()] == ["b4"]


def test_quality_checks_count_failures_and_skip_null_in_domain_tests(spark):
    exp = _exp(
        spark,
        [
            ("a1", "x", None, "control", "2026-01-01", T0, "t", 0, 1),
            ("a1", "x", "u1", None, "2026-01-01", T0, "t", 0, 2),
            ("a2", "x", "u1", "other", "2999-01-01", T0, "t", 0, 3),
            ("a3", "x", "u1", "control", "2026-01-01", T0, "t", 0, 4),
        ],
    ).withColumn("event_timestamp", F.try_to_timestamp("event_time"))
    beh = spark.createDataFrame(
        [("b1", "x", "u9", "purchase", None, None), ("b1", "x", "u1", None, 5.0, None)],
        "event_id string, experiment_id string, user_id string, event_name string, revenue_gbp double, refund_gbp double",
    ).withColumn("event_timestamp", F.lit(None).cast("timestamp"))
    res = {r.check_name: (r.status, r.observed_value) for r in quality.run_checks(exp, beh).collect()}
    assert len(res) == 16
    assert res["silver_exposures_has_rows"] == ("PASS", 4.0)
    assert res["exposures_user_id_not_null"] == ("FAIL", 1.0)
    assert res["exposures_valid_variant"] == ("FAIL", 1.0)  # the NULL variant is not counted
    assert res["exposures_event_id_unique"] == ("FAIL", 1.0)
    assert res["user_assigned_to_single_variant"] == ("FAIL", 1.0)
    assert res["exposure_event_time_not_in_future"] == ("FAIL", 1.0)
    assert res["behavior_valid_event_name"] == ("PASS", 0.0)  # NULL name not counted
    assert res["purchase_revenue_valid"] == ("FAIL", 1.0)
    assert res["behavior_has_matching_exposure"] == ("WARN", 1.0)
    assert res["behavior_event_id_unique"] == ("FAIL", 1.0)


def test_quality_on_empty_tables(spark):
    exp = _exp(spark, []).withColumn("event_timestamp", F.lit(None).cast("timestamp"))
    beh = spark.createDataFrame(
        [], "event_id string, experiment_id string, user_id string, event_name string, revenue_gbp double, "
        "refund_gbp double, event_timestamp timestamp"
    )
    res = {r.check_name: (r.status, r.observed_value) for r in quality.run_checks(exp, beh).collect()}
    assert res["silver_exposures_has_rows"] == ("FAIL", 0.0)
    assert res["behavior_has_matching_exposure"] == ("PASS", 0.0)
    assert all(v == 0.0 for _, v in res.values())


def test_fan_out_counts_repeated_exposures(spark):
    exp = _exp(
        spark,
        [
            ("a1", "x", "u1", "control", "2026-01-01", T0, "t", 0, 1, "GB", "organic", "ios"),
            ("a2", "x", "u1", "control", "2026-01-01", T0, "t", 0, 2, "GB", "organic", "ios"),
            ("a3", "x", "u2", "control", "2026-01-01", T0, "t", 0, 3, "GB", "organic", "ios"),
        ],
    )
    beh = spark.createDataFrame(
        [("p1", "x", "u1", "purchase", 10.0, None, T0), ("r1", "x", "u2", "refund", None, 4.0, T0)],
        "event_id string, experiment_id string, user_id string, event_name string, revenue_gbp double, "
        "refund_gbp double, event_timestamp timestamp",
    )
    per_row = gold.experiment_metrics(exp, beh).first()
    assert (per_row.exposed_users, per_row.converted_users, per_row.total_purchases) == (2, 2, 2)
    assert (per_row.gross_revenue_gbp, per_row.refunds_gbp, per_row.net_revenue_gbp) == (20.0, 4.0, 16.0)
    assert per_row.avg_order_value_gbp == 10.0
    per_user = gold.experiment_metrics(exp, beh, one_row_per_user=True).first()
    assert (per_user.converted_users, per_user.total_purchases, per_user.gross_revenue_gbp) == (1, 1, 10.0)
    seg = gold.segment_metrics(exp, beh).first()
    assert (seg.exposed_users, seg.converted_users, seg.revenue_gbp, seg.conversion_rate_pct) == (2, 2, 20.0, 100.0)


def test_unused_first_purchase_time_is_pruned(spark):
    """D13: the first-purchase time is part of user outcomes but never reaches the
    experiment metrics; the optimizer removes its aggregation."""
    exp = _exp(spark, [("a1", "x", "u1", "control", "2026-01-01", T0, "t", 0, 1, "GB", "organic", "ios")])
    beh = spark.createDataFrame(
        [("p1", "x", "u1", "purchase", 10.0, None, T0)],
        "event_id string, experiment_id string, user_id string, event_name string, revenue_gbp double, "
        "refund_gbp double, event_timestamp timestamp",
    )
    plan = gold.experiment_metrics(exp, beh)._jdf.queryExecution().optimizedPlan().toString()
    assert "min(event_timestamp" not in plan
    assert "min(event_timestamp" in gold.user_outcomes(beh)._jdf.queryExecution().optimizedPlan().toString()


def test_conflicts_are_judged_after_de_duplication(spark):
    """A later retry of an event with another variant is dropped by keep-first
    de-dup, so it must not make the user conflicted."""
    later = T0 + dt.timedelta(seconds=9)
    rows = [
        ("e1", "x", "u1", "control", "2026-01-01", T0, "t", 0, 1),
        ("e1", "x", "u1", "treatment", "2026-01-01", later, "t", 0, 2),
        ("e2", "x", "u1", "control", "2026-01-01", T0, "t", 0, 3),
    ]
    clean, quarantine = silver.silver_exposures(_exp(spark, rows))
    assert sorted((r.event_id, r.assigned_variant) for r in clean.collect()) == [("e1", "control"), ("e2", "control")]
    assert quarantine.count() == 0


@settings(max_examples=12, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from([None, "e1", "e2", "e3", "e4"]),
            st.sampled_from(["x", "y"]),
            st.sampled_from([None, "u1", "u2", "u3"]),
            st.sampled_from([None, "control", "treatment", "holdout"]),
            st.sampled_from([None, "2026-01-01", "2026-01-02", "bad"]),
            st.integers(min_value=0, max_value=3),
        ),
        max_size=14,
    )
)
def test_silver_exposure_split_properties(spark, rows):
    data = [
        (eid, xid, uid, v, t, T0 + dt.timedelta(seconds=lag), "t", 0, i)
        for i, (eid, xid, uid, v, t, lag) in enumerate(rows)
    ]
    bronze = _exp(spark, data)
    clean, quarantine = silver.silver_exposures(bronze)
    enriched = silver.enrich_exposures(bronze)
    valid = silver.valid_exposures(enriched)
    dups = valid.count() - silver.dedup_keep_first(valid).count()
    c, q = clean.collect(), quarantine.collect()
    # conservation: every bronze row is in Silver, in quarantine, or a removed duplicate
    assert len(data) == len(c) + len(q) + dups
    # Silver: unique event ids, one variant per (experiment, user), disjoint from quarantine
    assert len({r.offset for r in c}) == len({r.event_id for r in c}) == len(c)
    variants = {}
    for r in c:
        variants.setdefault((r.experiment_id, r.user_id), set()).add(r.assigned_variant)
    assert all(len(v) == 1 for v in variants.values())
    assert not ({r.offset for r in c} & {r.offset for r in q})


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from([None, "b1", "b2", "b3"]),
            st.sampled_from([None, "u1", "u2"]),
            st.sampled_from([None, "page_view", "purchase", "refund", "unknown"]),
            st.sampled_from([None, "2026-01-01", "bad"]),
            st.sampled_from([None, -1.0, 0.0, 12.5]),
            st.booleans(),
            st.integers(min_value=0, max_value=2),
        ),
        max_size=12,
    )
)
def test_silver_behavior_split_conserves_rows(spark, rows):
    data = [
        (eid, "x", uid, name, t, T0 + dt.timedelta(seconds=lag), "t", 0, i, ("/p", bot, amount, None))
        for i, (eid, uid, name, t, amount, bot, lag) in enumerate(rows)
    ]
    bronze = spark.createDataFrame(data, BEHAVIOR_COLS)
    clean, quarantine = silver.silver_behavior(bronze)
    flat = silver.flatten_behavior(bronze)
    bots = silver.bot_behavior(flat).count()
    valid = silver.valid_behavior(flat)
    dups = valid.count() - silver.dedup_keep_first(valid).count()
    c = clean.collect()
    assert len(data) == len(c) + quarantine.count() + dups + bots
    assert len({r.event_id for r in c}) == len(c)
    assert not any(r.is_bot for r in c)


def test_user_with_exposures_on_two_devices_counts_in_both_segments(spark):
    exp = _exp(
        spark,
        [
            ("a1", "x", "u1", "control", "2026-01-01", T0, "t", 0, 1, "GB", "organic", "ios"),
            ("a2", "x", "u1", "control", "2026-01-01", T0, "t", 0, 2, "GB", "organic", "android"),
            ("a3", "x", "u1", "control", "2026-01-01", T0, "t", 0, 3, "GB", "organic", "android"),
            ("a4", "x", "u2", "control", "2026-01-01", T0, "t", 0, 4, "GB", "organic", None),
        ],
    )
    beh = spark.createDataFrame(
        [("p1", "x", "u1", "purchase", 7.5, None, T0)],
        "event_id string, experiment_id string, user_id string, event_name string, revenue_gbp double, "
        "refund_gbp double, event_timestamp timestamp",
    )
    seg = {r.device: r for r in gold.segment_metrics(exp, beh).collect()}
    assert set(seg) == {"ios", "android", None}  # a NULL device is its own segment
    assert (seg["ios"].exposed_users, seg["ios"].converted_users, seg["ios"].revenue_gbp) == (1, 1, 7.5)
    # two exposure rows on android: the purchase counts once per exposure row, as upstream
    assert (seg["android"].exposed_users, seg["android"].converted_users, seg["android"].revenue_gbp) == (1, 2, 15.0)
    assert (seg[None].exposed_users, seg[None].converted_users, seg[None].conversion_rate_pct) == (1, 0, 0.0)
    overall = gold.experiment_metrics(exp, beh).first()
    assert (overall.exposed_users, overall.converted_users, overall.gross_revenue_gbp) == (2, 3, 22.5)


def test_null_event_ids_form_one_duplicate_group(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("b",), ("b",)], "event_id string")
    assert quality.duplicate_key_count(df).first()["duplicate_ids"] == 2
    stats = gold.key_stats(df).first()
    assert (stats["rows"], stats["duplicate_keys"]) == (5, 2)
    # keep-first de-dup also treats the NULL ids as one group
    ordered = df.withColumns({"kafka_ingestion_timestamp": F.lit(T0), "offset": F.monotonically_increasing_id()})
    assert silver.dedup_keep_first(ordered).count() == 3
