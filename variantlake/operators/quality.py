"""The 16 Silver data-quality checks as one DataFrame (one Spark job).

Four narrow scans: per table one aggregate by user, which carries the conditions on
single rows as ``count_if`` and combines map-side (users are far fewer than rows), and
one by ``event_id`` alone for duplicate ids. The two user aggregates meet in one full
outer join of one row per user, so no hot key reaches it; it gives check 7 (several
variants), check 14 (behavior without exposure; a NULL key never matches) and the sums
of all conditions. Results become rows with ``explode(array(struct(...)))`` - nothing is
collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantlake.functions.domains import (
    PURCHASE,
    QUALITY_CHECKS,
    QUALITY_LAYER,
    REFUND,
    USER_KEY,
    VALID_BEHAVIOR_EVENTS,
    VALID_VARIANTS,
)

_CATALOG = {name: (table, threshold, desc) for name, table, threshold, desc in QUALITY_CHECKS}
_ORDER = {name: i + 1 for i, (name, *_rest) in enumerate(QUALITY_CHECKS)}
_MIN_ROWS = {"silver_exposures_has_rows", "silver_behavior_has_rows"}
_WARN_ONLY = {"behavior_has_matching_exposure"}


def _status(name: str, observed: Column) -> Column:
    if name in _MIN_ROWS:
        return F.when(observed > 0, "PASS").otherwise("FAIL")
    if name in _WARN_ONLY:
        return F.when(observed > 0, "WARN").otherwise("PASS")
    return F.when(observed == 0, "PASS").otherwise("FAIL")


def _results(agg_row: DataFrame, observed: dict[str, str]) -> DataFrame:
    """Turn one aggregate row into one result row per check."""
    items = []
    for name, col in observed.items():
        table, threshold, desc = _CATALOG[name]
        value = F.col(col).cast("double")
        items.append(
            F.struct(
                F.lit(_ORDER[name]).alias("check_order"),
                F.lit(name).alias("check_name"),
                F.lit(QUALITY_LAYER).alias("layer"),
                F.lit(table).alias("table_name"),
                _status(name, value).alias("status"),
                value.alias("observed_value"),
                F.lit(threshold).alias("threshold"),
                F.lit(desc).alias("description"),
            )
        )
    return agg_row.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def _by_user(df: DataFrame, side: str, conditions: dict[str, Column]) -> DataFrame:
    """One row per (experiment, user): rows and a count for every condition, named ``<side>_<name>``."""
    return df.groupBy(*USER_KEY).agg(
        F.count(F.lit(1)).alias(f"{side}_rows"), *[F.count_if(cond).alias(f"{side}_{name}") for name, cond in conditions.items()]
    )


def run_checks(exposures: DataFrame, behavior: DataFrame, as_of: Column | None = None) -> DataFrame:
    """All 16 checks; ``as_of`` is the "now" for the future-time checks (default: query time).

    ``NOT isin`` on a NULL value is NULL and so not counted, as upstream; the NULL
    checks count NULLs separately.
    """
    now = as_of if as_of is not None else F.current_timestamp()
    name = F.col("event_name")
    of_exposure = {
        "null_user": F.col("user_id").isNull(),
        "null_id": F.col("event_id").isNull(),
        "bad_variant": ~F.col("assigned_variant").isin(VALID_VARIANTS),
        "future": F.col("event_timestamp") > now,
    }
    of_behavior = {
        "null_user": F.col("user_id").isNull(),
        "null_id": F.col("event_id").isNull(),
        "bad_name": ~name.isin(VALID_BEHAVIOR_EVENTS),
        "bad_revenue": (name == PURCHASE) & (F.col("revenue_gbp").isNull() | (F.col("revenue_gbp") < 0)),
        "bad_refund": (name == REFUND) & (F.col("refund_gbp").isNull() | (F.col("refund_gbp") < 0)),
        "future": F.col("event_timestamp") > now,
    }
    # by variant first: hash aggregates only, and at most one row a variant reaches the second
    per_variant = exposures.groupBy(*USER_KEY, "assigned_variant").agg(
        F.count(F.lit(1)).alias("e_rows"), *[F.count_if(cond).alias(f"e_{n}") for n, cond in of_exposure.items()]
    )
    e_names = ["e_rows", *(f"e_{n}" for n in of_exposure)]
    e = per_variant.groupBy(*USER_KEY).agg(F.count("assigned_variant").alias("_variants"), *[F.sum(n).alias(n) for n in e_names])
    b = _by_user(behavior, "b", of_behavior)
    b_names = ["b_rows", *(f"b_{n}" for n in of_behavior)]
    totals = e.join(b, on=USER_KEY, how="full").agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in [*e_names, *b_names]],
        F.count_if(F.col("_variants") > 1).alias("multi_variant_users"),
        F.coalesce(F.sum(F.when(F.col("e_rows").isNull(), F.col("b_rows"))), F.lit(0)).alias("orphan_rows"),
    )

    parts = [
        _results(
            totals,
            {
                "silver_exposures_has_rows": "e_rows",
                "exposures_user_id_not_null": "e_null_user",
                "exposures_event_id_not_null": "e_null_id",
                "exposures_valid_variant": "e_bad_variant",
                "exposure_event_time_not_in_future": "e_future",
                "user_assigned_to_single_variant": "multi_variant_users",
                "silver_behavior_has_rows": "b_rows",
                "behavior_user_id_not_null": "b_null_user",
                "behavior_event_id_not_null": "b_null_id",
                "behavior_valid_event_name": "b_bad_name",
                "purchase_revenue_valid": "b_bad_revenue",
                "refund_amount_valid": "b_bad_refund",
                "behavior_event_time_not_in_future": "b_future",
                "behavior_has_matching_exposure": "orphan_rows",
            },
        ),
        _results(duplicate_key_count(exposures), {"exposures_event_id_unique": "duplicate_ids"}),
        _results(duplicate_key_count(behavior), {"behavior_event_id_unique": "duplicate_ids"}),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("checked_at", F.current_timestamp()).orderBy("check_order").drop("check_order")


def duplicate_key_count(df: DataFrame, key: str = "event_id") -> DataFrame:
    """One row: number of ``key`` groups (a NULL key included) with more than one row."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.count_if(F.col("_n") > 1).alias("duplicate_ids"))
    )
