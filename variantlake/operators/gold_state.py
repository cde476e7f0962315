"""Gold kept up to date: day summaries of published Silver, and mergeable cells of metrics.

Two narrow tables carry what Gold needs to know of Silver:

* *day summaries*, one row per Silver folder (run and date) and user: exposure rows by
  variant and segment, behavior rows and amounts by event name. They are computed once,
  when a folder appears; a folder that left a version is simply not read any more.
* *cells*, one row per variant, segment and funnel stage, with sums over users. Users are
  independent of each other, so when some users change, the cells change by what these
  users add now less what they added before; nobody else is looked at.

Subtracting must undo adding to the last digit. A user's amounts are therefore summed in
a fixed order (by date and run), rounded to 2 places as in ``gold.user_outcomes``, and
added to the cells as decimals. NaN and infinite amounts, which Silver lets pass, are
counted beside the sums. A finite amount of a user of 10^21 or more is an error.

Published Silver holds each event id once, so rows of a user count distinct ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantlake.functions.domains import PARTITION_COLUMNS, PURCHASE, REFUND, USER_KEY
from variantlake.operators import gold

FOLDER = ["run", *PARTITION_COLUMNS]
SEGMENT = ["assigned_variant", "country", "traffic_source", "device"]
EXPOSURE_DAYS = (
    "run string, year int, month int, day int, experiment_id string, user_id string, assigned_variant string, "
    "country string, traffic_source string, device string, exposure_rows long"
)
BEHAVIOR_DAYS = (
    "run string, year int, month int, day int, experiment_id string, user_id string, event_name string, "
    "event_rows long, revenue_gbp double, refund_gbp double"
)
AMOUNTS = {"purchase_revenue_gbp": "revenue", "refund_amount_gbp": "refunded"}
#: amounts of a user beyond it are an error, not a rounded sum
LARGEST = 1e21
KEYS = ["level", *gold.SEGMENT_COLUMNS, "event_name"]
COUNTS = ["weight", "users", "converted", "purchases", "refunds"]
ODD = [f"{a}_{odd}" for a in AMOUNTS.values() for odd in ("nan", "inf")]
SUMS = [*COUNTS, *AMOUNTS.values(), *ODD]
CELLS = ", ".join(
    [*(f"{k} string" for k in KEYS), *(f"{c} long" for c in COUNTS), *(f"{a} decimal(38,2)" for a in AMOUNTS.values()), *(f"{o} long" for o in ODD)]
)


def exposure_days(exposures: DataFrame) -> DataFrame:
    """Exposure rows of each user by folder, variant and segment; combines map-side."""
    return exposures.groupBy(*FOLDER, *USER_KEY, *SEGMENT).agg(F.count(F.lit(1)).alias("exposure_rows"))


def behavior_days(behavior: DataFrame) -> DataFrame:
    """Behavior rows and amounts of each user by folder and event name; combines map-side."""
    return behavior.groupBy(*FOLDER, *USER_KEY, "event_name").agg(
        F.count(F.lit(1)).alias("event_rows"), F.sum("revenue_gbp").alias("revenue_gbp"), F.sum("refund_gbp").alias("refund_gbp")
    )


def matching(rows: DataFrame, keys: DataFrame, names: list[str]) -> DataFrame:
    """Rows whose key is among ``keys``, a NULL matching a NULL."""
    renamed = keys.select(*(F.col(n).alias(f"_{n}") for n in names))
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(n).eqNullSafe(F.col(f"_{n}"))
    return rows.join(renamed, cond, "left_semi")


def user_totals(days: DataFrame) -> DataFrame:
    """Purchases and refunds of each user, as ``gold.user_outcomes`` counts them; the same days give the same digits."""
    is_purchase, is_refund = (F.col("event_name") == e for e in (PURCHASE, REFUND))

    def total(event: Column, amount: str) -> Column:
        # one entry a date and run: few, and in a fixed order
        parts = F.array_sort(F.collect_list(F.when(event, F.struct(*PARTITION_COLUMNS, "run", F.coalesce(amount, F.lit(0.0)).alias("x")))))
        return F.round(F.aggregate(parts, F.lit(0.0), lambda s, p: s + p["x"]), 2)

    return (
        days.where(is_purchase | is_refund)
        .groupBy(*USER_KEY)
        .agg(
            F.max(is_purchase).alias("has_purchase"),
            F.sum(F.when(is_purchase, F.col("event_rows"))).alias("purchase_count"),
            total(is_purchase, "revenue_gbp").alias("purchase_revenue_gbp"),
            F.sum(F.when(is_refund, F.col("event_rows"))).alias("refund_count"),
            total(is_refund, "refund_gbp").alias("refund_amount_gbp"),
        )
    )


def _sums(users: Column) -> list[Column]:
    weight = F.col("exposure_rows")
    out = [F.sum(weight).alias("weight"), users.alias("users")]
    out += [F.sum(F.col(c) * weight).alias(n) for c, n in (("converted", "converted"), ("purchase_count", "purchases"), ("refund_count", "refunds"))]
    for column, name in AMOUNTS.items():
        amount = F.col(column)
        nan, inf = F.isnan(amount), F.abs(amount) == float("inf")
        beyond = F.raise_error(F.concat(F.lit(f"{column} of a user does not fit a cell: "), amount.cast("string"))).cast("double")
        exact = F.when(nan | inf, 0.0).when(F.abs(amount) >= LARGEST, beyond).otherwise(amount).cast("decimal(24,2)")
        out.append(F.sum((exact * weight).cast("decimal(38,2)")).cast("decimal(38,2)").alias(name))
        out += [F.count_if(nan).alias(f"{name}_nan"), F.count_if(~nan & inf).alias(f"{name}_inf")]
    return out


def cells(exposures: DataFrame, behavior: DataFrame) -> DataFrame:
    """What the users of these day summaries add to each cell.

    Levels: ``variant`` and ``segment`` (weighted by exposure rows, as upstream), ``exposed``
    (users by their smallest variant) and ``stage`` (those that reached an event).
    """
    base = exposures.groupBy(*USER_KEY, *SEGMENT).agg(F.sum("exposure_rows").alias("exposure_rows"))
    joined = gold.with_outcomes(base, user_totals(behavior))
    exposed = gold.exposed_users(base)
    reached = exposed.join(gold.user_stages(behavior), USER_KEY, "inner").where(F.col("event_name").isNotNull())
    variant = ["experiment_id", "assigned_variant"]
    people = [F.count(F.lit(1)).alias("weight"), F.count("user_id").alias("users")]
    levels = {
        "variant": joined.groupBy(*variant).agg(*_sums(F.count_distinct("user_id"))),
        "segment": joined.groupBy(*gold.SEGMENT_COLUMNS).agg(*_sums(F.count("user_id"))),
        "exposed": exposed.groupBy(*variant).agg(*people),
        "stage": reached.groupBy(*variant, "event_name").agg(*people),
    }
    out = None
    for level, rows in levels.items():
        rows = rows.withColumn("level", F.lit(level))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out.select(*KEYS, *(F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,2)" if c in AMOUNTS.values() else "long").alias(c) for c in SUMS))


def less(change: DataFrame) -> DataFrame:
    """The cells with the opposite sign."""
    return change.select(*KEYS, *((-F.col(c)).cast(change.schema[c].dataType).alias(c) for c in SUMS))


def merged(parts: DataFrame) -> DataFrame:
    """Cells summed over all parts; one that nobody adds to any more is gone."""
    summed = parts.groupBy(*KEYS).agg(*(F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in SUMS))
    return summed.where("weight <> 0")


def _amount(name: str) -> Column:
    odd = F.when(F.col(f"{name}_nan") != 0, F.lit(float("nan"))).when(F.col(f"{name}_inf") != 0, F.lit(float("inf")))
    return odd.otherwise(F.col(name).cast("double"))


def experiment_metrics(found: DataFrame) -> DataFrame:
    """``gold.experiment_metrics`` from cells."""
    finite = F.lit(0)
    for odd in ODD:
        finite = finite + F.abs(F.col(odd))
    net = F.when(finite == 0, (F.col("revenue") - F.col("refunded")).cast("double")).otherwise(_amount("revenue") - _amount("refunded"))
    return gold.experiment_rates(
        found.where("level = 'variant'").select(
            "experiment_id",
            "assigned_variant",
            F.col("users").alias("exposed_users"),
            F.col("converted").alias("converted_users"),
            F.col("purchases").alias("total_purchases"),
            F.col("refunds").alias("total_refunds"),
            _amount("revenue").alias("gross_revenue_gbp"),
            _amount("refunded").alias("refunds_gbp"),
            net.alias("net_revenue_gbp"),
        )
    )


def segment_metrics(found: DataFrame) -> DataFrame:
    """``gold.segment_metrics`` from cells."""
    counts = [F.col("users").alias("exposed_users"), F.col("converted").alias("converted_users"), _amount("revenue").alias("revenue_gbp")]
    return gold.segment_rates(found.where("level = 'segment'").select(*gold.SEGMENT_COLUMNS, *counts))


def funnel_metrics(found: DataFrame) -> DataFrame:
    """``gold.funnel_metrics`` from cells."""
    variant = ["experiment_id", "assigned_variant"]
    reached = found.where("level = 'stage'").select(*variant, "event_name", F.col("users").alias("users_reached_stage"))
    return gold.funnel_rates(reached, found.where("level = 'exposed'").select(*variant, F.col("users").alias("exposed_users")))


METRICS = {"experiment_metrics": experiment_metrics, "funnel_metrics": funnel_metrics, "segment_metrics": segment_metrics}
