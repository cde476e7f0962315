"""Column expressions shared by the operators.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so the
work stays inside whole-stage codegen; nothing here is a UDF.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from variantlake.functions.domains import (
    FUNNEL_ORDER,
    PURCHASE,
    REFUND,
    VALID_BEHAVIOR_EVENTS,
    VALID_VARIANTS,
)


def parse_event_time(col: str | Column = "event_time") -> Column:
    """ISO-8601 text -> timestamp; malformed text gives NULL instead of failing.

    ``to_timestamp`` raises under ANSI mode (the Spark 4 default), which would stop
    a stream on one bad record; ``try_to_timestamp`` keeps the row so the Silver
    validity rule can quarantine it.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c)


def _all_present(*names: str) -> Column:
    present = [F.col(n).isNotNull() for n in names]
    return reduce(and_, present)


def exposure_rule() -> Column:
    """A usable exposure, as a plain conjunction: true, or false or NULL.

    Requires event_id, user_id, experiment_id, a variant in the domain and a parsed
    event_timestamp. Filters use this form (a filter drops NULL anyway), so that its
    conjuncts on stored columns reach the Parquet scan.
    """
    return _all_present("event_id", "user_id", "experiment_id", "event_timestamp") & F.col("assigned_variant").isin(VALID_VARIANTS)


def exposure_is_valid() -> Column:
    """``exposure_rule``, never NULL; its negation is exactly the quarantine rule."""
    return F.coalesce(exposure_rule(), F.lit(False))


def behavior_rule() -> Column:
    """A usable behavior record (bots not considered), as a plain conjunction.

    A purchase needs a non-negative revenue, a refund a non-negative refund amount.
    ``NaN >= 0`` is true in Spark, so a NaN amount passes, as upstream.
    """
    name = F.col("event_name")
    purchase_ok = (name != PURCHASE) | (F.col("revenue_gbp").isNotNull() & (F.col("revenue_gbp") >= 0))
    refund_ok = (name != REFUND) | (F.col("refund_gbp").isNotNull() & (F.col("refund_gbp") >= 0))
    return (
        _all_present("event_id", "user_id", "experiment_id", "event_timestamp")
        & name.isin(VALID_BEHAVIOR_EVENTS)
        & purchase_ok
        & refund_ok
    )


def behavior_is_valid() -> Column:
    """``behavior_rule``, never NULL."""
    return F.coalesce(behavior_rule(), F.lit(False))


def funnel_order(col: str | Column = "event_name") -> Column:
    """Funnel position of an event name; unknown names give NULL."""
    c = F.col(col) if isinstance(col, str) else col
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(FUNNEL_ORDER.items())])
    return lookup[c]


def pct(numerator: str | Column, denominator: str | Column) -> Column:
    """round(numerator / denominator * 100, 2) (HALF_UP, as ``F.round``)."""
    n = F.col(numerator) if isinstance(numerator, str) else numerator
    d = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.round(n / d * 100, 2)
