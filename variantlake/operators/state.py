"""What an incremental Silver run needs to know about earlier runs, as mergeable tables.

* the index of kept ids: for each valid event id its first position, the date of the row
  kept, and (exposures) its user and variant. Runs append; of several entries of an id
  the one with the least position counts, so entries merge by ``min``;
* the variant state: rows kept by (experiment, user, variant, date). Runs append
  differences; entries merge by ``sum``. A user with two variants of positive sums is
  in conflict, and the dates say which Silver and quarantine folders hold their rows.

Both are narrow. All functions are lazy; joins are equi-joins on the event id or user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantlake.functions.domains import PARTITION_COLUMNS, USER_KEY
from variantlake.operators.positions import POSITION, position_code, position_of
from variantlake.operators.silver import dedup_keep_first, salted_left_join

KEPT = ["event_id", *POSITION, *PARTITION_COLUMNS]
VARIANT = [*USER_KEY, "assigned_variant", *PARTITION_COLUMNS]


def position() -> Column:
    return F.struct(*POSITION)


def decided_ids(firsts: DataFrame, index: DataFrame, topics: list[str]) -> DataFrame:
    """(event_id, rows, at, stored, verdict) for each id of a batch, given the index of earlier runs.

    ``firsts`` has the id's number of rows and first position in the batch. The verdict is
    ``new`` (not seen before), ``earlier`` (the batch holds an earlier row than the one
    kept: it takes its place) or ``later`` (all rows of the batch are duplicates).
    ``stored`` is the index entry in force. A retry storm on one id is one row here.
    """
    entry = F.struct(*POSITION, *(c for c in index.columns if c not in ("event_id", *POSITION)))
    held = index.select("event_id", entry.alias("entry")).join(firsts.select("event_id"), "event_id", "left_semi")
    held = held.groupBy("event_id").agg(F.min("entry").alias("stored"))  # ids of the batch only
    first = position_of(F.col("at"), topics)
    known = F.struct(*(F.col(f"stored.{c}").alias(c) for c in POSITION))
    return firsts.join(held, "event_id", "left").withColumn(
        "verdict", F.when(F.col("stored").isNull(), "new").when(first < known, "earlier").otherwise("later")
    )


def tied_ids(valid: DataFrame, decided: DataFrame, topics: list[str], held: int | None = None) -> DataFrame:
    """Ids whose first position in the batch is stored more than once; a scan of narrow columns.

    ``held`` is the counted number of ids with more than one row (``salted_left_join``).
    """
    lookup = decided.where("rows > 1").select("event_id", "at")
    coded = valid.select("event_id", "topic", "partition", "offset", position_code(topics).alias("_code"))
    found = salted_left_join(coded, lookup, ["event_id"], F.struct("topic", "partition", "offset"), held)
    return found.where("_code = at").groupBy("event_id").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def kept_rows(valid: DataFrame, decided: DataFrame, topics: list[str], tied: bool, held: int | None = None) -> DataFrame:
    """The rows of a batch that Silver keeps; only ids that repeat or were seen before are looked up.

    ``tied`` says that some id's first position is stored more than once (``tied_ids``): the
    rows of repeated ids are then cut to one each by the window. ``held`` is the counted
    number of ids to look up.
    """
    lookup = decided.where("rows > 1 OR verdict <> 'new'").select("event_id", "at", "verdict", F.col("rows").alias("_rows"))
    coded = valid.withColumn("_code", position_code(topics))
    found = salted_left_join(coded, lookup, ["event_id"], F.struct("topic", "partition", "offset"), held)
    first = found.where("verdict IS NULL OR (verdict <> 'later' AND _code = at)")
    if not tied:
        return first.select(*valid.columns)
    single = first.where("coalesce(_rows, 1) = 1").select(*valid.columns)
    again = first.where("_rows > 1").select(*valid.columns)
    return single.unionByName(dedup_keep_first(again))


def without_replaced(rows: DataFrame, replaced: DataFrame, held: int | None = None) -> DataFrame:
    """``rows`` kept by earlier runs, without those whose id has an earlier row now: ``held`` ids, where counted."""
    gone = replaced.select("event_id", F.struct(*(F.col(f"stored.{c}").alias(c) for c in POSITION)).alias("_gone"))
    found = salted_left_join(rows, gone, ["event_id"], F.struct("topic", "partition", "offset"), held)
    return found.where(F.col("_gone").isNull() | ~F.col("_gone").eqNullSafe(position())).drop("_gone")


def variant_changes(kept: DataFrame, replaced: DataFrame) -> DataFrame:
    """Differences of the variant state: rows that a run adds, less those that they replace."""
    added = kept.select(*VARIANT, F.lit(1).alias("n"))
    taken = replaced.select(*(F.col(f"stored.{c}").alias(c) for c in VARIANT), F.lit(-1).alias("n"))
    return added.unionByName(taken).groupBy(*VARIANT).agg(F.sum("n").alias("n"))


def _conflicted(n: Column) -> Column:
    return F.count_distinct(F.when(n > 0, F.col("assigned_variant"))) > 1


def changed_users(before: DataFrame, changes: DataFrame) -> DataFrame:
    """(experiment, user, was, now): whether users that a run touches were and are in conflict."""
    users = changes.select(*USER_KEY).distinct()
    mine = before.join(users, USER_KEY, "left_semi").withColumn("_old", F.col("n"))
    both = mine.unionByName(changes.withColumn("_old", F.lit(0).cast("long")))
    sums = both.groupBy(*USER_KEY, "assigned_variant").agg(F.sum("n").alias("n"), F.sum("_old").alias("_old"))
    return sums.groupBy(*USER_KEY).agg(_conflicted(F.col("_old")).alias("was"), _conflicted(F.col("n")).alias("now"))
