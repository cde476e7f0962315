"""Silver kept up to date: each run reads the new Bronze files only, and publishes a checked version.

``update_silver`` is an ``availableNow`` stream over the Bronze folder of each entity.
Spark's file source log says which files are new, so Bronze that was handled is not
read again. The batch is judged against the state of earlier runs (``operators.state``):

1. its first row of each event id, from one hash aggregate, meets the index of kept ids;
2. (exposures) the users of rows kept or replaced meet the variant state, which says
   whose conflict begins or ends, and on which dates their rows lie;
3. only touched dates are rewritten: their old Silver rows and conflicted rows, less the
   replaced ones, plus the new rows, are flagged again; Silver and quarantine are staged
   by one write, tagged by target;
4. the staged folders are checked (every row accounted for, no row in both tables) and
   published by one manifest row (``sources.versions``), with all other dates as they were.

The result equals one build over all of Bronze, whatever the split into runs. A failed
check or a lost driver leaves the published version as it was; the next run handles
the same files again. A run that published but did not commit its progress is
recognised by its batch number. One run at a time may write an entity.

The first run, or ``rebuild``, handles all of Bronze. A Bronze that was rewritten (for
instance compacted) has new files, so it needs ``rebuild``.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from variantlake.functions.domains import PARTITION_COLUMNS, QUARANTINE_MULTI_VARIANT, USER_KEY
from variantlake.functions.expressions import behavior_is_valid, exposure_is_valid
from variantlake.operators import positions, silver, state
from variantlake.sources import versions
from variantlake.sources.lake import normalise_base, read_table, scratch_dir, table_path
from variantlake.sources.schemas import (
    BRONZE_BEHAVIOR_SCHEMA,
    BRONZE_EXPOSURES_SCHEMA,
    QUARANTINE_BEHAVIOR_SCHEMA,
    QUARANTINE_EXPOSURES_SCHEMA,
    SILVER_BEHAVIOR_SCHEMA,
    SILVER_EXPOSURES_SCHEMA,
)

#: state folders of so many runs are merged into one
MERGE_STATES = 24


@dataclass(frozen=True)
class Entity:
    """How one entity goes from Bronze to Silver."""

    name: str
    bronze: StructType
    silver: StructType
    quarantine: StructType

    @property
    def has_variants(self) -> bool:
        return self.name == "exposures"

    def prepared(self, bronze: DataFrame) -> DataFrame:
        return silver.enrich_exposures(bronze) if self.has_variants else silver.flatten_behavior(bronze)

    def valid(self, rows: DataFrame) -> DataFrame:
        return silver.valid_exposures(rows) if self.has_variants else silver.valid_behavior(rows)

    def invalid(self, rows: DataFrame) -> DataFrame:
        return silver.invalid_exposures(rows) if self.has_variants else silver.invalid_behavior(rows)

    def survey(self, rows: DataFrame) -> list[Row]:
        """Rows of a batch by date and by what becomes of them, counted by themselves, and the topics; one scan."""
        ok = exposure_is_valid() if self.has_variants else behavior_is_valid()
        bot = F.lit(False) if self.has_variants else F.col("is_bot")
        counts = {"bronze": F.lit(True), "invalid": ~ok, "bots": ok & bot, "valid": ok & ~bot}
        by_date = rows.groupBy(*PARTITION_COLUMNS).agg(*(F.count_if(c).alias(n) for n, c in counts.items()), F.collect_set("topic").alias("topics"))
        return by_date.collect()  # dates, not rows

    @property
    def index(self) -> StructType:
        names = [*state.KEPT, *(c for c in ("experiment_id", "user_id", "assigned_variant") if self.has_variants)]
        return StructType([self.silver[n] for n in names])

    @property
    def variants(self) -> StructType:
        return StructType([self.silver[n] for n in state.VARIANT]).add("n", "long") if self.has_variants else StructType()


EXPOSURES = Entity("exposures", BRONZE_EXPOSURES_SCHEMA, SILVER_EXPOSURES_SCHEMA, QUARANTINE_EXPOSURES_SCHEMA)
BEHAVIOR = Entity("behavior", BRONZE_BEHAVIOR_SCHEMA, SILVER_BEHAVIOR_SCHEMA, QUARANTINE_BEHAVIOR_SCHEMA)
ENTITIES = {e.name: e for e in (EXPOSURES, BEHAVIOR)}


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _state(spark: SparkSession, base: str, entity: Entity, held: Row | None, table: str) -> DataFrame:
    """All entries of a state table, of every run that the version lists."""
    schema = entity.index if table == "ids" else entity.variants
    paths = [f"{versions.entity_path(base, entity.name, 'state')}run={r}/{table}" for r in (held.states if held else [])]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _write_states(spark: SparkSession, base: str, entity: Entity, held: Row | None, run: str, ids: DataFrame, changes: DataFrame | None) -> list[str]:
    """Store a run's entries; returns the runs that the next version lists."""
    states = list(held.states) if held else []
    if len(states) + 1 >= MERGE_STATES:  # one folder with everything; entries merge by min and sum
        ids = _state(spark, base, entity, held, "ids").unionByName(ids)
        if changes is not None:
            changes = _state(spark, base, entity, held, "variants").unionByName(changes)
            changes = changes.groupBy(*state.VARIANT).agg(F.sum("n").alias("n")).where("n <> 0")
        states = []
    path = f"{versions.entity_path(base, entity.name, 'state')}run={run}/"
    ids.write.parquet(f"{path}ids")
    if changes is not None:
        changes.write.parquet(f"{path}variants")
    return [*states, run]


def _check_staged(entity: Entity, staged: list[Row], written: DataFrame, expected: int) -> None:
    """Every row is staged once: as many as there must be, and none in Silver and quarantine at once."""
    rows = sum(f.rows for f in staged)
    if rows != expected:
        raise RuntimeError(f"{entity.name}: {expected} rows must be in the touched dates, but {rows} were staged; nothing was published")
    place = ["topic", "partition", "offset", "event_id"]
    sides = [written.where(F.col("target") == t).select(*place) for t in ("silver", "quarantine")]
    if sides[0].join(sides[1], on=place, how="left_semi").limit(1).count():
        raise RuntimeError(f"{entity.name}: a row was staged for Silver and for quarantine; nothing was published")


def apply_batch(spark: SparkSession, base: str, entity: Entity, bronze: DataFrame, epoch: str, batch: int) -> Row:
    """Judge one batch of Bronze rows and publish the version that follows; a batch published before is left alone."""
    newest = versions.current(spark, base, entity.name)
    held = newest if newest and newest.epoch == epoch else None  # another epoch starts from nothing
    if held and held.batch >= batch:
        return held
    run = f"r{(newest.version if newest else 0) + 1:06d}-{uuid.uuid4().hex[:8]}"
    scratch = scratch_dir(spark, f"silver-{entity.name}")
    prepared = entity.prepared(bronze)
    valid = entity.valid(prepared)
    survey = entity.survey(prepared)
    topics = positions.ranked({t for r in survey for t in r.topics})
    counts = {k: sum(r[k] for r in survey) for k in ("bronze", "invalid", "bots", "valid")}

    index = _state(spark, base, entity, held, "ids")
    decided = _written(state.decided_ids(positions.first_positions(valid, topics), index, topics), f"{scratch}decided")
    counted = decided.groupBy("verdict").agg(F.count(F.lit(1)).alias("ids"), F.count_if(F.col("rows") > 1).alias("repeated")).collect()
    verdicts = {r.verdict: r.ids for r in counted}
    repeated = sum(r.repeated for r in counted)
    looked_up = sum(r.repeated if r.verdict == "new" else r.ids for r in counted)
    added, replaced_ids = verdicts.get("new", 0) + verdicts.get("earlier", 0), verdicts.get("earlier", 0)
    replaced = decided.where("verdict = 'earlier'")
    tied = bool(state.tied_ids(valid, decided, topics, repeated).limit(1).count())
    new = _written(state.kept_rows(valid, decided, topics, tied, looked_up), f"{scratch}kept")

    # whose conflict begins or ends, and which dates that touches
    changes = changed = None
    if entity.has_variants:
        before = _state(spark, base, entity, held, "variants")
        changes = _written(state.variant_changes(new, replaced), f"{scratch}changes")
        changed = _written(state.changed_users(before, changes), f"{scratch}changed")
        moved = before.join(changed.where("was <> now").select(*USER_KEY), USER_KEY, "left_semi").select(*PARTITION_COLUMNS)
        parts = [changes.select(*PARTITION_COLUMNS), moved]
    else:
        parts = [new.select(*PARTITION_COLUMNS), replaced.select(*(F.col(f"stored.{c}").alias(c) for c in PARTITION_COLUMNS))]
    dates = {tuple(r) for r in parts[0].unionByName(parts[1]).distinct().collect()}  # dates, not rows
    dates |= {(r.year, r.month, r.day) for r in survey if r.invalid}

    # the touched dates anew; of all others not a file is opened
    folders = list(held.folders) if held else []
    old = [f for f in folders if (f.year, f.month, f.day) in dates]
    stored = {
        t: versions.read_folders(spark, base, entity.name, [f for f in old if f.target == t], schema)
        for t, schema in (("silver", entity.silver), ("quarantine", entity.quarantine))
    }
    reason = F.col("quarantine_reason")
    conflicted = reason.eqNullSafe(QUARANTINE_MULTI_VARIANT)
    kept_before = stored["silver"].withColumn("_was", F.lit(False)).unionByName(stored["quarantine"].where(conflicted).drop("quarantine_reason").withColumn("_was", F.lit(True)))
    if replaced_ids:
        kept_before = state.without_replaced(kept_before, replaced, replaced_ids)
    pool = kept_before.unionByName(new.select(*entity.silver.fieldNames()).withColumn("_was", F.lit(False)))
    if entity.has_variants:
        pool = silver.salted_left_join(pool, changed.select(*USER_KEY, "now"), USER_KEY, F.col("event_id"), changed.count())
        pool = pool.withColumn("_was", F.coalesce("now", "_was")).drop("now")
    judged = pool.withColumn("quarantine_reason", F.when(F.col("_was"), QUARANTINE_MULTI_VARIANT)).drop("_was")
    judged = judged.unionByName(stored["quarantine"].where(~conflicted)).unionByName(entity.invalid(prepared).select(*entity.quarantine.fieldNames()))
    tagged = judged.withColumn("target", F.when(reason.isNull(), "silver").otherwise("quarantine"))
    staged, written = versions.stage(tagged, base, entity.name, run)

    expected = sum(f.rows for f in old) + counts["invalid"] + added - replaced_ids
    _check_staged(entity, staged, written, expected)
    states = _write_states(spark, base, entity, held, run, new.select(*entity.index.fieldNames()), changes)
    now = [f for f in folders if (f.year, f.month, f.day) not in dates] + staged
    report = {
        "bronze": counts["bronze"],
        "valid_bots_dropped": counts["bots"],
        "duplicates_removed": counts["valid"] - added + replaced_ids,
        "dates_rewritten": len(dates),
        "dates_vanished": len({(f.target, f.year, f.month, f.day) for f in old} - {(f.target, f.year, f.month, f.day) for f in staged}),
        **{t: sum(f.rows for f in now if f.target == t) for t in ("silver", "quarantine")},
    }
    return versions.publish(spark, base, entity.name, newest, epoch=epoch, batch=batch, folders=now, states=states, report=report)


def update_entity(spark: SparkSession, base: str, entity: Entity, rebuild: bool = False) -> dict[str, int]:
    """Handle the Bronze files that no earlier run has seen; returns the totals of this call."""
    bronze = table_path(base, "bronze", entity.name)
    read_table(spark, bronze, entity.bronze)  # a missing input is an error before anything is written
    held = versions.current(spark, base, entity.name)
    epoch = held.epoch if held and not rebuild else uuid.uuid4().hex
    total: dict[str, int] = {}

    def handle(batch: DataFrame, number: int) -> None:
        row = apply_batch(batch.sparkSession, base, entity, batch, epoch, number)
        for k, v in row.report.items():
            total[k] = v if k in ("silver", "quarantine") else total.get(k, 0) + v

    query = (
        spark.readStream.schema(entity.bronze)
        .parquet(bronze)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{normalise_base(base)}versions/{entity.name}/progress/{epoch}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not total:  # no new file
        total = {"bronze": 0} | ({t: held.report[t] for t in ("silver", "quarantine")} if held else {"silver": 0, "quarantine": 0})
    return total


def update_silver(spark: SparkSession, base: str, rebuild: bool = False) -> dict[str, dict[str, int]]:
    """Bring the published Silver and quarantine of both entities up to date with Bronze."""
    with ThreadPoolExecutor(max_workers=len(ENTITIES)) as pool:
        runs = {name: pool.submit(update_entity, spark, base, entity, rebuild) for name, entity in ENTITIES.items()}
        return {name: r.result() for name, r in runs.items()}


def read_published(spark: SparkSession, base: str, layer: str, entity: str, version: int | None = None) -> DataFrame:
    """The Silver or quarantine table of the newest (or a given) version."""
    spec = ENTITIES[entity]
    held = versions.current(spark, base, entity, version)
    return versions.read_version(spark, base, entity, layer, spec.silver if layer == "silver" else spec.quarantine, held)
