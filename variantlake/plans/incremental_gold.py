"""Gold kept up to date: each run reads the Silver folders that appeared since the last one.

``update_gold`` compares the published Silver versions with those that Gold was last
computed from. The folders that differ are the change:

1. folders that appeared are summarised by user (``gold_state``); of Silver nothing else
   is read, and folders that vanished need no read at all;
2. the users of changed folders, old and new, are the changed users. Their summaries
   before and after say what they added to each cell and what they add now;
3. the cells of the last version, less the one, plus the other, are checked (every
   published exposure row is in a cell, every behavior row in a summary) and published by
   one manifest row, as Silver is (``sources.versions``);
4. the Gold tables, some rows each, are written from the cells.

The result equals ``build_gold`` over the whole version. A run that died before
publishing starts again from the last version; one that died after it finds the cells
and writes the tables. The health summary checks Silver as it is stored, duplicates
included, so it stays with ``build_gold``. One run at a time may write.

``rebuild``, or a Silver that was rebuilt and so shares no folder with the last version,
starts from nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from variantlake.functions.domains import USER_KEY
from variantlake.operators import gold_state
from variantlake.plans.incremental import ENTITIES
from variantlake.sources import versions
from variantlake.sources.lake import table_path, write_table

GOLD = "gold"
#: summaries of so many runs are merged into one, without folders that no version lists any more
MERGE_STATES = 24
DAYS = {"exposures": (gold_state.exposure_days, gold_state.EXPOSURE_DAYS), "behavior": (gold_state.behavior_days, gold_state.BEHAVIOR_DAYS)}
FOLDER_SCHEMA = "run string, year int, month int, day int"

Folder = tuple[str, int | None, int | None, int | None]


def _folders(held: Row | None) -> dict[Folder, Row]:
    return {(f.run, f.year, f.month, f.day): f for f in held.folders if f.target == "silver"} if held else {}


def _state_path(base: str, run: str, table: str) -> str:
    return f"{versions.entity_path(base, GOLD, 'state')}run={run}/{table}"


def _days(spark: SparkSession, base: str, entity: str, states: list[str], folders: dict[Folder, Row]) -> DataFrame:
    """The day summaries of some folders."""
    schema = DAYS[entity][1]
    if not states:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(schema).parquet(*(_state_path(base, r, f"{entity}_days") for r in states))
    listed = spark.createDataFrame(list(folders), FOLDER_SCHEMA)  # dates, not rows
    return gold_state.matching(stored, listed, gold_state.FOLDER)


def _summarise(spark: SparkSession, base: str, entity: str, run: str, added: dict[Folder, Row]) -> None:
    """Store the summaries of folders that appeared; every row of them is counted."""
    summary, schema = DAYS[entity]
    silver = StructType([*ENTITIES[entity].silver.fields, StructField("run", StringType())])
    rows = versions.read_folders(spark, base, entity, list(added.values()), silver)
    path = _state_path(base, run, f"{entity}_days")
    summary(rows).write.parquet(path)
    count = "exposure_rows" if entity == "exposures" else "event_rows"
    found = spark.read.schema(schema).parquet(path).agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    expected = sum(f.rows for f in added.values())
    if found != expected:
        raise RuntimeError(f"{entity}: {expected} rows were published, but {found} are in the summaries; nothing was published")


def read_cells(spark: SparkSession, base: str, held: Row | None) -> DataFrame:
    """The cells of a Gold version."""
    if held is None:
        return spark.createDataFrame([], gold_state.CELLS)
    return spark.read.schema(gold_state.CELLS).parquet(_state_path(base, held.states[-1], "cells"))


def read_gold(spark: SparkSession, base: str, name: str, version: int | None = None) -> DataFrame:
    """A Gold table (experiment, funnel or segment metrics) from the cells of the newest (or a given) version."""
    return gold_state.METRICS[name](read_cells(spark, base, versions.current(spark, base, GOLD, version)))


def _advance(spark: SparkSession, base: str, newest: Row | None, rebuild: bool, silver: int | None = None) -> Row:
    """Publish the Gold version of a Silver version (the newest); the held one where Silver is the same."""
    now = {name: versions.current(spark, base, name, silver) for name in ENTITIES}
    if missing := [name for name, row in now.items() if row is None]:
        raise ValueError(f"no published Silver of {', '.join(missing)}; run update_silver first")
    held = None if rebuild else newest
    before = {name: _folders(versions.current(spark, base, name, held.report[name]) if held else None) for name in ENTITIES}
    after = {name: _folders(row) for name, row in now.items()}
    if held and not any(before[n].keys() & after[n].keys() for n in ENTITIES):
        held, before = None, {name: {} for name in ENTITIES}
    changed = {name: before[name].keys() ^ after[name].keys() for name in ENTITIES}
    if held and not any(changed.values()):
        return held

    run = f"g{(newest.version if newest else 0) + 1:06d}-{uuid.uuid4().hex[:8]}"
    states = [*(held.states if held else []), run]
    for name in ENTITIES:
        _summarise(spark, base, name, run, {f: after[name][f] for f in after[name].keys() - before[name].keys()})
    days = {name: _days(spark, base, name, states, after[name]) for name in ENTITIES}
    if held:
        moved = [_days(spark, base, name, states, dict.fromkeys(changed[name])).select(*USER_KEY) for name in ENTITIES]
        path = _state_path(base, run, "changed_users")
        moved[0].unionByName(moved[1]).distinct().write.parquet(path)
        users = spark.read.parquet(path)

        def of_changed(folders: dict[str, dict[Folder, Row]]) -> DataFrame:
            rows = [gold_state.matching(_days(spark, base, name, states, folders[name]), users, USER_KEY) for name in ("exposures", "behavior")]
            return gold_state.cells(*rows)

        parts = read_cells(spark, base, held).unionByName(gold_state.less(of_changed(before))).unionByName(of_changed(after))
    else:
        parts = gold_state.cells(days["exposures"], days["behavior"])
    gold_state.merged(parts).coalesce(1).write.parquet(_state_path(base, run, "cells"))  # some rows a variant and segment

    found = spark.read.schema(gold_state.CELLS).parquet(_state_path(base, run, "cells"))
    counted = {r.level: r.n for r in found.groupBy("level").agg(F.sum("weight").alias("n")).collect()}
    expected = sum(f.rows for f in after["exposures"].values())
    for level in ("variant", "segment"):
        if counted.get(level, 0) != expected:
            raise RuntimeError(f"{expected} exposure rows were published, but the cells by {level} hold {counted.get(level, 0)}; nothing was published")
    if len(states) >= MERGE_STATES:
        merged = f"{run}-all"
        for name in ENTITIES:
            days[name].write.parquet(_state_path(base, merged, f"{name}_days"))
        found.coalesce(1).write.parquet(_state_path(base, merged, "cells"))
        states = [merged]
    report = {name: row.version for name, row in now.items()}
    report |= {"folders_read": sum(len(after[n].keys() - before[n].keys()) for n in ENTITIES)}
    return versions.publish(spark, base, GOLD, newest, epoch="", batch=0, folders=[], states=states, report=report)


def update_gold(spark: SparkSession, base: str, rebuild: bool = False, silver: int | None = None) -> dict[str, str]:
    """Bring Gold up to date with the published Silver (the newest, or version ``silver``); returns the paths of the three metric tables."""
    _advance(spark, base, versions.current(spark, base, GOLD), rebuild, silver)
    paths = {name: table_path(base, "gold", name) for name in gold_state.METRICS}
    for name, path in paths.items():
        write_table(read_gold(spark, base, name), path)
    return paths
