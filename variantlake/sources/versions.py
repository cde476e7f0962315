"""Published versions of partitioned tables: staged folders, swapped by one manifest row.

Data is staged in a folder of its own, checked there, and becomes visible when a single
row is appended to the manifest: the list of partition folders that make up the new
version. Until then readers see the old version, whatever happened to the run; after
it, a date whose last row went away is simply no longer listed. Nothing is
overwritten or deleted, so a reader of an older version is never disturbed.

    versions/<entity>/manifest/          one row a version
    versions/<entity>/data/run=<id>/     target=silver|quarantine/year=/month=/day=
    versions/<entity>/state/run=<id>/    what later runs need to know (operators.state)

One manifest row lists dates, not rows of data: some thousands of folders at most.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from variantlake.sources.lake import normalise_base

FOLDER = "struct<target:string,year:int,month:int,day:int,run:string,rows:bigint>"
MANIFEST = (
    f"version long, epoch string, batch long, folders array<{FOLDER}>, states array<string>, report map<string,bigint>, published_at timestamp"
)
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
DATE = ("year", "month", "day")


def entity_path(base: str, entity: str, part: str) -> str:
    return f"{normalise_base(base)}versions/{entity}/{part}/"


def _manifest(spark: SparkSession, base: str, entity: str) -> DataFrame | None:
    path = entity_path(base, entity, "manifest")
    try:
        return spark.read.schema(MANIFEST).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current(spark: SparkSession, base: str, entity: str, version: int | None = None) -> Row | None:
    """The manifest row of the newest version (or of ``version``); None where nothing was published."""
    found = _manifest(spark, base, entity)
    if found is None:
        return None
    if version is None:
        version = found.agg(F.max("version")).first()[0]  # a narrow column of one row a version
    rows = found.where(F.col("version") == F.lit(version)).collect()
    if len(rows) > 1:
        raise RuntimeError(f"{entity}: version {version} was published {len(rows)} times; only one run may write at a time")
    return rows[0] if rows else None


def publish(spark: SparkSession, base: str, entity: str, held: Row | None, **values) -> Row:
    """Append the next version's row: one file, so that it appears whole or not at all."""
    version = held.version + 1 if held else 1
    folders = [(f.target, f.year, f.month, f.day, f.run, f.rows) for f in values["folders"]]
    row = [(version, values["epoch"], values["batch"], folders, values["states"], values["report"], None)]
    made = spark.createDataFrame(row, MANIFEST).withColumn("published_at", F.current_timestamp())
    made.coalesce(1).write.mode("append").parquet(entity_path(base, entity, "manifest"))
    return current(spark, base, entity, version)


def folder_path(base: str, entity: str, folder: Row) -> str:
    date = "/".join(f"{c}={NULL_PARTITION if folder[c] is None else folder[c]}" for c in DATE)
    return f"{entity_path(base, entity, 'data')}run={folder.run}/target={folder.target}/{date}"


def read_folders(spark: SparkSession, base: str, entity: str, folders: list[Row], schema: StructType) -> DataFrame:
    """Rows of some listed folders; files of others are never opened."""
    if not folders:
        return spark.createDataFrame([], schema)
    paths = [folder_path(base, entity, f) for f in folders]
    read = spark.read.schema(schema).option("basePath", entity_path(base, entity, "data")).parquet(*paths)
    return read.select(*schema.fieldNames())


def read_version(spark: SparkSession, base: str, entity: str, target: str, schema: StructType, held: Row | None) -> DataFrame:
    """A whole table of a version."""
    return read_folders(spark, base, entity, [f for f in held.folders if f.target == target] if held else [], schema)


def stage(df: DataFrame, base: str, entity: str, run: str) -> tuple[list[Row], DataFrame]:
    """Write rows tagged with ``target`` to the run's folder; returns its folders with row counts, and what was written.

    One scan of ``df`` feeds all targets. Nobody reads the folder before it is published, so
    tasks may commit their files straight into it, and no commit moves them one by one
    on the driver. The counts read Parquet footers only.
    """
    keys = ["target", *DATE]
    path = f"{entity_path(base, entity, 'data')}run={run}/"
    writer = df.hint("rebalance", *keys).write.partitionBy(*keys).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    counts = written.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return [Row(target=r.target, year=r.year, month=r.month, day=r.day, run=run, rows=r.rows) for r in counts.collect()], written
