"""Lake layout and Parquet table I/O.

Layout under one base URI (``s3a://``, ``file://`` or a path):
``bronze/ silver/ quarantine/ gold/ checkpoints/``, one directory per table,
Silver and quarantine partitioned by ``year/month/day``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LAYERS = ("bronze", "silver", "quarantine", "gold", "checkpoints")


def normalise_base(base: str) -> str:
    """Base URI with exactly one trailing slash; a relative local path becomes absolute."""
    if "://" in base:
        return base.rstrip("/") + "/"
    return os.path.abspath(os.path.expanduser(base)).rstrip("/") + "/"


def table_path(base: str, layer: str, table: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
    return f"{normalise_base(base)}{layer}/{table}/"


def scratch_dir(spark: SparkSession, name: str = "") -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    Uses ``spark.checkpoint.dir`` (or the SparkContext checkpoint dir) as set by the
    cluster. Where neither is set, a session in one JVM (``local[...]``) gets a temp
    folder, registered as its checkpoint dir; on a cluster, whose executors could not
    see such a folder, it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:  # classic sessions may have set it on the SparkContext only
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - e.g. Spark Connect has no SparkContext
            base = None
    if not base and not spark.conf.get("spark.master", "").startswith(("local[", "local ")) and spark.conf.get("spark.master", "") != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="variantlake-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(base)
        except Exception:  # noqa: BLE001
            pass
    return f"{base.rstrip('/')}/variantlake/{name or 'run'}-{uuid.uuid4().hex}/"


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet scan with partition discovery.

    With an explicit schema an existing empty table reads as zero rows instead of
    failing schema inference; a missing one is an error. Directories written by a
    streaming file sink are listed through their ``_spark_metadata`` log (only
    committed files are seen).
    """
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def _optimized_away(df: DataFrame) -> bool:
    """Whether the optimizer found the input empty and dropped the observed plan with it."""
    return "CollectMetrics" not in df._jdf.queryExecution().optimizedPlan().toString()


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
    dynamic: bool = True,
    count_rows: bool = False,
    rebalance: bool = True,
) -> int | None:
    """Write ``df`` as Parquet; return its row count when ``count_rows`` is set.

    Partitioned overwrite is *dynamic* by default: only partitions present in ``df``
    are replaced, others are kept (``dynamic=False`` replaces the whole table). The
    row count comes from an ``Observation`` gathered during the write itself, so no
    second pass over the data and no cache is needed.

    A partitioned batch write is preceded by ``REBALANCE(partition columns)``:
    without it every upstream task (e.g. after a shuffle by event id) holds rows of
    every date and writes one small file per date. AQE sizes the rebalance from
    runtime statistics, splitting an oversized (hot) date into several tasks and
    merging small ones, so files come out near the advisory partition size.
    """
    obs = None
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    if count_rows:
        obs = Observation(f"write-{uuid.uuid4().hex[:8]}")
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option(
            "partitionOverwriteMode", "dynamic" if dynamic else "static"
        )
    writer.parquet(path)
    if obs is None:
        return None
    if _optimized_away(df):
        return 0
    return int(obs.get["rows"] or 0)
