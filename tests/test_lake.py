"""Lake layout (A13) and reads of stream-written tables (A8)."""

import os

import pytest

from tests.conftest import SF_SMALL
from variantlake.plans.queries import stage_topic
from variantlake.sources import fixtures
from variantlake.sources.lake import normalise_base, read_table, table_path
from variantlake.sources.schemas import BRONZE_EXPOSURES_SCHEMA, ENVELOPE_SCHEMA
from variantlake.streaming.bronze import exposures_stream


def test_layout_and_base_normalisation(tmp_path, monkeypatch):
    assert table_path("s3a://bucket/lake", "silver", "exposures") == "s3a://bucket/lake/silver/exposures/"
    assert table_path("s3a://bucket/lake/", "gold", "experiment_metrics") == "s3a://bucket/lake/gold/experiment_metrics/"
    assert table_path("file:///data/lake", "checkpoints", "bronze/behavior") == "file:///data/lake/checkpoints/bronze/behavior/"
    monkeypatch.chdir(tmp_path)
    assert normalise_base("lake") == str(tmp_path / "lake") + "/"
    with pytest.raises(ValueError):
        table_path("/x", "platinum", "t")


def test_batch_read_of_a_stream_table_sees_only_committed_files(spark, tmp_path):
    root = str(tmp_path)
    stage_topic(fixtures.exposure_envelopes(spark, SF_SMALL), f"{root}/topic")
    q = exposures_stream(
        spark, f"{root}/lake", source=spark.readStream.schema(ENVELOPE_SCHEMA).parquet(f"{root}/topic"),
        trigger="availableNow",
    )
    q.awaitTermination()
    path = table_path(f"{root}/lake", "bronze", "exposures")
    assert os.path.isdir(os.path.join(path, "_spark_metadata"))
    before = read_table(spark, path, BRONZE_EXPOSURES_SCHEMA).count()
    # a file that no micro-batch committed (e.g. left by a failed attempt) is not listed
    stray = read_table(spark, path, BRONZE_EXPOSURES_SCHEMA).limit(5)
    stray.write.mode("overwrite").parquet(os.path.join(root, "stray"))
    part = next(f for f in os.listdir(os.path.join(root, "stray")) if f.endswith(".parquet"))
    target = os.path.join(path, "year=1995", "month=1", "day=1")
    os.makedirs(target, exist_ok=True)
    with open(os.path.join(root, "stray", part), "rb") as src, open(os.path.join(target, "uncommitted.parquet"), "wb") as dst:
        dst.write(src.read())
    assert read_table(spark, path, BRONZE_EXPOSURES_SCHEMA).count() == before == 183
