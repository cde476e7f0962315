"""Golden rows for the Bronze ingest steps (decode, JSON parse, event time)."""

import math

from pyspark.sql import Row
from pyspark.sql import functions as F

from variantlake.operators import silver
from variantlake.sources import kafka as K
from variantlake.sources.schemas import BEHAVIOR_JSON_SCHEMA, ENVELOPE_SCHEMA, EXPOSURE_JSON_SCHEMA


def _envelopes(spark, values):
    rows = [
        (None if v is None else bytearray(v.encode()), "t", 0, i, None)
        for i, v in enumerate(values)
    ]
    df = spark.createDataFrame(rows, "value binary, topic string, partition int, offset long, timestamp timestamp")
    return df.select(F.lit(None).cast("binary").alias("key"), *df.columns).select(*ENVELOPE_SCHEMA.fieldNames())


def test_decode_envelope_casts_key_and_value(spark):
    df = spark.createDataFrame(
        [(bytearray(b"u1"), bytearray(b'{"a":1}'), "experiment_exposures", 2, 7, None)], ENVELOPE_SCHEMA
    )
    row = K.decode_envelope(df).first()
    assert row.kafka_key == "u1" and row.kafka_value == '{"a":1}'
    assert (row.topic, row.partition, row.offset) == ("experiment_exposures", 2, 7)


def test_unparseable_values_give_all_null_fields(spark):
    parsed = K.parse_json(K.decode_envelope(_envelopes(spark, ["not json", "[]", "null", "", None])), EXPOSURE_JSON_SCHEMA)
    rows = parsed.collect()
    assert len(rows) == 5
    for r in rows:
        assert all(r[c] is None for c in EXPOSURE_JSON_SCHEMA.fieldNames())


def test_unknown_field_ignored_and_number_into_string(spark):
    parsed = K.parse_json(
        K.decode_envelope(_envelopes(spark, ['{"event_id":"a","extra":1}', '{"event_id":5}'])), EXPOSURE_JSON_SCHEMA
    )
    assert sorted(r.event_id for r in parsed.collect()) == ["5", "a"]
    assert "extra" not in parsed.columns


def test_wrong_typed_leaf_and_non_object_properties(spark):
    values = ['{"properties":{"revenue_gbp":"12.5","page":"/x"}}', '{"properties":"str"}']
    parsed = K.parse_json(K.decode_envelope(_envelopes(spark, values)), BEHAVIOR_JSON_SCHEMA)
    flat = silver.flatten_behavior(K.add_event_time(parsed)).orderBy("offset").collect()
    assert flat[0].revenue_gbp is None and flat[0].page_url == "/x"
    assert flat[1].page_url is None and flat[1].is_bot is False


def test_json_nan_revenue_passes_the_rule(spark):
    values = ['{"event_id":"e","experiment_id":"x","user_id":"u","event_name":"purchase",'
              '"event_time":"2026-01-01 00:00:00","properties":{"revenue_gbp":NaN}}']
    bronze = K.add_event_time(K.parse_json(K.decode_envelope(_envelopes(spark, values)), BEHAVIOR_JSON_SCHEMA))
    flat = silver.flatten_behavior(bronze)
    row = silver.valid_behavior(flat).first()
    assert row is not None and math.isnan(row.revenue_gbp)


def test_event_time_parts_bad_time_and_zone_offset(spark):
    df = spark.createDataFrame(
        [Row(event_time="garbage"), Row(event_time="2026-05-09T10:11:12.123456+02:00"), Row(event_time=None)]
    )
    rows = K.add_event_time(df).select(
        "event_time", F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "year", "month", "day"
    ).collect()
    got = {r.event_time: r for r in rows}
    assert got["garbage"].ts is None and got["garbage"].year is None
    assert got["2026-05-09T10:11:12.123456+02:00"].ts == "2026-05-09 08:11:12.123456"
    assert (got["2026-05-09T10:11:12.123456+02:00"].year, got["2026-05-09T10:11:12.123456+02:00"].day) == (2026, 9)
    assert got[None].ts is None


def test_reparse_recovers_fields_missing_from_an_old_bronze_schema(spark):
    from tests.conftest import SF_SMALL
    from variantlake.sources import fixtures

    old = fixtures.bronze_behavior(spark, SF_SMALL).withColumn(
        "properties", F.col("properties").dropFields("refund_gbp")
    )
    assert silver.silver_behavior(old)[0].filter(F.col("event_name") == "refund").count() == 0
    recovered = K.reparse_bronze(old, BEHAVIOR_JSON_SCHEMA)
    clean = silver.silver_behavior(recovered)[0]
    assert clean.filter(F.col("event_name") == "refund").count() > 0
    assert clean.count() == silver.silver_behavior(fixtures.bronze_behavior(spark, SF_SMALL))[0].count()
