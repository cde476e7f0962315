"""Engine-neutral projection of a result, used by the registered queries.

Query-time stamps are dropped, event-time timestamps become
``yyyy-MM-dd HH:mm:ss`` text (parsed and printed in the same session zone, so the
text is zone-independent), the Kafka ingestion time becomes epoch seconds and
struct columns are flattened to ``<struct>_<field>`` and the year/month/day
partition values are compared as text. All of it is narrow (projection only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

VOLATILE = ("processing_timestamp", "metric_generated_at", "checked_at")
EPOCH_COLUMNS = ("kafka_ingestion_timestamp",)
# partition values, NULL for rows without an event time, compared as text (a
# NULL-able integer column is typed differently by the engines' pandas conversions)
TEXT_COLUMNS = ("year", "month", "day")


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in VOLATILE:
            continue
        if isinstance(f.dataType, TimestampType):
            if f.name in EPOCH_COLUMNS:
                cols.append(F.unix_timestamp(F.col(f.name)).alias(f.name))
            else:
                cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name))
        elif f.name in TEXT_COLUMNS:
            cols.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(f.dataType, StructType):
            cols.extend(F.col(f"{f.name}.{s.name}").alias(f"{f.name}_{s.name}") for s in f.dataType.fields)
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
