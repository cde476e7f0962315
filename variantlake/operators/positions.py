"""Order-preserving codes of ingestion positions, so that first rows are found without a sort.

A position is (ingestion time, topic, partition, offset). As a struct with a string in it,
``min`` is planned as a sort aggregate over every row. ``position_code`` packs it into
one ``decimal(38,0)`` of the same order: such a value lives in a mutable aggregation
buffer, so ``min`` and ``count`` per event id are one hash aggregate that combines
map-side, with one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POSITION = ("kafka_ingestion_timestamp", "topic", "partition", "offset")
#: digits of each part: microseconds (1970 to 5138), topic, partition, offset; 0 stands for NULL, which comes first
DIGITS = {"kafka_ingestion_timestamp": 17, "topic": 2, "partition": 5, "offset": 14}
CODE = "decimal(38,0)"


def ranked(topics: set[str]) -> list[str]:
    """Topics in ascending order, as ``position_code`` takes them."""
    if len(topics) > 98:
        raise ValueError(f"{len(topics)} topics in one table; a position code holds 98")
    return sorted(topics)


def topics_of(df: DataFrame) -> list[str]:
    """The topics of a Bronze table (one aggregate over one dictionary-coded column)."""
    return ranked(set(df.agg(F.collect_set("topic")).first()[0]))


def _parts(topics: list[str]) -> dict[str, Column]:
    names = F.array(*(F.lit(t) for t in topics)) if topics else F.array(F.lit(""))
    return {
        "kafka_ingestion_timestamp": F.unix_micros("kafka_ingestion_timestamp"),
        "topic": F.array_position(names, F.col("topic")) - 1,  # -1 for a topic that is not among them
        "partition": F.col("partition").cast("long"),
        "offset": F.col("offset").cast("long"),
    }


def position_code(topics: list[str]) -> Column:
    """The position of a row as one number of the same order; a part beyond its digits is an error, never a wrong order."""
    code = None
    for name, part in _parts(topics).items():
        low, high = F.lit(0).cast("long"), F.lit(10 ** DIGITS[name] - 2).cast("long")
        bad = F.raise_error(F.concat(F.lit(f"{name} does not fit a position code: "), part.cast("string"))).cast("long")
        digits = F.when(part.isNull(), F.lit(0).cast("long")).when(part.between(low, high), part + 1).otherwise(bad).cast(CODE)
        code = digits if code is None else (code * F.lit(10 ** DIGITS[name]).cast("decimal(15,0)")).cast(CODE) + digits
    return code.cast(CODE)


def position_of(code: Column, topics: list[str]) -> Column:
    """The position struct that ``position_code`` packed."""
    parts, rest = {}, code
    for name in reversed(POSITION):
        base = F.lit(10 ** DIGITS[name]).cast(CODE)
        last = (rest % base).cast("long") if name != POSITION[0] else rest.cast("long")
        parts[name] = F.when(last > 0, last - 1)
        rest = ((rest - rest % base) / base).cast(CODE) if name != POSITION[0] else rest
    names = F.array(*(F.lit(t) for t in topics)) if topics else F.array(F.lit(""))
    return F.struct(
        F.timestamp_micros(parts["kafka_ingestion_timestamp"]).alias(POSITION[0]),
        F.get(names, parts["topic"].cast("int")).alias("topic"),
        parts["partition"].cast("int").alias("partition"),
        parts["offset"].alias("offset"),
    )


def first_positions(df: DataFrame, topics: list[str], key: str = "event_id") -> DataFrame:
    """(key, rows, at): how often each key occurs, and the code of its first position; one hash aggregate."""
    return df.select(key, position_code(topics).alias("_code")).groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.min("_code").alias("at"))
