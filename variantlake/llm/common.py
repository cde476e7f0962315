"""Helpers shared by the text operators: bounded batches, written tables, documents."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from variantlake.sources.lake import scratch_dir

#: UTF-8 bytes of text that one call of a per-text function sees (one longer text is
#: always seen whole); bounds a Python worker's memory whatever the Arrow batch holds
SLICE_BYTES = 2_000_000

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of anything but the six ASCII white spaces, as UTF-8 (what ``bytes.split`` splits at)."""
    return text.encode().split() if text else []


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, length) of consecutive runs of texts of at most ``limit`` bytes, or of one text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield start, i - start
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield start, len(sizes) - start


def text_udf(fields: StructType, make: Callable[[], Callable[[list], list]]):
    """A struct-valued UDF over a text column, evaluated on Arrow batches.

    ``make`` runs once in each task and returns a function from a list of texts (None
    for null) to a list of columns, one for each of ``fields``.
    """
    arrow = to_arrow_type(fields)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = make()
        for texts in batches:
            parts = []
            for start, n in slices(texts):
                columns = function(texts.slice(start, n).to_pylist())
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
                parts.append(pa.StructArray.from_arrays(arrays, fields=list(arrow)))
            yield pa.concat_arrays(parts) if parts else pa.array([], arrow)

    return F.arrow_udf(run, fields)


def text_batches(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches of ``mapInArrow``, cut so that each holds at most ``limit`` bytes of text."""
    for batch in batches:
        for start, n in slices(batch.column(text), limit):
            yield batch.slice(start, n)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Groups of neighbouring rows that agree in ``keys``, from sorted batches; null equals null.

    Holds one batch and one group at a time.
    """
    held: list[pa.RecordBatch] = []

    def whole() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        starts = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            a, b = batch.column(k)[1:], batch.column(k)[:-1]
            other = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
            starts |= other | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))
        if held and any(held[0].column(k)[0].as_py() != batch.column(k)[0].as_py() for k in keys):
            yield whole()
            held.clear()
        at = [0, *(np.flatnonzero(starts) + 1).tolist(), batch.num_rows]
        for start, end in zip(at[:-1], at[1:], strict=True):
            if start:
                yield whole()
                held.clear()
            held.append(batch.slice(start, end - start))
    if held:
        yield whole()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder, and read again.

    Cuts the lineage: a lost executor costs its running tasks, not this result.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(name: str, taken: list[str]) -> str:
    """A column name like ``name`` that no column has, in any spelling."""
    held = {c.lower() for c in taken}
    while name.lower() in held:
        name = f"_{name}"
    return name


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit("")).cast("string")) % folds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
