"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often.

Every text is encoded by two tokenizers whose tokens spell the same bytes. Places where
tokens of both end cut a text into groups; two tokens whose bytes overlap are linked. The
count of a linked id pair is the number of documents that hold it, over the whole corpus.

Pairs are counted externally, by spilling:

1. a map task encodes a slice of texts (a *batch*), partitions its pair-document records
   by the first tokenizer's id modulo ``BUCKETS`` (the radix), and writes one sorted,
   zstd-compressed run for each bucket;
2. a k-way heap merge of up to ``FAN`` runs of a bucket adds up the documents of each
   pair. Merged runs are merged again, as often as the number of batches asks for, until
   one is left for a bucket: the bucket's dictionary;
3. that order has the first tokenizer's id as its major key, so the highest count of an
   id is known as soon as its last pair is read;
4. dictionary and runs of a bucket go through the same merge order once more, and each
   run's contributions to its documents (links that hold their id's highest count, sum of
   counts) stream back, one small array for each batch and bucket, and are added up.

No pair is ever a row of its own, and records move twice, compressed. A pair that occurs
in a third of all documents is one entry of each run, so no task sees more than its runs.
A dictionary is bounded by the two vocabularies, whatever the corpus; it is copied once
for every ``FAN`` runs.

The first tokenizer is a byte-level BPE in a ``tokenizers`` file (``byte_level``). Words of
the second (a sentencepiece file) are encoded once and remembered, up to ``REMEMBERED``
characters.

Defined results: texts that are null, empty, or that either tokenizer does not spell
back as a space and the text have no tokens, hence zeros and an empty digest. Repeated
rows and rows without an id are documents of their own. An empty table gives no rows.
Only the columns named in ``keep`` are carried.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from variantlake.llm.byte_level import byte_level
from variantlake.llm.common import slices
from variantlake.sources.lake import scratch_dir

BUCKETS = 64
#: runs of a bucket that one group merges, and that share a copy of its dictionary
FAN = 512
#: documents of one batch at most
BATCH_DOCS = 8192
#: characters of words whose pieces a task remembers
REMEMBERED = 16_000_000
SPACE = "▁"

FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
FIGURE_TYPE = T.StructType([*(T.StructField(n, T.LongType()) for n in FIGURES), T.StructField("groups_sha256", T.StringType())])


class ByteLevel:
    """Ids by a byte-level BPE file; strings of special tokens are plain text."""

    def __init__(self, path: str):
        self.encode, spelled = byte_level(path, special=False)
        self.size, self.spelled = len(spelled), pa.array(spelled, pa.binary())

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each) of a space and each text; none for an empty one."""
        found = [self.encode(" " + t) if t else [] for t in texts]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(size.sum())), size


class Pieces:
    """Ids by a sentencepiece file; equal words are encoded once."""

    #: words with the spaces before them, spaces at an end, line ends: no piece reaches across
    WORD = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        byte = [self.model.is_byte(i) for i in range(self.size)]
        if any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p, b in zip(pieces, byte, strict=True) if not b):
            raise ValueError(f"pieces of {path} reach across a word's start or a line's end")
        self.spelled = pa.array(
            [bytes([int(p[3:5], 16)]) if b else p.replace(SPACE, " ").encode() for p, b in zip(pieces, byte, strict=True)], pa.binary()
        )
        self._forget()

    def _forget(self) -> None:
        self.of: dict[str, list[int]] = {}
        self.characters = 0

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each); the library itself adds the space before a text."""
        words = [self.WORD.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = list(set(chain.from_iterable(words)).difference(self.of))
        for at in range(0, len(new), 10_000):  # after a line end, with which no piece merges
            some = new[at : at + 10_000]
            self.of.update(zip(some, (ids[2:] for ids in self.model.encode(["\n" + w for w in some], num_threads=1)), strict=True))
        self.characters += sum(map(len, new))
        of = self.of.__getitem__
        found = [list(chain.from_iterable(map(of, w))) for w in words]
        size = np.fromiter(map(len, found), np.int64, len(found))
        if self.characters > REMEMBERED:
            self._forget()
        return np.fromiter(chain.from_iterable(found), np.int64, int(size.sum())), size


class Aligner:
    """Groups and links of texts, by two tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        marks = [[f"{i}{mark}" for i in range(t.size) for mark in ends] for t, ends in ((self.a, ",|"), (self.b, ",;"))]
        self.marks = pa.array([*marks[0], *marks[1]])

    def __call__(self, texts: list[str | None]) -> tuple[dict[str, list], np.ndarray, np.ndarray, np.ndarray]:
        """(figures, and the a id, b id and text number of each link)."""
        (a, size_a), (b, size_b) = self.a([t or "" for t in texts]), self.b([t or "" for t in texts])
        spelled = [_spelled(t, ids) for t, ids in ((self.a, a), (self.b, b))]
        target = [b" " + t.encode() if t else b"" for t in texts]
        same = np.ones(len(texts), bool)
        for (values, ends), size in zip(spelled, (size_a, size_b), strict=True):
            bounds = np.append(0, ends)[np.append(0, np.cumsum(size))].tolist()
            same &= [values[x:y] == t for x, y, t in zip(bounds[:-1], bounds[1:], target, strict=True)]
        if not same.all():  # only texts that both spell back
            a, b = a[np.repeat(same, size_a)], b[np.repeat(same, size_b)]
            size_a, size_b = size_a * same, size_b * same
            spelled = [_spelled(t, ids) for t, ids in ((self.a, a), (self.b, b))]
        end_a, end_b = spelled[0][1], spelled[1][1]
        last = np.append(0, end_a)[np.cumsum(size_a)]  # where each text ends
        place = np.searchsorted(end_b, end_a)
        shared = end_a[end_b[np.minimum(place, len(end_b) - 1)] == end_a] if len(end_b) else end_a
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        ends = ends[np.append(True, ends[1:] != ends[:-1])] if len(ends) else ends
        of_a, of_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        text = np.searchsorted(last, ends)
        n_groups = np.diff(np.searchsorted(shared, last, "right"), prepend=0)
        n_links = np.diff(np.searchsorted(ends, last, "right"), prepend=0)
        figures = {"n_a": size_a, "n_b": size_b, "n_groups": n_groups, "n_links": n_links}
        figures["groups_sha256"] = self._digests(a, b, end_a, end_b, shared, size_a, size_b, last)
        return figures, a[of_a], b[of_b], text

    def _digests(self, a, b, end_a, end_b, shared, size_a, size_b, last) -> list[str]:
        """Digest of each text's groups, ``a1,a2|b1;a3|b2,b3``, written group by group."""
        group_a, group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
        code = np.empty(len(a) + len(b), np.int64)
        # an a token stands after the b tokens of earlier groups, a b token after the a tokens up to its own
        code[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = 2 * a + np.append(group_a[1:] != group_a[:-1], True)[: len(a)]
        code[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = (
            2 * self.a.size + 2 * b + np.append(group_b[1:] != group_b[:-1], True)[: len(b)]
        )
        made = self.marks.take(pa.array(code))
        offsets = np.frombuffer(made.buffers()[1], np.int32)[: len(made) + 1] if len(made) else np.zeros(1, np.int32)
        values = memoryview(made.buffers()[2] or b"").cast("B")
        bounds = offsets[np.append(0, np.cumsum(size_a + size_b))].tolist()
        # the mark after the last token of a text is not written
        return [hashlib.sha256(values[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(bounds[:-1], bounds[1:], strict=True)]


def _spelled(tokenizer, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """(the bytes that ids spell, where each one's end)."""
    made = tokenizer.spelled.take(pa.array(ids))
    if not len(made):
        return memoryview(b""), np.empty(0, np.int64)
    return memoryview(made.buffers()[2] or b"").cast("B"), np.frombuffer(made.buffers()[1], np.int32)[1 : len(made) + 1].astype(np.int64)


# --- runs ---------------------------------------------------------------------------


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers, each in the narrowest type that holds it, compressed."""
    parts = []
    for x in arrays:
        kind = np.min_scalar_type(int(x.max())) if len(x) else np.dtype(np.uint8)
        parts.append(np.array([len(x), kind.itemsize], "<u8").tobytes() + x.astype(kind).tobytes())
    return zstandard.compress(b"".join(parts), 3)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    held, at, out = zstandard.decompress(blob), 0, []
    while at < len(held):
        n, width = np.frombuffer(held, "<u8", 2, at).tolist()
        out.append(np.frombuffer(held, f"<u{width}", n, at + 16).astype(np.int64))
        at += 16 + n * width
    return out


def _firsts(x: np.ndarray) -> np.ndarray:
    """Where values of a sorted array begin."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.empty(0, np.int64)


def runs_of(a: np.ndarray, b: np.ndarray, text: np.ndarray, size_b: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, pairs, records) of a batch: the sorted pairs with their numbers of documents, and for each
    pair its documents with the number of links."""
    width = int(BATCH_DOCS).bit_length()
    pair = (a // BUCKETS) * size_b + b
    bits = int(pair.max(initial=0)).bit_length() + width
    if bits + BUCKETS.bit_length() > 63:
        raise ValueError("vocabularies too large for one sort key")
    key = np.sort(((a % BUCKETS) << bits) | (pair << width) | text)
    first = _firsts(key)
    links = np.diff(np.append(first, len(key)))
    key = key[first]
    bounds = np.searchsorted(key >> bits, np.arange(BUCKETS + 1)).tolist()
    for bucket, (x, y) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if x == y:
            continue
        pairs = (key[x:y] & ((1 << bits) - 1)) >> width
        at = _firsts(pairs)
        documents = np.diff(np.append(at, y - x))
        yield bucket, _packed(np.diff(pairs[at], prepend=0), documents), _packed(key[x:y] & ((1 << width) - 1), links[x:y])


def merged(runs: list[tuple[np.ndarray, np.ndarray]], size_b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """K-way heap merge of sorted runs (pairs, counts): (pairs, counts) of one first id after another."""

    def by_id(pairs: np.ndarray, counts: np.ndarray, number: int):
        ids = pairs // size_b
        at = _firsts(ids)
        for i, x, y in zip(ids[at].tolist(), at.tolist(), [*at[1:].tolist(), len(ids)], strict=True):
            yield i, number, pairs[x:y], counts[x:y]

    heads = heapq.merge(*(by_id(*run, n) for n, run in enumerate(runs)), key=lambda head: head[:2])
    for _, same in groupby(heads, key=lambda head: head[0]):
        held = list(same)
        if len(held) == 1:
            yield held[0][2], held[0][3]
            continue
        pairs, counts = (np.concatenate([h[k] for h in held]) for k in (2, 3))
        order = np.argsort(pairs, kind="stable")
        pairs = pairs[order]
        at = _firsts(pairs)
        yield pairs[at], np.add.reduceat(counts[order], at)


def _stored(df: DataFrame, name: str, *parts: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.partitionBy(*parts).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _encoded(docs: DataFrame, path_a: str, path_b: str, text: str, keep: list[str]) -> DataFrame:
    """Rows of two kinds: documents with their figures, and the runs of their batches; written once."""
    schema = T.StructType(
        [
            T.StructField("batch", T.LongType()),
            T.StructField("place", T.IntegerType()),
            T.StructField("kept", T.StructType([docs.schema[k] for k in keep])),
            T.StructField("figures", FIGURE_TYPE),
            T.StructField("bucket", T.IntegerType()),
            T.StructField("pairs", T.BinaryType()),
            T.StructField("records", T.BinaryType()),
            T.StructField("kind", T.StringType()),
        ]
    )
    arrow = to_arrow_type(schema)

    def rows(n: int, **columns) -> pa.RecordBatch:
        arrays = [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow]
        return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(list(arrow)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        align, number = Aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        for held in batches:
            for start, n in slices(held.column(text)):
                for at in range(start, start + n, BATCH_DOCS):
                    part = held.slice(at, min(BATCH_DOCS, start + n - at))
                    figures, a, b, of = align(part.column(text).to_pylist())
                    batch = pa.array(np.full(part.num_rows, number))
                    kinds = arrow.field("figures").type
                    yield rows(
                        part.num_rows,
                        batch=batch,
                        place=pa.array(np.arange(part.num_rows)),
                        kept=pa.StructArray.from_arrays([part.column(k) for k in keep], names=keep),
                        figures=pa.StructArray.from_arrays([pa.array(figures[f.name], f.type) for f in kinds], fields=list(kinds)),
                        kind=pa.array(["document"] * part.num_rows),
                    )
                    found = list(runs_of(a, b, of, align.b.size))
                    if found:
                        bucket, pairs, records = zip(*found, strict=True)
                        yield rows(
                            len(found),
                            batch=pa.array([number] * len(found)),
                            bucket=pa.array(bucket),
                            pairs=pa.array(pairs, pa.binary()),
                            records=pa.array(records, pa.binary()),
                            kind=pa.array(["run"] * len(found)),
                        )
                    number += 1

    return _stored(docs.select(text, *(k for k in keep if k != text)).mapInArrow(run, schema), "alignment", "kind")


def _merge(size_b: int, final: bool):
    """A function of one group's runs to its merged run; the last one also says which counts are highest."""

    def merge(group: pa.Table) -> pa.Table:
        read = [_unpacked(blob) for blob in group.column("pairs").to_pylist()]
        parts, flags = [], []
        for pairs, counts in merged([(np.cumsum(p), c) for p, c in read], size_b):
            parts.append((pairs, counts))
            flags.append(counts == counts.max())
        pairs, counts = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        best = _packed(np.concatenate(flags).astype(np.int64)) if final else None
        return pa.table(
            {
                "bucket": group.column("bucket")[:1],
                "slice": group.column("slice")[:1],
                "pairs": pa.array([_packed(np.diff(pairs, prepend=0), counts)], pa.binary()),
                "best": pa.array([best], pa.binary()),
            }
        )

    return merge


def _dictionaries(runs: DataFrame, batches: int, size_b: int, fan: int) -> DataFrame:
    """(bucket, pairs, best): each bucket's pairs with their counts, and whether a count is its first id's highest."""
    columns = "bucket int, slice long, pairs binary, best binary"
    left, level = max(1, -(-batches // fan)), runs.select("bucket", "batch", "pairs")
    held = level.withColumn("slice", F.pmod(F.xxhash64("batch"), F.lit(left))).select("bucket", "slice", "pairs")
    while True:
        final = left == 1
        path = scratch_dir(runs.sparkSession, "llm-pairs")
        held.groupBy("bucket", "slice").applyInArrow(_merge(size_b, final), columns).write.parquet(path)
        level = runs.sparkSession.read.schema(columns).parquet(path)
        if final:
            return level.select("bucket", "pairs", "best")
        left = -(-left // fan)
        held = level.select("bucket", F.pmod(F.col("slice"), F.lit(left)).alias("slice"), "pairs")


def _contributions(runs: DataFrame, dictionaries: DataFrame, batches: int, fan: int) -> DataFrame:
    """(batch, added): for each run, its documents' links with a highest count, and their sums of counts."""
    slices_ = max(1, -(-batches // fan))
    dealt = runs.select("bucket", "batch", "pairs", "records").withColumn("slice", F.pmod(F.xxhash64("batch"), F.lit(slices_)))
    copies = dictionaries.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices_ - 1).cast("long"))))

    def back(mine: pa.Table, known: pa.Table) -> pa.Table:
        if not mine.num_rows:
            return pa.table({"batch": pa.array([], pa.int64()), "added": pa.array([], pa.binary())})
        pairs, counts = _unpacked(known.column("pairs")[0].as_py())
        pairs, (best,) = np.cumsum(pairs), _unpacked(known.column("best")[0].as_py())
        added = []
        for held, records in zip(mine.column("pairs"), mine.column("records"), strict=True):
            mine_pairs, documents = _unpacked(held.as_py())
            text, links = _unpacked(records.as_py())
            at = np.repeat(np.searchsorted(pairs, np.cumsum(mine_pairs)), documents)
            order = np.argsort(text, kind="stable")
            first = _firsts(text[order])
            sums = [np.add.reduceat((links * x[at])[order], first) for x in (best, counts)]
            added.append(_packed(text[order][first], *sums))
        return pa.table({"batch": mine.column("batch"), "added": pa.array(added, pa.binary())})

    grouped = dealt.groupBy("bucket", "slice").cogroup(copies.groupBy("bucket", "slice"))
    return grouped.applyInArrow(back, "batch long, added binary")


def pair_counts(dictionaries: DataFrame, size_b: int) -> DataFrame:
    """(a, b, documents, best) of all linked pairs, from the dictionaries."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, held, best in zip(*(batch.column(c).to_pylist() for c in ("bucket", "pairs", "best")), strict=True):
                pairs, documents = _unpacked(held)
                pairs, flags = np.cumsum(pairs), _unpacked(best)[0].astype(bool)
                for x in range(0, len(pairs), 100_000):
                    p = pairs[x : x + 100_000]
                    arrays = [p // size_b * BUCKETS + bucket, p % size_b, documents[x : x + 100_000], flags[x : x + 100_000]]
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["a", "b", "documents", "best"])

    return dictionaries.mapInArrow(rows, "a long, b long, documents long, best boolean")


def aligned(
    docs: DataFrame, path_a: str, path_b: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), fan: int = FAN
) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): ``keep`` and a struct ``alignment`` for each document, and ``pair_counts`` of the corpus."""
    keep = list(keep)
    size_b = Pieces(path_b).size
    encoded = _encoded(docs, path_a, path_b, text, keep)
    runs, documents = encoded.where("kind = 'run'"), encoded.where("kind = 'document'").select("batch", "place", "kept", "figures")
    batches = documents.where("place = 0").count()
    dictionaries = _dictionaries(runs, batches, size_b, fan)
    back = _contributions(runs, dictionaries, batches, fan)
    whole = T.StructType([T.StructField("kept", documents.schema["kept"].dataType), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    whole.add(T.StructField("figures", FIGURE_TYPE))

    def sums(mine: pa.Table, added: pa.Table) -> pa.Table:
        place = mine.column("place").to_numpy()
        best, counts = np.zeros(BATCH_DOCS, np.int64), np.zeros(BATCH_DOCS, np.int64)
        for blob in added.column("added").to_pylist():
            at, x, y = _unpacked(blob)
            best[at] += x
            counts[at] += y
        return pa.table({"kept": mine.column("kept"), "n_best": best[place], "count_sum": counts[place], "figures": mine.column("figures")})

    met = documents.groupBy("batch").cogroup(back.groupBy("batch")).applyInArrow(sums, whole)
    figures = F.struct(*(F.col(f"figures.{n}").alias(n) for n in FIGURES), "n_best", "count_sum", F.col("figures.groups_sha256").alias("groups_sha256"))
    return met.select("kept.*", figures.alias("alignment")), pair_counts(dictionaries, size_b)
