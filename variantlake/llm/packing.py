"""Best-fit packing of tokenized documents into sequences of fixed capacity.

``token_pieces`` tokenizes whole texts and cuts only those longer than a sequence.
``pack`` deals the narrow piece rows into blocks of about ``BLOCK_PIECES`` by a hash of
their place (never of a key, so no block is hot) and packs each block by linear
grouping: large lengths are rounded up within groups of equal cardinality, the few
sizes left are combined into configurations of least slack (a subset-sum over bit sets,
used as often as the groups allow), actual documents take the places, and the small
ones go best-fit into what is free. A block wastes at most a few sequences, so the
total stays within some hundredths of a percent of one that packs all at once.

Defined results: a null or empty text is one piece that holds the end id alone; rows
without an id and repeated rows are packed like any other; ties in length are taken in
the order dealt; an empty table gives no rows. Further columns pass through ``pack``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantlake.llm.byte_level import byte_level
from variantlake.llm.common import free_name, text_batches, written

CAPACITY = 2048
END_ID = 0
BLOCK_PIECES = 32_768
#: lengths above this share of the capacity are grouped; the others are best-fitted
SMALL_SHARE = 1 / 8
GROUPS = 4096


class Encoder:
    """Ids of whole texts; strings of special tokens get their ids, as the file's library has it."""

    def __init__(self, tokenizer_path: str):
        self.encode, _ = byte_level(tokenizer_path, special=True)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self.encode(t), np.uint32) for t in texts]


def token_pieces(docs: DataFrame, tokenizer_path: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(id, piece, start, length, ids) for each piece; ids are unsigned little-endian 32-bit.

    Pieces of a long text hold ``capacity`` ids each but the first, which takes the rest.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer_path)
        end = np.array([end_id], np.uint32)
        for batch in text_batches(batches, "text"):
            texts = batch.column("text").to_pylist()
            row, piece, start, length, held = [], [], [], [], []
            for i, ids in enumerate(encode([t or "" for t in texts])):
                ids = np.concatenate([ids, end])
                first = len(ids) - capacity * (-(-len(ids) // capacity) - 1)
                at = 0
                for number, to in enumerate(range(first, len(ids) + 1, capacity)):
                    row.append(i)
                    piece.append(number)
                    start.append(at)
                    length.append(to - at)
                    held.append(ids[at:to].astype("<u4").tobytes())
                    at = to
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(held, pa.binary())],
                names=["id", "piece", "start", "length", "ids"],
            )

    schema = T.StructType(
        [
            T.StructField(id, docs.schema[id].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    return docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(cut, schema)


def configuration(sizes: list[int], left: list[int], capacity: int) -> dict[int, int]:
    """How often to take each size so that the largest one left is used and least room stays free.

    ``sizes`` falls; ``left`` says how many documents each size still has.
    """
    first = next(i for i, n in enumerate(left) if n)
    room = capacity - sizes[first]
    mask, reached, steps = (1 << (room + 1)) - 1, 1, []
    for i in range(first, len(sizes)):
        for _ in range(min(left[i] - (i == first), room // sizes[i])):
            steps.append((i, reached))
            reached |= (reached << sizes[i]) & mask
        if reached >> room & 1:
            break
    best, taken = reached.bit_length() - 1, defaultdict(int, {first: 1})
    for i, before in reversed(steps):
        if not before >> best & 1:
            taken[i] += 1
            best -= sizes[i]
    return dict(taken)


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each document of one block."""
    if len(lengths) and int(lengths.max()) > capacity:
        raise ValueError("a document is longer than a sequence")
    number, offset = np.full(len(lengths), -1, np.int64), np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    large = order[lengths[order] > capacity * SMALL_SHARE]
    per_group = max(1, len(large) // GROUPS)
    members: dict[int, list[int]] = {}
    for at in range(0, len(large), per_group):  # rounded up to the group's longest
        members.setdefault(int(lengths[large[at]]), []).extend(large[at : at + per_group].tolist())
    sizes = list(members)
    queues = [members[s][::-1] for s in sizes]
    left = [len(q) for q in queues]
    filled: list[int] = []
    while any(left):
        taken = configuration(sizes, left, capacity)
        for _ in range(min(left[i] // n for i, n in taken.items())):
            used = 0
            for i, n in taken.items():
                left[i] -= n
                for _ in range(n):
                    doc = queues[i].pop()
                    number[doc], offset[doc] = len(filled), used
                    used += int(lengths[doc])
            filled.append(used)
    free: dict[int, list[int]] = defaultdict(list)
    rooms = 0
    for sequence, used in enumerate(filled):
        free[capacity - used].append(sequence)
        rooms |= 1 << (capacity - used)
    for doc in order[len(large) :].tolist():  # best fit: the least room that is enough
        need = int(lengths[doc])
        enough = rooms >> need
        if enough:
            room = need + (enough & -enough).bit_length() - 1
            sequence = free[room].pop()
            if not free[room]:
                rooms ^= 1 << room
        else:
            room, sequence = capacity, len(filled)
            filled.append(0)
        number[doc], offset[doc] = sequence, filled[sequence]
        filled[sequence] += need
        free[room - need].append(sequence)
        rooms |= 1 << (room - need)
    return number, offset


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; sequences are gapless from offset 0.

    Existing columns of these two names are replaced; all others pass through.
    """
    pieces = written(pieces.drop("sequence_id", "offset"), "pieces")
    blocks = max(1, -(-pieces.count() // block_pieces))
    helper = free_name("block", pieces.columns)
    dealt = pieces.withColumn(helper, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))

    def of_block(block: pa.Table) -> pa.Table:
        number, offset = pack_lengths(block.column(length).to_numpy().astype(np.int64), capacity)
        first = block.column(helper)[0].as_py() << 32
        out = block.drop_columns([helper])
        return out.append_column("sequence_id", pa.array(number + first, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return dealt.groupBy(helper).applyInArrow(of_block, schema)


def packed_sequences(docs: DataFrame, tokenizer_path: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The sequences themselves: (sequence_id, length, ids as unsigned little-endian 32-bit)."""
    pieces = written(token_pieces(docs, tokenizer_path, id, text, capacity).withColumn("piece_id", F.monotonically_increasing_id()), "token-pieces")
    placed = pack(pieces.select("piece_id", "length"), capacity=capacity)
    rows = placed.join(pieces.select("piece_id", "ids"), "piece_id")
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return rows.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select(
        "sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda held, part: F.concat(held, part["ids"])).alias("ids")
    )
