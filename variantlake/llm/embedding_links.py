"""Near duplicates among embeddings by randomised-rotation binary codes.

Vectors with the same label and a cosine of at least ``THRESHOLD`` (in double precision)
are linked; the result has each vector's number of links and its component.

A unit vector is turned by fixed random rotations and coded by its signs, one bit a
dimension; the correction factor kept with a code is its inner product with the vector
that it codes. With it, the inner product of a code and another (rotated, 8-bit,
dithered) vector is an unbiased estimate of the cosine, whose error at a given cosine
is bounded with high confidence. Only pairs whose bound reaches the threshold are
computed again, exactly.

1. Rows are coded where they are read; exact copies become one class (a 128-bit digest of
   label and vector, which stands for it in every join). No vector moves.
2. Candidate search: bits of the codes form ``tables`` bucket keys, so that a pair at
   the threshold shares one with probability ``RECALL`` or more. Bits grow with the
   logarithm of the largest label, tables follow from them; no bucket is dropped. A
   bucket of more than ``BLOCK`` classes is dealt to blocks and compared block by block.
3. What moves to a bucket is a class's number and its bare signs (some 30 bytes). Signs of
   a pair at the threshold that differ in more places than ``cut`` allows are as rare as
   estimates beyond their bound. A row stays in the first bucket that it shares with
   such a partner.
4. Only rows that stay meet their vectors: they are estimated within the bound, then
   computed exactly. A pair counts in the first bucket that it shares, so each is computed
   and counted once, and no pair leaves its task: a task returns, for each class, its
   number of links and one star link.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, nor does a null label; vectors of different lengths are
never compared. Repeated rows are further vectors. A row without an id takes part, and
is not kept. An empty table gives no rows; further columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantlake.llm.common import grouped, written
from variantlake.llm.components import connected_components
from variantlake.operators.silver import salted_left_join

THRESHOLD = 0.98
#: probability that a pair at the threshold shares a bucket (closer ones more)
RECALL = 0.9999
#: the confidence bound in standard deviations; beyond it lies less than one pair in a million
SIGMAS = 5.0
#: signs of a code that are compared in a bucket
SIGNS = 128
#: classes that are compared at once
BLOCK = 8192
#: classes of one label that share a bucket by chance: each further one is compared in
#: nanoseconds, while each further table moves every class once more
BY_CHANCE = 1024
#: rows and columns of the pairs that are held at once
TILE = 256, 4096
#: classes whose digests (4 bytes each) a task may hold, to read the vectors of these only
WANTED = 4_000_000
SEED = 20_260_101


def sizes(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits of a bucket key, number of tables) for a label of ``n`` classes."""
    bits = min(24, max(6, math.ceil(math.log2(max(n, 1) / BY_CHANCE)))) if n else 6
    alike = 1 - math.acos(threshold) / math.pi
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - alike**bits))


def cut(threshold: float, signs: int = SIGNS) -> int:
    """In how many of its signs a pair at the threshold differs at most, but for what lies beyond ``SIGMAS``."""
    unlike, beyond, k = math.acos(threshold) / math.pi, 0.0, signs
    while k and (beyond := beyond + math.comb(signs, k) * unlike**k * (1 - unlike) ** (signs - k)) <= math.erfc(SIGMAS / math.sqrt(2)) / 2:
        k -= 1
    return k


class Codes:
    """Rotations of one dimension: sign codes, factors, rotated vectors, bucket keys."""

    def __init__(self, dim: int, bits: int, tables: int):
        self.dim, self.bits, self.tables = dim, bits, tables
        #: bits of the stored signs, in whole words
        self.width = -(-max(SIGNS, bits * tables) // 64) * 64
        rng = np.random.default_rng([SEED, dim])
        self.rotations = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-self.width // dim))]
        self.dither = np.random.default_rng([SEED, dim, 1]).random(dim)

    def signs(self, unit: np.ndarray) -> np.ndarray:
        """The signs of each row in all rotations, packed; bucket keys are made of them."""
        turned = np.concatenate([unit @ r.T for r in self.rotations], axis=1)
        return np.packbits(turned[:, : self.width] >= 0, axis=1)

    def estimators(self, unit: np.ndarray) -> tuple[np.ndarray, ...]:
        """(packed code, factor, rotated vector in steps, step) of each row, of the first rotation."""
        first = unit @ self.rotations[0].T
        factor = np.abs(first).sum(1) / math.sqrt(unit.shape[1])
        step = np.abs(first).max(1) / 126
        coded = np.floor(first / step[:, None] + self.dither).astype(np.int8)
        return np.packbits(first >= 0, axis=1), factor, coded, step

    def __call__(self, unit: np.ndarray) -> tuple[np.ndarray, ...]:
        """(packed code, factor, rotated vector in steps, step, bucket keys) of each row."""
        return *self.estimators(unit), bucket_keys(self.signs(unit), self.bits, self.tables).T


def bucket_keys(signs: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The key of each row (along the second axis) in each table, from its packed signs."""
    held = np.unpackbits(signs, axis=1)[:, : bits * tables]
    keys = held.reshape(len(held), -1, bits).astype(np.float32) @ np.exp2(np.arange(bits, dtype=np.float32))
    return np.ascontiguousarray(keys.T.astype(np.int32))


def bound(dim: int, factor: np.ndarray, step: np.ndarray | float, threshold: float) -> np.ndarray:
    """How far below the threshold the estimate of a pair at the threshold may lie."""
    spread = np.sqrt(np.maximum(1 - factor**2, 0) / max(dim - 1, 1) * (1 - threshold**2))
    return SIGMAS * (spread + step / 2) / factor + 1e-6


class Coded:
    """The codes of one group's vectors, a byte and a bit a component; tiles are unpacked where they are compared."""

    def __init__(self, vectors: np.ndarray, codes: Codes):
        self.dim = vectors.shape[1]
        parts = [codes.estimators(_units(x)) for x in np.array_split(vectors, -(-vectors.size // 1_000_000))]
        self.code, self.factor, self.coded, self.step = (np.concatenate(x) for x in zip(*parts, strict=True))

    def near(self, mine: np.ndarray, other: np.ndarray, threshold: float) -> np.ndarray:
        """Whether the pairs mine x other are within the bound, judged by either one's code."""

        def one_way(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            signs = np.unpackbits(self.code[a], axis=1)[:, : self.dim].astype(np.float32) * 2 - 1
            whole = signs @ self.coded[b].astype(np.float32).T  # sums of small whole numbers, exact in any order
            # estimate >= threshold - bound, in which only the step is the other's
            spread = bound(self.dim, self.factor[a], 0.0, threshold)
            least = ((threshold - spread) * self.factor[a])[:, None] - SIGMAS / 2 * self.step[b][None, :]
            return whole >= least * (math.sqrt(self.dim) / self.step[b])[None, :]

        return one_way(mine, other) & one_way(other, mine).T


def _fixed(column: pa.Array) -> np.ndarray:
    """Bytes of a binary column whose values are of one length, a row each."""
    n, wide = len(column), np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], wide)[column.offset :]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[n]].reshape(n, -1)


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a binary column."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _rows(lists: pa.Array, dim: int) -> np.ndarray:
    """Lists of one length as they are, a row each."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dim)


def _units(vector: np.ndarray) -> np.ndarray:
    """Vectors brought to length one, in double precision."""
    vector = vector.astype(np.float64)
    vector /= np.abs(vector).max(1, keepdims=True)
    return vector / np.linalg.norm(vector, axis=1, keepdims=True)


def _tiles(mine: np.ndarray, other: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers to compare, tile by tile: one block against the other, or (same) against itself, less the tiles below the diagonal."""
    for s in range(0, len(mine), TILE[0]):
        for t in range(s if same else 0, len(other), TILE[1]):
            yield mine[s : s + TILE[0]], other[t : t + TILE[1]]


def _sides(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, bool]:
    block = rows.column("block").to_numpy()
    low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
    return np.flatnonzero(block == low), np.flatnonzero(block == high), low == high


def _first_here(pairs: np.ndarray, keys: np.ndarray, band: int, mine: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Of the pairs mine x other that are marked, those whose first shared bucket is one of ``band``."""
    if np.count_nonzero(pairs) * 16 > pairs.size:
        pairs = pairs & (keys[band][mine][:, None] == keys[band][other])
        for b in range(band):
            pairs &= keys[b][mine][:, None] != keys[b][other]
        return pairs
    a, b = np.nonzero(pairs)
    shared = keys[: band + 1, mine[a]] == keys[: band + 1, other[b]]
    first = shared[band] & ~shared[:band].any(0)
    kept = np.zeros_like(pairs)
    kept[a[first], b[first]] = True
    return kept


def partners(signs: np.ndarray, band: int, bits: int, tables: int, most: int, sides: tuple[np.ndarray, np.ndarray, bool]) -> np.ndarray:
    """Whether each row differs from another in ``most`` signs at most, and both meet first in this bucket."""
    words, found, keys = np.ascontiguousarray(signs[:, : SIGNS // 8]).view(np.uint64).T.copy(), np.zeros(len(signs), bool), None
    for mine, other in _tiles(*sides):
        far = np.bitwise_count(words[0][mine][:, None] ^ words[0][other])
        for w in words[1:]:
            far += np.bitwise_count(w[mine][:, None] ^ w[other])
        near = far <= most
        if sides[2]:
            near &= mine[:, None] < other
        if near.any():
            keys = bucket_keys(signs, bits, tables) if keys is None else keys
            near = _first_here(near, keys, band, mine, other)
            found[mine] |= near.any(1)
            found[other] |= near.any(0)
    return found


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row of each row's component, from links a-b."""
    root = np.arange(n)
    while len(a):
        least = root.copy()
        np.minimum.at(least, a, root[b])
        np.minimum.at(least, b, root[a])
        least = least[least]
        if (least == root).all():
            break
        root = least
    return root


def valid(label: Column, vector: Column) -> Column:
    """Whether a vector may have links: a label, some component that is not zero, all of them finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(wide, lambda x: x != 0), F.lit(False))


def with_signs(rows: DataFrame, bits: int, tables: int) -> DataFrame:
    """(vec_id, label, h0, h1, dim, signs) of valid rows (vec_id, label, h0, h1, embedding); no shuffle."""
    kept = ["vec_id", "label", "h0", "h1"]
    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField("dim", T.IntegerType()), T.StructField("signs", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        makers: dict[int, Codes] = {}
        for batch in batches:
            length = batch.column("embedding").value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(length).tolist():
                if dim not in makers:
                    makers[dim] = Codes(dim, bits, tables)
                at = np.flatnonzero(length == dim)
                for part in np.array_split(at, -(-len(at) * dim // 1_000_000)):  # some 8 MB of vectors at once
                    rows = batch if len(part) == batch.num_rows else batch.take(pa.array(part))
                    signs = makers[dim].signs(_units(_rows(rows.column("embedding"), dim)))
                    dims = pa.array(np.full(len(part), dim, np.int32))
                    yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), dims, _binary(signs)], [*kept, "dim", "signs"])

    return rows.select(*kept, "embedding").mapInArrow(run, schema)


def in_buckets(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """(place, band, id, signs) of each class (id, label, dim, signs) in each table, sorted by place; a place is a digest of label, dim, band and key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part").to_numpy().astype(np.uint64)
                for band, key in enumerate(bucket_keys(_fixed(batch.column("signs")), bits, tables)):
                    place = part + (np.uint64((band << 32) + 1) + key.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                        place = (place ^ (place >> np.uint64(shift))) * np.uint64(factor)
                    place = pa.array((place ^ (place >> np.uint64(31))).view(np.int64))
                    bands = pa.array(np.full(batch.num_rows, band, np.int32))
                    yield pa.RecordBatch.from_arrays([place, bands, batch.column("id"), batch.column("signs")], ["place", "band", "id", "signs"])

    dealt = classes.select("id", F.xxhash64("label", "dim").alias("part"), "signs").mapInArrow(run, "place long, band int, id long, signs binary")
    return dealt.repartition("place").sortWithinPartitions("place")


def with_candidates(buckets: DataFrame, bits: int, tables: int, most: int, block: int) -> DataFrame:
    """(place, band, id, signs) of rows with a partner in a bucket, without signs; with them, all rows of a bucket beyond ``block``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # of the last bucket, which may go on
        beyond: tuple[int, int] | None = None  # the bucket that is given back as it comes

        def rows_of(parts: list[list[np.ndarray]], whole: bool) -> Iterator[pa.RecordBatch]:
            if parts:
                place, band, number, signs = (np.concatenate(x) for x in zip(*parts, strict=True))
                code = _binary(signs) if whole else pa.nulls(len(place), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(band), pa.array(number), code], ["place", "band", "id", "signs"])

        def judged(groups: Iterator[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
            found, back = [], []
            for group in groups:
                n = len(group[0])
                if n > block:
                    back.append(group)
                elif n > 1:
                    at = np.arange(n)
                    kept = partners(group[3], int(group[1][0]), bits, tables, most, (at, at, True))
                    if kept.any():
                        found.append([x[kept] for x in group])
            yield from rows_of(found, False)
            yield from rows_of(back, True)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [*(batch.column(c).to_numpy() for c in ("place", "band", "id")), _fixed(batch.column("signs"))]
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)] if held is not None else rows
            place, band = rows[:2]
            ends = [*(np.flatnonzero((place[1:] != place[:-1]) | (band[1:] != band[:-1])) + 1).tolist(), len(place)]
            groups = [[x[a:b] for x in rows] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            if beyond == (place[0], band[0]):
                yield from rows_of(groups[:1], True)
                if len(groups) == 1:
                    continue
                groups = groups[1:]
            beyond, held = None, groups.pop()
            if len(held[0]) > block:
                beyond = int(held[0][0]), int(held[1][0])
                groups, held = [*groups, held], None
            yield from judged(groups)
        if held is not None:
            yield from judged([held])

    return buckets.mapInArrow(run, "place long, band int, id long, signs binary")


BUCKET = ["place", "band"]
PLACE = [*BUCKET, "low", "high"]


def in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """Rows of large buckets, once for each pair of blocks they belong to."""
    counts = rows.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("members"))
    held = salted_left_join(rows, counts, BUCKET, F.col("id"))
    blocks = F.ceil(F.col("members") / block).cast("int")
    mine = F.pmod(F.xxhash64("id"), blocks).cast("int")
    dealt = held.withColumn("block", mine).withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.withColumn("low", F.least("block", "with")).withColumn("high", F.greatest("block", "with")).drop("members", "with")


def _by_place(rows: DataFrame, keys: list[str], function, schema: str) -> DataFrame:
    """``function`` of each group of one place; groups stream through a task one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, keys):
            if group.num_rows > 1:
                yield from function(group)

    return rows.repartition(*PLACE).sortWithinPartitions(*keys).mapInArrow(run, schema)


def with_candidates_of_blocks(rows: DataFrame, bits: int, tables: int, most: int) -> DataFrame:
    """(place, band, low, high, block, id) of rows with a partner in a pair of blocks."""

    def run(group: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        band = group.column("band")[0].as_py()
        kept = partners(_fixed(group.column("signs")), band, bits, tables, most, _sides(group))
        if kept.any():
            yield group.select([*PLACE, "block", "id"]).filter(pa.array(kept))

    return _by_place(rows, PLACE, run, "place long, band int, low int, high int, block int, id long")


def recomputed(rows: DataFrame, threshold: float, bits: int, tables: int) -> DataFrame:
    """(id, links, root): links found in each place, and the least linked row there; nothing for rows without."""
    makers: dict[int, Codes] = {}

    def run(group: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        dim, band = group.column("dim")[0].as_py(), group.column("band")[0].as_py()
        if dim not in makers:
            makers[dim] = Codes(dim, bits, tables)
        vectors, keys = _rows(group.column("embedding"), dim), bucket_keys(_fixed(group.column("signs")), bits, tables)
        codes, copies = Coded(vectors, makers[dim]), group.column("copies").to_numpy()
        links, root = np.zeros(group.num_rows, np.int64), np.arange(group.num_rows)
        sides = _sides(group)
        for mine, other in _tiles(*sides):
            pairs = mine[:, None] < other if sides[2] else np.ones((len(mine), len(other)), bool)
            pairs = _first_here(pairs, keys, band, mine, other)
            if not pairs.any():
                continue
            pairs &= codes.near(mine, other, threshold)
            if np.count_nonzero(pairs) * 16 > pairs.size:
                pairs &= _units(vectors[mine]) @ _units(vectors[other]).T >= threshold
            elif pairs.any():
                a, b = np.nonzero(pairs)
                (x, a_at), (y, b_at) = np.unique(a, return_inverse=True), np.unique(b, return_inverse=True)
                x, y = _units(vectors[mine[x]]), _units(vectors[other[y]])
                for at in range(0, len(a), TILE[1]):
                    some = slice(at, at + TILE[1])
                    pairs[a[some], b[some]] = np.einsum("ij,ij->i", x[a_at[some]], y[b_at[some]]) >= threshold
            counted = pairs.astype(np.float64)  # sums of whole numbers, exact up to 2**53
            links[mine] += (counted @ copies[other]).astype(np.int64)
            links[other] += (copies[mine] @ counted).astype(np.int64)
            a, b = np.nonzero(pairs & (root[mine][:, None] != root[other]))
            if len(a):
                root = _roots(len(root), root[mine[a]], root[other[b]])[root]
        number, at = group.column("id"), np.flatnonzero(links)
        if len(at):
            yield pa.RecordBatch.from_arrays([number.take(pa.array(x)) if x is not None else pa.array(links[at]) for x in (at, None, root[at])], ["id", "links", "root"])

    return _by_place(rows, [*PLACE, "label", "dim"], run, "id long, links long, root long")


def vectors_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` classes (h0, h1, ...; written) with their embedding, from rows (h0, h1, embedding) in which copies repeat."""
    if wanted.count() <= WANTED:
        held = np.unique(wanted.select((F.col("h0").bitwiseAND(0x7FFFFFFF)).cast("int").alias("h")).toArrow().column("h").to_numpy())

        def some(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for h in batches:
                x = (h.to_numpy() & 0x7FFFFFFF).astype(np.int32)
                at = np.searchsorted(held, x)
                yield pa.array(held[np.minimum(at, len(held) - 1)] == x if len(held) else np.zeros(len(x), bool))

        rows = rows.where(F.arrow_udf(some, T.BooleanType())("h0"))
    one = rows.groupBy("h0", "h1").agg(F.first("embedding").alias("embedding"))
    return wanted.join(one, ["h0", "h1"]).drop("h0", "h1")


def linked_classes(classes: DataFrame, rows: DataFrame, bits: int, tables: int, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(id, links, component) of the classes (id, h0, h1, label, dim, copies, signs; written) with a link; component is an id.

    ``rows`` (h0, h1, embedding) has the vectors.
    """
    most = cut(threshold)
    asked = written(with_candidates(in_buckets(classes, bits, tables), bits, tables, most, block), "candidates")
    large = asked.where("signs IS NOT NULL")
    zero = F.lit(0)
    asked = asked.where("signs IS NULL").select(*BUCKET, zero.alias("low"), zero.alias("high"), zero.alias("block"), "id")
    if large.limit(1).count():
        asked = asked.unionByName(written(with_candidates_of_blocks(in_blocks(large, block), bits, tables, most), "candidates"))
    wanted = written(classes.select("id", "h0", "h1", "label", "dim", "copies", "signs").join(asked.select("id").distinct(), "id"), "wanted")
    vectors = written(vectors_of(rows, wanted), "vectors")
    found = written(recomputed(asked.join(vectors, "id"), threshold, bits, tables), "stars")
    # one star link a class, and the hubs that its places name: the same components with far fewer links
    per = written(found.groupBy("id").agg(F.sum("links").alias("links"), F.min("root").alias("hub"), F.collect_set("root").alias("roots")), "linked")
    hubs = per.select(F.explode("roots").alias("id"), "hub").distinct()
    whole = connected_components(per.select("id", "hub").unionByName(hubs), "id", "hub")
    return per.select("id", "links").join(whole.withColumnRenamed("node", "id"), "id")


def embedding_links(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding, label)."""
    label = F.col("label").cast("string")
    row = vectors.select("vec_id", "embedding", label.alias("label"))
    # the number of components tells vectors with nulls, which a digest passes over, from shorter ones
    known = F.col("label").isNotNull() & F.col("embedding").isNotNull()
    digests = [F.when(known, F.xxhash64(F.lit(i), "label", F.size("embedding"), "embedding")).alias(f"h{i}") for i in range(2)]
    row = row.select("vec_id", "label", "embedding", *digests)
    # rows of the largest label, of which there are no fewer than classes
    largest = vectors.select(label.alias("label")).where("label IS NOT NULL").groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = sizes(largest, threshold, recall)
    coded = with_signs(row.where(valid(F.col("label"), F.col("embedding"))), bits, tables)
    per = coded.groupBy("h0", "h1").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"), *(F.first(c).alias(c) for c in ("label", "dim", "signs"))
    )
    classes = written(per.withColumn("id", F.monotonically_increasing_id()), "classes")
    linked = linked_classes(classes, row.select("h0", "h1", "embedding").where("h0 IS NOT NULL"), bits, tables, threshold, block)
    # all others have no links and their own id for a component
    found = classes.select("id", "h0", "h1", "copies", "least").join(linked, "id", "left").where("copies > 1 OR links IS NOT NULL")
    found = written(found.withColumn("component", F.coalesce("component", "id")), "known")
    least = found.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = salted_left_join(found, least, ["component"], F.col("id")).select(
        "h0", "h1", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    rows = salted_left_join(row.select("vec_id", "h0", "h1"), of_class, ["h0", "h1"], F.monotonically_increasing_id())
    component = F.coalesce("component_id", "vec_id")
    return rows.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
