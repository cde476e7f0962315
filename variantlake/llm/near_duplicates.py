"""N-gram Jaccard self-join by a MinHash LSH forest, verified exactly.

Each text becomes its set of five-word shingles. A forest of prefix tries holds the
MinHash signatures; ``prefix_length`` shortens the matched prefix until pairs at the
threshold meet in some trie with the target recall. Texts below one trie node are
candidates; they are gathered into candidate components (stars, never pairs), and each
component is verified in blocks, where exact Jaccard similarities are counted by matrix
products. Only one row per text and block pair leaves a task, so that a group of many
near copies is compared in full without writing its pairs.

Equal shingle sets form one class (hot groups of copies are counted before anything is
shuffled by trie node). Defined results: words are maximal runs of anything but the six
ASCII white spaces, in the case as given; a text of one to four words has one shingle,
all its words; a null, empty or blank text has no shingle, no link and a class of its
own. Repeated rows and rows without an id are copies like any other. An empty table
gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantlake.llm.common import text_batches, words_of, written
from variantlake.llm.components import connected_components, folded

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TREES = 20
LONGEST_PREFIX = 10
RECALL = 0.9999
#: texts of one block of a component; a task compares two blocks
BLOCK = 512
#: entries of a task's memory of word hashes; it starts anew beyond, without effect on results
CACHED_WORDS = 300_000


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, longest: int = LONGEST_PREFIX, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at ``threshold`` shares a trie node with probability ``recall``."""
    depth = longest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    """Sorted distinct 64-bit hashes of a text's shingles."""

    def __init__(self, n: int = SHINGLE_WORDS):
        self.n, self.weights, self.known = n, _odd(7, 2 * n), {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > CACHED_WORDS:
            self.known = {}
        known, hashes = self.known, np.empty(len(words), np.uint64)
        try:
            hashes[:] = [known[w] for w in words]
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            hashes[:] = [known[w] for w in words]
        size = min(self.n, len(words))
        total = np.zeros(len(words) - size + 1, np.uint64)
        for j in range(size):
            total += hashes[j : len(words) - size + 1 + j] * self.weights[j]
        if size < self.n:
            total += self.weights[self.n + size]
        return np.unique(_mix(total))


class Forest:
    """Trie node of a shingle set in each tree, at the given prefix length."""

    def __init__(self, trees: int, depth: int):
        self.trees, self.depth = trees, depth
        self.a = (_odd(11, trees * depth) >> np.uint64(31)).astype(np.uint32) | np.uint32(1)
        self.b = (_odd(13, trees * depth) >> np.uint64(31)).astype(np.uint32)
        self.weights = _odd(17, depth)
        self.tree = _odd(19, trees)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.a), np.iinfo(np.uint32).max, np.uint32)
        for i in range(0, len(x), 4096):
            values = self.a[:, None] * x[None, i : i + 4096]
            values += self.b[:, None]
            np.minimum(least, values.min(axis=1), out=least)
        prefix = least.reshape(self.trees, self.depth).astype(np.uint64)
        return _mix((prefix * self.weights).sum(axis=1, dtype=np.uint64) + self.tree).astype(np.int64)


def _row_key(id: str, text: str):
    return F.xxhash64(F.col(id), F.col(text))


def sketches(docs: DataFrame, id: str, text: str, n: int, trees: int, depth: int) -> DataFrame:
    """For each row: id, row_key, class_key (null without a word) and its trie nodes; no shuffle."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, forest = Shingler(n), Forest(trees, depth)
        for batch in text_batches(batches, "text"):
            keys, nodes = [], []
            for value in batch.column("text").to_pylist():
                shingles = shingle(value)
                if len(shingles):
                    keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                    nodes.append(forest(shingles))
                else:
                    keys.append(None)
                    nodes.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row_key"), pa.array(keys, pa.binary()), pa.array(nodes, pa.list_(pa.int64()))],
                names=["id", "row_key", "class_key", "nodes"],
            )

    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id].dataType),
            T.StructField("row_key", T.LongType()),
            T.StructField("class_key", T.BinaryType()),
            T.StructField("nodes", T.ArrayType(T.LongType())),
        ]
    )
    return docs.select(F.col(id).alias("id"), _row_key(id, text).alias("row_key"), F.col(text).alias("text")).mapInArrow(sketch, schema)


def _verified(threshold: float):
    """Exact similarities of one pair of blocks: (class_key, links, root) for each text."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("class_key").sort_values("class_key", ignore_index=True)
        m = len(frame)
        sizes = np.array([len(s) for s in frame["shingles"]], np.int64)
        _, codes, counts = np.unique(np.concatenate(frame["shingles"].tolist()), return_inverse=True, return_counts=True)
        text = np.repeat(np.arange(m), sizes)
        shared = counts > 1
        column = np.cumsum(shared) - 1
        text, codes = text[shared[codes]], column[codes[shared[codes]]]
        by = np.argsort(codes, kind="stable")
        text, codes = text[by], codes[by]
        both = np.zeros((m, m), np.float32)
        width = 4096
        for start in range(0, int(shared.sum()), width):
            low, high = np.searchsorted(codes, [start, start + width])
            present = np.zeros((m, width), np.float32)
            present[text[low:high], codes[low:high] - start] = 1
            both += present @ present.T
        linked = both / (sizes[:, None] + sizes[None, :] - both.astype(np.float64)) >= threshold
        block = frame["block"].to_numpy()
        if frame["low"].iat[0] != frame["high"].iat[0]:  # pairs within a block are compared in its own task
            linked &= block[:, None] != block[None, :]
        np.fill_diagonal(linked, False)
        links = linked @ frame["copies"].to_numpy()
        root = np.arange(m)
        while True:
            least = np.where(linked, root[None, :], m).min(axis=1, initial=m)
            nearer = np.minimum(root, least)
            nearer = nearer[nearer]
            if (nearer == root).all():
                break
            root = nearer
        keys = frame["class_key"].to_numpy()
        return pd.DataFrame({"class_key": keys, "links": links.astype(np.int64), "root": keys[root]})

    return compare


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    n: int = SHINGLE_WORDS,
    trees: int = TREES,
    recall: float = RECALL,
) -> DataFrame:
    """One row per row of ``docs``: (id, row_key, class_id, n_copies, n_links, keeper).

    ``n_links`` counts the other rows whose shingle sets are ``threshold`` similar or
    more, ``n_copies`` the rows with the same set. ``class_id`` is the least id that
    links connect the row to; ``keeper`` marks the row of that id (each of them, where
    whole rows are repeated; ``row_key`` hashes id and text).
    """
    depth = prefix_length(threshold, trees, recall=recall)
    rows = written(sketches(docs, id, text, n, trees, depth), "sketches")
    ordered = F.struct(F.col("id").isNull().alias("without"), F.col("id").alias("id"), F.col("row_key").alias("row_key"))
    classes = written(
        rows.where("class_key IS NOT NULL")
        .groupBy("class_key")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(ordered).alias("least"), F.first("nodes").alias("nodes")),
        "classes",
    )

    # below each trie node, a star from its least class: candidates without their pairs
    leaves = classes.select("class_key", F.explode("nodes").alias("node"))
    shared = leaves.groupBy("node").agg(F.min("class_key").alias("first"), F.max("class_key").alias("last")).where("first < last")
    stars = leaves.join(shared, "node").where("class_key <> first").select("class_key", "first")
    candidates = written(connected_components(folded(stars, "class_key", "first"), "node", "hub"), "candidates")

    blocks = candidates.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = (
        candidates.join(blocks, "component")
        .join(classes.select(F.col("class_key").alias("node"), "copies", "least.row_key"), "node")
        .select(
            F.col("node").alias("class_key"),
            "component",
            "blocks",
            "copies",
            "row_key",
            F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
        )
    )
    held = docs.select(_row_key(id, text).alias("row_key"), F.col(text).alias("text")).join(members, "row_key")
    held = held.dropDuplicates(["row_key"]).drop("row_key")  # whole rows repeated: one is enough

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        for batch in text_batches(batches, "text"):
            sets = pa.array([shingle(t).view(np.int64) for t in batch.column("text").to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("class_key", "component", "blocks", "copies", "block")), sets],
                names=["class_key", "component", "blocks", "copies", "block", "shingles"],
            )

    sets = held.mapInArrow(
        shingled, "class_key binary, component binary, blocks int, copies bigint, block int, shingles array<bigint>"
    )
    dealt = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "class_key", "component", "copies", "block", "shingles", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    found = written(
        dealt.groupBy("component", "low", "high").applyInPandas(_verified(threshold), "class_key binary, links bigint, root binary"),
        "verified",
    )

    groups = connected_components(folded(found, "class_key", "root"), "node", "hub")
    links = found.groupBy("class_key").agg(F.sum("links").alias("links"))
    known = (
        classes.join(groups.withColumnRenamed("node", "class_key"), "class_key", "left")
        .join(links, "class_key", "left")
        .select(
            "class_key",
            "copies",
            "least",
            F.coalesce("component", "class_key").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    known = written(known, "known")
    first = known.groupBy("component").agg(F.min("least").alias("first"))
    known = known.join(first, "component").select("class_key", F.col("copies").alias("n_copies"), "n_links", "first")
    in_class = (
        rows.where("class_key IS NOT NULL")
        .join(known, "class_key")
        .select(
            "id",
            "row_key",
            F.col("first.id").alias("class_id"),
            "n_copies",
            "n_links",
            (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("row_key") == F.col("first.row_key"))).alias("keeper"),
        )
    )
    alone = rows.where("class_key IS NULL").select(
        "id", "row_key", F.col("id").alias("class_id"), F.lit(1).cast("bigint").alias("n_copies"), F.lit(0).cast("bigint").alias("n_links"), F.lit(True).alias("keeper")
    )
    return in_class.unionByName(alone).withColumnRenamed("id", id)


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay when one row of each group of linked texts is kept.

    Only the keys of rows that go (or are repeated) are written and joined. The join deals
    the texts by row key at every size, so that what it moves grows with the input alone.
    """
    marks = near_duplicates(docs, id, text, **options).groupBy("row_key").agg(F.first("keeper").alias("keeper"), F.count(F.lit(1)).alias("n"))
    marks = written(marks.where("NOT keeper OR n > 1"), "marks").withColumnRenamed("row_key", "__row_key")
    keyed = docs.withColumn("__row_key", _row_key(id, text))
    repeated = marks.where("keeper")
    if not repeated.limit(1).count():
        return keyed.join(marks.hint("merge"), "__row_key", "left_anti").drop("__row_key")
    kept = keyed.join(marks.hint("merge"), "__row_key", "left_anti")
    again = keyed.join(repeated, "__row_key", "left_semi")  # whole rows repeated: one of them stays
    has_word = F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return kept.unionByName(again.where(has_word).dropDuplicates(["__row_key"])).unionByName(again.where(~has_word)).drop("__row_key")
