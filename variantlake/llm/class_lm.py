"""Language model scoring with Brown classes found by exchange clustering.

``learn`` counts all words of the training texts and gives every word that occurs ``LEAST``
times or more, a fixed count, a class by exchange: a word moves to the class that raises
the class-bigram likelihood most. The ``CLUSTERED`` most frequent words
are exchanged one by one among themselves for a start; the others then join them, and all words
are exchanged in rounds. Rarer words and unknown ones form one class, whatever the size of
the corpus. A word's probability given the word before is

    (c + a) * (w * P(class | class before) / (C + a * Vc) + (1 - w) / (N + a * (V + 1)))

with c its count, C and Vc its class's words and distinct words, N and V those of the
corpus, and a = 0.1; an unknown word counts as one more word of the class of rare words.
The bracket depends on classes only, so that words with a class are scored in the map
task, and only counts of rarer words are joined.

Rounds run over a written table of each word's neighbours with their counts, dealt by word
(and by neighbour for the most frequent ones), so that a round is one scan without a
shuffle of pairs. In a round each task goes through its words, by falling frequency (half of
all, others in each round): those of
``STEP`` words whose exact gain is above 0 move together to the class of the best first-order
gain, and the task goes on with labels and class-pair counts that know of its own moves. The
driver moves the most frequent words in the same way, and all moves are joined. The next scan counts
the class pairs of the joined labels exactly. If they are less likely than the best ones so
far, the round is taken back and half as many words may move. Rounds end, as those of the start
do, when one lowers the training perplexity by less than ``TOLERANCE`` of it.

Defined results: words are maximal runs of anything but the six ASCII white spaces,
with A-Z in lower case; each text ends with one end token (a null or empty text has it
alone); a text begins in the class of the end. With no training text every word is
unknown. Rows without an id and repeated rows are scored each. Words with a class are
told apart by a 64-bit hash. Bounds: 20 bytes for each word that occurs ``LEAST`` times or
more reach the driver and the tasks; their strings do not.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantlake.llm.common import text_batches, written

ADD = 0.1
#: words that occur so often or more are clustered
LEAST = 5
#: words whose codes a task remembers; it starts anew beyond, without effect on results
FREQUENT = 300_000
#: most frequent words, exchanged one by one before the others join them
CLUSTERED = 1000
#: rounds end when one lowers the perplexity by less than this share of it
TOLERANCE = 0.001
#: words that a task moves at once
STEP = 512
#: share of the words that may move in a round, after that in which all others join; and the
#: least one, after rounds that were taken back
FIRST_SHARE = 0.5
LEAST_SHARE = 0.125
CLASSES = 48
WEIGHT = 0.8
END = ""
#: tokens whose pairs make up one block of the written neighbours, and pairs a task holds
BLOCK_TOKENS = 2_000_000
HELD_PAIRS = 1_000_000
#: most frequent words whose counts make up one row of a scan's result
HOT_ROWS = 64
CACHED_WORDS = 200_000


def lowered(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case (of bytes, no others change)."""
    return text.encode().lower().split() if text else []


def _counted(docs: DataFrame, text: str) -> DataFrame:
    """(word, n) of all texts, the end token as the empty word; summed per task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            words = [w.decode() for w in held]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in text_batches(batches, "text"):
            for value in batch.column("text").to_pylist():
                held[b""] += 1
                held.update(lowered(value))
            if len(held) > CACHED_WORDS:
                yield flushed()
                held.clear()
        yield flushed()

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def _entropy(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def _least_gain(counts: np.ndarray) -> float:
    """Gains below are rounding errors."""
    total = counts.sum()
    return max(1e-9, 1e-13 * float(_entropy(total)))


def _likelihood(table: np.ndarray) -> float:
    """Log-likelihood of class pairs, up to a constant."""
    return float(_entropy(table).sum() - _entropy(table.sum(axis=0)).sum() - _entropy(table.sum(axis=1)).sum())


def exchange(pairs: np.ndarray, movable: int, classes: int, tolerance: float = 0.0) -> np.ndarray:
    """Class of each symbol: the first ``movable`` (by falling frequency) are clustered, the others keep one each.

    ``pairs[a, b]`` counts symbol b after symbol a. Each step takes a symbol out of its
    class and puts it where the class-bigram likelihood is highest; rounds end when no
    symbol moves, or one raises the log-likelihood of a pair by less than ``tolerance``.
    """
    symbols = len(pairs)
    classes = min(classes, movable)
    total = classes + symbols - movable
    label = np.concatenate([np.arange(movable) % max(1, classes), np.arange(classes, total)]).astype(np.int64)
    pairs = pairs.astype(np.float64)
    to_class = np.zeros((symbols, total))  # pairs of a symbol and a class after it
    from_class = np.zeros((symbols, total))  # of a class before it and the symbol
    for c in range(total):
        to_class[:, c] = pairs[:, label == c].sum(axis=1)
        from_class[:, c] = pairs[label == c].sum(axis=0)
    counts = np.zeros((total, total))
    np.add.at(counts, label, to_class)

    before, least = _likelihood(counts), tolerance * counts.sum()
    while _exchange(pairs, movable, classes, label, to_class, from_class, counts):
        after = _likelihood(counts)
        if after - before < least:
            break
        before = after
    return label


def _exchange(pairs: np.ndarray, movable: int, classes: int, label: np.ndarray, to_class: np.ndarray, from_class: np.ndarray, counts: np.ndarray) -> bool:
    """One round of exchange in place, from the given labels; whether any symbol moved."""
    least, moved = _least_gain(counts), False
    for w in range(movable):
        old, own = label[w], pairs[w, w]
        right, left = to_class[w].copy(), from_class[w].copy()
        right[old] -= own
        left[old] -= own
        counts[old] -= right
        counts[:, old] -= left
        counts[old, old] -= own
        row, column = counts.sum(axis=1), counts.sum(axis=0)
        c = np.arange(classes)
        both = left + right + own
        diagonal = counts[c, c]
        gain = (_entropy(counts[:classes] + right) - _entropy(counts[:classes])).sum(axis=1)
        gain -= _entropy(diagonal + right[:classes]) - _entropy(diagonal)
        gain += (_entropy(counts[:, :classes] + left[:, None]) - _entropy(counts[:, :classes])).sum(axis=0)
        gain -= _entropy(diagonal + left[:classes]) - _entropy(diagonal)
        gain += _entropy(diagonal + both[:classes]) - _entropy(diagonal)
        after, before = right.sum() + own, left.sum() + own
        gain -= _entropy(row[:classes] + after) - _entropy(row[:classes]) + _entropy(column[:classes] + before) - _entropy(column[:classes])
        new = int(gain.argmax())
        if gain[new] <= gain[old] + least:
            new = old
        counts[new] += right
        counts[:, new] += left
        counts[new, new] += own
        if new != old:
            moved = True
            label[w] = new
            to_class[:, old] -= pairs[:, w]
            to_class[:, new] += pairs[:, w]
            from_class[:, old] -= pairs[w]
            from_class[:, new] += pairs[w]
    return moved


class Coder:
    """Codes of words: by falling count, then the code of all others and that of the end."""

    def __init__(self, hashes: np.ndarray, codes: np.ndarray, limit: int):
        self.hashes, self.codes, self.limit = hashes, codes, limit
        self.end = {b"": len(hashes) + 1}
        self.known = dict(self.end)

    def __call__(self, texts: list) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """The codes of all tokens (the end after each text), these tokens, and how many each text has."""
        flat: list[bytes] = []
        ends = []
        for text in texts:
            flat += lowered(text)
            flat.append(b"")
            ends.append(len(flat))
        if len(self.known) > self.limit:
            self.known = dict(self.end)
        try:
            codes = list(map(self.known.__getitem__, flat))
        except KeyError:
            new = list(set(flat) - self.known.keys())
            self.known.update(zip(new, self._looked_up(new).tolist(), strict=True))
            codes = list(map(self.known.__getitem__, flat))
        return np.array(codes, np.int64), flat, np.diff(np.array([0, *ends], np.int64))

    def _looked_up(self, words: list[bytes]) -> np.ndarray:
        rest = len(self.hashes)
        if not rest:
            return np.full(len(words), rest)
        hashed = np.array([xxhash.xxh64_intdigest(w, 42) for w in words], np.uint64).view(np.int64)  # as Spark's xxhash64
        at = np.minimum(np.searchsorted(self.hashes, hashed), rest - 1)
        return np.where(self.hashes[at] == hashed, self.codes[at], rest)


@dataclass
class ClassModel:
    """Codes and counts of words with a class, classes of codes, and log10 of the bracket by class pair.

    ``hashes`` are sorted, ``codes`` theirs; after the words, ``counts`` and ``symbol`` hold
    the rare words (count 0 here, joined instead) and the end. ``between`` counts class pairs
    in the training texts, ``likelihoods`` has their log-likelihood before each round.
    """

    hashes: np.ndarray
    codes: np.ndarray
    counts: np.ndarray
    symbol: np.ndarray
    label: np.ndarray
    log_bracket: np.ndarray
    vocabulary: DataFrame
    tokens: int
    distinct: int
    least: int
    frequent: int
    between: np.ndarray
    likelihoods: list[float]

    @property
    def words(self) -> dict[bytes, int]:
        """Codes of all words with a class and of the end (brings their strings to the driver: for inspection)."""
        rows = self.vocabulary.where((F.col("word") != END) & (F.col("n") >= self.least)).select("word").collect()
        words = [r["word"].encode() for r in rows]
        coder = Coder(self.hashes, self.codes, self.frequent)
        return {**dict(zip(words, coder._looked_up(words).tolist(), strict=True)), **coder.end}


def _packed(*arrays: np.ndarray) -> bytes:
    return pa.compress(np.concatenate([a.astype(np.int32) for a in arrays]).tobytes(), codec="zstd", asbytes=True)


def _unpacked(size: int, blob: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, size * 12, codec="zstd", asbytes=True), np.int32).reshape(3, size)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their sums."""
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(_new(keys))
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _new(values: np.ndarray) -> np.ndarray:
    """Where neighbouring values differ, the first one included."""
    return np.concatenate((np.ones(min(1, len(values)), bool), values[1:] != values[:-1]))


def _counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(_new(keys))
    return keys[first], np.diff(np.concatenate((first, [len(keys)])))


def _neighbours(training: DataFrame, text: str, coded, frequent: int, hot: int, blocks: int) -> DataFrame:
    """(size, pairs): a block's (owner, neighbour, count) in order, packed; after the owner, and with its code raised, before it.

    All pairs of a word are in one block, but those of the ``hot`` most frequent words, of
    rare words and of the end are dealt by neighbour.
    """
    words = len(coded.value[0])
    size, rest = words + 2, words

    def dealt(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = (keys // size).astype(np.int32), (keys % size).astype(np.int32)
        back = b < rest
        owner, other = np.concatenate((a, b[back] + np.int32(size))), np.concatenate((b, a[back]))
        n = np.concatenate((n, n[back])).astype(np.int32)
        mixed = np.concatenate((a, b[back])).astype(np.uint32)
        spread = (mixed < hot) | (mixed >= rest)
        mixed[spread] += other[spread].astype(np.uint32) * np.uint32(7919)
        mixed += np.uint32(1)
        mixed *= np.uint32(0x9E3779B1)
        block = ((mixed.astype(np.uint64) * np.uint64(blocks)) >> np.uint64(32)).astype(np.uint16 if blocks < 1 << 16 else np.int64)
        del a, b, back, mixed, spread
        order = np.argsort(block, kind="stable")
        block, owner, other, n = block[order], owner[order], other[order], n[order]
        del order
        edges = np.searchsorted(block, np.arange(blocks + 1))
        held = [(k, i, j) for k, (i, j) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if j > i]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _, _ in held], pa.int64()),
                pa.array([j - i for _, i, j in held], pa.int64()),
                pa.array([_packed(owner[i:j], other[i:j], n[i:j]) for _, i, j in held], pa.binary()),
            ],
            names=["block", "size", "pairs"],
        )

    def joined(keys: np.ndarray, n: np.ndarray, fresh: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        more, of_more = _counts(np.concatenate([keys[:0], *fresh]))
        return _summed(np.concatenate((keys, more)), np.concatenate((n, of_more)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*coded.value, frequent)
        keys, n, fresh = np.empty(0, np.int64), np.empty(0, np.int64), []
        for batch in text_batches(batches, "text"):
            codes, _, _ = coder(batch.column("text").to_pylist())
            if len(codes):
                fresh.append(np.concatenate(([rest + 1], codes[:-1])) * size + codes)
            if sum(map(len, fresh)) > HELD_PAIRS:
                keys, n = joined(keys, n, fresh)
                fresh = []
                if len(keys) > HELD_PAIRS:
                    yield from dealt(keys, n)
                    keys, n = keys[:0], n[:0]
        keys, n = joined(keys, n, fresh)
        if len(keys):
            yield from dealt(keys, n)

    def merge(group: pa.Table) -> pa.Table:
        parts = [_unpacked(s, b) for s, b in zip(group.column("size").to_pylist(), group.column("pairs").to_pylist(), strict=True)]
        owner, other, n = np.concatenate(parts, axis=1)
        keys, n = _summed(owner.astype(np.int64) * size + other, n.astype(np.int64))
        return pa.table({"size": pa.array([len(keys)], pa.int64()), "pairs": pa.array([_packed(keys // size, keys % size, n)], pa.binary())})

    rows = training.select(F.col(text).alias("text")).mapInArrow(count, "block bigint, size bigint, pairs binary")
    return written(rows.groupBy("block").applyInArrow(merge, "size bigint, pairs binary"), "neighbours")


def _gains(table: np.ndarray, right: np.ndarray, left: np.ndarray, own: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Exact change of the likelihood when one word moves from class ``old`` to ``new``, for each word.

    ``right`` and ``left`` count the classes after and before the word, ``own`` its pairs with itself.
    """
    at = np.arange(len(old))
    right, left = right.astype(np.float64), left.astype(np.float64)
    right[at, old] -= own
    left[at, old] -= own
    logs, rows, columns = _entropy(table), table.sum(axis=1), table.sum(axis=0)
    from_, to = table[old] - right, table[new] + right
    from_[at, old] -= left[at, old] + own
    from_[at, new] += left[at, old]
    to[at, old] -= left[at, new]
    to[at, new] += left[at, new] + own
    gain = (_entropy(from_) - logs[old] + _entropy(to) - logs[new]).sum(axis=1)
    across = _entropy(table.T[old] - left) - logs.T[old] + _entropy(table.T[new] + left) - logs.T[new]
    across[at, old] = across[at, new] = 0.0
    gain += across.sum(axis=1)
    after, before = right.sum(axis=1) + own, left.sum(axis=1) + own
    for sums, moved in ((rows, after), (columns, before)):
        gain -= _entropy(sums[old] - moved) - _entropy(sums[old]) + _entropy(sums[new] + moved) - _entropy(sums[new])
    return gain


def _proposed(table: np.ndarray, classes: int, right: np.ndarray, left: np.ndarray, own: np.ndarray, old: np.ndarray, least: float) -> np.ndarray:
    """The class each word would move to, or its own one; words that are not in a class yet take the best one."""
    logs = np.log(np.maximum(table, 0.5))
    sums = table.sum(axis=1), table.sum(axis=0)
    rows, columns = (np.log(np.maximum(x, 0.5)) for x in sums)
    after, before = right.sum(axis=1), left.sum(axis=1)
    score = right @ logs[:classes].T + left @ logs[:, :classes]
    score -= after[:, None] * rows[:classes] + before[:, None] * columns[:classes]
    at = np.arange(len(old))
    placed = np.flatnonzero(old < classes)
    score[placed, old[placed]] = -np.inf  # the best other one
    best = score.argmax(axis=1)
    if classes == 1:
        best[placed] = old[placed]
    # its own class without it: only words that some other class suits better are computed exactly
    r, f, o = right[placed], left[placed], old[placed]
    stay = (r * np.log(np.maximum(table[o] - r, 0.5))).sum(axis=1) + (f * np.log(np.maximum(table.T[o] - f, 0.5))).sum(axis=1)
    stay -= after[placed] * np.log(np.maximum(sums[0][o] - after[placed], 0.5)) + before[placed] * np.log(np.maximum(sums[1][o] - before[placed], 0.5))
    suits = score[at, best][placed] > stay
    best[placed[~suits]] = old[placed[~suits]]
    some = placed[suits & (best[placed] != o)]
    gain = _gains(table, right[some], left[some], own[some], old[some], best[some])
    best[some] = np.where(gain > least, best[some], old[some])
    return best


def _exchanged(table: np.ndarray, classes: int, right: np.ndarray, left: np.ndarray, own: np.ndarray, old: np.ndarray, least: float, step: int) -> np.ndarray:
    """New classes of words, ``step`` at a time; ``table`` is changed as if words of one call were no neighbours."""
    new, kinds = old.copy(), len(table)
    for i in range(0, len(old), step):
        part = slice(i, i + step)
        new[part] = _proposed(table, classes, right[part], left[part], own[part], old[part], least)
        at = i + np.flatnonzero(new[part] != old[part])
        if not len(at):
            continue
        of, row = np.zeros((len(at), kinds)), np.arange(len(at))
        of[row, new[at]] = 1.0
        of[row, old[at]] = -1.0
        r, f = right[at].astype(np.float64), left[at].astype(np.float64)
        r[row, old[at]] -= own[at]
        f[row, old[at]] -= own[at]
        table += of.T @ r + f.T @ of
        table[np.arange(kinds), np.arange(kinds)] += own[at] @ of
    return new


def _summed_blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of equal keys added up, key by key; rows with a key below 0 (moves) pass as they are."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        keys = batch.column("key").to_numpy()
        yield batch.filter(pa.array(keys < 0))
        for i in np.flatnonzero(keys >= 0).tolist():
            numbers = _numbers(batch.column("size")[i].as_py(), batch.column("numbers")[i].as_py())
            key = int(keys[i])
            held[key] = held[key] + numbers if key in held else numbers
    yield _blobs(list(held.items()))


def _blobs(rows: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k for k, _ in rows], pa.int64()),
            pa.array([x.size for _, x in rows], pa.int64()),
            pa.array([pa.compress(x.astype(np.int64).tobytes(), codec="zstd", asbytes=True) for _, x in rows], pa.binary()),
        ],
        names=["key", "size", "numbers"],
    )


def _numbers(size: int, blob: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, size * 8, codec="zstd", asbytes=True), np.int64)


def _clustered(neighbours: DataFrame, label: np.ndarray, table: np.ndarray, own: np.ndarray, classes: int, step: int) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Labels after exchange in rounds, their class-pair counts, and the log-likelihoods of all rounds.

    ``table`` has the class pairs of ``label``, ``own`` the pairs with themselves of the most frequent words.
    """
    context = neighbours.sparkSession.sparkContext
    size, kinds, hot = len(label), classes + 2, len(own)
    rest, cells = size - 2, kinds * kinds
    least = _least_gain(table)

    def may_move(words: np.ndarray, turn: int, share: float) -> np.ndarray:
        return ((words + 1 + turn * 7919) * 0x9E3779B1 % (1 << 32)) < share * (1 << 32)

    def scan(label: np.ndarray, table: np.ndarray, turn: int, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Class pairs of ``label``, changes of them by the moves, counts of the most frequent words; words that move, and where to."""
        held = context.broadcast((label.astype(np.int16), table))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            begin, table = held.value
            now, table = begin.copy(), table.copy()
            first = table.copy()
            total = np.zeros(cells, np.int64)
            of_hot = np.zeros(hot * 2 * kinds, np.int64)
            moves = []
            for batch in batches:
                for length, blob in zip(batch.column("size").to_pylist(), batch.column("pairs").to_pylist(), strict=True):
                    owner, other, n = _unpacked(length, blob)
                    # owners are in order: the most frequent words, others, rare ones and the end; again for what is before them
                    heads, others, middle, heads_again = np.searchsorted(owner, [hot, rest, size, size + hot]).tolist()
                    kind = begin[other]
                    total += np.bincount(begin[owner[:middle]].astype(np.int64) * kinds + kind[:middle], n[:middle], cells).astype(np.int64)
                    for i, j, back in ((0, heads, 0), (middle, heads_again, 1)):
                        of_hot += np.bincount(((owner[i:j].astype(np.int64) - back * size) * 2 + back) * kinds + kind[i:j], n[i:j], len(of_hot)).astype(np.int64)
                    parts = [(owner[heads:others], slice(heads, others)), (owner[heads_again:] - size, slice(heads_again, None))]
                    distinct = [(of, _new(of)) for of, _ in parts]
                    words = np.union1d(*(of[at] for of, at in distinct)).astype(np.int64)
                    if not len(words):
                        continue
                    if moves:
                        kind = now[other]
                    counted = []
                    for (of, at), (_, part) in zip(distinct, parts, strict=True):
                        row = np.searchsorted(words, of[at])[np.cumsum(at) - 1]
                        counted.append(np.bincount(row * kinds + kind[part], n[part], len(words) * kinds).reshape(len(words), kinds))
                    of, part = parts[0]
                    at = of == other[part]
                    itself = np.bincount(np.searchsorted(words, of[at]), n[part][at], len(words)).astype(np.float64)
                    at = np.flatnonzero(may_move(words, turn, share) | (now[words] >= classes))
                    words = words[at]
                    old = now[words].astype(np.int64)
                    new = _exchanged(table, classes, counted[0][at], counted[1][at], itself[at], old, least, step)
                    at = np.flatnonzero(new != old)
                    now[words[at]] = new[at]
                    moves.append(np.stack((words[at], new[at])))
            rows = [(0, total), (1, np.rint(table - first).ravel())]
            rows += [(2 + k, part) for k, part in enumerate(np.split(of_hot, range(HOT_ROWS * 2 * kinds, len(of_hot), HOT_ROWS * 2 * kinds)))]
            if moves:
                moved = np.concatenate(moves, axis=1)
                rows.append((-1 - (int(moved[0, 0]) if moved.size else 0), moved.ravel()))
            yield _blobs(rows)

        scheme = "key bigint, size bigint, numbers binary"
        rows = neighbours.mapInArrow(run, scheme).repartition("key").mapInArrow(_summed_blobs, scheme).toArrow()
        held.destroy()
        found = [(k, _numbers(n, blob)) for k, n, blob in zip(*(rows.column(c).to_pylist() for c in rows.column_names), strict=True)]
        by = {k: x.astype(np.float64) for k, x in found if k >= 0}
        moved = np.concatenate([np.empty((2, 0), np.int64), *(x.reshape(2, -1) for k, x in found if k < 0)], axis=1)
        of_hot = np.concatenate([by[k] for k in sorted(by) if k > 1] or [np.zeros(hot * 2 * kinds)])
        pairs, change = by.get(0, np.zeros(cells)), by.get(1, np.zeros(cells))
        return pairs.reshape(kinds, kinds), change.reshape(kinds, kinds), of_hot.reshape(hot, 2, kinds), moved[0], moved[1]

    best: tuple[float, np.ndarray, np.ndarray] | None = None
    turn, share, likelihoods, again = 0, 1.0, [], False
    while True:
        exact, change, of_hot, words, new = scan(label, table, turn, share)
        found = _likelihood(exact)
        likelihoods.append(found)
        if best is not None and found < best[0] and not again:
            share /= 2
            if share < LEAST_SHARE:
                return best[1], best[2], likelihoods
            label, table, turn, again = best[1], best[2], turn + 1, True
            continue
        # the first round has only let the other words join, and one that was taken back is no gain
        ended = best is not None and turn > 1 and not again and found - best[0] <= TOLERANCE * exact.sum()
        best, again = (found, label, exact), False
        if ended:
            return label, exact, likelihoods
        label, table = label.copy(), exact.copy()
        label[words] = new
        at = np.flatnonzero(may_move(np.arange(hot), turn, share))
        label[at] = _exchanged(table, classes, of_hot[at, 0], of_hot[at, 1], own[at], label[at], least, max(1, step // 32))
        table = np.maximum(table + change, 0.0)
        share = min(share, FIRST_SHARE)  # of all words, neighbours of different tasks often swap
        turn += 1


def learn(
    training: DataFrame,
    text: str = "text",
    frequent: int = FREQUENT,
    clustered: int = CLUSTERED,
    classes: int = CLASSES,
    weight: float = WEIGHT,
    least: int = LEAST,
    step: int = STEP,
    block_tokens: int = BLOCK_TOKENS,
) -> ClassModel:
    """The model of all texts of ``training``; ``frequent`` bounds a task's memory of words, without effect on results."""
    context = training.sparkSession.sparkContext
    vocabulary = written(_counted(training, text), "vocabulary")
    is_end = F.col("word") == END
    sums = vocabulary.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words"), F.sum(F.when(is_end, F.col("n"))).alias("ends")).first()
    tokens, distinct, ends = sums["n"] or 0, sums["words"], sums["ends"] or 0
    top = vocabulary.where(~is_end & (F.col("n") >= least)).select(F.xxhash64("word").alias("hash"), "n").toArrow()
    hashes, counts = top.column("hash").to_numpy(), top.column("n").to_numpy()
    order = np.lexsort((hashes, -counts))
    hashes, counts = hashes[order], counts[order]
    codes = np.argsort(hashes, kind="stable").astype(np.int32)
    hashes, words = hashes[codes], len(hashes)
    hot = min(clustered, words)
    classes = max(1, min(classes, hot))
    rest, end = classes, classes + 1
    coded = context.broadcast((hashes, codes))
    neighbours = _neighbours(training, text, coded, frequent, hot, max(1, tokens // block_tokens))

    # the most frequent words among themselves; the others, the rare ones and the end keep one symbol each
    symbols = hot + 3

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(symbols * symbols, np.int64)
        for batch in batches:
            for length, blob in zip(batch.column("size").to_pylist(), batch.column("pairs").to_pylist(), strict=True):
                owner, other, n = _unpacked(length, blob)
                at = owner < words + 2
                a, b = (np.where(x < hot, x, np.where(x < words, hot, x - words + hot + 1)) for x in (owner[at], other[at]))
                pairs += np.bincount(a * symbols + b, n[at], symbols * symbols).astype(np.int64)
        at = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(pairs[at], pa.int64())], names=["pair", "n"])

    got = neighbours.mapInArrow(count_pairs, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros(symbols * symbols, np.int64)
    pairs[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    label = np.full(words + 2, rest, np.int64)
    label[-1] = end
    pairs = pairs.reshape(symbols, symbols)
    of_symbol = exchange(pairs, hot, classes, TOLERANCE)
    label[:hot] = of_symbol[:hot]
    kinds = classes + 2
    of = np.eye(kinds)[np.concatenate((of_symbol[:hot], [rest, rest, end]))]
    label, between, likelihoods = _clustered(neighbours, label, of.T @ pairs @ of, np.diag(pairs)[:hot].astype(np.float64), classes, step)

    counts = np.concatenate((counts, [0, ends]))
    mass = np.bincount(label, counts, kinds)
    variety = np.bincount(label[np.arange(words + 2) != words], minlength=kinds).astype(np.float64)
    mass[rest] += tokens - counts.sum()
    variety[rest] += distinct - words - (1 if ends else 0) + 1  # the unknown word
    alone = np.where(variety > 0, between.sum(axis=0) + ADD, 0.0)  # an empty class gets no probability
    alone /= alone.sum()
    after = (between + kinds * alone) / (between.sum(axis=1, keepdims=True) + kinds)
    bracket = weight * after / np.maximum(mass + ADD * variety, ADD) + (1 - weight) / (tokens + ADD * (distinct + 1))
    return ClassModel(hashes, codes, counts, label, np.arange(kinds), np.log10(bracket), vocabulary, tokens, distinct, least, frequent, between, likelihoods)


def scored(docs: DataFrame, model: ClassModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) for each row.

    ``base_score`` is the smoothed unigram log10 probability, ``score`` the class model's.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.hashes, model.codes, model.symbol, model.counts, model.label, model.log_bracket, model.frequent))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, of_hash, symbol, counts, label, log_bracket, frequent = held.value
        log_count = np.log10(counts + ADD)
        coder, rest = Coder(hashes, of_hash, frequent), len(hashes)
        for batch in text_batches(batches, "text"):
            codes, found, sizes = coder(batch.column("text").to_pylist())
            first = np.cumsum(sizes) - sizes
            known = codes != rest
            own = np.where(known, log_count[codes], 0.0)
            kinds = label[symbol[codes]]
            before = np.concatenate(([label[-1]], kinds[:-1]))
            at = np.flatnonzero(~known)
            words = pa.array([found[i] for i in at.tolist()], pa.binary()).cast(pa.string())
            of_text = pa.array(np.searchsorted(first, at, "right") - 1)
            rare = pa.table({"of": of_text, "word": words}).group_by(["of", "word"]).aggregate([([], "count_all")]).sort_by("of").combine_chunks()
            bounds = np.searchsorted(rare.column("of").to_numpy(), np.arange(len(sizes) + 1)).astype(np.int32)
            parts = [rare.column(c).combine_chunks() for c in ("word", "count_all")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(sizes),
                    pa.array(np.add.reduceat((known & (counts[codes] > 0)).astype(np.int64), first)),
                    pa.array(np.add.reduceat(own, first)),
                    pa.array(np.add.reduceat(log_bracket[before, kinds], first)),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays([x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in parts], names=["word", "n"])),
                ],
                names=["id", "n_tokens", "n_known", "log_counts", "log_brackets", "rare"],
            )

    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("log_counts", T.DoubleType()),
            T.StructField("log_brackets", T.DoubleType()),
            T.StructField("rare", T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())]))),
        ]
    )
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(score, schema)
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    counts = rare.join(model.vocabulary.where(F.col("word") != END), "word", "left")
    sums = counts.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.coalesce(F.col("n"), F.lit(0)) + F.lit(ADD))).alias("rare_counts"),
    )
    log_counts = F.col("log_counts") + F.coalesce("rare_counts", F.lit(0.0))
    denominator = float(np.log10(model.tokens + ADD * (model.distinct + 1)))
    return rows.drop("rare").join(sums, "row", "left").select(
        F.col("id").alias(id),
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        (log_counts - F.col("n_tokens") * F.lit(denominator)).alias("base_score"),
        (log_counts + F.col("log_brackets")).alias("score"),
    )
