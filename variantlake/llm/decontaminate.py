"""Benchmark decontamination by greedy string tiling.

Words of texts and benchmark items are joined on short shared windows (seeds). A pair
whose seeds could cover enough of the item is tiled: search lengths fall by halves,
running Karp-Rabin hashes find all matches of at least that length between words not
yet marked, and the longest is marked first, again and again. The share of the item's
words under tiles is compared with a threshold, so that passages in another order or
with words put in between are found too.

Defined results: words are runs of ASCII letters and digits and of characters beyond
ASCII, in lower case; a null or empty
text, or an item without a word, never matches; an item shorter than a seed must occur
whole. Ties between tiles go to the first place in the item, then in the text. Repeated
texts give the same rows each; repeated items count once. An empty table on either side
gives no match. Other columns pass through; an existing column named like the output is
replaced. Items are shipped to the tasks in blocks of at most ``BLOCK_CHARS``
characters (or one longer item); a larger benchmark takes one more pass per block.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantlake.llm.common import text_udf, written

#: ASCII but letters and digits separates words
SEPARATED = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
MIN_MATCH = 4
MIN_COVERAGE = 0.5
BLOCK_CHARS = 8_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode().translate(SEPARATED).split() if text else []


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Polynomial (Karp-Rabin) hash modulo 2**64 of each window of ``size`` codes."""
    if len(codes) < size:
        return np.empty(0, np.uint64)
    values = codes.astype(np.uint64) + np.uint64(1)
    done, have, out = 0, 1, None
    power = values  # hashes of windows of `have` codes, doubled as needed
    offset = 0
    while size >> done:
        if size >> done & 1:
            n = len(codes) - offset - have + 1
            part = power[offset : offset + n]
            out = part if out is None else out[:n] * _power(have) + part
            offset += have
        power = power[: len(power) - have] * _power(have) + power[have:] if len(power) > have else power[:0]
        have, done = 2 * have, done + 1
    return out[: len(codes) - size + 1]


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(BASE), n, 1 << 64))


def tiles(text: np.ndarray, item: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in text, place in item, length), longest first."""
    free_text, free_item = np.ones(len(text), bool), np.ones(len(item), bool)
    out, size = [], min(len(text), len(item))
    while size >= least:
        of_text, of_item = _free(free_text, size), _free(free_item, size)
        in_text, in_item = window_hashes(text, size)[of_text], window_hashes(item, size)[of_item]
        by = np.argsort(in_item, kind="stable")
        low, high = np.searchsorted(in_item[by], in_text, "left"), np.searchsorted(in_item[by], in_text, "right")
        count = high - low
        p = np.repeat(of_text, count)
        q = of_item[by][np.repeat(low - np.cumsum(count) + count, count) + np.arange(int(count.sum()))]
        order = np.lexsort((q, p - q))
        p, q = p[order], q[order]
        fresh = np.ones(len(p), bool)
        fresh[1:] = (np.diff(p - q) != 0) | (np.diff(p) != 1)
        starts = np.flatnonzero(fresh)
        runs = np.diff(np.append(starts, len(p))) + size - 1
        heap = [(-int(n), int(q[i]), int(p[i])) for n, i in zip(runs, starts, strict=True)]
        heapq.heapify(heap)
        while heap:
            n, j, i = heapq.heappop(heap)
            both = free_text[i : i - n] & free_item[j : j - n]
            if both.all():
                if (text[i : i - n] == item[j : j - n]).all():
                    free_text[i : i - n] = free_item[j : j - n] = False
                    out.append((i, j, -n))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate(([0], both.astype(np.int8), [0]))))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if b - a >= size:
                    heapq.heappush(heap, (a - b, j + a, i + a))
        size = size // 2 if size > 2 * least else least if size > least else 0
    return out


def _free(free: np.ndarray, size: int) -> np.ndarray:
    """Starts of the windows in which every place is free."""
    taken = np.concatenate(([0], np.cumsum(~free)))
    return np.flatnonzero(taken[size:] == taken[:-size])


class Benchmark:
    """Seeds of a block of items, ready to be joined with texts."""

    def __init__(self, items: list[tuple], least: int, coverage: float):
        self.least, self.coverage = least, coverage
        self.ids, self.codes, self.vocabulary = [], [], {}
        for item_id, text in items:
            if words := words_of(text):
                self.ids.append(item_id)
                self.codes.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], np.int64))
        self.sizes = np.array([len(c) for c in self.codes], np.int64)
        postings: dict[int, list] = defaultdict(list)
        for number, codes in enumerate(self.codes):
            postings[min(least, len(codes))].append((number, codes))
        self.seeds = {}
        for size, members in postings.items():
            hashes = np.concatenate([window_hashes(c, size) for _, c in members])
            number = np.concatenate([np.full(len(c) - size + 1, n) for n, c in members])
            place = np.concatenate([np.arange(len(c) - size + 1) for _, c in members])
            by = np.argsort(hashes, kind="stable")
            self.seeds[size] = hashes[by], number[by], place[by]

    def candidates(self, text: np.ndarray) -> list[int]:
        """Items whose seeds found in ``text`` could cover enough of them."""
        out = []
        for size, (hashes, number, place) in self.seeds.items():
            known = np.concatenate(([0], np.cumsum(text < 0)))
            if len(text) < size:
                continue
            whole = known[size:] == known[:-size]
            found = np.unique(window_hashes(text, size)[whole])
            low, high = np.searchsorted(hashes, found, "left"), np.searchsorted(hashes, found, "right")
            count = high - low
            if not count.any():
                continue
            at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
            n, p = number[at], place[at]
            by = np.lexsort((p, n))
            n, p = n[by], p[by]
            gap = np.full(len(p), size)
            gap[:-1] = np.where(n[1:] == n[:-1], np.minimum(size, p[1:] - p[:-1]), size)
            reach = np.bincount(n, gap, len(self.sizes))
            out += np.flatnonzero((reach > 0) & (reach >= self.coverage * self.sizes)).tolist()
        return sorted(out)

    def of_all(self, texts: list) -> list[list[dict]]:
        """``leaks`` of each text; texts without any seed are told apart all at once."""
        get = self.vocabulary.get
        codes, begin = [], [0]
        for text in texts:
            codes += map(get, words_of(text), repeat(-1))
            codes.append(-1)  # no window reaches across texts
            begin.append(len(codes))
        codes = np.array(codes, np.int64)
        seeded = np.zeros(len(texts), bool)
        unknown = np.concatenate(([0], np.cumsum(codes < 0)))
        for size, (hashes, _, _) in self.seeds.items():
            whole = np.flatnonzero(unknown[size:] == unknown[:-size]) if len(codes) >= size else np.empty(0, np.int64)
            if not len(whole):
                continue
            windows = window_hashes(codes, size)[whole]
            at = np.minimum(np.searchsorted(hashes, windows), len(hashes) - 1)
            seeded[np.searchsorted(begin, whole[hashes[at] == windows], "right") - 1] = True
        return [self.leaks(codes[begin[i] : begin[i + 1] - 1]) if s else [] for i, s in enumerate(seeded.tolist())]

    def leaks(self, codes: np.ndarray) -> list[dict]:
        out = []
        for number in self.candidates(codes):
            item = self.codes[number]
            found = tiles(codes, item, min(self.least, len(item)))
            share = sum(n for _, _, n in found) / len(item)
            if share >= self.coverage:
                out.append(
                    {
                        "item_id": self.ids[number],
                        "coverage": share,
                        "item_words": len(item),
                        "longest_tile": found[0][2],
                        "tiles": [{"text_start": i, "item_start": j, "words": n} for i, j, n in sorted(found)],
                    }
                )
        return out


def with_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    out: str = "leaks",
    least: int = MIN_MATCH,
    coverage: float = MIN_COVERAGE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with the array column ``out``: the items found in each text, with coverage and tiles; no shuffle."""
    leak = T.StructType(
        [
            T.StructField("item_id", benchmark.schema[item_id].dataType),
            T.StructField("coverage", T.DoubleType()),
            T.StructField("item_words", T.IntegerType()),
            T.StructField("longest_tile", T.IntegerType()),
            T.StructField(
                "tiles",
                T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("text_start", "item_start", "words")])),
            ),
        ]
    )
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * chars // block_chars))
    for block in range(blocks):  # a block holds about half of block_chars
        held = [tuple(r) for r in items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()]

        def make(held=held):
            bench = Benchmark(held, least, coverage)
            return lambda texts: [bench.of_all(texts)]

        found = text_udf(T.StructType([T.StructField("leaks", T.ArrayType(leak))]), make)(F.col(text))["leaks"]
        docs = docs.withColumn(out, F.concat(F.col(out), found) if block else found)
        if blocks > 1:  # a pass of its own: neither the driver nor a task holds two blocks
            docs = written(docs, "leaks")
    return docs
