"""Quality rules by suffix arrays: repeated passages within a text.

``suffix_order`` sorts the suffixes of many texts' words at once by prefix doubling
(only suffixes not yet told apart are sorted again), ``neighbour_lcp`` gives the
longest common prefix of neighbours. Intervals of that array are the repeated
substrings; the union of their spans gives the covered share of a text, the deepest
interval its longest repeat. ``with_quality`` adds the verdict as a struct column.

Defined results: a null text counts as empty (no words, so the base rule rejects it);
texts are judged alone, so ties, repeated rows and row order have no influence; other
columns pass through, and an existing column named like the output is replaced.
Memory is about 100 bytes a word of one slice of texts (``common.SLICE_BYTES``), or of
the longest text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from variantlake.llm.common import WHITE, text_udf, words_of

SYMBOLS = "#*$%&|<>"

#: a repeat counts towards the covered share from so many words on; single common
#: phrases of a language stay below it
MIN_REPEAT = 8
#: rejected when repeats cover more than this share of the words
MAX_COVERED = 0.4
#: rejected when one passage of more than so many words occurs twice or more
MAX_LONGEST = 100
MIN_WORDS = 50
MAX_REPEAT_WORDS_PERCENT = 50

SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
QUALITY = StructType(
    [
        StructField("n_words", LongType()),
        StructField("word_chars", LongType()),
        StructField("n_symbols", LongType()),
        StructField("n_dup_lines", LongType()),
        StructField("n_repeat_words", LongType()),
        StructField("base_failed", BooleanType()),
        StructField("covered_words", LongType()),
        StructField("covered_share", DoubleType()),
        StructField("longest_repeat", LongType()),
        StructField("repeat_spans", ArrayType(SPAN)),
        StructField("kept", BooleanType()),
    ]
)


def suffix_order(symbols: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix array of concatenated texts, and the ranks by the first 1, 2, 4, ... symbols.

    ``texts`` holds the text number of each symbol; each text must end with a symbol
    that occurs nowhere else. Suffixes of different texts never share a prefix.
    """
    n = len(symbols)
    rank = np.zeros(n, np.int64)
    active = np.arange(n)
    key = (texts.astype(np.int64) << 32) | symbols
    levels, k = [], 0
    while len(active):
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        fresh = np.ones(len(by), bool)
        fresh[1:] = key[1:] != key[:-1]
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))
        if k == 0:
            rank[active] = first
        else:
            old = rank[active]
            group = np.ones(len(by), bool)
            group[1:] = old[1:] != old[:-1]
            start = np.maximum.accumulate(np.where(group, np.arange(len(by)), 0))
            rank[active] = old + (first - start)
        k = max(1, 2 * k)
        levels.append((k, rank.astype(np.int32)))
        single = fresh & np.append(fresh[1:], True)
        active = active[~single]
        key = rank[active] * (n + 1) + rank[active + k]
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, levels


def neighbour_lcp(order: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Longest common prefix of each suffix and the one before it in ``order`` (0 for the first)."""
    lcp = np.zeros(len(order), np.int64)
    if not len(order):
        return lcp
    first = levels[0][1]
    alike = np.flatnonzero(first[order[1:]] == first[order[:-1]]) + 1
    a, b = order[alike - 1], order[alike]
    shared = np.zeros(len(alike), np.int64)
    for k, rank in reversed(levels):
        step = rank[a + shared] == rank[b + shared]  # a shared prefix never reaches a text's last symbol
        shared[step] += k
    lcp[alike] = shared
    return lcp


def lcp_intervals(lcp: np.ndarray, least: int = 1) -> list[tuple[int, int, int]]:
    """Intervals (depth, first, last) of the suffix array with a common prefix of ``least`` symbols or more."""
    out, stack = [], []
    for i in range(1, len(lcp) + 1):
        depth, first = (int(lcp[i]) if i < len(lcp) else 0), i - 1
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            out.append((d, first, i - 1))
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))
    return out


def maximal_repeats(words: list, least: int = MIN_REPEAT) -> list[tuple[int, list[int]]]:
    """Maximal repeated word sequences of one text: (length, start of each occurrence).

    An interval whose occurrences all follow the same word is not maximal: the one
    that holds that word too covers it.
    """
    ids: dict = {}
    symbols = np.array([ids.setdefault(w, len(ids)) for w in words] + [len(words) + 1], np.int64)
    order, levels = suffix_order(symbols, np.zeros(len(symbols), np.int64))
    out = []
    for depth, first, last in lcp_intervals(neighbour_lcp(order, levels), least):
        at = sorted(order[first : last + 1].tolist())
        if at[0] == 0 or len({int(symbols[i - 1]) for i in at}) > 1:
            out.append((depth, at))
    return sorted(out)


def repeats_of(texts: list[list], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[dict]]]:
    """For each text: words in three-word windows found twice, covered words, longest repeat, covered spans.

    The deepest interval that holds a suffix contains the spans of the shallower ones
    there, so the union over all maximal repeats is the union over each suffix of its
    deepest interval.
    """
    count = len(texts)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(sizes)
    ids: dict = {}
    symbols = np.empty(int(ends[-1]) if count else 0, np.int64)
    at = 0
    for number, words in enumerate(texts):
        symbols[at : at + len(words)] = [ids.setdefault(w, len(ids)) for w in words]
        symbols[at + len(words)] = (1 << 31) + number
        at += len(words) + 1
    text = np.repeat(np.arange(count), sizes)
    order, levels = suffix_order(symbols, text)
    lcp = neighbour_lcp(order, levels)
    deepest = np.empty(len(order), np.int64)
    deepest[order] = np.maximum(lcp, np.append(lcp[1:], 0))

    def covered(starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        edges = np.zeros(len(symbols) + 1, np.int64)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + lengths, -1)
        return np.cumsum(edges[:-1]) > 0

    three = covered(np.flatnonzero(deepest >= 3), 3)
    far = np.flatnonzero(deepest >= least)
    long = covered(far, deepest[far])
    longest = np.zeros(count, np.int64)
    np.maximum.at(longest, text, deepest)
    spans: list[list[dict]] = [[] for _ in range(count)]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], long.astype(np.int8), [0]))))
    begin = ends - sizes
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):  # a text's last symbol is never covered
        number = int(text[start])
        spans[number].append({"start": start - int(begin[number]), "end": end - int(begin[number])})
    return np.bincount(text[three], minlength=count), np.bincount(text[long], minlength=count), longest, spans


def with_quality(
    docs: DataFrame,
    text: str = "text",
    out: str = "quality",
    min_repeat: int = MIN_REPEAT,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """``docs`` with the struct column ``out`` (fields of ``QUALITY``); no shuffle."""

    def make():
        def judge(texts: list) -> list:
            texts = [t or "" for t in texts]
            words = [words_of(t) for t in texts]
            n = [len(w) for w in words]
            three, covered, longest, spans = repeats_of(words, min_repeat)
            duplicates = []
            for t in texts:
                seen, extra = set(), 0
                for line in t.split("\n"):
                    if line in seen:
                        extra += 1
                    elif line.strip(WHITE):
                        seen.add(line)
                duplicates.append(extra)
            base = [k < MIN_WORDS or 100 * r > MAX_REPEAT_WORDS_PERCENT * k for k, r in zip(n, three.tolist(), strict=True)]
            share = [c / k if k else 0.0 for c, k in zip(covered.tolist(), n, strict=True)]
            kept = [not b and s <= max_covered and m <= max_longest for b, s, m in zip(base, share, longest.tolist(), strict=True)]
            return [
                n,
                [len(t) - sum(map(t.count, WHITE)) for t in texts],
                [sum(map(t.count, SYMBOLS)) for t in texts],
                duplicates,
                three.tolist(),
                base,
                covered.tolist(),
                share,
                longest.tolist(),
                spans,
                kept,
            ]

        return judge

    return docs.withColumn(out, text_udf(QUALITY, make)(docs[text]))
