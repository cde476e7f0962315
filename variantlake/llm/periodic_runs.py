"""Periodic stretches (runs) of words in texts, by Lyndon roots.

A run is a stretch of words with smallest period ``q`` and a length of at least
``max(MIN_LENGTH, MIN_EXPONENT * q)`` that no neighbouring word extends.

``lyndon_lengths`` is the first phase of Baier's suffix sorter: suffixes are split into
groups, from the greatest group to the least, by how many suffixes of a group point back
at them. A suffix ends in a group whose common prefix is its longest Lyndon prefix, so
the phase alone gives the Lyndon array, in linear time and without sorting suffixes. By
the runs theorem every run has, under the order of symbols or its reverse, a root that is
the longest Lyndon word at its place: the arrays under both orders name all roots, and
the longest common extensions of each to the right and left say how far its period goes.

Before that, texts are cut to stretches that can hold a run: each window of three words
in a run occurs three times in it, so windows that occur less often in their stretch are
taken out until none is left. This loses no run, and prose mostly ends there.

Defined results: a null text counts as empty; texts are judged alone, so ties, repeated
rows and row order have no influence; an empty table gives no rows; other columns pass
through, and an existing column named like the output is replaced. Memory is about 200
bytes a word of one slice of texts (``common.SLICE_BYTES``), or of the longest text.
"""

from __future__ import annotations

from functools import cmp_to_key

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from variantlake.llm.common import text_udf, words_of
from variantlake.llm.repetition import suffix_order

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: words of the windows that cut texts down, and how often one occurs in any run that holds it
WINDOW, TIMES = 3, 3

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])
RUNS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("strongest", RUN),
        T.StructField("collapsed", T.StringType()),
    ]
)


def lyndon_lengths(symbols: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place; the end is less than any symbol.

    A group is a range of ``held`` and is known by where the range begins; ``size`` and
    ``prefix`` (the length of the common prefix) are kept there. Splitting a group moves
    the members pointed at to the end of its range, those with most pointers last.
    """
    n = len(symbols)
    if not n:
        return np.empty(0, np.int64)
    held = np.argsort(symbols, kind="stable")
    ordered = symbols[held]
    fresh = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    starts = fresh.tolist()
    size, prefix, group, at = [0] * n, [1] * n, [0] * n, [0] * n
    for start, end in zip(starts, [*starts[1:], n], strict=True):
        size[start] = end - start
    of = np.repeat(fresh, np.diff(np.append(fresh, n)))
    where = np.empty(n, np.int64)
    where[held] = np.arange(n)
    group, at, held = of[where].tolist(), where.tolist(), held.tolist()
    before = [-1] * n  # the nearest suffix to the left in a lesser group, once its group was reached
    lengths = [0] * n
    end = n
    while end:
        start = group[held[end - 1]]
        length = prefix[start]
        members = held[start:end]
        pointed: dict[int, int] = {}
        for s in sorted(members) if len(members) > 1 else members:
            lengths[s] = length
            p = s - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[s] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        end = start
        if not pointed:
            continue
        if len(pointed) > 1:
            ranked = sorted(pointed, key=pointed.__getitem__, reverse=True)
        else:
            ranked = list(pointed)
        i = 0
        while i < len(ranked):
            times, j = pointed[ranked[i]], i
            while j < len(ranked) and pointed[ranked[j]] == times:
                j += 1
            moved: dict[int, int] = {}
            for p in ranked[i:j]:  # to the end of its old range
                old = group[p]
                taken = moved.get(old, 0) + 1
                moved[old] = taken
                to = old + size[old] - taken
                other, here = held[to], at[p]
                held[here], at[other] = other, here
                held[to], at[p] = p, to
            for old, taken in moved.items():
                left = size[old] - taken
                if left:
                    new = old + left
                    size[old], size[new] = left, taken
                    prefix[new] = prefix[old] + times * length
                    for p in held[new : new + taken]:
                        group[p] = new
                else:
                    prefix[old] += times * length
            i = j
    return np.array(lengths, np.int64)


def _numbered(keys: np.ndarray) -> np.ndarray:
    """How often the value of each place occurs."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    times = np.diff(np.append(first, len(keys)))
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(times, times)
    return out


def stretches(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the parts of [start, end) that can hold a run; no run crosses their bounds."""
    mix = np.uint64(0x9E3779B97F4A7C15)
    while len(starts):
        size = ends - starts
        long = size >= MIN_LENGTH
        starts, size = starts[long], size[long]
        if not len(starts):
            break
        windows = size - WINDOW + 1
        part = np.repeat(np.arange(len(starts)), windows)
        place = np.arange(len(part)) + np.repeat(starts - (np.cumsum(windows) - windows), windows)
        key = part.astype(np.uint64)
        for i in range(WINDOW):  # equal windows have equal keys; that others may too only keeps more
            key = (key ^ (key >> np.uint64(29))) * mix + symbols[place + i].astype(np.uint64)
        kept = _numbered(key) >= TIMES
        if kept.all():
            return starts, starts + size
        edge = np.diff(np.concatenate([[0], kept.astype(np.int8), [0]]))
        cut = np.flatnonzero((part[1:] != part[:-1]) & kept[1:] & kept[:-1]) + 1  # neighbouring parts
        first = np.sort(np.concatenate([np.flatnonzero(edge == 1), cut]))
        last = np.sort(np.concatenate([np.flatnonzero(edge == -1), cut]))
        starts, ends = place[first], place[last - 1] + WINDOW
    return np.empty(0, np.int64), np.empty(0, np.int64)


def _extensions(symbols: np.ndarray, parts: np.ndarray):
    """A function (a, b) -> longest common prefixes of the suffixes at a and b."""
    _, levels = suffix_order(symbols, parts)

    def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        shared = np.zeros(len(a), np.int64)
        for k, rank in reversed(levels):
            shared[rank[a + shared] == rank[b + shared]] += k
        return shared

    return common


def runs_of(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of the runs in the given parts of ``symbols``, by start, then period."""
    size = ends - starts
    offset = np.cumsum(size + 1) - (size + 1)  # each part is followed by an end of its own
    n = int((size + 1).sum())
    if not n:
        return np.empty((0, 3), np.int64)
    part = np.repeat(np.arange(len(size)), size + 1)
    inside = np.arange(n) - offset[part]
    real = inside < size[part]
    joined = np.empty(n, np.int64)
    joined[~real] = np.arange(len(size))
    joined[real] = np.unique(symbols[(starts[part] + inside)[real]], return_inverse=True)[1] + len(size)
    back = np.arange(n)
    back[real] = (2 * offset + size - 1)[part[real]] - back[real]
    ahead, behind = _extensions(joined, part), _extensions(joined[back], part)
    found = []
    for sign in (1, -1):
        root = np.concatenate([np.append(lyndon_lengths(sign * joined[o : o + s]), 0) for o, s in zip(offset, size, strict=True)])
        at = np.flatnonzero(root)
        period = root[at]
        right = ahead(at, at + period)
        # the place before ``at`` in the reversed part; before the first one lies the part's end
        mirror = (2 * offset + size)[part[at]] - at
        left = behind(mirror, mirror - period)
        length = left + period + right
        good = length >= np.maximum(MIN_LENGTH, MIN_EXPONENT * period)
        begin = at[good] - left[good]
        found.append(np.stack([begin - offset[part[begin]] + starts[part[begin]], length[good], period[good]], axis=1))
    return np.unique(np.concatenate(found)[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


def _weaker(a: tuple[int, int, int], b: tuple[int, int, int]) -> int:
    """Orders runs by exact exponent; of equal ones the first, then the one of the shorter period, is greatest."""
    return a[1] * b[2] - b[1] * a[2] or b[0] - a[0] or b[2] - a[2]


def analysed(texts: list[str | None]) -> list[list]:
    """The columns of ``RUNS`` for each text."""
    words = [words_of(t) for t in texts]
    number: dict[bytes, int] = {}
    symbols = np.fromiter((number.setdefault(w, len(number)) for ws in words for w in ws), np.int64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    runs = runs_of(symbols, *stretches(symbols, np.append(0, ends)[:-1], ends))
    of = np.searchsorted(ends, runs[:, 0], "right")
    bounds = np.searchsorted(of, np.arange(len(words) + 1)).tolist()
    all_runs, strongest, collapsed = [], [], []
    for i, ws in enumerate(words):
        a, b = bounds[i], bounds[i + 1]
        if a == b:
            all_runs.append([])
            strongest.append(None)
            collapsed.append(b" ".join(ws).decode())
            continue
        first = int(ends[i]) - len(ws)
        found = [(start - first, length, period) for start, length, period in runs[a:b].tolist()]
        dropped = np.zeros(len(ws) + 1, np.int64)
        for start, length, period in found:
            dropped[start + period] += 1
            dropped[start + length] -= 1
        all_runs.append([dict(zip(RUN.names, r, strict=True)) for r in found])
        strongest.append(dict(zip(RUN.names, max(found, key=cmp_to_key(_weaker)), strict=True)))
        collapsed.append(b" ".join(ws[k] for k in np.flatnonzero(np.cumsum(dropped[:-1]) == 0)).decode())
    return [list(map(len, words)), all_runs, strongest, collapsed]


def with_runs(docs: DataFrame, text: str = "text", out: str = "periodic") -> DataFrame:
    """``docs`` with the struct column ``out``: words, runs, the strongest run and the collapsed text; no shuffle."""
    return docs.withColumn(out, text_udf(RUNS, lambda: analysed)(docs[text]))
