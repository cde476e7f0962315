"""License scans with a generalised suffix automaton of license words.

The automaton holds every word sequence of all templates and phrases. Each text is
streamed through it: the matching statistics say at each word how long the longest
match that ends there is. Long maximal matches are chained, in the order of a template
and with short gaps, into spans; a span that covers enough of its template gives the
template's label. Phrases are places where the whole phrase ends (its state is the
current one or is reached from it by suffix links).

Only stretches of words whose neighbours all stand next to each other in some template
are streamed; elsewhere no match of two words exists. Defined results: words are runs of
ASCII letters and digits (A-Z in lower case) and characters beyond ASCII; a null text
counts as empty; a text without a match has no label and score 0; overlapping spans are
all kept; equal texts give equal results. Other columns pass through; an existing
column named like the output is replaced.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from variantlake.llm.common import text_udf

#: fixed values: phrases and their labels
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: notices as commonly printed, by label; a parameter of the operator
TEMPLATES = {
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0"],
    "cc-by-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
}

#: words of a match that may enter a chain, words that may lie between two, least share of the template
MIN_MATCH = 4
MAX_GAP = 6
MIN_COVER = 0.7

LOWER = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))

PLACE = T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("words", T.IntegerType())])
COVERED = T.StructType(
    [T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("cover", T.DoubleType())]
)
LICENSES = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("places", T.ArrayType(PLACE)),
        T.StructField("spans", T.ArrayType(COVERED)),
        T.StructField("score", T.DoubleType()),
    ]
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(LOWER).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton of word-code sequences, with the places where each state's words end."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        for number, sequence in enumerate(sequences):
            last = 0
            for place, code in enumerate(sequence):
                last = self._extend(last, code)
                self.ends[last].append((number, place + 1))
        for state in sorted(range(1, len(self.size)), key=lambda s: -self.size[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] += self.ends[state]
        self.ends = [sorted(set(e)) for e in self.ends]

    def _new(self, size: int, follow: dict[int, int], link: int) -> int:
        self.next.append(dict(follow))
        self.size.append(size)
        self.link.append(link)
        self.ends.append([])
        return len(self.size) - 1

    def _split(self, state: int, code: int) -> int:
        """The state for the words of ``state`` and ``code``, cut off from longer ones if need be."""
        target = self.next[state][code]
        if self.size[target] == self.size[state] + 1:
            return target
        copy = self._new(self.size[state] + 1, self.next[target], self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(code) == target:
            self.next[state][code] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, code: int) -> int:
        if code in self.next[last]:
            return self._split(last, code)
        state, at = self._new(self.size[last] + 1, {}, 0), last
        while at >= 0 and code not in self.next[at]:
            self.next[at][code] = state
            at = self.link[at]
        if at >= 0:
            self.link[state] = self._split(at, code)
        return state

    def statistics(self, codes: list[int]):
        """(state, length) of the longest match that ends at each word."""
        state, length = 0, 0
        for code in codes:
            while state and code not in self.next[state]:
                state = self.link[state]
                length = self.size[state]
            if code in self.next[state]:
                state, length = self.next[state][code], length + 1
            yield state, length


class Scanner:
    def __init__(self, templates: dict[str, list[str]], phrases: dict[str, str], min_match: int, max_gap: int, min_cover: float):
        self.min_match, self.max_gap, self.min_cover = min_match, max_gap, min_cover
        self.codes: dict[bytes, int] = {}
        encode = lambda text: [self.codes.setdefault(w, len(self.codes)) for w in words_of(text)]
        self.templates = [(label, encode(text)) for label, texts in templates.items() for text in texts]
        self.templates = [(label, words) for label, words in self.templates if words]
        ends = [(label, encode(text)) for text, label in phrases.items()]
        sequences = [words for _, words in self.templates] + [words for _, words in ends]
        self.automaton = SuffixAutomaton(sequences)
        of_state = {}
        for label, words in ends:
            state = 0
            for code in words:
                state = self.automaton.next[state][code]
            of_state.setdefault(state, []).append((label, len(words)))
        self.phrases = []  # for each state: phrases that may end there, by the suffix links
        for state in range(len(self.automaton.size)):
            found, at = [], state
            while at > 0:
                found += of_state.get(at, [])
                at = self.automaton.link[at]
            self.phrases.append(found)
        n = len(self.codes)
        self.pairs = np.zeros((n + 1, n + 1), bool)
        for words in sequences:
            self.pairs[words[:-1], words[1:]] = True

    def stretches(self, texts: list) -> tuple[list[int], list[list[tuple[int, list[int]]]]]:
        """Word counts, and for each text the (start, codes) that may hold matches of two words or more."""
        codes, begin, get, none = [], [0], self.codes.get, len(self.codes)
        for text in texts:
            codes += map(get, words_of(text), repeat(none))
            codes.append(none)
            begin.append(len(codes))
        codes = np.array(codes, np.int64)
        out: list[list] = [[] for _ in texts]
        if len(codes) > 1:
            good = self.pairs[codes[:-1], codes[1:]].astype(np.int8)
            edges = np.flatnonzero(np.diff(np.concatenate(([0], good, [0]))))
            for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                number = int(np.searchsorted(begin, start, "right")) - 1
                out[number].append((start - begin[number], codes[start : end + 1].tolist()))
        return [b - a - 1 for a, b in zip(begin[:-1], begin[1:], strict=True)], out

    def scan(self, stretches: list[tuple[int, list[int]]]) -> tuple[list[dict], list[dict], float]:
        places, matches = [], []
        for start, codes in stretches:
            before = (0, 0)
            for at, (state, length) in enumerate(self.automaton.statistics(codes), start):
                for label, size in self.phrases[state]:
                    if length >= size:
                        places.append({"label": label, "start": at + 1 - size, "words": size})
                if length <= before[1] and before[1] >= self.min_match:
                    matches.append((at, *before))
                before = (state, length)
            if before[1] >= self.min_match:
                matches.append((start + len(codes), *before))
        return places, *self._chained(matches)

    def _chained(self, matches: list[tuple[int, int, int]]) -> tuple[list[dict], float]:
        """Spans of templates from maximal matches (end, state, length) in text order; the best cover."""
        open_: dict[int, list[int]] = {}  # template -> [start, end, end in template, words covered]
        spans, best = [], 0.0

        def close(number: int) -> None:
            nonlocal best
            label, words = self.templates[number]
            start, end, _, covered = open_.pop(number)
            cover = min(1.0, covered / len(words))
            best = max(best, cover)
            if cover >= self.min_cover:
                spans.append({"label": label, "start": start, "end": end, "cover": cover})

        for end, state, length in matches:
            by_template: dict[int, list[int]] = {}
            for number, place in self.automaton.ends[state]:
                if number < len(self.templates):
                    by_template.setdefault(number, []).append(place)
            for number, ends in by_template.items():
                chain = open_.get(number)
                if chain:
                    overlap = max(0, chain[1] - (end - length))  # neighbouring matches may share words
                    fits = [p for p in ends if p - length + overlap >= chain[2]] if overlap < length else []
                    if fits and end - length - chain[1] <= self.max_gap:
                        chain[3] += length - overlap
                        chain[1:3] = [end, fits[0]]
                        continue
                    if chain[1] >= end:
                        continue
                    close(number)
                open_[number] = [end - length, end, ends[0], length]
        for number in sorted(open_):
            close(number)
        return sorted(spans, key=lambda s: (s["start"], s["end"], s["label"])), best


def with_licenses(
    docs: DataFrame,
    text: str = "text",
    out: str = "licenses",
    templates: dict[str, list[str]] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    min_match: int = MIN_MATCH,
    max_gap: int = MAX_GAP,
    min_cover: float = MIN_COVER,
) -> DataFrame:
    """``docs`` with the struct column ``out``: words, phrase places, template spans and the best cover; no shuffle."""

    def make():
        scanner = Scanner(templates, phrases, min_match, max_gap, min_cover)

        def scan(texts: list) -> list:
            n_words, stretches = scanner.stretches(texts)
            found = [scanner.scan(s) if s else ([], [], 0.0) for s in stretches]
            return [n_words, *map(list, zip(*found, strict=True))] if texts else [[], [], [], []]

        return scan

    return docs.withColumn(out, text_udf(LICENSES, make)(docs[text]))
