"""Runs against a brute-force search of all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from variantlake.llm import periodic_runs as P
from variantlake.llm.common import table
from variantlake.llm.queries import QUERIES, made_periodic


def brute(words):
    """(start, length, period) of all runs, from the definition."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                part = words[i : i + length]
                if not any(all(part[k] == part[k + p] for k in range(length - p)) for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def lyndon(symbols):
    """Longest Lyndon word at each place: up to the next lesser suffix."""
    n = len(symbols)
    return [next((j for j in range(i + 1, n) if symbols[j:] < symbols[i:]), n) - i for i in range(n)]


def collapsed(words, runs):
    gone = {k for start, length, period in runs for k in range(start + period, start + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def texts(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        letters = "abcdef"[: rng.randint(1, 6)]
        words = [rng.choice(letters) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            root = [rng.choice(letters) for _ in range(rng.randint(1, 7))]
            words[at:at] = (root * 9)[: rng.randint(1, 9 * len(root))]
        out.append(words)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_first_phase_gives_the_lyndon_array(seed):
    for words in texts(seed, 150):
        symbols = [ord(w) for w in words]
        assert P.lyndon_lengths(np.array(symbols, np.int64)).tolist() == lyndon(symbols)


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    held = texts(seed + 50, 150)
    n_words, runs, strongest, short = P.analysed([" ".join(w) for w in held])
    for i, words in enumerate(held):
        expected = brute(words)
        assert [tuple(r.values()) for r in runs[i]] == expected
        assert n_words[i] == len(words) and short[i] == collapsed(words, expected)
        best = max(expected, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        assert (strongest[i] and tuple(strongest[i].values())) == best


def test_long_periodic_texts_are_linear():
    words = ["la"] * 30_000 + [f"w{i % 5000}" for i in range(45_000)] + ["x", "y"] * 20_000
    _, runs, strongest, short = P.analysed([" ".join(words)])
    assert [tuple(r.values()) for r in runs[0]] == [(0, 30_000, 1), (30_000, 45_000, 5000), (75_000, 40_000, 2)]
    assert strongest[0]["period"] == 1 and len(short[0].split()) == 1 + 5000 + 2


def test_edge_cases(spark, edge_docs, no_docs):
    done = {}
    for r in P.with_runs(edge_docs, out="quality").collect():  # replaces a column of that name
        words = (r.text or "").encode().split()
        assert r.quality.n_words == len(words) and r.n == 2
        done.setdefault(r.text, r.quality)
        assert done[r.text] == r.quality
        if len(words) < 5000:
            assert [tuple(x) for x in r.quality.runs] == brute(words)
    assert done["la " * 4000].collapsed == "la" and [tuple(x) for x in done["la " * 4000].runs] == [(0, 4000, 1)]
    assert done[None].collapsed == "" and done[None].strongest is None
    assert P.with_runs(no_docs).count() == 0


def test_query_equals_brute_force(spark):
    expected = []
    for d in table(spark, SF_SMALL, "documents").collect():
        words = (d.text or "").encode().split()
        h = zlib.crc32(str(d.doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        words = [w.decode() for w in words]
        runs = brute(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        sums = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, runs))]
        expected.append((d.doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sums))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = [tuple(r) for r in QUERIES["op13_lyndon_runs"](spark, SF_SMALL).select(*names).collect()]
    assert sorted(got) == sorted(expected) and any(r[1] for r in got)


def test_made_periodic_without_words(spark, edge_docs, no_docs):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    docs = spark.createDataFrame([(ids[0], None), (ids[1], ""), (ids[2], " \n\t"), (ids[3], "a"), (None, "a a")], "doc_id long, text string")
    made = {r.doc_id: r.text for r in made_periodic(docs).collect()}
    assert [(made[i] or "").split() for i in (*ids[:4], None)] == [[], [], [], ["a"], ["a", "a"]]
    assert made_periodic(edge_docs).columns == edge_docs.columns and made_periodic(edge_docs).count() == edge_docs.count()
    assert made_periodic(no_docs).count() == 0
