import random

import numpy as np

from tests.llm.conftest import SCHEMA, prose, row
from variantlake.llm import decontaminate as D


def brute(text, item, least):
    """Greedy string tiling as first published: all matches anew for each tile."""
    free_text, free_item, out = [True] * len(text), [True] * len(item), []
    while True:
        best = None
        for j in range(len(item)):
            for i in range(len(text)):
                n = 0
                while i + n < len(text) and j + n < len(item) and free_text[i + n] and free_item[j + n] and text[i + n] == item[j + n]:
                    n += 1
                if n >= least and (best is None or (-n, j, i) < best):
                    best = -n, j, i
        if best is None:
            return out
        n, j, i = -best[0], best[1], best[2]
        free_text[i : i + n] = [False] * n
        free_item[j : j + n] = [False] * n
        out.append((i, j, n))


def test_tiles_match_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        text = [rng.randint(0, 3) for _ in range(rng.randint(0, 40))]
        item = [rng.randint(0, 3) for _ in range(rng.randint(1, 25))]
        assert D.tiles(np.array(text, np.int64), np.array(item, np.int64), 3) == brute(text, item, 3)


def test_window_hashes_tell_windows_apart():
    rng = random.Random(3)
    for _ in range(100):
        codes = [rng.randint(0, 3) for _ in range(rng.randint(0, 30))]
        size = rng.randint(1, 12)
        windows = [tuple(codes[i : i + size]) for i in range(len(codes) - size + 1)]
        hashes = D.window_hashes(np.array(codes, np.int64), size).tolist()
        assert len(hashes) == len(windows) and len(set(zip(hashes, windows, strict=True))) == len(set(windows)) == len(set(hashes))


def found(docs, benchmark, **options):
    return {r.doc_id: {x.item_id: x for x in r.leaks} for r in D.with_leaks(docs, benchmark, **options).collect()}


def test_whole_reordered_and_edited_passages(spark):
    item = prose(1, 40, "qa wb ec rd te yf ug")
    words = item.split()
    halves = " ".join(words[20:] + ["between"] + words[:20])
    benchmark = spark.createDataFrame([(7, item), (7, item), (8, prose(2, 30, "zu hv jw")), (9, "solo item"), (10, None), (11, "")], "item_id long, text string")
    docs = [
        row(1, f"{prose(3, 300)} {item.upper()}, {prose(4, 200)}"),
        row(2, f"{prose(5, 100)} {halves} {prose(6, 50)}"),
        row(3, f"{prose(7, 100)} {' '.join(words[:12])} {prose(8, 100)}"),  # less than half: clean
        row(4, prose(9, 2000)),
        row(5, "this solo, item here"),
    ]
    hits = found(spark.createDataFrame(docs, SCHEMA), benchmark)
    assert {d: sorted(x) for d, x in hits.items()} == {1: [7], 2: [7], 3: [], 4: [], 5: [9]}
    assert hits[1][7].coverage == 1.0 and hits[1][7].longest_tile == 40
    assert hits[2][7].coverage == 1.0 and sorted(t.words for t in hits[2][7].tiles) == [20, 20]
    # many blocks of items, the same result
    blocks = found(spark.createDataFrame(docs, SCHEMA), benchmark, block_chars=200)
    assert {d: sorted(x) for d, x in blocks.items()} == {d: sorted(x) for d, x in hits.items()}


def test_edges(spark, edge_docs, no_docs):
    benchmark = spark.createDataFrame([(1, "la la la la la la"), (2, prose(1, 80)[:200])], "item_id long, text string")
    hits = [(r.doc_id, sorted(x.item_id for x in r.leaks)) for r in D.with_leaks(edge_docs, benchmark).collect()]
    assert hits.count((1, [2])) == 2 and (2, [2]) in hits and (8, [1]) in hits
    assert all(not items for doc, items in hits if doc in (3, 4, 5, 6, 7))
    assert D.with_leaks(no_docs, benchmark).count() == 0
    assert all(not r.leaks for r in D.with_leaks(edge_docs, benchmark.limit(0)).collect())
