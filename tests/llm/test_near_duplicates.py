from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import SCHEMA, prose, row
from variantlake.llm import near_duplicates as N
from variantlake.llm.common import words_of
from variantlake.llm.components import connected_components


def shingles(text, n=5):
    words = words_of(text)
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute(rows, threshold=0.8):
    """(links, least id of the component) of each row, by comparing all pairs."""
    sets = [shingles(r[1]) for r in rows]
    links, root = Counter(), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)].append(r[0])
    return [(r[0], min(least[find(i)], default=None), links[i]) for i, r in enumerate(rows)]


def edited(text, places):
    words = text.split()
    for p in places:
        words[p] = f"new{p}"
    return " ".join(words)


def corpus():
    base = [prose(100 + i, 60 + 20 * i) for i in range(12)]
    rows = [row(i, t) for i, t in enumerate(base)]
    rows += [row(100 + i, edited(t, [5])) for i, t in enumerate(base)]  # near copies, some below the threshold
    rows += [row(200 + i, edited(t, [5, 30])) for i, t in enumerate(base)]
    rows += [row(300 + i, base[3]) for i in range(20)]  # a group of copies
    rows += [row(400 + i, edited(base[11], [7 * i + 3])) for i in range(30)]  # a group of near copies
    rows += [row(500, "one two"), row(501, "one two"), row(502, "two one"), row(503, base[0].upper())]
    return rows


@pytest.mark.parametrize("block", [512, 7])
def test_links_and_classes_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)  # small blocks: a component is compared by several tasks
    rows = corpus()
    found = N.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in found) == sorted(brute(rows))


def test_edges(edge_docs, edge_rows, no_docs):
    found = N.near_duplicates(edge_docs).collect()
    key = lambda t: tuple((x is None, x or 0) for x in t)
    expected = [(r[0], c if r[1] and r[1].strip(" \n\t") else r[0], n) for r, (_, c, n) in zip(edge_rows, brute(edge_rows), strict=True)]
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in found), key=key) == sorted(expected, key=key)
    assert N.near_duplicates(no_docs).count() == 0
    kept = N.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and sorted(i for i in ids if i) == [1, 3, 4, 5, 6, 7, 8]
    assert N.one_of_each(no_docs).count() == 0


def test_prefix_is_as_long_as_the_recall_allows():
    depth = N.prefix_length()
    miss = lambda d: (1 - N.THRESHOLD**d) ** N.TREES
    assert miss(depth) <= 1 - N.RECALL < miss(depth + 1)
    forest = N.Forest(N.TREES, depth)
    rng = np.random.default_rng(1)
    met = 0
    for _ in range(300):  # pairs at the threshold: 80 of 100 shared
        values = rng.integers(0, 1 << 63, 100, np.uint64)
        met += bool((forest(np.sort(values[:90])) == forest(np.sort(values[10:]))).any())
    assert met >= 299


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (7, 7), (300, 300)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert {found[i] for i in range(41)} == {0} and found[200] == found[100] == 100 and found[300] == 300
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
