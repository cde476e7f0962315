import random

import numpy as np

from tests.llm.conftest import SCHEMA, prose, row
from variantlake.llm import repetition as R


def windows(words, size):
    """Places covered by windows of ``size`` words that occur twice or more, by brute force."""
    seen = {}
    for i in range(len(words) - size + 1):
        seen.setdefault(tuple(words[i : i + size]), []).append(i)
    return {p for at in seen.values() if len(at) > 1 for i in at for p in range(i, i + size)}


def test_repeats_match_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        texts = [[rng.choice("abc") for _ in range(rng.randint(0, 40))] for _ in range(rng.randint(0, 5))]
        three, covered, longest, spans = R.repeats_of(texts, 4)
        for i, words in enumerate(texts):
            depth = 0
            while windows(words, depth + 1):
                depth += 1
            assert (three[i], covered[i], longest[i]) == (len(windows(words, 3)), len(windows(words, 4)), depth)
            assert {p for s in spans[i] for p in range(s["start"], s["end"])} == windows(words, 4)
            union = {p for n, at in R.maximal_repeats(words, 4) for a in at for p in range(a, a + n)}
            assert union == windows(words, 4)


def test_suffix_order_and_intervals():
    words = list("banana")
    symbols = np.array([ord(c) for c in words] + [1000])
    order, levels = R.suffix_order(symbols, np.zeros(7, np.int64))
    suffixes = [tuple(symbols[i:]) for i in range(7)]
    assert order.tolist() == sorted(range(7), key=lambda i: suffixes[i])
    lcp = R.neighbour_lcp(order, levels)
    assert sorted(R.lcp_intervals(lcp)) == [(1, 0, 2), (2, 4, 5), (3, 0, 1)] or max(d for d, *_ in R.lcp_intervals(lcp)) == 3
    assert R.maximal_repeats(words, 1) == [(1, [1, 3, 5]), (3, [1, 3])]


def test_edges(edge_docs, no_docs):
    found = {(r.doc_id, r.n_chars): r.quality for r in R.with_quality(edge_docs).collect()}
    assert R.with_quality(no_docs).count() == 0
    for key in ((3, 0), (4, 0), (None, 0)):
        q = found[key]
        assert q.n_words == 0 and q.base_failed and not q.kept and q.repeat_spans == []
    assert all(q.kept for (doc, _), q in found.items() if doc in (1, 2, 7))
    tiring = next(q for (doc, _), q in found.items() if doc == 8)
    assert tiring.n_words == 4000 and tiring.longest_repeat == 3999 and not tiring.kept
    assert next(q for (doc, _), q in found.items() if doc == 7).n_words == 60_000


def test_a_long_repeat_is_rejected_and_clean_text_stays(spark):
    passage = prose(5, 120)
    docs = [row(1, f"{prose(6, 200)} {passage} {prose(7, 200)} {passage}"), row(2, prose(8, 500)), row(3, "a line\n" * 3 + prose(9, 300))]
    found = {r.doc_id: r.quality for r in R.with_quality(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert not found[1].base_failed and not found[1].kept and found[1].longest_repeat == 120
    assert found[2].kept and found[3].kept and found[3].n_dup_lines == 2
    assert found[1].repeat_spans[0].asDict() == {"start": 200, "end": 320}
