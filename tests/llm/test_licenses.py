import random
import re

from tests.llm.conftest import SCHEMA, prose, row
from variantlake.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_matching_statistics_match_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        sequences = [[rng.randint(0, 2) for _ in range(rng.randint(1, 8))] for _ in range(rng.randint(1, 4))]
        automaton = L.SuffixAutomaton(sequences)
        known = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        text = [rng.randint(0, 3) for _ in range(30)]
        for i, (state, length) in enumerate(automaton.statistics(text)):
            longest = 0
            while longest <= i and tuple(text[i - longest : i + 1]) in known:
                longest += 1
            assert length == longest
            words = tuple(text[i + 1 - length : i + 1])
            if words:
                ends = [(n, k + length) for n, s in enumerate(sequences) for k in range(len(s) - length + 1) if tuple(s[k : k + length]) == words]
                assert automaton.ends[state] == sorted(ends)


def scan(spark, texts):
    docs = spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], SCHEMA)
    return {r.doc_id: r.licenses for r in L.with_licenses(docs).collect()}


def test_phrases_and_words_by_the_letter(spark):
    rng = random.Random(2)
    parts = ["cc", "by", "CC-BY", "general", "Public", "license", "all", "rights", "reserved", "É", "x9", "ſ", "K", "the", "İ"]
    texts = [rng.choice(" ,.\n").join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    for i, found in scan(spark, texts).items():
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in texts[i]))
        places = [(label, k) for phrase, label in L.PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        assert found.n_words == len(words)
        assert sorted((p.label, p.start) for p in found.places) == sorted(places)


def test_templates_are_covered_in_chained_spans(spark):
    notice = L.TEMPLATES["mit"][1]
    words = notice.split()
    texts = [
        f"{prose(1, 50)} {notice} {prose(2, 50)}",
        " ".join([*words[:20], "(really)", *words[20:24], "ALL", *words[24:]]),  # words put in between
        " ".join(words[:10]),  # too little
        prose(3, 5000),
        "Licensed under the Apache License, Version 2.0. " * 3,
    ]
    found = scan(spark, texts)
    assert [(s.label, s.start) for s in found[0].spans] == [("mit", 50)] and found[0].score == 1.0
    assert [s.label for s in found[1].spans] == ["mit"] and 0.7 <= found[1].score <= 1
    assert found[2].spans == [] and 0 < found[2].score < 0.7
    assert found[3].spans == [] and found[3].score == 0.0
    assert [(s.label, s.start) for s in found[4].spans] == [("apache-2.0", 0), ("apache-2.0", 8), ("apache-2.0", 16)]


def test_edges(edge_docs, no_docs):
    found = [(r.doc_id, r.licenses) for r in L.with_licenses(edge_docs).collect()]
    assert len(found) == 11 and L.with_licenses(no_docs).count() == 0
    assert all(x.n_words == 0 and x.score == 0.0 and x.places == [] and x.spans == [] for doc, x in found if doc in (3, 4, 5))
    assert next(x for doc, x in found if doc == 7).n_words == 60_000
