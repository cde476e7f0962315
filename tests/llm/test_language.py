import itertools
import random

import numpy as np

from tests.llm.conftest import SCHEMA, prose, row
from variantlake.llm import language as L

STEMS = {"en": "the and ing of to wh th er", "de": "sch ein der und ung ver ß ü", "ru": "ов на при ст ли не ко по"}


def say(lang, seed, words=60):
    return prose(seed, words, STEMS[lang])


def model(spark):
    rows = [row(i, say(lang, 10 * i + k), lang) for k, lang in enumerate(STEMS) for i in range(40)]
    return L.learn(spark.createDataFrame([*rows, row(999, "x y z", None)], SCHEMA))


def test_viterbi_is_the_best_labelling():
    rng = random.Random(1)
    prior = np.array([-1, 0, -2])

    def value(path, scores):
        return prior[path[0]] + sum(scores[i, p] for i, p in enumerate(path)) - 4 * sum(a != b for a, b in zip(path, path[1:]))

    texts = [np.array([[rng.randint(-9, 0) for _ in range(3)] for _ in range(rng.randint(1, 6))]) for _ in range(60)]
    for scores, labels in zip(texts, L._labels(texts, prior, 4), strict=True):
        best = max(value(p, scores) for p in itertools.product(range(3), repeat=len(scores)))
        assert value(labels.tolist(), scores) == best == value(L.viterbi(scores, prior, 4).tolist(), scores)


def test_whole_and_mixed_texts(spark):
    m = model(spark)
    assert m.languages == ["de", "en", "ru"] and m.script["cyrillic"].tolist() == [False, False, True]
    texts = [say("en", 9001), say("de", 9002), say("ru", 9003), f"{say('en', 9004, 50)}\n{say('de', 9005, 90)}", f"{say('de', 9006, 30)} {say('ru', 9007, 70)}"]
    docs = spark.createDataFrame([row(i, t, None) for i, t in enumerate(texts)], SCHEMA)
    found = {r.doc_id: r.language for r in L.with_language(docs, m).collect()}
    assert [found[i].lang for i in range(5)] == ["en", "de", "ru", "de", "ru"]
    assert all(len(found[i].spans) == 1 and found[i].score == 1.0 for i in range(3))
    assert [(s.lang, s.start) for s in found[3].spans] in ([("en", 0), ("de", 50)], [("en", 0), ("de", 49)], [("en", 0), ("de", 51)])
    assert [s.lang for s in found[4].spans] == ["de", "ru"] and 0.5 < found[4].score < 1


def test_the_short_way_equals_the_stepped_one(spark):
    m = model(spark)
    rng = random.Random(2)
    langs = list(STEMS)
    texts = [" ".join(say(rng.choice(langs), rng.randint(0, 10**6), rng.randint(1, 12)) for _ in range(rng.randint(1, 5))) for _ in range(150)]
    labeller = L.Labeller(m)
    for text, spans in zip(texts, labeller(texts)[2], strict=True):
        scores = labeller.scores[[labeller.index[w] for w in L.words_of(text)]]
        labels = np.concatenate([np.full(s["end"] - s["start"], m.languages.index(s["lang"])) for s in spans])
        value = lambda x: m.prior[x[0]] + scores[np.arange(len(x)), x].sum() - L.SWITCH * (np.diff(x) != 0).sum()
        assert value(labels) == value(L.viterbi(scores, m.prior))


def test_edges(spark, edge_docs, no_docs):
    m = model(spark)
    found = [(r.doc_id, r.language) for r in L.with_language(edge_docs, m).collect()]
    assert len(found) == 11 and L.with_language(no_docs, m).count() == 0
    assert all((x.lang, x.score, x.spans) == ("und", 0.0, []) for doc, x in found if doc in (3, 4, 5))
    assert all(0 <= x.score <= 1 and x.lang in (*m.languages, "und") for _, x in found)
    digits = spark.createDataFrame([row(1, "12 34 — ½²"), row(2, "日本語")], SCHEMA)
    assert [r.language.lang for r in L.with_language(digits, m).orderBy("doc_id").collect()] == ["und", max(m.languages, key=lambda x: m.prior[m.languages.index(x)])]
    nothing = L.learn(no_docs)
    assert nothing.languages == [] and {r.language.lang for r in L.with_language(edge_docs, nothing).collect()} == {"und"}
