import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import SCHEMA, row
from variantlake.llm import class_lm as C

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), ""]


def corpus(n, seed):
    """Two kinds of words that take turns: classes tell more than single words do."""
    rng = random.Random(seed)
    left, right = [f"l{i}" for i in range(40)], [f"R{i}" for i in range(40)]
    return [" ".join(rng.choice(left if k % 2 else right) for k in range(rng.randint(5, 40))) for _ in range(n)]


@pytest.mark.parametrize("frequent", [10, 60, 1000])
def test_scores_match_brute_force(spark, frequent):
    train = [row(i, t) for i, t in enumerate(corpus(60, 1))] + [row(900, None), row(901, "")]
    held = [row(i, t) for i, t in enumerate([*corpus(20, 2), "ſ K É unseen words Here", "", None])]
    model = C.learn(spark.createDataFrame(train, SCHEMA), frequent=frequent, clustered=30, classes=4)
    counts = Counter(w for r in train for w in tokens(r[1]))
    total, distinct = sum(counts.values()), len(counts)
    assert (model.tokens, model.distinct) == (total, distinct)
    by_symbol = {w.decode(): int(model.symbol[i]) for w, i in model.words.items()}
    rest = len(model.label) - 2
    label = lambda w: int(model.label[by_symbol.get(w, rest)])
    for r in C.scored(spark.createDataFrame(held, SCHEMA), model).collect():
        words = tokens(held[r.doc_id][1])
        assert r.n_tokens == len(words) and r.n_known == sum(counts[w] > 0 for w in words)
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
        score = sum(math.log10(counts[w] + 0.1) + model.log_bracket[label(a), label(w)] for a, w in zip(["", *words], words))
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
    # the probabilities of all words and the unknown one add up to one after every class
    for before in range(len(model.log_bracket)):
        mass = sum((counts[w] + 0.1) * 10 ** model.log_bracket[before, label(w)] for w in counts)
        assert mass + 0.1 * 10 ** model.log_bracket[before, int(model.label[rest])] == pytest.approx(1.0)


def test_classes_beat_single_words_on_held_out_texts(spark):
    model = C.learn(spark.createDataFrame([row(i, t) for i, t in enumerate(corpus(300, 3))], SCHEMA), clustered=80, classes=3)
    found = C.scored(spark.createDataFrame([row(i, t) for i, t in enumerate(corpus(50, 4))], SCHEMA), model).collect()
    assert sum(r.score for r in found) > sum(r.base_score for r in found) + 0.1 * sum(r.n_tokens for r in found)
    of = {w.decode()[:1]: {int(model.label[model.symbol[i]]) for v, i in model.words.items() if v[:1] == w[:1]} for w in model.words if w}
    assert not of["l"] & of["r"]


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(5)
    pairs = rng.poisson(2.0, (20, 20)) + 30 * (np.add.outer(np.arange(20), np.arange(20)) % 2)

    def likelihood(label):
        kinds = label.max() + 1
        table = np.zeros((kinds, kinds))
        np.add.at(table, (label[:, None], label[None, :]), pairs)
        log = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        return log(table) - log(table.sum(axis=0)) - log(table.sum(axis=1))

    begin = np.concatenate([np.arange(16) % 3, np.arange(3, 7)])
    found = C.exchange(pairs, 16, 3)
    assert found[16:].tolist() == [3, 4, 5, 6] and likelihood(found) > likelihood(begin)
    for w in range(16):  # no single move is better
        for c in range(3):
            other = found.copy()
            other[w] = c
            assert likelihood(other) <= likelihood(found) + 1e-6


def test_edges(edge_docs, no_docs):
    model = C.learn(edge_docs)
    found = C.scored(edge_docs, model).collect()
    assert len(found) == 11 and all(math.isfinite(r.score) and r.score <= 0 for r in found)
    assert sorted(r.n_tokens for r in found if r.doc_id in (3, 4, 5)) == [1, 1, 1]
    assert C.scored(no_docs, model).count() == 0
    unknown = C.scored(edge_docs, C.learn(no_docs)).collect()
    assert all(r.n_known == 0 and math.isfinite(r.score) for r in unknown)


def test_every_word_above_the_count_gets_its_class_by_exchange(spark):
    rare = [row(900 + i, "l1 seldom R1") for i in range(C.LEAST - 1)]
    model = C.learn(spark.createDataFrame([row(i, t) for i, t in enumerate(corpus(300, 3))] + rare, SCHEMA), clustered=10, classes=2)
    of = {w.decode(): int(model.label[model.symbol[i]]) for w, i in model.words.items() if w}
    assert len(of) == 80 and "seldom" not in of  # far more than the ten that are clustered first
    assert len({c for w, c in of.items() if w[0] == "l"}) == len({c for w, c in of.items() if w[0] == "r"}) == 1
    assert set(of.values()) == {0, 1}


def test_the_memory_of_words_changes_no_score_and_no_class(spark):
    train = spark.createDataFrame([row(i, t) for i, t in enumerate(corpus(60, 1))], SCHEMA)
    held = spark.createDataFrame([row(i, t) for i, t in enumerate([*corpus(20, 2), "unknown l1"])], SCHEMA)
    models = [C.learn(train, frequent=n, clustered=30, classes=4) for n in (5, 1000)]
    few, many = (sorted((r.doc_id, r.n_known, r.base_score, r.score) for r in C.scored(held, m).collect()) for m in models)
    assert (models[0].symbol == models[1].symbol).all()
    assert few == [pytest.approx(r) for r in many]


def test_gain_of_a_move_is_the_change_of_the_likelihood():
    rng = np.random.default_rng(8)
    pairs, label = rng.poisson(1.5, (12, 12)).astype(float), np.arange(12) % 4

    def likelihood(label):
        table = np.zeros((4, 4))
        np.add.at(table, (label[:, None], label[None, :]), pairs)
        return table, sum(k * C._entropy(x).sum() for k, x in ((1, table), (-1, table.sum(axis=0)), (-1, table.sum(axis=1))))

    table, begin = likelihood(label)
    of = np.eye(4)[label]
    for w in range(12):
        for new in set(range(4)) - {label[w]}:
            other = label.copy()
            other[w] = new
            gain = C._gains(table, pairs[[w]] @ of, pairs.T[[w]] @ of, np.diag(pairs)[[w]], label[[w]], np.array([new]))
            assert gain[0] == pytest.approx(likelihood(other)[1] - begin)


@pytest.mark.parametrize("more", [{}, {"block_tokens": 400}, {"block_tokens": 100, "step": 4}], ids=["one block", "blocks", "many blocks"])
def test_rounds_over_blocks_come_near_the_exchange_of_single_words(spark, more):
    """Zipf words with four hidden kinds; counts of class pairs are exact however the words are dealt."""
    rng = np.random.default_rng(11)
    weight = 1 / np.arange(1, 31)
    words = [f"w{(i % 30) * 4 + i // 30}" for i in range(120)]
    texts = []
    for i in range(200):
        kinds = (np.cumsum(rng.choice(3, 30, p=[0.8, 0.1, 0.1]) + 1) + i) % 4
        texts.append(" ".join(words[30 * k + j] for k, j in zip(kinds, rng.choice(30, 30, p=weight / weight.sum()), strict=True)))
    model = C.learn(spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], SCHEMA), clustered=10, classes=4, **more)
    code, rest = {w.decode(): i for w, i in model.words.items()}, len(model.symbol) - 2
    pairs = np.zeros((rest + 2, rest + 2))
    for t in texts:
        of = [code.get(w, rest) for w in ["", *tokens(t)]]
        np.add.at(pairs, (of[:-1], of[1:]), 1)
    of = np.eye(6)[model.symbol]
    assert (of.T @ pairs @ of == model.between).all()
    assert C._likelihood(model.between) == pytest.approx(max(model.likelihoods))
    single, joined = C._likelihood(pairs), C._likelihood(np.full((1, 1), pairs.sum()))
    best = C.exchange(pairs, rest, 4)
    at_best = C._likelihood(np.eye(6)[best].T @ pairs @ np.eye(6)[best])
    assert joined < C._likelihood(model.between) < single
    assert C._likelihood(model.between) - joined > 0.9 * (at_best - joined)
