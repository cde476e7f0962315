"""Alignment against the two libraries and a plain count of pairs."""

import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, models

from tests.conftest import SF_SMALL
from tests.llm.conftest import prose
from variantlake.llm import alignment as A
from variantlake.llm.common import table
from variantlake.llm.queries import QUERIES

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def tokens(libraries, text):
    """[(id, bytes)] of both libraries, or two empty lists."""
    a, b = libraries
    if not text:
        return [], []
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in keep} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in keep)}
    found = a.encode(" " + text, add_special_tokens=False)
    mine = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in found.ids]
    other = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    whole = (" " + text).encode()
    return (mine, other) if b"".join(x for _, x in mine) == whole == b"".join(x for _, x in other) else ([], [])


def brute(libraries, texts):
    """The fields of each text, by walking bytes."""
    parts, corpus = [], Counter()
    for text in texts:
        a, b = tokens(libraries, text)
        of_a = [k for k, (_, x) in enumerate(a) for _ in x]
        of_b = [k for k, (_, x) in enumerate(b) for _ in x]
        links = sorted(set(zip(of_a, of_b, strict=True)))
        pairs = [(a[i][0], b[j][0]) for i, j in links]
        corpus.update(set(pairs))
        groups, left = [], ([], [])
        for at in range(len(of_a)):
            for side, of, ids in ((0, of_a, a), (1, of_b, b)):
                if at + 1 == len(of) or of[at + 1] != of[at]:
                    left[side].append(ids[of[at]][0])
            if all(at + 1 == len(of) or of[at + 1] != of[at] for of in (of_a, of_b)):
                groups.append("|".join(",".join(map(str, s)) for s in left))
                left = ([], [])
        parts.append((len(a), len(b), groups, pairs))
    highest = {}
    for (a, _), n in corpus.items():
        highest[a] = max(n, highest.get(a, 0))
    rows = [
        (na, nb, len(g), len(p), sum(corpus[x] == highest[x[0]] for x in p), sum(corpus[x] for x in p), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for na, nb, g, p in parts
    ]
    return rows, corpus, highest


def noise(seed, n):
    rng = random.Random(seed)
    ranges = [(32, 126), (32, 126), (160, 591), (0x400, 0x4FF), (0x3040, 0x30FF), (0x4E00, 0x9FFF), (0x1F300, 0x1F6FF), (0, 31), (0x2000, 0x206F), (0x2581, 0x2581)]
    out = []
    for _ in range(n):
        low, high = rng.choice(ranges)
        out.append("".join(chr(rng.randint(low, high)) if rng.random() < 0.8 else rng.choice(" \n\t 'ae1.") for _ in range(rng.randint(0, 40))))
    return out


def test_ids_equal_the_libraries(libraries):
    a, b = A.ByteLevel(PATH_A), A.Pieces(PATH_B)
    texts = [t for t in noise(1, 4000) if t] + [prose(1, 300), "a" * 5000, " " * 3000 + "x", "漢字" * 2000, "😀" * 1000, "<|endoftext|> <s> </s>", "x\n\n  y \n"]
    ids, size = a(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == [e.ids for e in libraries[0].encode_batch([" " + t for t in texts], add_special_tokens=False)]
    ids, size = b(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == libraries[1].encode(texts)


def test_every_token_is_what_its_bytes_merge_to():
    held = json.load(open(PATH_A, encoding="utf-8"))
    special = {t["id"] for t in held["added_tokens"]}
    model = Tokenizer(models.BPE(vocab=held["model"]["vocab"], merges=[tuple(m) for m in held["model"]["merges"]]))
    assert all(model.encode(t, add_special_tokens=False).ids == [i] for t, i in held["model"]["vocab"].items() if i not in special)


def test_alignment_equals_brute_force(spark, libraries):
    texts = [*noise(2, 300), *(prose(s, 40, "the and of in to a is") for s in range(40)), *["the and the"] * 30, None, "", "a▁b", "the and the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    expected, corpus, highest = brute(libraries, texts)
    for fan in (A.FAN, 2):  # few merges of many runs, and many merges of two
        found, pairs = A.aligned(docs, PATH_A, PATH_B, fan=fan)
        assert sorted((r.doc_id, *(r.alignment[f] for f in FIELDS)) for r in found.collect()) == sorted((i, *r) for i, r in enumerate(expected))
        assert {(r.a, r.b): (r.documents, r.best) for r in pairs.collect()} == {k: (n, n == highest[k[0]]) for k, n in corpus.items()}


def test_many_batches(spark, libraries, monkeypatch):
    texts = [prose(s, 15, "the and of in") for s in range(60)]
    monkeypatch.setattr(A, "BATCH_DOCS", 4)
    expected, corpus, _ = brute(libraries, texts)
    align, runs = A.Aligner(PATH_A, PATH_B), {}
    for at in range(0, 60, 4):
        _, a, b, of = align(texts[at : at + 4])
        for bucket, pairs, _ in A.runs_of(a, b, of, align.b.size):
            p, n = A._unpacked(pairs)
            runs.setdefault(bucket, []).append((np.cumsum(p), n))
    got = {}
    for bucket, held in runs.items():
        for pairs, counts in A.merged(held, align.b.size):
            got |= {(int(p) // align.b.size * A.BUCKETS + bucket, int(p) % align.b.size): int(c) for p, c in zip(pairs, counts, strict=True)}
    assert got == dict(corpus)


def test_edge_cases(spark, edge_docs, no_docs, libraries):
    found, _ = A.aligned(edge_docs, PATH_A, PATH_B, keep=("doc_id", "text", "block", "n"))
    rows = found.collect()
    assert len(rows) == 11 and all((r.block, r.n) == (3, 2) for r in rows)
    expected, _, _ = brute(libraries, [r.text for r in rows])
    assert [tuple(r.alignment[f] for f in FIELDS) for r in rows] == expected
    found, pairs = A.aligned(no_docs, PATH_A, PATH_B)
    assert found.count() == 0 and pairs.count() == 0


def test_query_equals_brute_force(spark, libraries):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    expected, _, _ = brute(libraries, [d.text for d in docs])
    got = QUERIES["op12_spill_alignment"](spark, SF_SMALL)
    assert sorted((r.doc_id, *(r[f] for f in FIELDS)) for r in got.collect()) == sorted((d.doc_id, *e) for d, e in zip(docs, expected, strict=True))
