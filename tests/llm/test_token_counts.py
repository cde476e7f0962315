import random

import public_tokenizers
import pytest
import sentencepiece

from variantlake.llm import token_counts as T

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_counts_equal_the_library(library, monkeypatch):
    monkeypatch.setattr(T, "CACHED", 20_000)  # the memory starts anew on the way
    rng = random.Random(1)
    alphabets = [" \n\tabcthe", "  ▁▁a\x00é日本语ß<s>0x", "the of and in er on re st", "0123456789abcdef", "aaaa  b", "éèçàñüö .,;:!?'\"()"]
    texts = ["", " ", "  ", "<s>", "</s> <unk> <0x0A>", "\x00", "😀😀", "​ x", " " * 100, "a" * 1000, "=-" * 300, "the" * 500]
    texts += ["".join(rng.choice(a) for _ in range(rng.randint(0, 300))) for a in alphabets for _ in range(400)]
    count = T.CountingTransducer(PATH)
    got = [n for i in range(0, len(texts), 100) for n in count(texts[i : i + 100]).tolist()]
    assert got == [len(library.encode(t)) for t in texts]


def test_maps_compose_at_any_cut(library):
    count = T.CountingTransducer(PATH)
    text = "▁internationalisation=0123456789abcdefghe"
    whole = count.run(0, text)
    for cut in range(len(text)):
        state, emitted = count.run(0, text[:cut])
        end, more = count.run(state, text[cut:])
        assert (end, emitted + more) == whole
    assert whole[1] == len(library.encode(text[1:]))


def test_edges(edge_docs, no_docs, library):
    rows = T.with_token_counts(edge_docs, PATH).collect()
    assert [(r.tokens.n_bytes, r.tokens.n_tokens) for r in rows] == [(len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in rows]
    assert T.with_token_counts(no_docs, PATH).count() == 0


def test_very_long_runs_of_any_alphabet(library):
    rng = random.Random(3)
    alphabets = ["😀", "漢字", "0123456789", "กขคงจ", "한국어글자", "ш", "𝒳𝒴", "ab", "=-_", "é", "\u200b", "▁", "\x01\x02"]
    texts = [(a * 100_000)[:100_000] for a in alphabets] + ["".join(rng.choice(a) for _ in range(100_000)) for a in alphabets[:6]]
    count = T.CountingTransducer(PATH)
    assert count(texts).tolist() == [len(library.encode(t)) for t in texts]
    assert max(map(len, count.chunks), default=0) <= T.PART  # no long text is remembered
