import random
import re

from tests.llm.conftest import SCHEMA, prose, row
from variantlake.llm import secrets as S


def key(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


HEXES, UPPER = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def credentials(n=300):
    rng = random.Random(4)
    docs = [row(i, f'{prose(i, 40)} token = "{key(rng, HEXES, 40)}" {prose(i + 1, 30)} AKIA{key(rng, UPPER, 16)} end') for i in range(n)]
    return docs


def test_base_spans_by_the_letter():
    text = "x Token: abc password='0123456789ab' AKIA1234567890ABCD AKIAX secret=token=abcdefghijkl 0123456789abcdef0 ſecret=abcdefghijklmn"
    whole = re.compile(S.ASSIGN.pattern, re.I | re.A)
    expected = [(m.start(), 0, m.end()) for m in whole.finditer(text) if len(m[2]) >= 12]
    expected += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    expected += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    assert [s[:3] for s in S.base_spans(text)] == sorted(expected)
    assert [text[s:e] for s, rank, e, _ in S.base_spans(text) if rank == 0] == ["password='0123456789ab", "secret=token=abcdefghijkl"]


def test_automaton_learns_a_format():
    rng = random.Random(5)
    words = ["A" + key(rng, "0", 3) + "-" + key(rng, "ag", rng.choice([4, 6])) for _ in range(300)]
    learned = S.Automaton(sorted(words))
    assert learned.reached[0] == 300 and len(learned.red) < 20
    assert learned.bits("A000-agag") > learned.bits("A000agag-") + 1
    assert learned.bits("A000-agag") > learned.bits("GGGGGGGGG") + 3


def test_learned_formats_find_more_and_leave_prose_alone(spark):
    rng = random.Random(6)
    lone = key(rng, HEXES.upper().replace("A", "a").replace("B", "b"), 15)  # no base pattern fits
    docs = spark.createDataFrame(credentials(), SCHEMA)
    formats = S.learn_formats(docs)
    assert set(formats.kinds) == {"assign", "access", "hex"}
    assert formats.kind(key(rng, HEXES, 40)) is not None
    assert all(formats.kind(w) is None for w in ("internationalisation", "well-established-practice", "Donaudampfschiffahrt"))
    probe = spark.createDataFrame([row(1, f"see {key(rng, HEXES, 39).upper().lower()[:15]}g0{key(rng, HEXES, 15)} {lone}"), row(2, prose(99, 3000))], SCHEMA)
    found = {r.doc_id: r.secrets for r in S.with_secrets(probe, formats).collect()}
    assert found[2].base == [] and found[2].learned == []
    assert all(s.kind.startswith("like_") for s in found[1].learned)


def test_redaction_masks_every_span(spark):
    docs = spark.createDataFrame(credentials(40), SCHEMA)
    formats = S.learn_formats(docs)
    masked = S.redacted(docs, formats)
    assert masked.columns == docs.columns
    for r in masked.collect():
        assert S.base_spans(r.text) == [] and r.text.count("[SECRET]") == 2 and r.text.endswith(" end")
    clean = spark.createDataFrame([row(1, prose(7, 500))], SCHEMA)
    assert S.redacted(clean, formats).first().text == prose(7, 500)


def test_edges(edge_docs, no_docs):
    formats = S.learn_formats(edge_docs)
    assert formats.kinds == {} and S.learn_formats(no_docs).kinds == {}
    found = S.with_secrets(edge_docs, formats).collect()
    assert len(found) == 11 and all(r.secrets.base == [] and r.secrets.learned == [] for r in found)
    assert S.with_secrets(no_docs, formats).count() == 0
    texts = sorted(str(r.text) for r in S.redacted(edge_docs, formats).collect())
    assert texts == sorted(str(r.text) for r in edge_docs.collect())
