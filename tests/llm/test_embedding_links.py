"""Embedding links against all pairs in double precision."""

import math

import numpy as np
import pytest

from variantlake.llm import embedding_links as L
from variantlake.llm.common import table
from variantlake.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, node string, copies int, links string, block int, component string"


def brute(rows):
    """(vec_id, n_links, component_id, kept) of rows (vec_id, embedding, label), all pairs."""
    n = len(rows)
    unit = []
    for _, e, label in rows:
        good = label is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)
        unit.append(np.float32(e).astype(float) / np.linalg.norm(np.float32(e).astype(float)) if good else None)
    near = [
        [j for j in range(n) if j != i and u is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(u) == len(unit[j]) and u @ unit[j] >= L.THRESHOLD]
        for i, u in enumerate(unit)
    ]
    out = []
    for i in range(n):
        seen, stack = {i}, [i]
        while stack:
            for j in near[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), least, rows[i][0] is not None and rows[i][0] == least))
    return sorted(out, key=str)


def made(spark, rows):
    return spark.createDataFrame([(*r, "n", 3, "l", 1, "c") for r in rows], SCHEMA).repartition(3)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def near_copies(seed, dim, groups, each, noise):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.standard_normal(dim)
        for _ in range(each):
            rows.append((len(rows), (centre + noise * rng.standard_normal(dim) * np.linalg.norm(centre) / math.sqrt(dim)).tolist(), g % 3))
    return rows


@pytest.mark.parametrize("noise", [0.02, 0.1, 0.14])  # far above, about, and around the threshold
def test_links_equal_all_pairs(spark, noise):
    rows = near_copies(1, 48, 12, 25, noise)
    assert got(L.embedding_links(made(spark, rows))) == brute(rows)


def test_a_large_group_is_compared_in_blocks(spark):
    rows = near_copies(2, 32, 2, 150, 0.05)
    assert got(L.embedding_links(made(spark, rows), block=16)) == brute(rows)


def test_bucket_keys_of_many_bits(spark, monkeypatch):
    """As many bits as a label of 8,193 classes or more has; the first byte of a key was read as its sign."""
    monkeypatch.setattr(L, "BY_CHANCE", 1)
    rows = near_copies(3, 48, 6, 100, 0.1)
    assert L.sizes(200)[0] == 8
    assert got(L.embedding_links(made(spark, rows))) == brute(rows)


@pytest.mark.parametrize("wanted", [0, L.WANTED])  # the vectors read again are filtered first, or not
def test_buckets_over_many_batches(spark, monkeypatch, wanted):
    monkeypatch.setattr(L, "WANTED", wanted)
    rows = [*near_copies(4, 32, 40, 8, 0.05), *((1000 + i, e, label) for i, e, label in near_copies(5, 32, 3, 60, 0.1)), (2000, [1.0, 3.0], 1)]
    rows += [(2001, [1.0, None, 3.0], 1), (2002, [None, 1.0, 3.0], 1), (2003, [1.0, 3.0], 1)]  # no digest of theirs is another's
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert got(L.embedding_links(made(spark, rows), block=16)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_signs_within_the_cut():
    """A pair at the threshold differs in more signs in less than one case in a million, others nearly always do."""
    unlike = math.acos(L.THRESHOLD) / math.pi
    beyond = lambda k, p: sum(math.comb(128, i) * p**i * (1 - p) ** (128 - i) for i in range(k + 1, 129))
    most = L.cut(L.THRESHOLD)
    assert beyond(most, unlike) < 3e-7 < beyond(most - 1, unlike)
    assert 1 - beyond(most, 0.5) < 1e-11


def test_nulls_zeros_copies_lengths_and_ties(spark, tmp_path):
    a, b = [1.0, 2.0, 3.0, 4.0], [4.0, -3.0, 2.0, -1.0]
    rows = [
        (1, a, 1),
        (1, a, 1),  # the whole row again
        (2, a, 1),
        (3, a, 2),  # another label
        (4, a, None),
        (5, None, 1),
        (6, [], 1),
        (7, [0.0] * 4, 1),
        (8, [1.0, None, 3.0, 4.0], 1),
        (9, [1.0, float("nan"), 3.0, 4.0], 1),
        (10, [1.0, float("inf"), 3.0, 4.0], 1),
        (11, [x * 1e30 for x in a], 1),  # the same direction
        (12, [x * 1e-30 for x in a], 1),
        (13, [1.0, 2.0, 3.0], 1),  # another length
        (14, [-x for x in a], 1),
        (None, a, 1),
        (None, b, 2),
        (15, b, 2),
        (16, [5.0], 1),
        (17, [6.0], 1),
        (18, [0.0, 5.0], 2),
        (19, [-0.0, 5.0], 2),
    ]
    assert got(L.embedding_links(made(spark, rows))) == brute(rows)
    assert L.embedding_links(made(spark, [])).count() == 0


def test_query_over_the_given_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, "/root/testdata/sf0.01", "embeddings").collect()]
    assert got(QUERIES["op11_rotation_codes"](spark, "/root/testdata/sf0.01")) == brute(rows)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(5)
    x = rng.standard_normal(64)
    x /= np.linalg.norm(x)
    across = rng.standard_normal(64)
    across -= across @ x * x
    across /= np.linalg.norm(across)
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * across
    errors = []
    for dim_seed in range(400):
        turn = np.linalg.qr(np.random.default_rng(dim_seed).standard_normal((64, 64)))[0]
        codes = L.Codes(64, 6, 4)
        codes.rotations = [turn]
        code, factor, coded, step, _ = codes(np.array([x, y]))
        signs = np.unpackbits(code[0])[:64] * 2.0 - 1
        errors.append(signs @ coded[1] * step[1] / 8 / factor[0] - 0.98)
        assert errors[-1] >= -L.bound(64, factor[0], step[1], 0.98)
    assert abs(np.mean(errors)) < 4 * np.std(errors) / 20
