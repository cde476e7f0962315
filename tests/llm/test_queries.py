"""Registered queries: SQL oracles, and the pipeline against stage-by-stage expectations."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_near_duplicates import brute
from variantlake.llm.common import table
from variantlake.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(ORACLE[name])
    order = sorted(got.columns)
    assert order == sorted(rel.columns)
    expected = sorted(tuple(r[rel.columns.index(c)] for c in order) for r in rel.fetchall())
    assert sorted(tuple(r[c] for c in order) for r in got.collect()) == expected


def test_all_eleven_queries_are_registered():
    names = E.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names


def test_near_duplicates_of_the_small_table(spark):
    docs = table(spark, SF_SMALL, "documents").collect()
    got = QUERIES["op7_minhash_forest_join"](spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == sorted(brute([(d.doc_id, d.text) for d in docs]))


def test_pipeline_stages(spark, edge_docs, no_docs):
    docs = table(spark, SF_SMALL, "documents")
    held = {r.doc_id: r.text for r in docs.collect()}
    for (name, stage), check in zip(corpus_pipeline.STAGES, ("fewer", "fewer", "fewer", "same", "pieces"), strict=True):
        kept = stage(spark, docs, SF_SMALL)
        rows = {r.doc_id: r for r in kept.collect()}
        if check == "pieces":
            assert kept.columns[:4] == ["doc_id", "piece", "start", "length"] and rows.keys() == held.keys()
            continue
        assert kept.columns == docs.columns and rows.keys() <= held.keys() and rows
        if check == "same":
            assert rows.keys() == held.keys() and all(r.n_chars == len(r.text) for r in rows.values())
        else:
            assert all(r.text == held[i] for i, r in rows.items())
        docs, held = spark.createDataFrame(list(rows.values()), docs.schema), {i: r.text for i, r in rows.items()}
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, edge_docs, SF_SMALL).collect()
        assert stage(spark, no_docs, SF_SMALL).count() == 0
