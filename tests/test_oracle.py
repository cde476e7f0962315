"""Every registered query against its DuckDB oracle on the smallest fixture scale."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from variantlake.plans.queries import ORACLE, QUERIES

TABLES = ["customer", "nation", "orders", "events"]
SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _rows(cols, rows):
    order = sorted(cols)
    idx = [cols.index(c) for c in order]
    return order, sorted((tuple(_norm(r[i]) for i in idx) for r in rows), key=lambda t: [(x is None, str(x)) for x in t])


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = _rows(sdf.columns, sdf.collect())
    rel = con.sql(E.oracle_sql()[name])
    d_cols, d_rows = _rows(rel.columns, rel.fetchall())
    assert s_cols == d_cols
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in sdf.schema.fields}
    assert s_types == dict(zip(rel.columns, (str(t) for t in rel.types)))
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "conversion_rate_pct" in df.columns
