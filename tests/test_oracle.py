"""Every registered query against its DuckDB oracle on the smallest tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E

TABLES = "events pages documents embeddings conversations benchmark labels".split()


def norm(v):
    return "NULL" if v is None else repr(float(v)) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = E.queries()[name](spark, sf_dir)
    cols = df.columns
    rows = Counter(tuple(norm(r[c]) for c in sorted(cols)) for r in df.collect())
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == sorted(cols)
    idx = [rel.columns.index(c) for c in sorted(cols)]
    orows = Counter(tuple(norm(r[i]) for i in idx) for r in rel.fetchall())
    assert rows == orows


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "cost" in df.columns and "start_time" in df.columns
