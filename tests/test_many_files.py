"""File queries when the fixture has more files per log type than the
minimum: the rule that sizes files is lowered so that the smallest table
renders 13 files per type (names beyond ``9.log``), and the file queries
are checked against their oracles under the same rule."""

from collections import Counter

import duckdb
import pytest

from slotbook.plans.oracle_queries import ORACLES
from slotbook.plans.queries import QUERIES
from slotbook.sources import fixture as FX

FILE_QUERIES = ("scan_log_lines", "source_file_audit", "pending_files", "ledger_prune",
                "ledger_latest", "arrive_first_per_file", "report_files_job")


def _rows(cols, rows):
    norm = lambda v: "NULL" if v is None else repr(float(v)) if isinstance(v, float) else str(v)
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in idx) for r in rows)


@pytest.fixture
def many_files(monkeypatch):
    old_sql = FX.FILES_SQL
    monkeypatch.setattr(FX, "ROWS_PER_FILE", 80)
    new_sql = old_sql.replace(f"/ {1_000_000}.0", "/ 80.0")
    assert new_sql != old_sql
    monkeypatch.setattr(FX, "FILES_SQL", new_sql)
    monkeypatch.setattr(FX, "_FILE_CACHE", {})
    return old_sql, new_sql


def test_file_queries_with_many_files(spark, sf_dir, many_files):
    old_sql, new_sql = many_files
    assert FX.files_per_type(spark, sf_dir) == 13
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf_dir}/events.parquet')")
    for name in FILE_QUERIES:
        df = QUERIES[name](spark, sf_dir)
        got = _rows(df.columns, [tuple(r) for r in df.collect()])
        rel = con.sql(ORACLES[name].replace(old_sql, new_sql))
        assert sorted(df.columns) == sorted(rel.columns), name
        assert got == _rows(rel.columns, rel.fetchall()), name
    names = {r[0] for r in QUERIES["source_file_audit"](spark, sf_dir).select("file_name").collect()}
    assert "12.log" in names
