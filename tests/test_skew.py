"""Hot groups: one arrival group and one report key each hold about a third
of all rows.  The report must stay exact (checked against the DuckDB
oracle over the same skewed table) and the groups must be combined on the
map side, never collected into one task."""

from collections import Counter

import duckdb
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq

from slotbook.plans.oracle_queries import ORACLES
from slotbook.plans.queries import QUERIES


def _skewed_events(src: str, dst: str, copies: int) -> None:
    """events + ``copies`` repeats of one purchase row (same cookie and
    order, so one arrival group; increasing times) and of one view row (one
    report key), each with a new event id."""
    table = pq.read_table(f"{src}/events.parquet")
    ev = table.to_pandas()
    k = ev["props"].str.extract(r"(-?[0-9]+)", expand=False).astype("int64")
    # a purchase inside the five-minute arrival window (k <= 50, k % 13 != 0)
    purchase = ev[(ev["event_type"] == "purchase") & (k <= 50) & (k % 13 != 0)].head(1)
    view = ev[ev["event_type"] == "view"].head(1)
    top = int(ev["event_id"].max())
    hot_arrivals = purchase.loc[purchase.index.repeat(copies)].reset_index(drop=True)
    hot_arrivals["event_id"] = range(top + 1, top + 1 + copies)
    # later copies arrive later (within ten minutes): the earliest must be kept
    hot_arrivals["ts"] = hot_arrivals["ts"] + pd.to_timedelta([j % 600 for j in range(copies)], "s")
    hot_views = view.loc[view.index.repeat(copies)].reset_index(drop=True)
    hot_views["event_id"] = range(top + 1 + copies, top + 1 + 2 * copies)
    out = pd.concat([ev, hot_arrivals, hot_views], ignore_index=True)
    pq.write_table(pa.Table.from_pandas(out, schema=table.schema, preserve_index=False),
                   f"{dst}/events.parquet")


def _rows(cols, rows):
    norm = lambda v: "NULL" if v is None else repr(float(v)) if isinstance(v, float) else str(v)
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in idx) for r in rows)


def test_hot_groups_stay_exact(spark, sf_dir, tmp_path):
    n = pq.read_metadata(f"{sf_dir}/events.parquet").num_rows
    _skewed_events(sf_dir, str(tmp_path), copies=n // 2)   # each hot group ~1/3 of all rows
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet')")
    for name in ("report_batch", "arrive_first", "agg_arrive", "agg_expose"):
        df = QUERIES[name](spark, str(tmp_path))
        got = _rows(df.columns, [tuple(r) for r in df.collect()])
        rel = con.sql(ORACLES[name])
        want = _rows(rel.columns, rel.fetchall())
        assert sorted(df.columns) == sorted(rel.columns), name
        assert got == want, name
    # the hot view key really is hot: one report row carries ~a third of all lines
    top = QUERIES["agg_expose"](spark, str(tmp_path)).agg({"expose_cnt": "max"}).first()[0]
    assert top >= n // 2
