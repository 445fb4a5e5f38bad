"""Plan shape of the registered queries: the properties that matter at scale.

* no Python evaluation anywhere (every operator is built-in expressions),
* no cartesian product or nested-loop join,
* the report is one shuffle on the report key, plus one on (cookie, order id)
  for arrive de-duplication, both with map-side partial aggregation,
* scans read only the columns and rows they need.
"""

import contextlib
import io

import pytest

from slotbook.operators.upsert import upsert
from slotbook.plans import report as R
from slotbook.plans.queries import QUERIES
from slotbook.sources.fixture import fixture_lines
from slotbook.specs import ReportConfig

# queries that run a stream or write files while they are built
BUILT_BY_RUNNING = {"scan_log_lines", "arrive_first_per_file", "pending_files", "ledger_prune",
                    "ledger_latest", "source_file_audit", "stream_file_ingest", "stream_report",
                    "updated_keys", "stream_late_data", "batch_timing", "metrics_archive",
                    "report_files_job", "stream_stage_metrics", "stream_arrive_dedup", "two_stage_any_cap",
                    "two_stage_stream_report", "report_changes_stream", "updated_keys_stream", "arrive_any_cap",
                    "stream_scope_metrics", "metrics_stream", "job_from_file"}
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "FlatMapCoGroupsInPandas", "PythonUDF", "MapInArrow")
PAIR_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - BUILT_BY_RUNNING))
def test_no_python_and_no_pairs(spark, sf_dir, name):
    p = plan(QUERIES[name](spark, sf_dir))
    for node in PYTHON_NODES + PAIR_NODES:
        assert node not in p, f"{name}: {node}"


def test_report_is_two_shuffles_with_partial_aggregation(spark, sf_dir):
    p = plan(R.report(fixture_lines(spark, sf_dir), ReportConfig()))
    # Formatted plans list each node once in the header and once in detail;
    # count the detail entries' partitioning lines.
    parts = [ln for ln in p.splitlines() if ln.strip().startswith("Arguments: hashpartitioning(")]
    assert len(parts) == 2, parts
    assert any("slot_ms" in ln for ln in parts)                                  # the report key
    assert any("cookie" in ln and "dedup_order_id" in ln for ln in parts)        # arrive dedup
    assert "partial_sum" in p and "partial_min" in p                             # map-side combine
    assert "Join" not in p and "Window" not in p


def test_upsert_is_union_and_one_shuffle(spark, sf_dir):
    ls = fixture_lines(spark, sf_dir)
    a = R.report(ls.where("early"), ReportConfig())
    b = R.report(ls.where("NOT early"), ReportConfig())
    p = plan(upsert(a, b))
    assert "Join" not in p
    assert "Union" in p


def test_scans_prune_columns_and_push_filters(spark, sf_dir):
    p = plan(QUERIES["url_domain"](spark, sf_dir))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in p   # the html column is not read
    p = plan(QUERIES["agg_click"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in p
    assert "value:double" not in p                                 # click lines carry no cost


def test_dedup_is_an_aggregate_not_a_window(spark, sf_dir):
    p = plan(QUERIES["arrive_first"](spark, sf_dir))
    assert "Window" not in p and "row_number" not in p
    assert "partial_min" in p
