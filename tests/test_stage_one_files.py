"""Files that stage one of two writes of a batch (T6): by its lines, whatever the log types and partitions."""

from slotbook import session as S
from slotbook.operators.upsert import ReportStore
from slotbook.plans.queries import topic_records
from slotbook.sources.fixture import write_fixture_files
from slotbook.sources import files as FS
from slotbook.specs import ReportConfig
from slotbook.streaming import report_stream as RS

CFG = ReportConfig(dedup_scope="stream")


def parts(spark, topic):
    return [p for d in S.list_dirs(spark, topic) for p in S.list_files(spark, d)]


def test_records_of_a_batch_are_few_files(spark, sf_dir, monkeypatch):
    root = write_fixture_files(spark, sf_dir)
    lines = FS.scan_lines(spark, root)
    reports = []
    for per_file, files in ((1_000_000, 1), (300, -(-lines.count() // 300))):
        monkeypatch.setattr(RS, "LINES_PER_FILE", per_file)
        topic = S.scratch_path(spark, "t-few")
        RS.run_delta_stream(RS.file_lines_stream(spark, root, None), topic, S.scratch_path(spark, "t-few1"), CFG)
        assert len(parts(spark, topic)) == files
        store = ReportStore(spark, S.scratch_path(spark, "t-few-report"))
        RS.run_merge_stream(topic_records(spark, topic, 1), store, S.scratch_path(spark, "t-few2"), CFG)
        reports.append(sorted(map(tuple, RS.stream_report(store, CFG).collect())))
    assert reports[0] and reports[0] == reports[1]
