"""Streaming equals batch; in-progress files; late data; replay."""

import pytest
from pyspark.sql import functions as F

from slotbook import session as S
from slotbook.operators import metrics as M
from slotbook.operators.upsert import ReportStore
from slotbook.plans import report as R
from slotbook.sources import files as FS
from slotbook.sources import publish as P
from slotbook.sources.fixture import fixture_lines, write_fixture_files
from slotbook.specs import ReportConfig
from slotbook.streaming import report_stream as RS

FILE_CFG = ReportConfig(dedup_scope="file")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_equals_batch_per_file_scope(spark, sf_dir):
    root = write_fixture_files(spark, sf_dir)
    store = ReportStore(spark, S.scratch_path(spark, "t-stream"))
    RS.run_report_stream(spark, root, store, S.scratch_path(spark, "t-ckpt"), FILE_CFG, max_files=3)
    batch = R.report(FS.scan_lines(spark, root), FILE_CFG, scope=("file_path",))
    assert same(RS.stream_report(store, FILE_CFG), batch)


def test_new_file_taken_once_and_tmp_skipped(spark, sf_dir):
    root = write_fixture_files(spark, sf_dir, reuse=False)
    sink, ckpt = S.scratch_path(spark, "t-sink"), S.scratch_path(spark, "t-ick")
    RS.run_ingest_stream(spark, root, sink, ckpt, max_files=2)
    n1 = spark.read.parquet(sink).count()
    assert n1 == FS.scan_lines(spark, FS.type_folders(root)).count()
    # a second run with no new file adds nothing; renaming the _part.tmp makes it new
    RS.run_ingest_stream(spark, root, sink, ckpt, max_files=2)
    assert spark.read.parquet(sink).count() == n1
    S.rename(spark, f"{root}/click/_part.tmp", f"{root}/click/9.log")
    RS.run_ingest_stream(spark, root, sink, ckpt, max_files=2)
    extra = spark.read.text(f"{root}/click/9.log").count()
    assert spark.read.parquet(sink).count() == n1 + extra > n1


def test_ledger_pending_and_prune(spark, sf_dir):
    root = write_fixture_files(spark, sf_dir)
    listing = FS.listing(spark, root)
    ledger_dir = S.scratch_path(spark, "t-ledger")
    FS.append_ledger(listing.where(F.col("name") == "0.log"), ledger_dir)
    ledger = FS.read_ledger(spark, ledger_dir)
    assert FS.pending(listing, ledger).where(F.col("name") == "0.log").count() == 0
    assert FS.prune(ledger, listing).count() == ledger.count()



@pytest.mark.parametrize("compact_every", [None, 2])
def test_replayed_batch_is_not_counted_twice(spark, sf_dir, compact_every):
    """The driver dies after the last micro-batch wrote its delta but before
    the stream committed it: on restart Spark runs that batch again, and the
    report must not change."""
    root = write_fixture_files(spark, sf_dir)
    store = ReportStore(spark, S.scratch_path(spark, "t-replay"), compact_every=compact_every)
    ckpt = S.scratch_path(spark, "t-replay-ckpt")
    RS.run_report_stream(spark, root, store, ckpt, FILE_CFG, max_files=10)
    before = spark.createDataFrame(store.current().collect(), store.current().schema)
    commits = sorted(int(p.rsplit("/", 1)[-1]) for p in S.list_files(spark, f"{ckpt}/commits"))
    assert len(commits) >= 2
    S.delete(spark, f"{ckpt}/commits/{commits[-1]}")
    q = RS.run_report_stream(spark, root, store, ckpt, FILE_CFG, max_files=10)
    assert S.exists(spark, f"{ckpt}/commits/{commits[-1]}")        # it ran again
    # a folded batch is known to be written and reads nothing
    assert [p["batchId"] for p in q.recentProgress if p["numInputRows"] > 0] == ([] if compact_every else [commits[-1]])
    assert same(store.current(), before)


def test_registered_handler_serves_batch_and_stream(spark, sf_dir, monkeypatch):
    """A handler registered for a log type replaces the built-in one
    in the batch job and in the stream alike (here: clicks of area '1' only)."""
    from slotbook.operators import aggregate as A
    from slotbook.operators import keys

    def area_one_clicks(valid, cfg, spec, scope=()):
        k = keys.click_keys(valid, cfg, keep=scope).where(F.col("area_id") == "1")
        return A.with_measures(k, {"click_cnt": A.ONE})

    monkeypatch.setitem(A.HANDLERS, "click", area_one_clicks)
    root = write_fixture_files(spark, sf_dir)
    batch = R.report(FS.scan_lines(spark, root), FILE_CFG, scope=("file_path",))
    assert batch.where((F.col("click_cnt") > 0) & (F.col("area_id") != "1")).count() == 0
    assert batch.where(F.col("click_cnt") > 0).count() > 0
    store = ReportStore(spark, S.scratch_path(spark, "t-handler"))
    RS.run_report_stream(spark, root, store, S.scratch_path(spark, "t-handler-ckpt"), FILE_CFG)
    assert same(RS.stream_report(store, FILE_CFG), batch)


def _write(spark, folder, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(folder)


GOOD = "\x02".join(["23", "1", "1704067200000", "0.00000001", "7", "a", "o", "v", "", "", "u", "", "", "", "m",
                    "", "p", "", "", "r", "s", "x", ""])


def test_batches_of_rejected_lines_only(spark):
    """Audit, metrics and rejects of a batch without one good line, then a good one."""
    root, out = S.scratch_path(spark, "t-bad"), S.scratch_path(spark, "t-bad-out")
    store, ckpt = ReportStore(spark, f"{out}/report"), f"{out}/ckpt"
    dirs = {d: f"{out}/{d}" for d in ("audit_dir", "metrics_dir", "rejects_dir", "changes_dir", "timing_dir")}
    _write(spark, f"{root}/expose/day/bad", ["junk", ""])
    RS.run_report_stream(spark, root, store, ckpt, FILE_CFG, **dirs)
    assert store.current().count() == 0
    _write(spark, f"{root}/expose/day/good", [GOOD])
    _write(spark, f"{root}/other", [GOOD])
    RS.run_report_stream(spark, root, store, ckpt, FILE_CFG, **dirs)
    row = RS.stream_report(store, FILE_CFG).first()
    assert (row.expose_cnt, row.cost) == (1, 1e-8)
    gone = spark.read.option("basePath", dirs["rejects_dir"]).parquet(dirs["rejects_dir"])
    assert sorted((r.batch_id, r.log_type, r.reason) for r in gone.collect()) == [
        (0, "expose", "length"), (0, "expose", "length"), (1, "other", "unknown_type")]
    assert spark.read.text(dirs["audit_dir"]).count() == 1
    stages = {(r.host, r.log_type, r.stage[0]): r.n_rows
              for r in M.parse_messages(spark.read.text(dirs["metrics_dir"])).collect()}
    assert stages[("batch-0", "expose", "1")] == 2 and stages[("batch-0", "expose", "3")] == 0
    assert stages[("batch-1", "expose", "4")] == 1 == stages[("batch-1", "merge", "3")]
    timed = P.timing(spark, dirs["timing_dir"]).groupBy("batch_id").agg(F.sum("n_rows").alias("n"))
    assert {r.batch_id: r.n for r in timed.collect() if r.n} == {1: 1}


def test_file_names_with_glob_characters(spark):
    root, out = S.scratch_path(spark, "t-glob"), S.scratch_path(spark, "t-glob-out")
    for i, name in enumerate(("a[1]", "b{2}", "c 3", "d%204")):
        _write(spark, f"{out}/w{i}", [GOOD])
        S.rename(spark, next(p for p in S.list_files(spark, f"{out}/w{i}")), f"{root}/expose/x/{name}.log")
    store = ReportStore(spark, f"{out}/report")
    RS.run_report_stream(spark, root, store, f"{out}/ckpt", FILE_CFG, max_files=1)
    assert store.current().first().expose_cnt == 4


def test_a_report_read_before_a_compaction_stays_readable(spark, sf_dir):
    """A report held over the next compaction (and its pruning) gives the rows it had."""
    ls = fixture_lines(spark, sf_dir, variant="days")
    cfg = ReportConfig()
    store = ReportStore(spark, S.scratch_path(spark, "t-held"), compact_every=2)
    held = None
    for i in range(6):
        store.write_delta(R.report(ls.where(f"event_id % 6 = {i}"), cfg, stored=True), i)
        if i == 4:
            held = store.current()
            want = held.count()
        store.maintain(i)
    assert held.count() == want


def test_rebalanced_writes_are_few_files(spark, sf_dir):
    store = ReportStore(spark, S.scratch_path(spark, "t-files"))
    store.write_delta(R.report(fixture_lines(spark, sf_dir, variant="days").repartition(16), ReportConfig(),
                               stored=True), 0)
    days = S.list_dirs(spark, f"{store.deltas}/batch_id=0")
    assert len(days) > 5 and all(len(S.list_files(spark, d)) <= 2 for d in days)
