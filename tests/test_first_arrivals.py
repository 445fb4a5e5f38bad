"""First arrivals over micro-batches: retractions, replays, folding, two stages, change feed."""

import pytest
from pyspark.sql import functions as F

from slotbook import session as S
from slotbook.operators import aggregate as A
from slotbook.operators import messages
from slotbook.operators.upsert import COUNTS_SOMETHING, FirstArrivals, ReportStore, published
from slotbook.plans import report as R
from slotbook.plans.queries import topic_records
from slotbook.sources import publish
from slotbook.sources.fixture import write_fixture_files
from slotbook.sources import files as FS
from slotbook.specs import KEY_PARTS, ReportConfig
from slotbook.streaming import report_stream as RS

CFG = ReportConfig(dedup_scope="stream")
ARRIVED = "cookie string, dedup_order_id string, log_ms bigint, check_id string, " + ", ".join(
    f"`{c}` string" for c in KEY_PARTS) + ", slot_ms bigint"


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def arrived(spark, rows):
    """(cookie, order, time, place): first arrivals whose key parts are all ``place``."""
    return spark.createDataFrame([(c, o, t, f"{c}{t}", *[p] * len(KEY_PARTS), 0) for c, o, t, p in rows], ARRIVED)


def moves(first, batch_id):
    return sorted((r["activity_id"], r["n"]) for r in first.moves(batch_id).collect())


def test_later_earlier_arrivals_take_their_place(spark):
    first = FirstArrivals(spark, S.scratch_path(spark, "t-first"), 4)
    first.take(arrived(spark, [("a", "1", 50, "p"), ("b", "1", 50, "q"), ("a", "2", 9, "r")]), 0)
    assert moves(first, 0) == [("p", 1), ("q", 1), ("r", 1)]
    first.take(arrived(spark, [("a", "1", 40, "s"), ("b", "1", 60, "t"), ("a", "2", 9, "r"), ("c", "1", 1, "u")]), 1)
    assert moves(first, 1) == [("p", -1), ("s", 1), ("u", 1)]          # later and equal ones change nothing
    # folded, then an earlier one still: the lookup reads the base
    first.compact(1)
    first.take(arrived(spark, [("a", "1", 30, "p"), ("b", "1", 50, "q")]), 2)
    assert moves(first, 2) == [("p", 1), ("s", -1)]
    # the same batch again, after its folder was written: the same moves
    first.take(arrived(spark, [("a", "1", 30, "p"), ("b", "1", 50, "q")]), 2)
    assert moves(first, 2) == [("p", 1), ("s", -1)]
    kept = {(r.cookie, r.dedup_order_id): (r.log_ms, r.activity_id) for r in first.current().collect()}
    assert kept == {("a", "1"): (30, "p"), ("b", "1"): (50, "q"), ("a", "2"): (9, "r"), ("c", "1"): (1, "u")}


def test_a_batch_reads_its_own_buckets_only(spark):
    """The lookup of a batch of one key reads the base files of that key's bucket alone."""
    first = FirstArrivals(spark, S.scratch_path(spark, "t-buckets"), 8)
    first.take(arrived(spark, [(f"c{i}", "1", 50, "p") for i in range(200)]), 0)
    first.compact(0)
    one = first.with_part(arrived(spark, [("c7", "1", 5, "z")]))
    files = first.current(0, first._touched(one)).inputFiles()
    assert len({f.split("bucket=")[1].split("/")[0] for f in files}) == 1
    assert len({f.split("bucket=")[1].split("/")[0] for f in first.current(0).inputFiles()}) == 8


@pytest.mark.parametrize("compact_every", [None, 1])
def test_replayed_batch_moves_nothing_twice(spark, sf_dir, compact_every):
    """The driver dies after the last micro-batch was written (and, compacting, folded) but before the
    stream committed it."""
    root = write_fixture_files(spark, sf_dir)
    store = ReportStore(spark, S.scratch_path(spark, "t-replay2"), compact_every=compact_every)
    ckpt = S.scratch_path(spark, "t-replay2-ckpt")
    roots = FS.type_folders(root, ("arrive", "click"))
    RS.run_report_stream(spark, roots, store, ckpt, CFG, max_files=2)
    before = spark.createDataFrame(store.current().collect(), store.current().schema)
    commits = sorted(int(p.rsplit("/", 1)[-1]) for p in S.list_files(spark, f"{ckpt}/commits"))
    S.delete(spark, f"{ckpt}/commits/{commits[-1]}")
    RS.run_report_stream(spark, roots, store, ckpt, CFG, max_files=2)
    assert same(store.current(), before)


def test_death_between_the_two_compactions(spark, sf_dir, monkeypatch):
    """The arrivals were folded, the report was not: the replay takes the batch's moves as they are written."""
    root = write_fixture_files(spark, sf_dir)
    store = ReportStore(spark, S.scratch_path(spark, "t-between"), compact_every=1)
    ckpt = S.scratch_path(spark, "t-between-ckpt")

    def die(upto):
        raise RuntimeError("driver lost")
    roots = FS.type_folders(root, ("arrive",))
    monkeypatch.setattr(store, "compact", die)
    with pytest.raises(Exception, match="driver lost"):
        RS.run_report_stream(spark, roots, store, ckpt, CFG, max_files=2)
    assert store.first.folded(0) and not store.folded(0)
    monkeypatch.undo()
    RS.run_report_stream(spark, roots, store, ckpt, CFG, max_files=2)
    lines = FS.scan_lines(spark, roots)
    want = A.finish(A.sum_measures(R.contributions_of(lines, "arrive", ReportConfig())), CFG)
    assert same(RS.stream_report(store, CFG), want)


def test_change_feed_removes_what_moved_away(spark):
    """A row whose only arrival moves to another slot comes with zeros in the batch that moved it."""
    store = ReportStore(spark, S.scratch_path(spark, "t-feed"))
    for i, rows in enumerate(([("a", "1", 50, "p")], [("a", "1", 40, "q")], [("b", "1", 1, "p")])):
        store.first.take(arrived(spark, rows), i)
        store.write_delta(A.finish(A.sum_measures(RS.moved_arrivals(store, i)), CFG, stored=True), i)
    feed = [sorted((r.activity_id, r.arrive_cnt) for r in store.changed(i).collect()) for i in range(3)]
    assert feed == [[("p", 1)], [("p", 0), ("q", 1)], [("p", 1)]]
    assert sorted((r.activity_id, r.arrive_cnt) for r in store.current(1).collect()) == [("q", 1)]
    store.compact(1)
    base = spark.read.parquet(f"{store.path}/base/upto=1")
    assert base.count() == 1 and sorted(r.activity_id for r in store.current().collect()) == ["p", "q"]


def test_first_arrival_messages_round_trip(spark):
    odd = "a\x1fb\x1ec\x1bd\ne"
    rows = spark.createDataFrame([(odd, odd, 1704067200000, odd, *[odd] * len(KEY_PARTS), 1704067200000)], ARRIVED)
    msgs = messages.encode_first(rows, CFG)
    assert same(messages.decode_first(msgs, CFG), rows)
    bad = msgs.union(msgs.select(F.regexp_replace("value", "1704067200000", "soon"))).union(
        spark.createDataFrame([("junk",)], "value string"))
    assert sorted(r.reason for r in messages.first_rejects(bad, CFG).collect()) == ["fields", "measure"]
    assert messages.decode_first(bad, CFG).count() == 1


def test_merge_stage_of_another_scope_rejects_first_arrivals(spark, sf_dir):
    root = write_fixture_files(spark, sf_dir)
    topic, gone = S.scratch_path(spark, "t-topic"), S.scratch_path(spark, "t-gone")
    RS.run_delta_stream(RS.file_lines_stream(spark, FS.type_folders(root, ("arrive",))), topic,
                        S.scratch_path(spark, "t-s1"), CFG)
    store = ReportStore(spark, S.scratch_path(spark, "t-other"))
    RS.run_merge_stream(topic_records(spark, topic), store, S.scratch_path(spark, "t-s2"),
                        ReportConfig(dedup_scope="file"), rejects_dir=gone)
    reasons = spark.read.parquet(gone).groupBy("reason").count().collect()
    assert [r.reason for r in reasons] == ["scope"] and store.current().count() == 0


@pytest.mark.parametrize("entry", ["lines", "report", "delta"])
def test_scope_batch_is_refused_by_every_stream(spark, sf_dir, entry):
    root = write_fixture_files(spark, sf_dir)
    store, cfg = ReportStore(spark, S.scratch_path(spark, "t-no")), ReportConfig()
    lines = RS.file_lines_stream(spark, root, None)
    with pytest.raises(ValueError, match="micro_batch"):
        if entry == "lines":
            RS.run_lines_stream(lines, store, S.scratch_path(spark, "t-nc"), cfg)
        elif entry == "report":
            RS.run_report_stream(spark, root, store, S.scratch_path(spark, "t-nc"), cfg, max_files=None)
        else:
            RS.run_delta_stream(lines, S.scratch_path(spark, "t-no-out"), S.scratch_path(spark, "t-nc"), cfg)


def test_micro_batch_scope_counts_each_batch_by_itself(spark, sf_dir):
    root = write_fixture_files(spark, sf_dir)
    roots, total = FS.type_folders(root, ("arrive",)), []
    for cap in (1, None):
        store, cfg = ReportStore(spark, S.scratch_path(spark, "t-mb")), ReportConfig(dedup_scope="micro_batch")
        RS.run_report_stream(spark, roots, store, S.scratch_path(spark, "t-mbc"), cfg, max_files=cap)
        total.append(store.current().agg(F.sum("arrive_cnt")).first()[0])
    per_file = R.report(FS.scan_lines(spark, roots), ReportConfig(
        dedup_scope="file", specs={t: s for t, s in cfg.specs.items() if t in ("arrive", "merge")}), scope=("file_path",))
    assert total[0] == per_file.agg(F.sum("arrive_cnt")).first()[0] > total[1]


def test_files_arrive_between_triggers_and_a_batch_is_cut_off(spark, sf_dir, monkeypatch):
    """Several real triggers at an interval; then the driver stops inside a batch, after its arrivals but before its
    delta; the restarted query ends with the batch's report."""
    root = S.scratch_path(spark, "t-interval")
    store, ckpt = ReportStore(spark, S.scratch_path(spark, "t-int-report"), compact_every=3), S.scratch_path(spark, "t-int-ckpt")
    trigger = {"processingTime": "1 second"}
    thirds = [f"event_id % 3 = {i}" for i in range(3)]

    def put(i):
        write_fixture_files(spark, sf_dir, where=thirds[i], root=root, suffix=f"-{i}", with_tmp=False)

    put(0)
    q = RS.run_report_stream(spark, root, store, ckpt, CFG, max_files=6, trigger=trigger)
    q.processAllAvailable()
    put(1)
    q.processAllAvailable()
    assert len({p["batchId"] for p in q.recentProgress if p["numInputRows"]}) >= 4
    q.stop()
    real = store.write_delta

    def stop(delta, batch_id):
        raise RuntimeError("stopped inside the batch")
    monkeypatch.setattr(store, "write_delta", stop)
    put(2)
    q = RS.run_report_stream(spark, root, store, ckpt, CFG, max_files=6, trigger=trigger)
    with pytest.raises(Exception, match="stopped inside the batch"):
        q.awaitTermination(60)
    monkeypatch.setattr(store, "write_delta", real)
    q = RS.run_report_stream(spark, root, store, ckpt, CFG, max_files=6, trigger=trigger)
    q.processAllAvailable()
    q.stop()
    assert same(RS.stream_report(store, CFG), R.report(FS.scan_lines(spark, root), ReportConfig()))


def test_writers_report_rows_and_time(spark, sf_dir):
    """One message per partition; rows add up to the batch's changed rows, which are what was written."""
    root, out = write_fixture_files(spark, sf_dir), S.scratch_path(spark, "t-timed")
    store, cfg = ReportStore(spark, f"{out}/report", compact_every=None), ReportConfig(dedup_scope="file")
    RS.run_report_stream(spark, root, store, f"{out}/ckpt", cfg, max_files=8, changes_dir=f"{out}/changes",
                         timing_dir=f"{out}/timing")
    rows = publish.timing(spark, f"{out}/timing")
    per_batch = {r.batch_id: r.n for r in rows.groupBy("batch_id").agg(F.sum("n_rows").alias("n")).collect()}
    assert len(per_batch) >= 2
    for b, n in per_batch.items():
        assert n == store.delta(b).count()
        assert same(spark.read.parquet(f"{out}/changes/batch_id={b}"), published(store.changed(b)))
    assert rows.where("write_ms < 0 OR ms_per_row < 0").count() == 0
    assert rows.groupBy("batch_id", "partition").count().where("count > 1").count() == 0


def test_report_without_arrivals_is_the_same(spark, sf_dir):
    """Rows that count nothing are rows of moved arrivals only: none of the batch report's is one."""
    root = write_fixture_files(spark, sf_dir)
    assert R.report(FS.scan_lines(spark, root), ReportConfig()).where(f"NOT ({COUNTS_SOMETHING})").count() == 0
