"""Invariants of the report job (§5 (c)) and the replay-safe store."""

from pyspark.sql import functions as F

from slotbook import session as S
from slotbook.operators import aggregate as A
from slotbook.operators import messages
from slotbook.operators.upsert import ReportStore, upsert
from slotbook.plans import report as R
from slotbook.sources.fixture import fixture_lines
from slotbook.specs import LOG_TYPES, ReportConfig

CFG = ReportConfig()


def totals(df):
    return df.agg(*[F.sum(c).alias(c) for c in ("bid_cnt", "bid_success_cnt", "expose_cnt",
                                                  "click_cnt", "arrive_cnt")]).first().asDict()


def test_measures_equal_valid_counts(spark, sf_dir):
    ls = fixture_lines(spark, sf_dir)
    rep = totals(R.report(ls, CFG))
    assert rep["bid_cnt"] == R.valid_of(ls, "bid", CFG).count()
    assert rep["expose_cnt"] == rep["bid_success_cnt"] == R.valid_of(ls, "expose", CFG).count()
    assert rep["click_cnt"] == R.valid_of(ls, "click", CFG).count()
    kept = R.contributions_of(ls, "arrive", CFG).count()
    assert rep["arrive_cnt"] == kept


def test_accepted_plus_rejected_is_all(spark, sf_dir):
    ls = fixture_lines(spark, sf_dir)
    for t in LOG_TYPES:
        n = ls.where(F.col("log_type") == t).count()
        assert R.valid_of(ls, t, CFG).count() + R.rejects_of(ls, t, CFG).count() == n


def test_union_order_and_two_phase(spark, sf_dir):
    ls = fixture_lines(spark, sf_dir)
    one = R.report(ls, CFG)
    frames = [R.contributions_of(ls, t, CFG) for t in reversed(LOG_TYPES)]
    other = A.finish(A.sum_measures(A.union_all(frames)), CFG)
    assert one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0


def test_message_roundtrip(spark, sf_dir):
    ls = fixture_lines(spark, sf_dir)
    msgs = A.union_all([messages.encode(A.own_measures(R.contributions_of(ls, t, CFG), t), CFG)
                        for t in LOG_TYPES])
    assert msgs.where(F.size(F.split("value", "\x1e", -1)) != 21).count() == 0
    back = A.finish(messages.merge(messages.decode(msgs, CFG)), CFG)
    direct = R.report(ls, CFG)
    assert back.exceptAll(direct).count() == 0 and direct.exceptAll(back).count() == 0


def test_store_replay_is_idempotent(spark, sf_dir):
    ls = fixture_lines(spark, sf_dir)
    early = R.report(ls.where("early"), CFG, stored=True)
    late = R.report(ls.where("NOT early"), CFG, stored=True)
    store = ReportStore(spark, S.scratch_path(spark, "test-store"))
    store.write_delta(early, 0)
    store.write_delta(late, 1)
    store.write_delta(late, 1)  # a replayed batch
    want = upsert(early, late)
    got = store.current()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    store.compact(0)
    got2 = store.current()
    assert got2.exceptAll(want).count() == 0 and want.exceptAll(got2).count() == 0


def test_compaction_rewrites_only_touched_days(spark, sf_dir):
    ls = fixture_lines(spark, sf_dir)
    early = R.report(ls.where("early"), CFG, stored=True)
    late = R.report(ls.where("NOT early"), CFG, stored=True)
    store = ReportStore(spark, S.scratch_path(spark, "test-compact"), compact_every=1)
    store.write_delta(early, 0)
    store.maintain(0)                      # compaction 0: every day of the first half
    assert store.last_compaction() == 0 and store.prune() == []
    # a delta touching one day only
    day = late.select(F.substring("start_time", 1, 8).alias("d")).first()["d"]
    one_day = late.where(F.substring("start_time", 1, 8) == day)
    store.write_delta(one_day, 1)
    store.write_delta(one_day, 1)          # replayed
    store.maintain(1)
    assert store.last_compaction() == 1
    written = spark.read.parquet(f"{store.path}/base/upto=1")
    assert [str(r[0]) for r in written.select("slot_date").distinct().collect()] == [day]
    want = upsert(early, one_day)
    got = store.current()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert store.committed(0) and store.committed(1) and not store.committed(2)
    # deltas folded before the older manifest are gone, those after it stay for readers that
    # hold it; compacting again is a no-op
    assert not S.exists(spark, f"{store.deltas}/batch_id=0") and S.exists(spark, f"{store.deltas}/batch_id=1")
    store.compact(1)
    got = store.current()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_prune_keeps_what_readers_use(spark, sf_dir):
    rep = R.report(fixture_lines(spark, sf_dir), CFG, stored=True)

    def on_day(day):  # the report's rows moved to another day
        return rep.withColumn("start_time", F.concat(F.lit(day), F.substring("start_time", 9, 6)))

    parts = [on_day("20240101"), on_day("20240102"), on_day("20240102"), on_day("20240102")]
    store = ReportStore(spark, S.scratch_path(spark, "test-prune"), compact_every=1)
    for i, p in enumerate(parts):
        store.write_delta(p, i)
        store.maintain(i)
    # the last two manifests stay; base 1 (day 2 before compactions 2 and 3) is
    # referenced by neither, base 0 (day 1) by both
    assert store._versions("manifest") == [2, 3]
    bases = sorted(int(p.rstrip("/").rsplit("=", 1)[-1])
                   for p in S.list_dirs(spark, f"{store.path}/base"))
    assert bases == [0, 2, 3]
    assert [p.rsplit("=", 1)[-1].rstrip("/") for p in S.list_dirs(spark, store.deltas)] == ["3"]
    want = upsert(upsert(upsert(parts[0], parts[1]), parts[2]), parts[3])
    got = store.current()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # fully compacted: the report is read as stored, with no shuffle
    from tests.test_plans import plan
    assert "Exchange" not in plan(got)
    # one pending delta on day 1: only that day is aggregated, day 2 passes through
    store.write_delta(parts[0], 4)
    got = store.current()
    want = upsert(want, parts[0])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    p = plan(got)
    assert p.count("Arguments: hashpartitioning(") == 1


def test_compaction_dying_before_its_manifest_is_invisible(spark, sf_dir, monkeypatch):
    ls = fixture_lines(spark, sf_dir)
    early = R.report(ls.where("early"), CFG, stored=True)
    late = R.report(ls.where("NOT early"), CFG, stored=True)
    store = ReportStore(spark, S.scratch_path(spark, "test-die"))
    store.write_delta(early, 0)
    store.compact(0)
    store.write_delta(late, 1)
    want = upsert(early, late)

    def die(entries, upto):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(store, "_publish", die)
    try:
        store.compact(1)                       # base/upto=1 written, no manifest
    except RuntimeError:
        pass
    assert S.exists(spark, f"{store.path}/base/upto=1")
    assert store.last_compaction() == 0
    got = store.current()                      # manifest 0 + delta 1
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    monkeypatch.undo()
    store.compact(1)                           # the re-run completes it
    assert store.last_compaction() == 1
    got = store.current()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_two_stages_through_kafka_shaped_records(spark, sf_dir):
    """The per-type stage sends its delta messages as Kafka records
    (key = value = the message, topic 'merge'); the merge stage decodes the
    topic's records and sums them into the report."""
    from slotbook.sources import kafka
    ls = fixture_lines(spark, sf_dir)
    msgs = A.union_all([messages.encode(A.own_measures(R.contributions_of(ls, t, CFG), t), CFG)
                        for t in LOG_TYPES])
    records = messages.kafka_records(msgs)
    assert records.columns == ["key", "value", "topic"]
    assert records.where(F.col("key") != F.col("value")).count() == 0
    lines = kafka.decode(records)
    assert {r[0] for r in lines.select("log_type").distinct().collect()} == {"merge"}
    back = A.finish(messages.merge(messages.decode(lines.select("value"), CFG)), CFG)
    direct = R.report(ls, CFG)
    assert back.exceptAll(direct).count() == 0 and direct.exceptAll(back).count() == 0
