"""Jobs declared by a job file (S10), log types below odd roots (S1), metric topic and archive (S9, K4), stage counts (M1)."""

import pytest
from pyspark.sql import functions as F

from slotbook import job
from slotbook import session as S
from slotbook.operators import metrics as M
from slotbook.operators.upsert import ReportStore
from slotbook.plans import report as R
from slotbook.sources import files as FS
from slotbook.sources.fixture import fixture_lines, write_fixture_files
from slotbook.specs import LOG_TYPES, REPORT_COLUMNS, SPECS, ReportConfig
from slotbook.streaming import report_stream as RS
from tests.test_plans import plan


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def log(t, minutes="15"):
    s = SPECS[t]
    return (f"<log><topicLogType>{t}</topicLogType><logSpace>{minutes}</logSpace><items>{','.join(s.columns)}</items>"
            f"<rowKey>{','.join(s.key)}</rowKey></log>")


def folder(t, path="/x", interval="2000"):
    return f"<input><topicLogType>{t}</topicLogType><loopInterval>{interval}</loopInterval><dir>{path}</dir></input>"


def write(tmp_path, *, logs, inputs="", topics="", settings="", table=REPORT_COLUMNS):
    path = tmp_path / "job.xml"
    path.write_text(f"<configuration><properies><describe>text</describe>{settings}</properies><filePath>{inputs}</filePath>"
                    f"<kafkaTopics>{topics}</kafkaTopics><logProperties>{logs}</logProperties><tableDefines><table>"
                    f"<tableName>r</tableName><items>{table}</items></table></tableDefines></configuration>")
    return str(path)


def test_all_kinds_of_declarations(spark, tmp_path):
    j = job.read_job(spark, write(
        tmp_path, logs="".join(map(log, LOG_TYPES)), inputs=folder("bid", "/b") + folder("click", "/c", "500"),
        topics="<kafka><topic>bid</topic><streamSpace>2</streamSpace><separator>|</separator></kafka>"
               "<kafka><topic>merge</topic><streamSpace>5</streamSpace></kafka>",
        settings="<appName>mine</appName><unionRDD_count>7</unionRDD_count><logSpace>15</logSpace>"))
    assert (j.name, j.max_files, j.config.slot_minutes, j.config.dedup_scope) == ("mine", 7, 15, "stream")
    assert j.folder("click") == job.Folder("click", "/c", 500) and j.topic("merge").interval_s == 5
    assert j.config.specs["bid"].separator == "|" and j.config.specs["click"].columns == SPECS["click"].columns
    with pytest.raises(job.JobError, match="expose"):
        j.folder("expose")


@pytest.mark.parametrize("what, said", [
    (dict(logs=log("bid") + log("bid"), inputs=folder("bid")), "found 2"),
    (dict(logs=log("bid"), inputs=folder("click")), "no <log> declares"),
    (dict(logs=log("bid"), inputs=folder("bid") + folder("bid", "/y")), "found 2"),
    (dict(logs=log("bid") + log("click", "30"), inputs=folder("bid")), "slot minutes differ"),
    (dict(logs=log("bid"), inputs=folder("bid", "/x", "often")), "no number"),
    (dict(logs=log("bid"), inputs=folder("bid"), settings="<unionRDD_count>0</unionRDD_count>"), "no number"),
    (dict(logs=log("bid"), inputs=folder("bid"), table="id,cost"), "columns"),
    (dict(logs=log("bid"), topics="<kafka><topic>click</topic></kafka>"), "no <log> declares"),
])
def test_a_file_that_does_not_say_one_thing_fails(spark, tmp_path, what, said):
    with pytest.raises(job.JobError, match=said):
        job.read_job(spark, write(tmp_path, **what))


def test_no_folder_no_job(spark, tmp_path):
    j = job.read_job(spark, write(tmp_path, logs=log("bid")))
    with pytest.raises(job.JobError, match="no folder"):
        job.run_batch(spark, j, ReportStore(spark, "/nowhere"), "/nowhere")


def test_one_file_starts_batch_and_stream(spark, sf_dir):
    root = write_fixture_files(spark, sf_dir)
    path = S.scratch_path(spark, "t-job")
    job.write_job(spark, path, FS.type_folders(root, ("bid", "arrive")), max_files=2, interval_ms=300)
    j = job.read_job(spark, path)
    want = R.report(FS.scan_lines(spark, FS.type_folders(root, ("bid", "arrive"))), ReportConfig())
    stores = [ReportStore(spark, S.scratch_path(spark, "t-job-report")) for _ in range(2)]
    job.run_batch(spark, j, stores[0], S.scratch_path(spark, "t-job-ckpt"))
    q = job.run_stream(spark, j, stores[1], S.scratch_path(spark, "t-job-ckpt"))
    q.processAllAvailable()
    assert q.isActive
    q.stop()
    for s in stores:
        assert same(RS.stream_report(s, j.config), want)


@pytest.mark.parametrize("path, root, want", [
    ("hdfs://nn/nn/bid/0.log", "/nn", "bid"), ("hdfs://nn/nn/bid/day/0.log", "/nn/", "bid"), ("file:///nn/bid/0.log", "/nn", "bid"),
    ("file:/nn/bid/0.log", "/nn", "bid"), ("s3a://b/logs/nn/nn/click/x/1.log", "/logs/nn", "nn"), ("hdfs://nn/other/nn/bid/0.log", "/nn", None),
    ("hdfs://nn/nn/0.log", "/nn", None)])
def test_log_type_below_an_ambiguous_root(spark, path, root, want):
    got = spark.createDataFrame([(path,)], "p string").select(FS.type_below(spark, F.col("p"), root)).first()[0]
    assert got == want


def test_stage_counts_parse_each_line_once(spark, sf_dir):
    p = plan(M.stage_counts(fixture_lines(spark, sf_dir), ReportConfig()))
    nodes = p.split("\n\n\n")[0]
    # the split of a line is a generator's output; the last one makes rows of the counters
    assert nodes.count("Generate") == len(LOG_TYPES) + 1
    assert p.count("Arguments: hashpartitioning(") == 2       # arrivals, report keys


def test_stage_counts_of_a_handler_of_any_kind(spark, sf_dir, monkeypatch):
    """A handler without a ``keyed`` function is counted from its own output."""
    from slotbook.operators import aggregate as A
    lines, cfg = fixture_lines(spark, sf_dir), ReportConfig()
    want = {tuple(r) for r in M.stage_counts(lines, cfg).collect()}
    old = A.HANDLERS["click"]
    monkeypatch.setitem(A.HANDLERS, "click", lambda *a, **k: old(*a, **k))
    assert {tuple(r) for r in M.stage_counts(lines, cfg).collect()} == want


def test_archive_fills_short_files_over_batches(spark):
    a = M.Archive(spark, S.scratch_path(spark, "t-archive2"), 7)
    at = 0
    for i, n in enumerate((3, 0, 11, 40, 2)):
        some = spark.range(at, at + n).selectExpr("CAST(id AS STRING) AS value").repartition(5)
        a.append(some, i)
        a.append(some, i)                        # each batch replayed
        at += n
        sizes = [r["count"] for r in a.read().groupBy("file_no").count().orderBy("file_no").collect()]
        assert sizes == [7] * (at // 7) + [at % 7] * bool(at % 7)
    assert sorted(int(r.value) for r in a.read().collect()) == list(range(at))
    full = spark.read.text(f"{a.folder}/files").groupBy(F.col("_metadata.file_path")).count()
    assert {r["count"] for r in full.collect()} == {7}


def test_metric_messages_that_cannot_be_read(spark):
    rows = [("click%5%1-createStream%batch-0%2024-01-01 00:00:00", None), ("click%x%s%h%2024-01-01 00:00:00", "count"),
            ("click%-1%s%h%2024-01-01 00:00:00", "count"), ("a%1%b", "fields"), ("", "fields"), (None, "fields"),
            ("click%5%s%h%soon", "time")]
    df = spark.createDataFrame(rows, "value string, want string")
    assert df.withColumn("got", M.message_reason()).where("NOT got <=> want").count() == 0
