"""A job declared by an XML job file (S10): one file starts the batch and the stream.

The file's elements are read by Spark's XML source, one kind at a time, wherever
they stand: ``<properies>`` (name, cap on files a batch, slot minutes), ``<input>``
(a watched folder of a log type and how often it is looked at), ``<kafka>`` (a topic,
its interval and separator), ``<kafakaOut>`` (the topic and separator of the hand-off),
``<log>`` (a log type's columns and key) and ``<table>`` (the report's columns).  Element names
are those of the job files in use.  The database's connection is not taken: there is none here.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotbook.operators.upsert import ReportStore
from slotbook.specs import (DEFAULT_SLOT_MINUTES, LOG_TYPES, MERGE, REPORT_ITEMS, SPECS, LogSpec, ReportConfig,
                            read_specs_xml, select_spec)
from slotbook.streaming import report_stream as RS

# Element names of the job files, by kind.
ELEMENTS = {
    "properies": ("appName", "unionRDD_count", "logSpace", "unionseparator"),
    "input": ("topicLogType", "dir", "loopInterval"),
    "kafka": ("topic", "appName", "streamSpace", "separator", "consumerNum"),
    "kafakaOut": ("topic", "brokers", "separator"),
    "table": ("tableName", "items"),
}


class JobError(ValueError):
    """A job file that does not say one thing."""


@dataclass(frozen=True)
class Folder:
    log_type: str
    path: str
    interval_ms: int | None = None


@dataclass(frozen=True)
class Topic:
    name: str
    interval_s: int | None = None
    separator: str | None = None


@dataclass(frozen=True)
class Job:
    """What a job file declares."""
    name: str = "slotbook"
    max_files: int | None = None
    config: ReportConfig = field(default_factory=ReportConfig)
    folders: tuple[Folder, ...] = ()
    topics: tuple[Topic, ...] = ()
    hand_off: Topic | None = None

    def folder(self, log_type: str) -> Folder:
        return _only([f for f in self.folders if f.log_type == log_type], f"folder of {log_type!r}")

    def topic(self, name: str) -> Topic:
        return _only([t for t in self.topics if t.name == name], f"topic {name!r}")


def _only(found: list, what: str):
    if len(found) != 1:
        raise JobError(f"expected one declaration of {what}, found {len(found)}")
    return found[0]


def _rows(spark: SparkSession, path: str, tag: str) -> list[dict]:
    """The elements ``tag`` as texts by child's name.  A job file holds a handful."""
    raw = (spark.read.format("xml").option("rowTag", tag).option("inferSchema", "false")
           .schema(", ".join(f"{c} string" for c in ELEMENTS[tag])).load(path))
    return [{k: (v or "").strip() for k, v in r.asDict().items()} for r in raw.collect()]


def _number(text: str, what: str, least: int = 1) -> int | None:
    if not text:
        return None
    try:
        n = int(text)
    except ValueError:
        n = least - 1
    if n < least:
        raise JobError(f"{what}: {text!r} is no number of {least} or more")
    return n


def read_job(spark: SparkSession, path: str, **config) -> Job:
    """The job that the file at ``path`` declares; ``config``: further settings of ``ReportConfig``.

    Raises ``JobError`` if a log type is declared twice, if a folder or topic names a log type without a
    declaration, or twice, if a number is none, if the logs' slot minutes differ, or if the
    table's columns are not the report's."""
    settings = _rows(spark, path, "properies")
    if len(settings) > 1:
        raise JobError("several <properies>")
    main = settings[0] if settings else dict.fromkeys(ELEMENTS["properies"], "")
    declared = read_specs_xml(spark, path)
    names = [r["log_type"] for r in declared.select("log_type").collect()]
    # the merge stage's declaration is this engine's own: its messages are
    types = [t for t in names if t != MERGE.log_type]
    specs: dict[str, LogSpec] = {}
    minutes = {_number(r["slot"], "logSpace") for r in declared.select(
        F.col("slot_minutes").cast("string").alias("slot")).collect() if r["slot"]}
    minutes |= {_number(main["logSpace"], "logSpace")} - {None}
    if len(minutes) > 1:
        raise JobError(f"slot minutes differ: {sorted(minutes)}")
    topics = tuple(Topic(r["topic"], _number(r["streamSpace"], "streamSpace"), r["separator"] or None)
                   for r in _rows(spark, path, "kafka"))
    separators = {t.name: t.separator for t in topics}
    for t in types:
        try:
            spec = select_spec(declared, t)
        except ValueError as e:
            raise JobError(str(e)) from e
        specs[t] = spec.with_separator(separators[t]) if separators.get(t) else spec
    folders = tuple(Folder(r["topicLogType"], r["dir"], _number(r["loopInterval"], "loopInterval"))
                    for r in _rows(spark, path, "input"))
    for what, given in (("folder", [f.log_type for f in folders]), ("topic", [t.name for t in topics])):
        for t in given:
            if given.count(t) > 1:
                raise JobError(f"expected one {what} of {t!r}, found {given.count(t)}")
            if t not in specs and t != MERGE.log_type:
                raise JobError(f"{what} of {t!r}, which no <log> declares")
    for r in _rows(spark, path, "table"):
        if tuple(r["items"].split(",")) != REPORT_ITEMS:
            raise JobError(f"table {r['tableName']!r} has not the report's columns")
    outs = [Topic(r["topic"], None, r["separator"] or None) for r in _rows(spark, path, "kafakaOut")]
    if len(outs) > 1:
        raise JobError("several <kafakaOut>")
    cfg = ReportConfig(slot_minutes=minutes.pop() if minutes else DEFAULT_SLOT_MINUTES,
                       specs={**specs, MERGE.log_type: MERGE}, **{"dedup_scope": "stream", **config})
    return Job(main["appName"] or "slotbook", _number(main["unionRDD_count"], "unionRDD_count"), cfg, folders, topics,
               outs[0] if outs else None)


def run_batch(spark: SparkSession, job: Job, store: ReportStore, checkpoint: str, **dirs):
    """Every pending file of the declared folders, the declared number a batch, then stop."""
    return RS.run_report_stream(spark, {f.log_type: f.path for f in _some(job.folders, "folder")}, store, checkpoint,
                                _with_inputs(job, [f.log_type for f in job.folders]), max_files=job.max_files, **dirs)


def run_stream(spark: SparkSession, job: Job, store: ReportStore, checkpoint: str, **dirs):
    """The declared folders watched at the shortest of their intervals, until the query is stopped."""
    every = min((f.interval_ms for f in _some(job.folders, "folder") if f.interval_ms), default=2000)
    return RS.run_report_stream(spark, {f.log_type: f.path for f in job.folders}, store, checkpoint,
                                _with_inputs(job, [f.log_type for f in job.folders]), max_files=job.max_files,
                                trigger={"processingTime": f"{every} milliseconds"}, **dirs)


def run_topic(records: DataFrame, job: Job, topic: str, out: str, checkpoint: str, trigger: dict | None = None):
    """One log topic's process: its records (with Kafka's columns) → delta messages of the hand-off."""
    t = job.topic(topic)
    lines = records.select(F.lit(t.name).alias("log_type"), F.col("value").cast("string").alias("value"))
    return RS.run_delta_stream(lines, out, checkpoint, _with_inputs(job, [t.name]), trigger=trigger or (
        {"processingTime": f"{t.interval_s} seconds"} if t.interval_s else None))


def run_merge(records: DataFrame, job: Job, store: ReportStore, checkpoint: str, trigger: dict | None = None, **dirs):
    """The merge topic's process: hand-off messages → store."""
    t = job.topic(MERGE.log_type)
    return RS.run_merge_stream(records, store, checkpoint, job.config, trigger=trigger or (
        {"processingTime": f"{t.interval_s} seconds"} if t.interval_s else None), **dirs)


def _some(found: tuple, what: str) -> tuple:
    if not found:
        raise JobError(f"no {what} is declared")
    return found


def _with_inputs(job: Job, types: list[str]) -> ReportConfig:
    """The job's settings with the log types that have an input."""
    return replace(job.config, specs={t: s for t, s in job.config.specs.items() if t in types or t == MERGE.log_type})


def write_job(spark: SparkSession, path: str, folders: dict[str, str], specs=None, max_files: int = 10,
              slot_minutes: int = DEFAULT_SLOT_MINUTES, topics: dict[str, int] | None = None,
              interval_ms: int = 2000) -> None:
    """A job file of these declarations, in the form ``read_job`` reads."""
    specs = specs or [SPECS[t] for t in LOG_TYPES]
    log = "struct<topicLogType:string,items:string,rowKey:string,logSpace:string>"
    ddl = ("properies struct<appName:string,unionRDD_count:string,logSpace:string>,"
           " filePath struct<input:array<struct<topicLogType:string,loopInterval:string,dir:string>>>,"
           " kafkaTopics struct<kafka:array<struct<topic:string,streamSpace:string>>>,"
           f" logProperties struct<log:array<{log}>>,"
           " tableDefines struct<table:struct<tableName:string,items:string>>")
    row = (("Mix_Log_process", str(max_files), str(slot_minutes)),
           ([(t, str(interval_ms), d) for t, d in folders.items()],),
           ([(t, str(s)) for t, s in (topics or {}).items()],),
           ([(s.log_type, ",".join(s.columns), ",".join(s.key), str(slot_minutes)) for s in specs],),
           (("report", ",".join(REPORT_ITEMS)),))
    (spark.createDataFrame([row], ddl).coalesce(1).write.format("xml").option("rootTag", "configurations")
     .option("rowTag", "configuration").mode("overwrite").save(path))
