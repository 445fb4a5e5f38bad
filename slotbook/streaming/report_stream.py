"""Structured Streaming over log lines.

A file-source query watches the log folders (each new file is taken
once; in-progress ``_``/``.`` files are skipped until renamed); any other
stream of lines - ``kafka.decode`` of a topic - will do as well.  Each
micro-batch runs the batch report functions in ``foreachBatch`` and stores
its delta by batch id, so the report table is the state (T3), late records
just add to their old slot (T4), and a replayed batch overwrites its own
delta instead of adding twice.  The source offsets and the batch ids live
in the checkpoint folder, so a restarted or failed query resumes exactly.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotbook.operators import aggregate as A
from slotbook.operators import messages
from slotbook.operators import metrics as M
from slotbook.operators.dedup import first_arrivals
from slotbook.operators.upsert import ReportStore, published
from slotbook.plans import report as R
from slotbook.sources import publish as P
from slotbook.sources.files import type_below
from slotbook.specs import KEY_COLUMNS, ReportConfig

#: Lines of a batch for each file of records that stage one writes of it: a line gives one record at most.
LINES_PER_FILE = 1_000_000


def file_lines_stream(spark: SparkSession, roots: str | dict[str, str], max_files: int | None = 10) -> DataFrame:
    """New files, at any depth below ``roots`` (a folder with one sub-folder per
    log type, or one folder per type), as lines with their file identity; at
    most ``max_files`` files of each folder given per batch."""
    if isinstance(roots, dict):
        return A.union_all([file_lines_stream(spark, r, max_files).withColumn("log_type", F.lit(t))
                            for t, r in roots.items()])
    r = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", int(max_files))
    path = F.col("_metadata.file_path")
    return r.load(roots).select(
        "value", path.alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
        type_below(spark, path, roots).alias("log_type"))


def _scope(cfg: ReportConfig) -> tuple[str, ...]:
    """The columns that part the arrivals of a micro-batch.  The scope 'batch' is refused: what
    counts would depend on how files fall into batches, which 'micro_batch' says by its name."""
    if cfg.dedup_scope == "batch":
        raise ValueError("dedup scope 'batch' in a stream: choose 'file', 'stream' or 'micro_batch'")
    return ("file_path",) if cfg.dedup_scope == "file" else ()


def batch_types(cfg: ReportConfig) -> tuple[tuple[str, ...], bool]:
    """The log types that a micro-batch counts by itself, and whether its arrivals are compared with
    those of all batches before (the scope 'stream')."""
    apart = cfg.dedup_scope == "stream" and "arrive" in cfg.log_types
    return tuple(t for t in cfg.log_types if not (apart and t == "arrive")), apart


def moved_arrivals(store: ReportStore, batch_id: int) -> DataFrame:
    """What a batch changes about the arrivals counted, as contributions of +1 and -1."""
    return A.with_measures(store.first.moves(batch_id), {"arrive_cnt": "n"})


def report_batch_writer(store: ReportStore, cfg: ReportConfig, audit_dir: str | None = None,
                        metrics_dir: str | None = None, rejects_dir: str | None = None,
                        changes_dir: str | None = None, timing_dir: str | None = None):
    """The ``foreachBatch`` function: batch lines → delta → store (+ key audit,
    stage metrics, rejected lines, changed rows and write time of the batch, each by batch id, so
    that a replayed batch replaces its own)."""
    scope, (types, apart) = _scope(cfg), batch_types(cfg)
    if timing_dir:
        P.register(store.spark)

    def run(batch: DataFrame, batch_id: int) -> None:
        if store.folded(batch_id):     # replayed after its compaction: all of it is written
            return
        part = f"batch_id={int(batch_id)}"
        # the log types each read the batch once; keep it for them
        lines = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows, moves = [R.contributions_of(lines, t, cfg, scope) for t in types], None
            if apart:
                if not store.first.folded(batch_id):
                    store.first.take(A.kept_arrivals(R.valid_of(lines, "arrive", cfg), cfg), batch_id)
                moves = moved_arrivals(store, batch_id)
                rows.append(moves)
            store.write_delta(A.finish(A.sum_measures(A.union_all(rows)), cfg, stored=True), batch_id)
            if metrics_dir:
                M.messages(M.stage_counts(lines, cfg, scope, moves=moves), batch_id).write.mode("overwrite").text(
                    f"{metrics_dir}/{part}")
            if rejects_dir:
                R.all_rejects(lines, cfg).write.mode("overwrite").parquet(f"{rejects_dir}/{part}")
        finally:
            lines.unpersist()
        after_delta(store, batch_id, audit_dir, changes_dir, timing_dir)
    return run


def after_delta(store: ReportStore, batch_id: int, audit_dir: str | None = None, changes_dir: str | None = None,
                timing_dir: str | None = None) -> None:
    """What follows a committed delta: the audit of its keys (K3), its changed rows by value, with the
    time that writing them took per partition (A9), and the store's upkeep, last."""
    part = f"batch_id={int(batch_id)}"
    if audit_dir:
        keys = store.delta(batch_id).select(F.concat_ws("\x1f", *KEY_COLUMNS[:-1]).alias("value"))
        keys.write.mode("overwrite").text(f"{audit_dir}/{part}")
    if changes_dir:
        P.write_rows(published(store.changed(batch_id)), f"{changes_dir}/{part}",
                     f"{timing_dir}/{part}" if timing_dir else None)
    # fold the deltas into the days they touch every few batches
    store.maintain(batch_id)


def stream_report(store: ReportStore, cfg: ReportConfig = ReportConfig()) -> DataFrame:
    """The report of all batches; with dedup scope 'stream', each (cookie, order id)'s
    first arrival over all of them counts, in whatever batch it came."""
    return published(store.current())


def _start(writer, checkpoint: str, trigger: dict | None):
    trigger = trigger or {"availableNow": True}
    q = writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
    if trigger.get("availableNow"):
        q.awaitTermination()
    return q


def run_lines_stream(lines: DataFrame, store: ReportStore, checkpoint: str, cfg: ReportConfig,
                     trigger: dict | None = None, **dirs):
    """The report query over any stream of lines (``log_type``, ``value``, and
    ``file_path`` for the dedup scope 'file')."""
    return _start(lines.writeStream.foreachBatch(report_batch_writer(store, cfg, **dirs)), checkpoint, trigger)


def run_report_stream(spark: SparkSession, roots: str | dict[str, str], store: ReportStore, checkpoint: str,
                      cfg: ReportConfig, max_files: int | None = 10, trigger: dict | None = None, **dirs):
    """The report query over watched folders; with the default ``availableNow``
    trigger it takes every pending file, ``max_files`` a batch, and stops: the batch
    job over folders (production: ``processingTime``).  The file source's log in the
    checkpoint folder is the ledger of files taken."""
    _scope(cfg)
    return run_lines_stream(file_lines_stream(spark, roots, max_files), store, checkpoint, cfg, trigger, **dirs)


def run_delta_stream(lines: DataFrame, out: str, checkpoint: str, cfg: ReportConfig, trigger: dict | None = None):
    """Stage one of two (K1, T6): each batch's per-type deltas as records with Kafka's
    columns, by batch id; with the scope 'stream', its first arrivals as records of their own topic, as
    only the merge stage can tell which of them count.  A Kafka sink takes the same records.

    The files written follow the batch's lines, not the shuffle partitions: a merge stage that caps its
    files would otherwise take many more batches, each of which looks up all arrivals before it."""
    scope, (types, apart) = _scope(cfg), batch_types(cfg)

    def run(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            records = [messages.kafka_records(messages.encode(
                A.own_measures(R.contributions_of(kept, t, cfg, scope), t), cfg)) for t in types]
            if apart:
                first = A.kept_arrivals(R.valid_of(kept, "arrive", cfg), cfg)
                records.append(messages.kafka_records(messages.encode_first(first, cfg), messages.FIRST_TOPIC))
            files = max(1, -(-kept.count() // LINES_PER_FILE))
            A.union_all(records).repartition(files).write.mode("overwrite").parquet(f"{out}/batch_id={int(batch_id)}")
        finally:
            kept.unpersist()

    return _start(lines.writeStream.foreachBatch(run), checkpoint, trigger)


def run_merge_stream(records: DataFrame, store: ReportStore, checkpoint: str, cfg: ReportConfig,
                     rejects_dir: str | None = None, trigger: dict | None = None, **dirs):
    """Stage two (S7, A5): messages from a stream with Kafka's columns → store.  Deltas are
    added up; a first arrival counts only if no earlier one of its cookie and order id is known, and
    takes the place of the one counted so far, so neither stage's cap on files matters.  Messages that
    cannot be read go to the rejects by batch id."""
    if dirs.get("timing_dir"):
        P.register(store.spark)

    def run(batch: DataFrame, batch_id: int) -> None:
        if store.folded(batch_id):
            return
        value = F.col("value").cast("string").alias("value")
        kept = batch.select("topic", value).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            first = kept.where(F.col("topic") == messages.FIRST_TOPIC).select("value")
            deltas = kept.where(~F.coalesce(F.col("topic") == messages.FIRST_TOPIC, F.lit(False))).select("value")
            rows = messages.decode(deltas, cfg)
            bad = messages.decode_rejects(deltas, cfg)
            if cfg.dedup_scope == "stream":
                if not store.first.folded(batch_id):
                    store.first.take(first_arrivals(messages.decode_first(first, cfg)), batch_id)
                rows = rows.unionByName(moved_arrivals(store, batch_id))
                bad = bad.unionByName(messages.first_rejects(first, cfg))
            else:      # stage one runs with another scope
                bad = bad.unionByName(first.select(F.lit("scope").alias("reason"), "value"))
            store.write_delta(A.finish(messages.merge(rows), cfg, stored=True), batch_id)
            if rejects_dir:
                bad.write.mode("overwrite").parquet(f"{rejects_dir}/batch_id={int(batch_id)}")
        finally:
            kept.unpersist()
        after_delta(store, batch_id, **dirs)

    return _start(records.writeStream.foreachBatch(run), checkpoint, trigger)


def lines_sink_writer(sink_dir: str):
    """``foreachBatch`` that lands the raw lines by batch id (idempotent)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        (batch.select("log_type", "file_name", "value").write.mode("overwrite")
         .parquet(f"{sink_dir}/batch_id={int(batch_id)}"))
    return run


def run_ingest_stream(spark: SparkSession, roots: str | dict[str, str], sink_dir: str, checkpoint: str,
                      max_files: int | None = 10):
    q = (file_lines_stream(spark, roots, max_files).writeStream
         .foreachBatch(lines_sink_writer(sink_dir))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
