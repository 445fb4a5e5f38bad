"""Stage row counts, metric messages and their archive.

The reference buffers each partition to count it and sends one message per
partition and stage.  Here counts are aggregates over the batch.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotbook import session as S
from slotbook.functions import format_ts
from slotbook.operators import aggregate as A
from slotbook.operators.dedup import FIRST
from slotbook.operators.keys import in_window
from slotbook.operators.parse import length_ok, parse_lines, reject_reason
from slotbook.plans import report as R
from slotbook.sources import kafka
from slotbook.specs import KEY_PARTS, MERGE, ReportConfig

MERGE_TYPE = MERGE.log_type
KEY_TYPE = "struct<" + ",".join(f"{c}:string" for c in KEY_PARTS) + ",slot_ms:bigint>"

# The counters' stage names, and the merge stage's.
MERGE_STAGE = "3-groupByKey_map_after"
STAGES = ("1-createStream", "2-log_length_filter_after", "3-map_after", "4-groupByKey_map_after")
METRIC_SEPARATOR = "%"


def per_partition(df: DataFrame, *by: str) -> DataFrame:
    """Rows per partition of ``df`` (and per value of ``by``)."""
    return df.groupBy(*by, F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def _counted(lines, t: str, cfg: ReportConfig, scope, arrivals_elsewhere: bool) -> DataFrame:
    """(log_type, s1, s2, s3, key): how many lines of the type were read, passed the length check and
    are valid, and the report key they add to (null for those that add to none).  Each line is
    parsed once: the keys are built from the same parsed columns as the checks."""
    spec, keyed = cfg.specs[t], A.keyed_of(t)
    p = parse_lines(R.typed_lines(lines, t), spec, keep=scope).withColumns(
        {"_ok": length_ok(None, spec), "_good": reject_reason(None, spec).isNull()})
    one, flag = F.lit(1).cast("bigint"), lambda c: F.when(F.col(c), 1).otherwise(0).cast("bigint")
    if keyed is None:      # a handler of any kind: its keys are counted from its own output
        c = p.agg(F.count(F.lit(1)).alias("s1"), F.count_if("_ok").alias("s2"), F.count_if("_good").alias("s3"))
        keys = R.contributions_of(lines, t, cfg, scope).select(F.struct(*A.GROUP).alias("key")).distinct()
        return c.select(F.lit(t).alias("log_type"), "s1", "s2", "s3", F.lit(None).cast(KEY_TYPE).alias("key")).unionByName(
            keys.select(F.lit(t).alias("log_type"), *[F.lit(0).cast("bigint").alias(s) for s in ("s1", "s2", "s3")], "key"))
    k = keyed(p, cfg, spec, [*scope, "_ok", "_good"])
    if t != "arrive":
        key = F.when(F.col("_good"), F.struct(*A.GROUP))
        return k.select(F.lit(t).alias("log_type"), one.alias("s1"), flag("_ok").alias("s2"), flag("_good").alias("s3"),
                        key.cast(KEY_TYPE).alias("key"))
    # one key per (cookie, order id), from the same aggregate that counts its lines
    first = F.when(F.col("_good") & in_window(), F.struct(*FIRST))
    g = k.groupBy(*(scope if cfg.dedup_scope == "file" else ()), "cookie", "dedup_order_id").agg(
        F.count(F.lit(1)).alias("s1"), F.count_if("_ok").alias("s2"), F.count_if("_good").alias("s3"), F.min(first).alias("f"))
    key = F.when(F.col("f").isNotNull() & F.lit(not arrivals_elsewhere), F.struct(*[F.col(f"f.{c}").alias(c) for c in A.GROUP]))
    return g.select(F.lit(t).alias("log_type"), "s1", "s2", "s3", key.cast(KEY_TYPE).alias("key"))


def stage_counts(lines, cfg: ReportConfig = ReportConfig(), scope=(), types=None, moves: DataFrame | None = None) -> DataFrame:
    """M1 per log type: lines read, lines passing the length check, valid
    keyed records, delta rows (distinct report keys of the type), and the
    report keys it has in the merge stage.

    One pass over the lines and one grouping by report key, with a counter per type and
    stage; only a handler registered without a ``keyed`` function is run beside the
    counters.  ``moves``: the arrivals that count elsewhere than in these lines (dedup scope 'stream')."""
    types = tuple(types or cfg.log_types)
    rows = A.union_all([_counted(lines, t, cfg, scope, moves is not None) for t in types])
    if moves is not None:
        rows = rows.unionByName(moves.select(
            F.lit("arrive").alias("log_type"), *[F.lit(0).cast("bigint").alias(s) for s in ("s1", "s2", "s3")],
            F.struct(*A.GROUP).cast(KEY_TYPE).alias("key")))
    there, counters = F.col("key").isNotNull(), []
    for i, t in enumerate(types):
        mine = F.col("log_type") == t
        counters += [F.sum(F.when(mine, F.col(s))).alias(f"{s}_{i}") for s in ("s1", "s2", "s3")]
        counters.append(F.max(F.when(mine & there, 1)).alias(f"s4_{i}"))
    by_key = rows.groupBy("key").agg(*counters)
    total = by_key.agg(*[F.sum(F.col(f"{s}_{i}")).alias(f"{s}_{i}") for i in range(len(types))
                         for s in ("s1", "s2", "s3", "s4")], F.count("key").alias("merged"))
    cells = [(t, stage, f"s{n + 1}_{i}") for i, t in enumerate(types) for n, stage in enumerate(STAGES)]
    return total.select(F.inline(F.array(*[F.struct(
        F.lit(t).alias("log_type"), F.lit(stage).alias("stage"), F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("n_rows"))
        for t, stage, c in [*cells, (MERGE_TYPE, MERGE_STAGE, "merged")]])))


def messages(counts: DataFrame, batch_id: int | Column = 0, ts: Column | None = None) -> DataFrame:
    """M2: ``topic % count % stage % host % time``.  The host field carries
    the batch id (Q23); ``ts`` defaults to the current time (F8, Q16)."""
    ts = F.current_timestamp() if ts is None else ts
    bid = batch_id if isinstance(batch_id, Column) else F.lit(int(batch_id))
    return counts.select(F.concat_ws(
        METRIC_SEPARATOR, F.col("log_type"), F.col("n_rows").cast("string"), F.col("stage"),
        F.concat(F.lit("batch-"), bid.cast("string")), format_ts(ts)).alias("value"))


def parse_messages(msgs: DataFrame) -> DataFrame:
    """M3: metric messages back to typed columns."""
    f = F.split(F.col("value"), METRIC_SEPARATOR, -1)
    return msgs.select(F.get(f, 0).alias("log_type"), F.get(f, 1).try_cast("bigint").alias("n_rows"),
                       F.get(f, 2).alias("stage"), F.get(f, 3).alias("host"),
                       F.get(f, 4).alias("time"))


def message_reason() -> Column:
    """Why a metric message cannot be read: 'fields' (their number), 'count' (no number) or 'time'; null for a good one."""
    f = F.split(F.col("value"), METRIC_SEPARATOR, -1)
    n = F.get(f, 1).try_cast("bigint")
    return (F.when(F.coalesce(F.size(f), F.lit(0)) != 5, "fields").when(n.isNull() | (n < 0), "count")
            .when(F.try_to_timestamp(F.get(f, 4), F.lit("yyyy-MM-dd HH:mm:ss")).isNull(), "time"))


class Archive:
    """K4: text lines in files of ``lines_per_file``, filled over micro-batches.

    ``files/batch_id=N/file_no=K``: the files that batch N filled; ``open/batch_id=N``: the lines left over
    after it, fewer than a file, which the next batch starts with.  A file is only written
    once it is full, as the lines that wait are taken along; a replayed batch starts from the same
    leftover and replaces its own folders."""

    OPEN_DDL = "file_no bigint, i bigint, value string"

    def __init__(self, spark: SparkSession, folder: str, lines_per_file: int):
        self.spark, self.folder, self.size = spark, folder.rstrip("/"), int(lines_per_file)

    def _before(self, batch_id: int | None = None) -> int | None:
        """The last finished batch (before ``batch_id``, when given)."""
        root = f"{self.folder}/open"
        if not S.exists(self.spark, root):
            return None
        done = [int(p.rstrip("/").rsplit("=", 1)[-1]) for p in S.list_dirs(self.spark, root)
                if S.exists(self.spark, f"{p}/_SUCCESS")]
        return max((n for n in done if batch_id is None or n < batch_id), default=None)

    def _left(self, batch: int | None) -> DataFrame:
        if batch is None:
            return self.spark.createDataFrame([], self.OPEN_DDL)
        return self.spark.read.schema(self.OPEN_DDL).parquet(f"{self.folder}/open/batch_id={batch}")

    def append(self, msgs: DataFrame, batch_id: int) -> None:
        """Number the lines across tasks - a running number inside each partition, plus the counts of the
        partitions before it - after those left open, deal them to files by number and write in parallel."""
        before = self._before(int(batch_id))
        left = self._left(before)
        # at most a file's lines; the marker row (i null) says which file is next
        state = left.agg(F.max("file_no").alias("file_no"), F.count("i").alias("n")).first()
        at, waiting = (state.file_no or 0), state.n
        staged = S.scratch_path(self.spark, "archive")
        # written first: numbers must not change between the two passes over the partitions
        (msgs.select("value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("i"))
         .write.parquet(staged))
        rows = self.spark.read.schema("value string, part int, i bigint").parquet(staged)
        counts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
        total = (counts.agg(F.sum("n")).first()[0] or 0) + waiting
        starts = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))
        # an id counts up from 2**33 times the partition's number
        number = F.col("start") + F.col("i") - F.shiftleft(F.col("part").cast("bigint"), 33) + F.lit(waiting)
        new = rows.join(starts, "part").select(number.alias("i"), "value")
        lines = left.where("i IS NOT NULL").select("i", "value").unionByName(new)
        full = total // self.size
        if full:
            (lines.where(F.col("i") < full * self.size)
             .withColumn("file_no", F.floor(F.col("i") / self.size) + F.lit(at))
             .repartition("file_no").sortWithinPartitions("file_no", "i").select("value", "file_no")
             .write.mode("overwrite").partitionBy("file_no").text(f"{self.folder}/files/batch_id={int(batch_id)}"))
        marker = self.spark.createDataFrame([(at + full, None, None)], self.OPEN_DDL)
        (lines.where(F.col("i") >= full * self.size)
         .select(F.lit(at + full).alias("file_no"), (F.col("i") - full * self.size).alias("i"), "value")
         .unionByName(marker).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/open/batch_id={int(batch_id)}"))
        self._drop_open(int(batch_id), before)

    def _drop_open(self, *keep: int | None) -> None:
        """Only the last leftover, and the one a replay would start from, are needed."""
        for p in S.list_dirs(self.spark, f"{self.folder}/open"):
            if int(p.rstrip("/").rsplit("=", 1)[-1]) not in keep:
                S.delete(self.spark, p)

    def read(self) -> DataFrame:
        """(file_no, value): every line, those still open in the file that they will lie in."""
        out = self._left(self._before()).where("i IS NOT NULL").select("file_no", "value")
        if S.exists(self.spark, f"{self.folder}/files"):
            full = (self.spark.read.schema("value string, batch_id bigint, file_no bigint")
                    .option("basePath", f"{self.folder}/files").text(f"{self.folder}/files"))
            out = full.select("file_no", "value").unionByName(out)
        return out


def run_metric_stream(records: DataFrame, archive: Archive, parsed_dir: str, rejects_dir: str, checkpoint: str,
                      trigger: dict | None = None):
    """The metric topic as a stream of records with Kafka's columns: messages that can be read go to the
    archive and, parsed, to ``parsed_dir``; the others to ``rejects_dir`` with a reason; all by batch id."""
    def run(batch: DataFrame, batch_id: int) -> None:
        part = f"batch_id={int(batch_id)}"
        msgs = kafka.decode(batch).withColumn("reason", message_reason()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = msgs.where("reason IS NULL")
            parse_messages(good).write.mode("overwrite").parquet(f"{parsed_dir}/{part}")
            msgs.where("reason IS NOT NULL").select("reason", "value").write.mode("overwrite").parquet(
                f"{rejects_dir}/{part}")
            archive.append(good.select("value"), batch_id)
        finally:
            msgs.unpersist()

    trigger = trigger or {"availableNow": True}
    q = (records.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**trigger).start())
    if trigger.get("availableNow"):
        q.awaitTermination()
    return q
