"""Accumulating the report.

The reference reads each report row by key and writes old + new back, one
statement per key, without a transaction, so a retried task adds twice.
Here the upsert is set-based and replay-safe:

* ``upsert(old, delta)`` is ``unionByName`` + ``groupBy`` over the ten keys
  (one shuffle; no per-key lookups, no join).
* ``ReportStore`` is a ``FoldedTable`` of report rows by ``slot_date``: each batch's delta
  replaces itself when the batch is replayed, and the report is a compacted base plus the deltas
  after it.
* The first arrival of each (cookie, order id) over all batches is kept in a second
  ``FoldedTable`` by hash bucket (``arrivals``).  A batch's delta holds what it changes
  about them: +1 at the key of each new first arrival, -1 at the key of the one it replaces.
  Reading the report therefore reads no arrivals, and a batch looks up its own buckets only.
* ``changed`` gives the current rows of the keys a batch touched: what a
  publication by value has to write, never an increment.

Report files are partitioned by ``slot_date`` so that a later reader (or a
date-restricted upsert) prunes whole days.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotbook import session as S
from slotbook.operators.dedup import FIRST, PAYLOAD, first_arrivals
from slotbook.operators.folded import FoldedTable
from slotbook.specs import (COST_SUM_TYPE, COUNT_MEASURES, KEY_COLUMNS, KEY_PARTS, MEASURES,
                            REPORT_OUTPUT)

# Stored report rows, read with this schema (no inference over many files;
# partition values keep their text form).  Cost stays a decimal in the store.
REPORT_DDL = ", ".join(
    f"`{c}` {'bigint' if c in COUNT_MEASURES else COST_SUM_TYPE if c == 'cost' else 'string'}"
    for c in REPORT_OUTPUT)
# a first arrival, and where the one it replaced was counted (null: it replaced none)
WAS_DDL = "struct<" + ", ".join(f"`{c}`: string" for c in KEY_PARTS) + ", slot_ms: bigint>"
ARRIVAL_DDL = ("cookie string, dedup_order_id string, log_ms bigint, check_id string, "
               + ", ".join(f"`{c}` string" for c in KEY_PARTS) + f", slot_ms bigint, was {WAS_DDL}")
ARRIVAL_KEY = ("cookie", "dedup_order_id")
#: a row that counts nothing is no row of the report (its arrivals went to other keys)
COUNTS_SOMETHING = " OR ".join(f"{m} <> 0" for m in COUNT_MEASURES)


def _sum(m: str):
    """Counts add as BIGINT, cost as an exact decimal."""
    if m == "cost":
        return F.coalesce(F.sum(F.col(m).cast(COST_SUM_TYPE)), F.lit(0)).cast(COST_SUM_TYPE).alias(m)
    return F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m)


def published(report: DataFrame) -> DataFrame:
    """The report as it leaves the engine: cost as DOUBLE."""
    return report.withColumn("cost", F.col("cost").cast("double")).select(*REPORT_OUTPUT)


def added_up(rows: DataFrame) -> DataFrame:
    """Report rows, one per key."""
    return rows.groupBy(*KEY_COLUMNS).agg(*[_sum(m) for m in MEASURES]).select(*REPORT_OUTPUT)


def upsert(old: DataFrame, delta: DataFrame) -> DataFrame:
    """K2: old (null → 0) + new per measure for keys in both; either row
    alone otherwise.  Both sides are report rows with cost as a decimal."""
    return added_up(old.select(*REPORT_OUTPUT).unionByName(delta.select(*REPORT_OUTPUT)))


def by_slot_date(report: DataFrame) -> DataFrame:
    return report.withColumn("slot_date", F.substring("start_time", 1, 8))


class FirstArrivals(FoldedTable):
    """The first arrival of each (cookie, order id) over all batches, by hash bucket."""

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        super().__init__(spark, path, ARRIVAL_DDL, "bucket",
                         lambda rows: first_arrivals(rows).withColumn("was", F.lit(None).cast(WAS_DDL)))
        self.buckets = int(buckets)

    def with_part(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*ARRIVAL_KEY), F.lit(self.buckets)).cast("string"))

    def take(self, arrived: DataFrame, batch_id: int) -> None:
        """Store what the batch's first arrivals (one per cookie and order id) change about
        those of the batches before it."""
        new = self.with_part(arrived).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # only the batch's own buckets are looked up: one value each
            old = self.current(int(batch_id) - 1, self._touched(new)).select(
                *ARRIVAL_KEY, F.struct(*FIRST).alias("before"))
            won = new.join(old, list(ARRIVAL_KEY), "left").where(
                F.col("before").isNull() | (F.struct(*FIRST) < F.col("before")))
            place = F.struct(*[F.col(f"before.{c}").alias(c) for c in PAYLOAD])
            self.write_batch(won.withColumn("was", F.when(F.col("before").isNotNull(), place))
                             .select(*self.columns, "bucket"), batch_id)
        finally:
            new.unpersist()

    def moves(self, batch_id: int) -> DataFrame:
        """Key parts, slot_ms and ``n``: +1 where an arrival of the batch counts now, -1 where the
        one it replaced did."""
        rows = self.batch(batch_id)
        return rows.select(*PAYLOAD, F.lit(1).cast("bigint").alias("n")).unionByName(
            rows.where("was IS NOT NULL").select("was.*", F.lit(-1).cast("bigint").alias("n")))


class ReportStore(FoldedTable):
    """Replay-safe accumulated report on a shared filesystem, with the first arrivals it counts.

    ``compact_every``: batches between compactions (None: never); ``arrival_buckets``: hash
    buckets of the first arrivals - as many as keep one bucket's rows to some executor's work."""

    def __init__(self, spark: SparkSession, path: str, compact_every: int | None = 20, arrival_buckets: int = 16):
        super().__init__(spark, path, REPORT_DDL, "slot_date", lambda rows: added_up(rows).where(COUNTS_SOMETHING))
        self.compact_every = compact_every
        self.first = FirstArrivals(spark, f"{self.path}/arrivals", arrival_buckets)

    def with_part(self, rows: DataFrame) -> DataFrame:
        return by_slot_date(rows)

    def write_delta(self, delta: DataFrame, batch_id: int) -> None:
        """Idempotent: replaying ``batch_id`` overwrites its own folder."""
        self.write_batch(by_slot_date(delta.select(*REPORT_OUTPUT)), batch_id)

    def delta(self, batch_id: int) -> DataFrame:
        """The rows that batch ``batch_id`` added (none for a batch without valid lines)."""
        return self.batch(batch_id).select(*REPORT_OUTPUT)

    def changed(self, batch_id: int) -> DataFrame:
        """The rows, as of batch ``batch_id``, of the keys that it touched (its delta must
        not be folded yet): what has to be published, by value, after it.  A row that counts nothing
        any more - its arrivals went to other keys - comes with zeros: it has to be removed."""
        keys = self.batch(batch_id)
        days = self._touched(keys)
        now = self.current(int(batch_id), days)
        zeros = [F.coalesce(F.col(m), F.lit(0)).cast(COST_SUM_TYPE if m == "cost" else "bigint").alias(m)
                 if m in MEASURES else F.col(m) for m in REPORT_OUTPUT]
        return keys.select(*KEY_COLUMNS).join(now, list(KEY_COLUMNS), "left").select(*zeros)

    def arrivals(self) -> DataFrame:
        """The first arrival of each (cookie, order id) over all batches; later batches
        may bring earlier ones, which then count instead."""
        return self.first.current().drop("was")

    def maintain(self, batch_id: int) -> None:
        """After batch ``batch_id``: compact and prune on every
        ``compact_every``-th batch (never when it is None)."""
        every = self.compact_every
        if every and (int(batch_id) + 1) % int(every) == 0:
            # the report last: once it is folded, the batch is done
            for table in (self.first, self):
                if table is self or S.exists(self.spark, table.deltas):
                    table.compact(batch_id)
                    table.prune()
