"""Replay-safe tables that grow by batches and are folded by partition.

Layout under ``path`` (``part`` is the partition column)::

    deltas/batch_id=N/{part}=P/   what batch N adds (overwritten when it is replayed)
    base/upto=N/{part}=P/         merged rows of the partitions touched by the
                                  deltas folded in compaction N
    manifest/upto=N/              ({part}, version): where each partition's
                                  current base rows live; written last

Compaction N folds the deltas after the previous compaction into the partitions they
touch only, so its cost follows the new data, not the history; other partitions
keep pointing at their older version.  Readers use the latest manifest with a
``_SUCCESS`` marker plus the deltas after it, so a compaction that dies half way is
invisible and can be re-run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotbook import session as S


class FoldedTable:
    """``ddl``: the stored columns; ``merge`` brings rows of a partition, old and new, to
    one per key (the same whatever the rows' order or grouping)."""

    def __init__(self, spark: SparkSession, path: str, ddl: str, part: str,
                 merge: Callable[[DataFrame], DataFrame]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.ddl, self.part, self.merge = ddl, part, merge
        self.columns = spark.createDataFrame([], ddl).columns

    @property
    def deltas(self) -> str:
        return f"{self.path}/deltas"

    def _write(self, rows: DataFrame, folder: str) -> None:
        """By partition, each one's rows by few tasks; the rebalance also splits a
        partition that is too large for one."""
        (rows.hint("rebalance", self.part).write.mode("overwrite").partitionBy(self.part).parquet(folder))

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """Idempotent: replaying ``batch_id`` overwrites its own folder."""
        self._write(rows, f"{self.deltas}/batch_id={int(batch_id)}")

    def batch(self, batch_id: int) -> DataFrame:
        """The rows that batch ``batch_id`` added, with their partition (none for a batch that added none)."""
        return (self.spark.read.schema(f"{self.ddl}, {self.part} string")
                .parquet(f"{self.deltas}/batch_id={int(batch_id)}"))

    # -- bookkeeping (metadata only) ---------------------------------------
    def _versions(self, folder: str) -> list[int]:
        """Complete ``upto=N`` folders (with ``_SUCCESS``), ascending."""
        root = f"{self.path}/{folder}"
        if not S.exists(self.spark, root):
            return []
        out = []
        for p in S.list_dirs(self.spark, root):
            name = p.rstrip("/").rsplit("/", 1)[-1]
            if name.startswith("upto=") and S.exists(self.spark, f"{p}/_SUCCESS"):
                out.append(int(name[5:]))
        return sorted(out)

    def last_compaction(self) -> int | None:
        v = self._versions("manifest")
        return v[-1] if v else None

    def folded(self, batch_id: int) -> bool:
        """Whether batch ``batch_id`` is in the base: all it had to write was written before."""
        c = self.last_compaction()
        return c is not None and int(batch_id) <= c

    def committed(self, batch_id: int) -> bool:
        """Batch ``batch_id``'s delta is in the table (folded or pending)."""
        return self.folded(batch_id) or S.exists(self.spark, f"{self.deltas}/batch_id={int(batch_id)}/_SUCCESS")

    def _manifest(self, c: int | None) -> DataFrame | None:
        if c is None:
            return None
        return (self.spark.read.schema(f"{self.part} string, version bigint")
                .parquet(f"{self.path}/manifest/upto={c}"))

    def _base(self, c: int | None, parts: list[str] | None = None,
              exclude: list[str] | None = None) -> DataFrame | None:
        """Base rows as of compaction ``c`` (only of ``parts`` when given, of none of
        ``exclude``).  The manifest has one row per partition, so its paths are
        listed on the driver."""
        m = self._manifest(c)
        if m is None:
            return None
        if parts is not None:
            m = m.where(F.col(self.part).isin(parts))
        if exclude:
            m = m.where(~F.col(self.part).isin(exclude))
        paths = [f"{self.path}/base/upto={r.version}/{self.part}={r[self.part]}"
                 for r in m.select(self.part, "version").collect()]
        if not paths:
            return None
        return (self.spark.read.schema(f"{self.ddl}, upto bigint, {self.part} string")
                .option("basePath", f"{self.path}/base").parquet(*paths))

    def _deltas_after(self, c: int | None, upto: int | None = None,
                      parts: list[str] | None = None) -> DataFrame | None:
        if not S.exists(self.spark, self.deltas):
            return None
        d = (self.spark.read.schema(f"{self.ddl}, batch_id bigint, {self.part} string")
             .option("basePath", self.deltas).parquet(self.deltas))
        if c is not None:
            d = d.where(F.col("batch_id") > c)
        if upto is not None:
            d = d.where(F.col("batch_id") <= int(upto))
        if parts is not None:
            d = d.where(F.col(self.part).isin(parts))
        return d

    def _touched(self, rows: DataFrame | None) -> list[str]:
        """The partitions of ``rows``: one value each, read from the partition column."""
        return [] if rows is None else [str(r[0]) for r in rows.select(self.part).distinct().collect()]

    # -- reading ------------------------------------------------------------
    def current(self, upto: int | None = None, parts: list[str] | None = None) -> DataFrame:
        """The table: base as of the latest compaction + the deltas after it (only those
        up to batch ``upto``, and of the partitions ``parts``, when given).

        Base rows are already one per key, so only the partitions the pending deltas
        touch are merged with them; every other one is read as is (a fully
        compacted table is read with no shuffle)."""
        c = self.last_compaction()
        if upto is not None and c is not None and upto < c:
            raise ValueError(f"batches up to {c} are already compacted")
        deltas = self._deltas_after(c, upto, parts)
        touched = self._touched(deltas)
        out = []
        if c is not None:
            untouched = self._base(c, parts, exclude=touched)
            if untouched is not None:
                out.append(untouched.select(*self.columns))
        if touched:
            rows = deltas.select(*self.columns)
            old = self._base(c, touched)
            if old is not None:
                rows = rows.unionByName(old.select(*self.columns))
            out.append(self.merge(rows).select(*self.columns))
        if not out:   # nothing stored yet: an empty table of the right shape
            return self.spark.createDataFrame([], self.ddl)
        return out[0] if len(out) == 1 else out[0].unionByName(out[1])

    # -- compaction ---------------------------------------------------------
    def with_part(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the partition column."""
        raise NotImplementedError

    def compact(self, upto: int) -> str:
        """Fold the deltas after the last compaction, up to ``upto``, into the
        partitions they touch; then publish the new manifest."""
        upto = int(upto)
        c = self.last_compaction()
        if c is not None and upto <= c:
            return f"{self.path}/manifest/upto={c}"
        new = self._deltas_after(c, upto)
        touched = self._touched(new)
        if touched:
            old = self._base(c, touched)
            rows = new.select(*self.columns)
            if old is not None:
                rows = rows.unionByName(old.select(*self.columns))
            self._write(self.with_part(self.merge(rows)), f"{self.path}/base/upto={upto}")
        # a partition whose rows all went has no folder
        kept = [p for p in touched if S.exists(self.spark, f"{self.path}/base/upto={upto}/{self.part}={p}")]
        entries = self._entries(kept, upto)
        prev = self._manifest(c)
        if prev is not None:
            entries = entries.unionByName(
                prev.where(~F.col(self.part).isin(touched)) if touched else prev)
        return self._publish(entries, upto)

    def _entries(self, parts: list[str], version: int) -> DataFrame:
        """Manifest rows as literals: one row per partition, no job to make them."""
        if not parts:
            return self.spark.createDataFrame([], f"{self.part} string, version bigint")
        return self.spark.range(1).select(F.explode(F.array(*map(F.lit, parts))).alias(self.part),
                                          F.lit(version).cast("bigint").alias("version"))

    def _publish(self, entries: DataFrame, upto: int) -> str:
        """Write manifest ``upto`` (one row per partition); readers switch to the
        compaction only once its ``_SUCCESS`` marker exists."""
        target = f"{self.path}/manifest/upto={int(upto)}"
        entries.coalesce(1).write.mode("overwrite").parquet(target)
        return target

    def prune(self, keep_manifests: int = 2) -> list[int]:
        """Drop what readers no longer use: manifests older than the last
        ``keep_manifests``, the delta folders folded before the oldest of those (a table read
        before the last compaction still holds the later ones), and base
        versions no kept manifest references (also the leftovers of a
        compaction that died).  Returns the deleted delta batch ids."""
        c = self.last_compaction()
        if c is None:
            return []
        kept = self._versions("manifest")[-keep_manifests:]
        gone = []
        if S.exists(self.spark, self.deltas):
            for p in S.list_dirs(self.spark, self.deltas):
                name = p.rstrip("/").rsplit("/", 1)[-1]
                if name.startswith("batch_id=") and len(kept) == keep_manifests and int(name[9:]) <= kept[0]:
                    S.delete(self.spark, p)
                    gone.append(int(name[9:]))
        # one row per partition and manifest: the versions still referenced
        used = set(kept)
        for v in kept:
            used |= {int(r.version) for r in self._manifest(v).select("version").distinct().collect()}
        for folder, drop in (("manifest", lambda v: v < kept[0]),
                             ("base", lambda v: v not in used and v <= c)):
            root = f"{self.path}/{folder}"
            if not S.exists(self.spark, root):
                continue
            for p in S.list_dirs(self.spark, root):
                name = p.rstrip("/").rsplit("/", 1)[-1]
                if name.startswith("upto=") and drop(int(name[5:])):
                    S.delete(self.spark, p)
        return sorted(gone)
