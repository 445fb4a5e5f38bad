"""Rows written by value, with the time each partition took.

``write_rows`` writes a batch's changed rows as Parquet.  With a folder for the timing it
goes through a Python data source, whose writers - one per partition - send their row
count and milliseconds back as commit messages: the times are the tasks' own and
count the writing alone, not the computation of the rows or the driver's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotbook import session as S

FORMAT = "slotbook_timed"
TIMING_DDL = "batch_id bigint, partition int, n_rows bigint, write_ms double"


def _source():
    """The data source class.  It is made here so that it travels to the workers by value."""
    import os
    import time
    import uuid
    from dataclasses import dataclass

    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark import TaskContext
    from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

    @dataclass
    class Written(WriterCommitMessage):
        partition: int
        file: str | None
        n_rows: int
        write_ms: float

    def store(path: str):
        return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("/") else (fs.LocalFileSystem(), path)

    class Writer(DataSourceArrowWriter):
        def __init__(self, options):
            self.folder, self.timing = options["path"], options["timing"]

        def write(self, iterator):
            where, folder = store(self.folder)
            partition = TaskContext.get().partitionId()
            # a name that readers skip: only what commits is renamed
            name, n, spent, out = f"_{partition:05d}-{uuid.uuid4().hex}", 0, 0.0, None
            for batch in iterator:
                began = time.perf_counter()
                if out is None:
                    where.create_dir(folder, recursive=True)
                    out = pq.ParquetWriter(f"{folder}/{name}", batch.schema, filesystem=where, compression="snappy")
                out.write_batch(batch)
                n += batch.num_rows
                spent += time.perf_counter() - began
            if out is not None:
                began = time.perf_counter()
                out.close()
                spent += time.perf_counter() - began
            return Written(partition, name if out is not None else None, n, 1000 * spent)

        def commit(self, messages):
            where, folder = store(self.folder)
            done = [m for m in messages if m is not None]
            where.create_dir(folder, recursive=True)
            for m in done:
                if m.file:
                    where.move(f"{folder}/{m.file}", f"{folder}/part-{m.file[1:]}.parquet")
            with where.open_output_stream(f"{folder}/_SUCCESS"):
                pass
            where, timing = store(self.timing)
            where.create_dir(timing, recursive=True)
            table = pa.table({"partition": pa.array([m.partition for m in done], pa.int32()),
                              "n_rows": pa.array([m.n_rows for m in done], pa.int64()),
                              "write_ms": pa.array([m.write_ms for m in done], pa.float64())})
            pq.write_table(table, f"{timing}/part-timing.parquet", filesystem=where)

        def abort(self, messages):
            where, folder = store(self.folder)
            for m in messages:
                if m is not None and m.file:
                    where.delete_file(os.path.join(folder, m.file))

    class TimedRows(DataSource):
        @classmethod
        def name(cls):
            return FORMAT

        def writer(self, schema, overwrite):
            return Writer(self.options)

    return TimedRows


def register(spark: SparkSession) -> None:
    """Make the timed writer known to the session; a stream's query must find it when it starts,
    as its batches run in a copy of the session."""
    spark.dataSource.register(_source())


def write_rows(rows: DataFrame, folder: str, timing: str | None = None) -> None:
    """``rows`` as Parquet in ``folder``, replacing what is there; the write time per partition in
    ``timing`` (``register`` comes first)."""
    if timing is None:
        rows.write.mode("overwrite").parquet(folder)
        return
    for f in (folder, timing):
        S.delete(rows.sparkSession, f)
    rows.write.format(FORMAT).mode("append").option("path", folder).option("timing", timing).save()


def timing(spark: SparkSession, folder: str) -> DataFrame:
    """Per batch and partition the rows written, and the write time in all and per row."""
    df = spark.read.schema(TIMING_DDL).option("basePath", folder).parquet(folder)
    return df.withColumn("ms_per_row", F.col("write_ms") / F.nullif(F.col("n_rows"), F.lit(0)))
