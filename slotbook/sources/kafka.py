"""Kafka topics as line sources (S7, S9); ``messages.kafka_records`` makes the sink's columns (K1).

The value of a record is the line; the key is ignored.  ``decode`` works
on any DataFrame with Kafka's columns (``key``, ``value`` binary,
``topic``, ``partition``, ``offset``, ``timestamp``), which is what both
``spark.read.format('kafka')`` and ``spark.readStream.format('kafka')``
return; the readers below are thin adapters and need the Kafka connector
package on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def decode(records: DataFrame, type_from_topic: bool = True) -> DataFrame:
    """Kafka records → ``(log_type, value)`` text lines (+ position columns)."""
    cols = [F.col("value").cast("string").alias("value")]
    if type_from_topic:
        cols.insert(0, F.col("topic").alias("log_type"))
    for c in ("partition", "offset", "timestamp"):
        if c in records.columns:
            cols.append(F.col(c))
    return records.select(*cols)


def read_topics(spark: SparkSession, servers: str, topics: list[str], streaming: bool = True,
                options: dict | None = None) -> DataFrame:
    """All partitions of ``topics`` as one source (no per-receiver union, U2)."""
    r = spark.readStream if streaming else spark.read
    r = (r.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", ",".join(topics)))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return decode(r.load())
