"""Log files as DataFrames: scans, listings and the processed-file ledger
(S1, S3-S6, J2-J4, K5, K6, L2).

A listing is a DataFrame of file paths made by Spark's own file index
(``binaryFile`` with the content column pruned, so no file is read); the
ledger is a parquet table of processed paths.  New files are the listing
``left_anti`` the ledger, surviving entries the ledger ``left_semi`` the
listing — joins Spark plans and distributes like any other.  Files whose
base name starts with ``_`` or ``.`` (in-progress files) are skipped by
Spark's file sources themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotbook.session import raw_path
from slotbook.specs import LOG_TYPES


def type_below(spark: SparkSession, path: Column, root: str) -> Column:
    """The log type of a file: the first folder below ``root``, however deep
    the file lies.  Evaluated for every line of a scan, so plain string functions,
    not a regular expression."""
    top = raw_path(spark, root) + "/"
    # the path without scheme and host begins with the root; its text may also stand elsewhere
    host = F.locate("://", path)
    own = F.when(host > 0, F.substr(path, F.call_function("locate", F.lit("/"), path, host + 3))).otherwise(
        F.substr(path, F.locate("/", path)))
    rest = F.when(F.startswith(own, F.lit(top)), F.substr(own, F.lit(len(top) + 1)))
    return F.when(F.instr(rest, "/") > 0, F.substring_index(rest, "/", 1))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def scan_lines(spark: SparkSession, roots: str | dict[str, str]) -> DataFrame:
    """Lines of text files, at any depth, with the identity of their file.

    ``roots``: a folder with one sub-folder per log type, or a folder for each
    log type.  Columns: ``value``, ``file_path``, ``file_name``,
    ``file_modified``, ``log_type``."""
    if isinstance(roots, dict):
        frames = [scan_lines(spark, r).withColumn("log_type", F.lit(t)) for t, r in roots.items()]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out
    df = spark.read.option("recursiveFileLookup", "true").text(roots)
    path = F.col("_metadata.file_path")
    return df.select(
        "value", path.alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
        type_below(spark, path, roots).alias("log_type"))


def type_folders(root: str, types=LOG_TYPES) -> dict[str, str]:
    """The usual layout: ``{root}/{log_type}``."""
    return {t: f"{root.rstrip('/')}/{t}" for t in types}


def listing(spark: SparkSession, root: str) -> DataFrame:
    """Files under ``root``: path, name, log_type, modified, length (no content read)."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return df.select(
        F.col("path"), base_name(F.col("path")).alias("name"),
        type_below(spark, F.col("_metadata.file_path"), root).alias("log_type"),
        F.col("modificationTime").alias("modified"), F.col("length"))


def pending(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files not yet in the ledger."""
    return files.join(ledger.select("path"), "path", "left_anti")


def prune(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """Ledger entries whose file still exists."""
    return ledger.join(files.select("path"), "path", "left_semi")


def append_ledger(paths: DataFrame, ledger_dir: str) -> None:
    """K6: record processed paths; called only after the batch's output committed."""
    paths.select("path").distinct().write.mode("append").parquet(ledger_dir)


def read_ledger(spark: SparkSession, ledger_dir: str) -> DataFrame:
    return spark.read.parquet(ledger_dir).select("path")


def latest_version(files: DataFrame) -> DataFrame:
    """L2: the greatest name among the non-empty ledger files."""
    return files.where(F.col("length") > 0).agg(F.max("name").alias("name"))


def audit(lines: DataFrame) -> DataFrame:
    """K5: one row per source file taken — type, path, modification time and
    line count (an aggregate, so each file costs one row however large)."""
    return (lines.groupBy("log_type", "file_path", "file_name")
            .agg(F.max("file_modified").alias("file_modified"), F.count(F.lit(1)).alias("n_lines")))
