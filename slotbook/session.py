"""Session helpers: building a session, the shared scratch folder, and
Hadoop-filesystem metadata calls (list / rename) that work on any cluster
filesystem, not only a local disk."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # PySpark otherwise records the Python call site of every Column function
    # with several JVM round trips each; that is a debugging aid and makes
    # building a plan (once per micro-batch in streaming) cost seconds.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "slotbook",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared (e.g. HDFS/S3) folder and is
    used as is.  Only when it is unset (local tests) is one made here.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="slotbook-ckpt-")
        sc.setCheckpointDir(d)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/slotbook/{name}-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def raw_path(spark: SparkSession, path: str) -> str:
    """The path part of ``path`` as it stands in ``_metadata.file_path``
    (percent-encoded, without scheme and host)."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toUri().getRawPath().rstrip("/")


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Metadata-only move on the cluster filesystem."""
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Names of the data files directly inside ``folder`` (bounded by the
    number of files one writer task made; used only to name them)."""
    fs, p = _fs(spark, folder)
    return [s.getPath().toString() for s in fs.listStatus(p)
            if s.isFile() and not os.path.basename(s.getPath().getName()).startswith(("_", "."))]


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a path on the cluster filesystem (used to model a vanished file)."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def list_dirs(spark: SparkSession, folder: str) -> list[str]:
    """Sub-folders directly inside ``folder`` (a handful of version folders)."""
    fs, p = _fs(spark, folder)
    return [s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory()]


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file (an in-progress or not yet filled output)."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()
