"""Session settings and the shared scratch folder.

Everything in the library assumes ``spark.sql.session.timeZone=UTC``: times
read from the plant CSVs are naive wall-clock values, and zone shifts are
always explicit (see :mod:`helioframe.functions.timefns`).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library is written against.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "helioframe",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and local runs.

    On a cluster the submit command supplies master, memory and
    ``spark.checkpoint.dir``; nothing here overrides those.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # Small local inputs: let AQE keep several tasks per shuffle instead of
        # packing a few MB (e.g. a write into many day/bucket folders) into one.
        conf["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = "64k"
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
    """Return the shared checkpoint folder, creating a local one only in local mode.

    A cluster names its shared folder in ``spark.checkpoint.dir``; it is read,
    never replaced. Only when it is unset *and* the master is local (tests,
    bench) is a fresh folder under the system temp directory used.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared "
                "folder for checkpoints and staging tables")
        d = tempfile.mkdtemp(prefix="helioframe-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python's os can look at a local path."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


def materialize(df, name: str, compression: str | None = None):
    """Cut lineage: write ``df`` as a Parquet table in the shared checkpoint
    folder and return it read back (one job, compressed, columnar).

    Returns ``(frame, path)``; the path can be dropped with :func:`discard`
    once the frame is no longer needed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table written by :func:`materialize`."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
