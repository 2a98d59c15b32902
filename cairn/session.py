"""Session helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "cairn") -> SparkSession:
    """Return the active session, or build a local one with settings suited to tests/bench.

    On a cluster the session comes from spark-submit and this only returns it.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster).  Only when it is unset on a
    ``local`` master, as in tests, a private folder under the system temp dir is created,
    registered and removed at exit; on a cluster an unset setting is an error, never a machine-local folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a shared folder to checkpoint")
        current = tempfile.mkdtemp(prefix="cairn-ckpt-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def tag_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir for a named materialisation."""
    return os.path.join(checkpoint_dir(spark), name)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote, through the file system it is on."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint dir, deleted when the session's file system closes."""
    path = tag_dir(spark, f"{name}-{uuid.uuid4().hex}")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path
