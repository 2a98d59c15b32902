"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import io
import os
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import cairn
from cairn.llm.arrow_text import trimmed
from cairn.session import checkpoint_dir

_shipped: set[str] = set()  # applications whose workers have the package


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_table(df: DataFrame, name: str) -> str:
    """Write ``df`` once as Parquet under ``spark.checkpoint.dir`` and return the path.

    A later stage that loses an executor rereads the files instead of recomputing the lineage.
    The folder goes when the session's file system closes, or earlier by ``drop_table``."""
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    p, fs = _path(spark, path)
    fs.deleteOnExit(p)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back; ``drop`` deletes it."""
    path = write_table(df, name)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept._table_path = path
    return kept


def drop(*tables: DataFrame) -> None:
    """Delete materialised tables that no later step reads."""
    for df in tables:
        drop_table(df.sparkSession, df._table_path)


def spread_join(rows: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with the one row that ``side`` has for its key, without a task for any frequent
    key.

    ``side`` (materialised) has ``n``, the number of ``rows`` with the key.  At most four keys a
    shuffle partition can have more than their share, all rows over four times the partitions: these
    few rows of ``side`` are sent to every task, so rows of frequent keys are not shuffled at all, and
    the others are joined by key.  ``rows`` is read twice."""
    total = side.agg(F.sum("n")).first()[0] or 0
    share = max(1000, total // (4 * shuffle_partitions(rows.sparkSession)))
    hot = F.broadcast(side.where(F.col("n") > share).drop("n"))
    cold = rows.join(hot.select(key), key, "left_anti").join(
        side.where(F.col("n") <= share).drop("n"), key)
    return rows.join(hot, key).unionByName(cold)


def drop_table(spark: SparkSession, *paths: str) -> None:
    """Delete tables of this run that no returned DataFrame reads any more."""
    for path in paths:
        p, fs = _path(spark, path)
        fs.delete(p, True)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished stages: Spark's cleaner follows the collectors.  The
    last execution stays referenced until another one, here an empty one, takes its place."""
    spark.range(0).collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable on the workers, once per application: its sources as a zip file in
    the shared folder, given to Spark as a Python file."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root, held = os.path.dirname(os.path.abspath(cairn.__file__)), io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in sorted(os.walk(root)):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    path = os.path.join(checkpoint_dir(spark), f"cairn-{sc.applicationId}.zip")
    p, fs = _path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(held.getvalue()))
    out.close()
    fs.deleteOnExit(p)
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def arrow(df: DataFrame, kernel: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with a kernel of this package: shipped to the workers, which give their
    memory back when its task ends."""
    ship_package(df.sparkSession)
    return df.mapInArrow(trimmed(kernel), schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """The names with underscores before them until no column of ``df`` is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
