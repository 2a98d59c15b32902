"""Loaders for the parquet tables, projecting only the columns each operator needs so the
scan's ReadSchema stays narrow."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def scan_partitions(df: DataFrame) -> int | None:
    """Number of splits of a file scan with nothing but projections and filters above it, as the
    scan node of its physical plan has them from the files; None for any other plan, whose
    partitions may only be known by running it."""
    node = df._jdf.queryExecution().sparkPlan()
    while node.getClass().getSimpleName() in ("ProjectExec", "FilterExec"):
        node = node.children().apply(0)
    if node.getClass().getSimpleName() != "FileSourceScanExec":
        return None
    return node.inputRDDs().apply(0).getNumPartitions()


def spread(scan: DataFrame, key: str, min_partitions: int | None = None) -> DataFrame:
    """Minimum-partitions hint (C24, as ``textFile(path, n)``): a table scan read in fewer
    partitions than ``min_partitions`` (default: the session's parallelism), e.g. a small
    file in one row group, is hash-partitioned by ``key`` once, so every core gets a share.
    A large table already has more splits than task slots and is left as it is (no shuffle).

    Only for scans with projections and filters, whose splits the scan node has; any other input
    is left as it is, since counting its partitions would run it."""
    n = min_partitions or scan.sparkSession.sparkContext.defaultParallelism
    have = scan_partitions(scan)
    return scan if have is None or have >= n else scan.repartition(n, key)


def documents(spark: SparkSession, sf_dir: str, min_partitions: int | None = None) -> DataFrame:
    """``(doc_id bigint, text string)``: one row per document (spread as ``spread`` says)."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id",
                  min_partitions)


def order_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id bigint, x double)`` from ``orders``: the numeric column used for statistics."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("x"))


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit-weight points ``(id bigint, v array<float>, w bigint)`` from ``embeddings``: the
    kernels widen the floats, so a pass keeps and sends half the bytes."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("v"),
        F.lit(1).cast("bigint").alias("w"))


def lineitem_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-d points (quantity, price, discount, tax) from ``lineitem``, for volume tests.

    (l_orderkey, l_linenumber) is not unique in the driver data, so the id is a generated
    one, deterministic for a fixed file layout."""
    pts = table(spark, sf_dir, "lineitem").select(
        F.monotonically_increasing_id().alias("id"),
        F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax").alias("v"),
        F.lit(1).cast("bigint").alias("w"))
    return spread(pts, "id")
