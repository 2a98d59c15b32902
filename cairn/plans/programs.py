"""The reference's programs as calls: each runs the same operators and returns one small
DataFrame report instead of printing.

* ``numeric_report``: maximum (reduce and ordered), minimum, mean and population variance of
  the normalised values (one scan for the extremes, one for the rest).
* ``word_count_report``: the three word-count shapes, each forced and timed (MET1), with the
  number of distinct words and their average length.
* ``kmedian_report``: the 3-round coreset k-median with its round times (MET2).
* ``sequential_kmedian_report``: one-table clustering (default k = 25, iter = 3) and its
  objective.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from cairn.operators import assign, kmedian, stats, wordcount


def numeric_report(df: DataFrame, col: str = "x") -> DataFrame:
    """``(n, max_reduce, max_ordered, min_ordered, mean_norm, var_norm)`` in one row."""
    z = stats.normalized(df, col)
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.max(col).alias("max_reduce"),
                  F.max_by(col, F.col(col)).alias("max_ordered"),
                  F.min_by(col, F.col(col)).alias("min_ordered"),
                  F.avg(z).alias("mean_norm"),
                  F.var_pop(z).alias("var_norm"))


def word_count_summary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(n_tokens, n_words, avg_len)``: tokens, distinct words and their mean UTF-16 length."""
    counts = wordcount.word_count(docs, text_col)
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_tokens"),
                      F.count(F.lit(1)).alias("n_words"),
                      F.avg(wordcount.utf16_length("word")).alias("avg_len"))


def _force(df: DataFrame) -> float:
    t = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def word_count_report(docs: DataFrame, k: int, seed: int = 0,
                      parts: int | None = None) -> DataFrame:
    """One row per shape ``(shape, seconds)`` plus the summary columns (MET1)."""
    spark = docs.sparkSession
    timings = [("word_count", _force(wordcount.word_count(docs))),
               ("word_count_salted", _force(wordcount.word_count_salted(docs, k, seed))),
               ("word_count_partitioned", _force(wordcount.word_count_partitioned(docs, parts)))]
    s = word_count_summary(docs).collect()[0]
    return spark.createDataFrame(
        [(name, secs, s.n_words, s.avg_len) for name, secs in timings],
        "shape string, seconds double, n_words bigint, avg_len double")


def kmedian_report(points: DataFrame, k: int, parts: int, iters: int,
                   seed: int = 0) -> DataFrame:
    """``(n, k, parts, iter, objective, round1_ms, round2_ms, round3_ms)`` (MET2)."""
    res = kmedian.coreset_kmedian(points, k, parts, iters, seed)
    ms = [int(round(res.timings[f"round{i}"] * 1000)) for i in (1, 2, 3)]
    spark: SparkSession = points.sparkSession
    return spark.createDataFrame(
        [(res.n, k, parts, iters, res.objective, *ms)],
        "n bigint, k int, parts int, iter int, objective double, "
        "round1_ms bigint, round2_ms bigint, round3_ms bigint")


def sequential_kmedian_report(points: DataFrame, k: int = 25, iters: int = 3,
                              seed: int = 0) -> DataFrame:
    """``(n, k, iter, objective)`` of one-table clustering with unit weights (KM7)."""
    pts = kmedian.prepare_points(points, 1, seed)
    try:
        centres = kmedian.weighted_kmedian(pts, k, iters, seed, prepared=True)
        n, _, objective = assign.observed_objective(pts, centres)
    finally:
        kmedian.drop_points(pts)
    return points.sparkSession.createDataFrame(
        [(n, k, iters, objective)], "n bigint, k int, iter int, objective double")
