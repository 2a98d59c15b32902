"""The named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables.  Column names and types match ``cairn.plans.oracle``; computed doubles are
rounded (``DIGITS``, ``NORM_DIGITS`` for normalised values) on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cairn.functions.random import hashed_bucket
from cairn.functions.vectors import parse_vector
from cairn.operators import assign, kmedian, placement, sampling, stats, wordcount
from cairn.operators.assign import Centres
from cairn.plans import programs
from cairn.plans.params import (CDF_X, DIGITS, ITER, K, L, N_CENTRES, NORM_DIGITS, SALT_K,
                                SEED, SEQ_ITER, SEQ_K)
from cairn.session import scratch_folder
from cairn.sources import tables
from cairn.sources.text import (parse_numbers, read_lines, read_numbers, read_vectors, text_lines,
                                write_lines)


def _r(c, digits: int = DIGITS):
    return F.round(c, digits)


# ----------------------------------------------------------------------------- inputs

def _prices(spark, sf):
    return tables.order_prices(spark, sf)


def _docs(spark, sf):
    return tables.documents(spark, sf)


def _points(spark, sf):
    return tables.embedding_points(spark, sf)


def _weighted_points(spark, sf):
    """Points with a weight derived from the table: ``w = label + 1``."""
    return tables.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("v"),
        (F.col("label") + 1).cast("bigint").alias("w"))


def _weights(spark, sf):
    """A separate weight table ``(id, w)`` derived from the labels (JN2)."""
    return tables.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), (F.col("label") + 1).cast("bigint").alias("w"))


def _first_centres(points: DataFrame, n: int = N_CENTRES) -> DataFrame:
    """The ``n`` lowest-id points as centres ``(cid, id, v)``.

    The ids come from a scan of the id column only (TakeOrderedAndProject keeps n per task);
    the vectors are then fetched with an ``IN`` filter that Parquet can push down."""
    ids = [r.id for r in points.select("id").orderBy("id").limit(n).collect()]
    first = points.where(F.col("id").isin(ids)).select("id", "v")
    # cid = rank of the id among the n chosen ones, known on the driver: no global window
    rank = F.array_position(F.array(*[F.lit(int(i)) for i in ids]), F.col("id")) - 1
    return first.select(rank.cast("int").alias("cid"), "id", "v")


# ----------------------------------------------------------------------------- statistics

def q_num_parse(spark, sf):
    li = tables.spread(tables.table(spark, sf, "lineitem"), "l_orderkey")
    line = F.concat(F.col("l_partkey").cast("string"), F.lit(" "),
                    F.col("l_suppkey").cast("string"), F.lit("\t"),
                    F.col("l_linenumber").cast("string"), F.lit("  "))
    nums = parse_numbers(li.select(line.alias("value")))
    return nums.groupBy("x").agg(F.count(F.lit(1)).alias("n"))


def q_max_reduce(spark, sf):
    return stats.max_reduce(_prices(spark, sf))


def q_min_max_custom_order(spark, sf):
    """Extremes under an order that is not the value's own: by the part below a thousand, then by
    the value."""
    x = F.col("x")
    return stats.extremes_by(_prices(spark, sf), key=F.struct((x % 1000).alias("r"), x.alias("x")))


def q_row_count_sum_mean(spark, sf):
    s = stats.sum_mean(_prices(spark, sf))
    return s.select("n", _r("sum_x", 2).alias("sum_x"), _r("mean_x", 4).alias("mean_x"),
                    _r("sum_norm", DIGITS).alias("sum_norm"),
                    _r("mean_norm", NORM_DIGITS).alias("mean_norm"))


def q_minmax_normalize(spark, sf):
    n = stats.minmax_normalize(_prices(spark, sf))
    return n.select("id", _r("x_norm", NORM_DIGITS).alias("x_norm"))


def q_normalized_variance(spark, sf):
    v = stats.normalized_variance(_prices(spark, sf))
    return v.select("n", _r("mean_norm", NORM_DIGITS).alias("mean_norm"),
                    _r("var_norm", NORM_DIGITS).alias("var_norm"))


# ----------------------------------------------------------------------------- text files

# Line ends of the files that the file queries write: a third of the rows each.
LINE_ENDS = {"lf": "\n", "cr": "\r", "crlf": "\r\n"}


def _written(spark, lines: DataFrame, number, name: str) -> list[str]:
    """``lines`` (value) as text in the shared folder: by the remainder of ``number``, three folders
    with different line ends, each with a blank line at its end."""
    folders = []
    blank = spark.createDataFrame([("",)], "value string")
    for i, (kind, end) in enumerate(LINE_ENDS.items()):
        at = F.coalesce(F.pmod(number, F.lit(len(LINE_ENDS))), F.lit(len(LINE_ENDS) - 1))
        rows = lines.where(at == i).select("value")
        folders.append(write_lines(rows.unionByName(blank), scratch_folder(spark, f"{name}-{kind}"),
                                   end))
    return folders


def q_file_numbers(spark, sf):
    """Numbers written as text with mixed white space and read back from the files."""
    o = tables.table(spark, sf, "orders")
    line = F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit("\t "),
                    F.col("o_totalprice").cast("string"), F.lit("  "))
    rows = o.select(line.alias("value"), "o_orderkey")
    nums = read_numbers(spark, _written(spark, rows, F.col("o_orderkey"), "numbers"))
    return nums.groupBy("x").agg(F.count(F.lit(1)).alias("n"))


def q_file_lines(spark, sf):
    """The documents written as text and read back line by line, in at least L splits."""
    docs = tables.table(spark, sf, "documents").select(F.col("text").alias("value"), "doc_id")
    lines = read_lines(spark, _written(spark, docs, F.col("doc_id"), "lines"), min_partitions=L)
    return lines.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


def q_file_vectors(spark, sf):
    """Vectors written one per line, their id first, and read back from the files."""
    e = tables.table(spark, sf, "embeddings")
    items = F.transform(F.col("embedding").cast("array<double>"), lambda x: x.cast("string"))
    line = F.concat_ws(" ", F.col("vec_id").cast("string"), F.array_join(items, " "))
    rows = e.select(line.alias("value"), "vec_id")
    files = _written(spark, rows, F.col("vec_id"), "vectors")
    # a blank line is no vector (C9): its only token reads as NULL
    vec = read_vectors(spark, files, on_error="null").where(F.col("v")[0].isNotNull())
    return vec.select(F.col("v")[0].cast("bigint").alias("id"),
                      F.posexplode(F.slice("v", F.lit(2), F.size("v") - 1)).alias("p", "x")).select(
        "id", (F.col("p") + 1).cast("int").alias("pos"), "x")


# ----------------------------------------------------------------------------- text

def q_lines(spark, sf):
    return text_lines(_docs(spark, sf))


def q_tokenize(spark, sf):
    return wordcount.tokenize(_docs(spark, sf))


def q_doc_word_count(spark, sf):
    return wordcount.doc_word_counts(_docs(spark, sf))


def q_word_count(spark, sf):
    return wordcount.word_count(_docs(spark, sf))


def q_word_count_salted(spark, sf):
    return wordcount.word_count_salted(_docs(spark, sf), SALT_K, SEED)


def q_word_count_partitioned(spark, sf):
    return wordcount.word_count_partitioned(_docs(spark, sf))


def q_distinct_words(spark, sf):
    return wordcount.distinct_words(_docs(spark, sf))


def q_avg_distinct_word_length(spark, sf):
    a = wordcount.avg_distinct_word_length(_docs(spark, sf))
    return a.select("n_words", _r("avg_len").alias("avg_len"))


# ----------------------------------------------------------------------------- vectors

def q_vector_parse(spark, sf):
    o = tables.table(spark, sf, "orders")
    tail = F.when(F.col("o_orderkey") % 2 == 0, F.lit(" ")).otherwise(F.lit(""))
    line = F.concat(F.col("o_custkey").cast("string"), F.lit(" "),
                    F.col("o_orderkey").cast("string"), tail)
    vec = o.select(F.col("o_orderkey").alias("id"), parse_vector(line).alias("v"))
    return vec.select("id", F.posexplode("v").alias("p", "x")).select(
        "id", (F.col("p") + 1).cast("int").alias("pos"), "x")


def q_repartition_balance(spark, sf):
    part = hashed_bucket(SEED, F.col("id"), L)
    return (_points(spark, sf).select(part.alias("part")).groupBy("part")
            .agg(F.count(F.lit(1)).alias("n")))


def q_repartition_exact(spark, sf):
    """Every point's partition after an exact redistribution into L equal parts."""
    placed = placement.repartition_exact(_points(spark, sf).select("id"), L)
    return placed.select("id", F.spark_partition_id().alias("part"))


def q_unit_weights(spark, sf):
    return _points(spark, sf).select("id", "w")


def q_pairwise_distance(spark, sf):
    pts = _points(spark, sf)
    d = assign.pairwise_distance(pts, _first_centres(pts))
    return d.select("id", "cid", _r("d").alias("d"))


def q_closest_center(spark, sf):
    pts = _points(spark, sf)
    d = assign.closest_center(pts, _first_centres(pts))
    return d.select("id", "cid", _r("d").alias("d"))


def q_cluster_members(spark, sf):
    pts = _points(spark, sf)
    return assign.cluster_members(pts, _first_centres(pts))


def q_cluster_weights(spark, sf):
    pts = _points(spark, sf)
    return assign.cluster_weights(pts, _first_centres(pts))


def q_remaining_points(spark, sf):
    pts = _points(spark, sf)
    chosen = _first_centres(pts).select("id")
    return pts.join(F.broadcast(chosen), "id", "left_anti").select("id")


def q_weights_lookup(spark, sf):
    pts = _points(spark, sf).select("id", "v")
    return pts.join(_weights(spark, sf), "id").select("id", "w")


def _wd_frame(spark, sf):
    """Weighted points with ``wd = w * d`` to the first centres (for the draws)."""
    pts = _weighted_points(spark, sf)
    d = assign.closest_center(pts, _first_centres(pts), keep_weight=True)
    return d.select("id", "w", (F.col("w") * F.col("d")).alias("wd"))


def _ids(spark, sf):
    return tables.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"))


def q_weighted_distance_total(spark, sf):
    pts = _weighted_points(spark, sf)
    t = assign.weighted_distance_total(pts, _first_centres(pts))
    return t.select(_r("total").alias("total"))


def q_cumulative_probability(spark, sf):
    c = sampling.cumulative_share(_wd_frame(spark, sf), F.col("wd"), "id",
                                  key_source=_ids(spark, sf))
    return c.select("id", _r("p", NORM_DIGITS).alias("p"), _r("cum", NORM_DIGITS).alias("cum"))


def q_weighted_draw_cdf(spark, sf):
    return sampling.cdf_draw(_wd_frame(spark, sf), F.col("wd"), CDF_X, "id",
                             key_source=_ids(spark, sf))


def q_uniform_draw(spark, sf):
    return sampling.uniform_draw(_points(spark, sf).select("id"), SEED, "u")


def q_weighted_draw_race(spark, sf):
    return sampling.weighted_race_draw(_wd_frame(spark, sf), F.col("wd"), SEED, "r").select("id")


def q_weighted_centroid(spark, sf):
    pts = _weighted_points(spark, sf)
    c = assign.weighted_centroids(pts, _first_centres(pts))
    return c.select("cid", (F.col("pos") + 1).cast("int").alias("pos"), _r("x").alias("x"))


def q_kmedian_objective(spark, sf):
    pts = _points(spark, sf)
    o = assign.kmedian_objective(pts, _first_centres(pts))
    return o.select("n", _r("objective").alias("objective"))


def q_union_weighted_points(spark, sf):
    pts = _weighted_points(spark, sf)
    chosen = _first_centres(pts).select("id")
    remaining = pts.join(F.broadcast(chosen), "id", "left_anti") \
        .select("id", "w", F.lit("remaining").alias("src"))
    picked = pts.join(F.broadcast(chosen), "id", "left_semi") \
        .select("id", "w", F.lit("chosen").alias("src"))
    return remaining.unionByName(picked)


# ----------------------------------------------------------------------------- k-median

def _long(spark, centres: Centres, with_part=False):
    df = kmedian.centres_long(spark, centres, with_part)
    return df.withColumn("x", _r("x"))


def q_kmedian_seed(spark, sf):
    pts = kmedian.prepare_points(_points(spark, sf), 1, SEED)
    try:
        s = kmedian.seed_centres(pts, K, SEED, "s", use_part=False)
    finally:
        kmedian.drop_points(pts)
    return spark.createDataFrame([(c, i) for _, c, i in s.chosen], "cid int, id bigint")


def q_lloyd_refine(spark, sf):
    pts = _points(spark, sf)
    start = Centres.collect(_first_centres(pts, K), part_col=None)
    prep = kmedian.prepare_points(pts, 1, SEED)
    try:
        final = kmedian.lloyd(prep, start, ITER, use_part=False)
    finally:
        kmedian.drop_points(prep)
    return _long(spark, final)


def q_weighted_kmedian(spark, sf):
    return _long(spark, kmedian.weighted_kmedian(_points(spark, sf), K, ITER, SEED))


def q_sequential_kmedian(spark, sf):
    """KM7: unit weights, k = 25, iter = 3, objective over the same points."""
    pts = kmedian.prepare_points(_points(spark, sf), 1, SEED)
    try:
        centres = kmedian.weighted_kmedian(pts, SEQ_K, SEQ_ITER, SEED, prepared=True)
        n, _, objective = assign.observed_objective(pts, centres)
    finally:
        kmedian.drop_points(pts)
    return spark.createDataFrame([(n, SEQ_K, SEQ_ITER, round(objective, DIGITS))],
                                 "n bigint, k int, iter int, objective double")


def q_coreset(spark, sf):
    pts = kmedian.prepare_points(_points(spark, sf), L, SEED)
    try:
        rows = kmedian.coreset(pts, K, ITER, SEED)
    finally:
        kmedian.drop_points(pts)
    data = [(p, c, w, pos, round(float(x), DIGITS))
            for p, c, v, w in rows for pos, x in enumerate(v, start=1)]
    return spark.createDataFrame(data, "part int, cid int, w bigint, pos int, x double")


def q_coreset_merge(spark, sf):
    pts = kmedian.prepare_points(_points(spark, sf), L, SEED)
    try:
        rows = kmedian.coreset(pts, K, ITER, SEED)
    finally:
        kmedian.drop_points(pts)
    return _long(spark, kmedian.coreset_merge(spark, rows, K, ITER, SEED))


def q_coreset_kmedian(spark, sf):
    res = kmedian.coreset_kmedian(_points(spark, sf), K, L, ITER, SEED)
    return res.summary(spark).withColumn("objective", _r("objective"))


# ----------------------------------------------------------------------------- programs

def q_numeric_statistics(spark, sf):
    """The statistics program's whole output in one row."""
    r = programs.numeric_report(_prices(spark, sf))
    return r.select("n", "max_reduce", "max_ordered", "min_ordered",
                    _r("mean_norm", NORM_DIGITS).alias("mean_norm"),
                    _r("var_norm", NORM_DIGITS).alias("var_norm"))


def q_word_count_summary(spark, sf):
    """The word-count program's counts: tokens, distinct words, their average length."""
    r = programs.word_count_summary(_docs(spark, sf))
    return r.select("n_tokens", "n_words", _r("avg_len").alias("avg_len"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "num_parse": q_num_parse,
    "max_reduce": q_max_reduce,
    "min_max_custom_order": q_min_max_custom_order,
    "row_count_sum_mean": q_row_count_sum_mean,
    "minmax_normalize": q_minmax_normalize,
    "normalized_variance": q_normalized_variance,
    "lines": q_lines,
    "tokenize": q_tokenize,
    "doc_word_count": q_doc_word_count,
    "word_count": q_word_count,
    "word_count_salted": q_word_count_salted,
    "word_count_partitioned": q_word_count_partitioned,
    "distinct_words": q_distinct_words,
    "avg_distinct_word_length": q_avg_distinct_word_length,
    "vector_parse": q_vector_parse,
    "repartition_balance": q_repartition_balance,
    "repartition_exact": q_repartition_exact,
    "file_numbers": q_file_numbers,
    "file_lines": q_file_lines,
    "file_vectors": q_file_vectors,
    "unit_weights": q_unit_weights,
    "pairwise_distance": q_pairwise_distance,
    "closest_center": q_closest_center,
    "cluster_members": q_cluster_members,
    "cluster_weights": q_cluster_weights,
    "remaining_points": q_remaining_points,
    "weights_lookup": q_weights_lookup,
    "weighted_distance_total": q_weighted_distance_total,
    "cumulative_probability": q_cumulative_probability,
    "weighted_draw_cdf": q_weighted_draw_cdf,
    "uniform_draw": q_uniform_draw,
    "weighted_draw_race": q_weighted_draw_race,
    "weighted_centroid": q_weighted_centroid,
    "kmedian_objective": q_kmedian_objective,
    "union_weighted_points": q_union_weighted_points,
    "kmedian_seed": q_kmedian_seed,
    "lloyd_refine": q_lloyd_refine,
    "weighted_kmedian": q_weighted_kmedian,
    "sequential_kmedian": q_sequential_kmedian,
    "coreset": q_coreset,
    "coreset_merge": q_coreset_merge,
    "coreset_kmedian": q_coreset_kmedian,
    "numeric_statistics": q_numeric_statistics,
    "word_count_summary": q_word_count_summary,
}
