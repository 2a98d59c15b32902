"""Random draws and cumulative distributions (PRJ8, PRJ10, WIN1, FLT1, TOP1, TOP2).

Draws use the hashed uniform of ``cairn.functions.random`` so they are reproducible under any
partitioning.  A weighted draw is an exponential race: the row with the smallest
``-ln(u)/weight`` wins with probability ``weight / sum(weight)``; Spark plans
``orderBy(key).limit(1)`` as TakeOrderedAndProject (each task keeps its best row), and the
per-group form is a ``min(struct(key, id, ...))`` aggregate with partial aggregation.

The inverse-CDF draw needs a running sum.  A global ``Window.orderBy`` would move every row
into one task; instead the rows are cut into ranges of the order key at approximate quantiles
(binary-searched per row by ``Bucketizer``), each range gets its own running sum, and a
per-range offset computed on the small table of range totals is broadcast back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cairn.functions.random import hashed_uniform, race_key


def uniform_draw(df: DataFrame, seed: int, tag: str = "u", id_col: str = "id") -> DataFrame:
    """One row drawn uniformly (TOP2)."""
    key = race_key(hashed_uniform(seed, tag, F.col(id_col)))
    return df.orderBy(key, F.col(id_col)).limit(1)


def weighted_race_draw(df: DataFrame, weight: Column, seed: int, tag: str = "r",
                       id_col: str = "id") -> DataFrame:
    """One row drawn with probability proportional to ``weight`` (TOP1); rows with
    weight <= 0 cannot be drawn."""
    key = race_key(hashed_uniform(seed, tag, F.col(id_col)), weight)
    return df.where(weight > 0).orderBy(key, F.col(id_col)).limit(1)


# Accuracy of the quantiles that are the range cuts: a rank error of N / accuracy only
# makes ranges a little uneven.
QUANTILE_ACCURACY = 10_000


# Up to so many ranges a row's range is found by comparisons with the cuts as literals.
MAX_LITERAL_CUTS = 256


def _range_of(key: Column, cuts: list[float]) -> Column:
    """The number of ``cuts`` not above ``key`` (0 for NULL), searched in two steps: the last block
    of cuts that begins not above it, then the place inside, about the square root of their number
    of comparisons each."""
    step = max(1, round(len(cuts) ** 0.5))
    blocks = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    begin = F.array(*[F.lit(b[0]) for b in blocks])
    block = F.size(F.filter(begin, lambda c: c <= key))
    table = F.array(*[F.array(*[F.lit(c) for c in b]) for b in blocks])
    inside = F.size(F.filter(F.get(table, block - 1), lambda c: c <= key))
    return F.when(block > 0, (block - 1) * step + inside).otherwise(F.lit(0))


def _with_range_bucket(rows: DataFrame, keys: DataFrame, order_col: str,
                       buckets: int) -> DataFrame:
    """``rows`` plus ``bucket``: the index of the key range holding each row.

    The B - 1 cut points are approximate quantiles of the key (one aggregate over the key
    column; B numbers reach the driver, a size set by the parameter).  Few cuts are
    literals of the plan; beyond ``MAX_LITERAL_CUTS`` Spark ML's ``Bucketizer`` finds each row's range
    by binary search inside the JVM, so the cost per row is O(log B) and the plan does not grow
    with B.  Any increasing cuts give the same result; the quantiles only balance the ranges."""
    if buckets <= 1:
        return rows.withColumn("bucket", F.lit(0))
    probs = [i / buckets for i in range(1, buckets)]
    key = F.col(order_col).cast("double")
    cuts = keys.select(F.percentile_approx(key, probs, QUANTILE_ACCURACY).alias("c")).first().c
    inner = sorted({float(c) for c in cuts or [] if c is not None})
    if not inner:
        return rows.withColumn("bucket", F.lit(0))
    if len(inner) < MAX_LITERAL_CUTS:
        return rows.withColumn("bucket", _range_of(key, inner))
    from pyspark.ml.feature import Bucketizer
    splits = [float("-inf")] + inner + [float("inf")]
    tmp_key, tmp_bucket = "__cairn_key", "__cairn_bucket"
    b = Bucketizer(splits=splits, inputCol=tmp_key, outputCol=tmp_bucket)
    out = b.transform(rows.withColumn(tmp_key, key))
    return out.withColumn("bucket", F.col(tmp_bucket).cast("int")).drop(tmp_key, tmp_bucket)


def default_buckets(df: DataFrame) -> int:
    """Ranges for a running share: the session's shuffle width, whatever the input's size."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def cumulative_share(df: DataFrame, value: Column, order_col: str = "id",
                     buckets: int | None = None, key_source: DataFrame | None = None) -> DataFrame:
    """``(order_col, p, cum)``: each row's share ``value / total`` and the running share in
    ``order_col`` order (WIN1, PRJ10).  ``order_col`` must be unique.

    The range cut points are approximate quantiles of ``order_col`` taken from
    ``key_source`` (default ``df``): pass a cheap frame with the same keys, e.g. the base
    table, when ``df`` is expensive to compute.  The rows are computed and exchanged once: a
    range's total is the last running sum in it, so both branches of the plan stand on the
    same exchange, which Spark reuses."""
    keys = (key_source if key_source is not None else df).select(order_col)
    if buckets is None:
        buckets = default_buckets(keys)
    rows = df.select(F.col(order_col), value.cast("double").alias("val"))
    rows = _with_range_bucket(rows, keys, order_col, buckets)
    within = Window.partitionBy("bucket").orderBy(order_col).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    run = rows.withColumn("run", F.sum("val").over(within))
    totals = run.groupBy("bucket").agg(F.max_by("run", order_col).alias("btotal"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "bucket", F.coalesce(F.sum("btotal").over(before), F.lit(0.0)).alias("offset"),
        F.sum("btotal").over(Window.partitionBy()).alias("total"))
    # One row per range, a number set by the parameter: 24 bytes each.  Every bucket has its row; a
    # left join adds no filter to one branch only, which would keep the exchange from being reused.
    return (run.join(F.broadcast(offsets), "bucket", "left")
            .select(order_col, (F.col("val") / F.col("total")).alias("p"),
                    ((F.col("offset") + F.col("run")) / F.col("total")).alias("cum")))


def cdf_draw(df: DataFrame, value: Column, x: float, order_col: str = "id",
             buckets: int | None = None, key_source: DataFrame | None = None) -> DataFrame:
    """Inverse-CDF draw for a given ``x`` in [0, 1]: the first row in ``order_col`` order
    whose running share reaches ``x`` (WIN1 + FLT1)."""
    cum = cumulative_share(df, value, order_col, buckets, key_source)
    return cum.where(F.col("cum") >= F.lit(x)).agg(F.min(order_col).alias(order_col))
