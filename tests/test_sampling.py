"""C10, C22: draws and running shares."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.functions.random import hashed_uniform
from cairn.operators import sampling
from conftest import plan_text


def weights(spark, ws):
    return spark.createDataFrame([(i + 1, float(w)) for i, w in enumerate(ws)], "id bigint, w double")


@pytest.mark.parametrize("x,expected", [(0.25, 1), (0.26, 2), (0.76, 3)])
def test_cdf_draw(spark, x, expected):
    df = weights(spark, [1, 2, 1])
    assert sampling.cdf_draw(df, F.col("w"), x).collect()[0].id == expected


@pytest.mark.parametrize("buckets", [1, 2, 3, 7])
def test_cumulative_share_matches_sequential(spark, buckets):
    rng = np.random.default_rng(buckets)
    ws = rng.random(200)
    df = weights(spark, ws)
    got = {r.id: (r.p, r.cum) for r in sampling.cumulative_share(df, F.col("w"), "id", buckets).collect()}
    cum = np.cumsum(ws) / ws.sum()
    for i in range(200):
        assert got[i + 1][0] == pytest.approx(ws[i] / ws.sum(), rel=1e-12)
        assert got[i + 1][1] == pytest.approx(cum[i], rel=1e-12)


def test_cumulative_share_has_no_global_window(spark):
    df = weights(spark, list(range(1, 100)))
    out = sampling.cumulative_share(df, F.col("w"), "id", 4)
    out.collect()
    plan = plan_text(out)
    # the only single-partition window runs over the per-bucket totals, after an aggregate
    assert "hashpartitioning(bucket" in plan


def test_uniform_hash_is_partition_independent(spark):
    df = spark.range(0, 1000)
    a = {r.id: r.u for r in df.select("id", hashed_uniform(7, "x", F.col("id")).alias("u")).collect()}
    b = {r.id: r.u for r in df.repartition(13).select("id", hashed_uniform(7, "x", F.col("id")).alias("u")).collect()}
    assert a == b
    us = np.array(list(a.values()))
    assert 0 < us.min() and us.max() < 1 and abs(us.mean() - 0.5) < 0.05


def test_race_draw_plan_is_take_ordered(spark):
    df = weights(spark, [1, 2, 3])
    out = sampling.weighted_race_draw(df, F.col("w"), 1)
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_race_draw_distribution(spark):
    """Chi-square of many seeded draws against w / sum(w) (one job for all seeds)."""
    ws = [1.0, 2.0, 3.0, 4.0]
    seeds = 2000
    n = len(ws)
    df = spark.range(seeds * n).select(
        (F.col("id") / n).cast("bigint").alias("seed"), (F.col("id") % n + 1).alias("id"),
        F.element_at(F.array(*[F.lit(w) for w in ws]), (F.col("id") % n + 1).cast("int")).alias("w"))
    key = -F.log((F.conv(F.substring(F.md5(F.concat(F.col("seed").cast("string"), F.lit(":r:"),
                                                          F.col("id").cast("string"))), 1, 13),
                         16, 10).cast("double") + 0.5) / 4503599627370496.0) / F.col("w")
    best = df.groupBy("seed").agg(F.min(F.struct(key.alias("k"), F.col("id"))).alias("b"))
    counts = {r.id: r.n for r in best.groupBy("b.id").agg(F.count("*").alias("n"))
              .withColumnRenamed("b.id", "id").select(F.col("id"), "n").collect()}
    expected = np.array(ws) / sum(ws) * seeds
    observed = np.array([counts.get(i + 1, 0) for i in range(len(ws))])
    chi2 = float(((observed - expected) ** 2 / expected).sum())
    assert chi2 < 16.27  # 3 degrees of freedom, p = 0.001
    # the library's single draw uses the same key
    one = sampling.weighted_race_draw(weights(spark, ws), F.col("w"), 0).collect()
    assert len(one) == 1


def test_weighted_draw_excludes_zero_weight(spark):
    df = weights(spark, [0, 0, 5])
    assert sampling.weighted_race_draw(df, F.col("w"), 3).collect()[0].id == 3


def test_cumulative_share_with_many_ranges(spark):
    """Thousands of key ranges (the width a large input needs): the bucket lookup is a
    binary search in the JVM, so the plan stays small and the result stays exact."""
    rng = np.random.default_rng(11)
    ws = rng.random(6000)
    df = weights(spark, ws).repartition(8)
    out = sampling.cumulative_share(df, F.col("w"), "id", 4000)
    got = {r.id: r.cum for r in out.collect()}
    cum = np.cumsum(ws) / ws.sum()
    assert len(got) == 6000
    assert all(got[i + 1] == pytest.approx(cum[i], rel=1e-9) for i in range(6000))
    assert len(plan_text(out)) < 20_000


def test_running_share_computes_and_exchanges_rows_once(spark):
    from cairn.plans import queries
    from conftest import SF01
    df = queries.QUERIES["cumulative_probability"](spark, SF01)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("MapInArrow") == 1 and plan.count("+- ReusedExchange") == 1
    assert plan.count("+- Exchange hashpartitioning(bucket") == 1


@pytest.mark.parametrize("buckets", [2, 5, 16, 256, 300])
def test_ranges_are_even_and_in_order(spark, buckets):
    rng = np.random.default_rng(buckets)
    ws, ids = rng.random(3000), rng.permutation(3000).tolist()
    df = spark.createDataFrame([(int(i) - 1500, float(w)) for i, w in zip(ids, ws)],
                               "id bigint, w double").repartition(4)
    out = sampling.cumulative_share(df, F.col("w"), "id", buckets)
    got = {r.id: r.cum for r in out.collect()}
    order = np.argsort(ids)
    cum = np.cumsum(ws[order]) / ws.sum()
    assert all(got[i - 1500] == pytest.approx(cum[i], rel=1e-9) for i in range(3000))
    ranged = sampling._with_range_bucket(df, df, "id", buckets).groupBy("bucket").agg(
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).orderBy("bucket")
    rows = ranged.collect()
    assert [r.bucket for r in rows] == list(range(buckets))
    assert all(a.hi < b.lo for a, b in zip(rows, rows[1:]))
    assert max(r.n for r in rows) <= 3 * 3000 / buckets


def test_running_share_of_few_distinct_and_no_rows(spark):
    df = weights(spark, [2.0])
    assert [(r.p, r.cum) for r in sampling.cumulative_share(df, F.col("w"), "id", 9).collect()] == [(1.0, 1.0)]
    assert sampling.cumulative_share(df.where("false"), F.col("w"), "id", 9).count() == 0


def test_null_ids_are_refused_in_draws(spark):
    from cairn.operators import kmedian
    df = spark.createDataFrame([(i, 1.0) for i in range(5)] + [(None, 1.0)], "id bigint, w double")
    pts = spark.createDataFrame([(i, [float(i)], 1) for i in range(5)] + [(None, [9.0], 1)],
                                "id bigint, v array<double>, w bigint")
    calls = [lambda: sampling.uniform_draw(df, 1).collect(),
             lambda: sampling.weighted_race_draw(df, F.col("w"), 1).collect(),
             lambda: kmedian.weighted_kmedian(pts, 2, 1, 1),
             lambda: kmedian.coreset_kmedian(pts, 2, 2, 1, 1),
             lambda: kmedian.seed_centres(kmedian.prepare_points(pts, 1, 1, False), 3, 1,
                                          use_part=False, lookahead=0)]
    for call in calls:
        with pytest.raises(Exception, match="NULL id"):
            call()
