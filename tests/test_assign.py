"""C14, C15, C18, C19, C23 and the two assignment kernels."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from cairn.operators import assign
from cairn.operators.assign import Centres
from cairn.sources import tables
from conftest import SF01, centres_df, plan_text, points_df


def test_tie_goes_to_lowest_cid(spark):
    pts = points_df(spark, [[0.0]])
    c = centres_df(spark, [[1.0], [-1.0]])
    r = assign.closest_center(pts, c).collect()[0]
    assert (r.cid, r.d) == (0, 1.0)
    r = assign.closest_center_sql(pts, c).collect()[0]
    assert (r.cid, r.d) == (0, 1.0)


def test_weights_and_objective(spark):
    pts = points_df(spark, [[0.0], [1.0], [10.0]])
    c = centres_df(spark, [[0.0], [10.0]])
    w = {r.cid: r.w for r in assign.cluster_weights(pts, c).collect()}
    assert w == {0: 2, 1: 1}
    o = assign.kmedian_objective(pts, c).collect()[0]
    assert o.n == 3 and o.objective == pytest.approx(1 / 3)


def test_empty_cluster_has_weight_zero_and_no_centroid(spark):
    pts = points_df(spark, [[0.0], [1.0]])
    c = centres_df(spark, [[0.0], [50.0]])
    w = {r.cid: r.w for r in assign.cluster_weights(pts, c).collect()}
    assert w == {0: 2, 1: 0}
    cen = assign.weighted_centroids(pts, c).collect()
    assert [(r.cid, r.pos, r.x) for r in cen] == [(0, 0, 0.5)]


def test_weighted_centroid(spark):
    pts = points_df(spark, [[0.0], [4.0]], weights=[1, 3])
    c = centres_df(spark, [[1.0]])
    cen = assign.weighted_centroids(pts, c).collect()
    assert [(r.cid, r.x) for r in cen] == [(0, 3.0)]


def test_ragged_vectors_fail(spark):
    pts = points_df(spark, [[1.0, 2.0], [1.0]])
    c = centres_df(spark, [[0.0, 0.0]])
    with pytest.raises(Exception):
        assign.closest_center(pts, c).collect()


def test_kernels_agree_on_embeddings(spark):
    pts = tables.embedding_points(spark, SF01)
    c = pts.orderBy("id").limit(7).select(
        (F.row_number().over(Window.orderBy("id")) - 1).cast("int").alias("cid"), "v")
    a = {r.id: (r.cid, r.d) for r in assign.closest_center(pts, c).collect()}
    b = {r.id: (r.cid, r.d) for r in assign.closest_center_sql(pts, c).collect()}
    assert a.keys() == b.keys() and len(a) == 500
    for k in a:
        assert a[k][0] == b[k][0]
        assert abs(a[k][1] - b[k][1]) <= 1e-9 * max(1.0, b[k][1])


def test_pairwise_distance_matches_numpy(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(50, 3))
    C = rng.normal(size=(4, 3))
    pts = points_df(spark, X.tolist())
    got = {(r.id, r.cid): r.d for r in assign.pairwise_distance(pts, centres_df(spark, C.tolist())).collect()}
    for i in range(50):
        for j in range(4):
            assert got[(i, j)] == pytest.approx(np.linalg.norm(X[i] - C[j]), rel=1e-12)


def test_assignment_plan_has_no_shuffle(spark):
    pts = tables.embedding_points(spark, SF01)
    df = assign.closest_center(pts, centres_df(spark, [[0.0] * 64]))
    df.collect()
    plan = plan_text(df)
    assert "Exchange" not in plan and "MapInArrow" in plan
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in plan


def test_centre_chunks_split_by_part():
    c = Centres.from_rows([(p, 0, [1.0] * 100) for p in range(10)])
    chunks = c.chunks(max_bytes=2 * (100 * 8 + 4))
    assert [ch.parts() for ch in chunks] == [[0, 1], [2, 3], [4, 5], [6, 7], [8, 9]]


def test_chunked_broadcast_gives_same_stats(spark):
    from cairn.operators.kmedian import prepare_points, seed_centres, centre_weights
    pts = prepare_points(tables.embedding_points(spark, SF01), 4, 42)
    seeded = seed_centres(pts, 3, 42)
    whole = centre_weights(pts, seeded.centres)
    objective = assign.kmedian_objective(pts, Centres({0: seeded.centres.by_part[0]})).collect()
    try:
        for size in ("2000", "600"):  # a part's centres per piece; one centre per piece
            spark.conf.set("cairn.maxCentreBytes", size)
            assert centre_weights(pts, seeded.centres) == whole
            assert assign.kmedian_objective(
                pts, Centres({0: seeded.centres.by_part[0]})).collect() == objective
    finally:
        spark.conf.unset("cairn.maxCentreBytes")
        pts.unpersist()
    assert sum(whole.values()) == 500
