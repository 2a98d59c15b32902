"""C12-C22: seeding, Lloyd, coreset and the 3-round k-median."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.operators import assign, kmedian
from cairn.sources import tables
from conftest import SF001, SF01, centres_df, plan_text, points_df


def _vecs(centres):
    return sorted(tuple(np.round(v, 9)) for _, _, v in centres.rows())


def test_duplicates_collapse(spark):
    pts = points_df(spark, [[1.0, 1.0]] * 5)
    res = kmedian.coreset_kmedian(pts, 3, 1, 1, seed=1)
    assert len(res.coreset) == 1 and res.coreset[0][3] == 5
    assert res.objective == 0.0 and res.n == 5


def test_k_above_n(spark):
    pts = points_df(spark, [[0.0], [3.0]])
    c = kmedian.weighted_kmedian(pts, 5, 0, seed=2)
    assert _vecs(c) == [(0.0,), (3.0,)]
    assert assign.kmedian_objective(pts, c).collect()[0].objective == 0.0


def test_k_equals_one(spark):
    pts = points_df(spark, [[0.0], [2.0]])
    res = kmedian.coreset_kmedian(pts, 1, 1, 1, seed=3)
    assert _vecs(res.centres) == [(1.0,)]
    assert res.objective == pytest.approx(1.0)


def test_lloyd_uses_all_centres(spark):
    # far-apart pairs: the second seed has neighbours; the first Lloyd step must use it (C12)
    pts = points_df(spark, [[0.0], [0.1], [100.0], [100.1]])
    seeded = kmedian.seed_centres(kmedian.prepare_points(pts, 1, 0, persist=False), 2, 5,
                                  use_part=False)
    assert len(list(seeded.centres.rows())) == 2
    c = kmedian.lloyd(kmedian.prepare_points(pts, 1, 0, persist=False), seeded.centres, 1,
                      use_part=False)
    assert _vecs(c) == [(0.05,), (100.05,)]


def test_empty_cluster_dropped(spark):
    pts = kmedian.prepare_points(points_df(spark, [[0.0], [1.0]]), 1, 0, persist=False)
    start = assign.Centres.from_rows([(0, 0, [0.0]), (0, 1, [50.0])])
    c = kmedian.lloyd(pts, start, 1, use_part=False)
    assert list(c.rows()) == [(0, 0, [0.5])]


def test_empty_part(spark):
    pts = points_df(spark, [[0.0], [5.0]])
    res = kmedian.coreset_kmedian(pts, 2, 4, 1, seed=4)
    assert sum(w for *_, w in res.coreset) == 2


@pytest.mark.parametrize("k,parts,iters", [(0, 1, 1), (2, 0, 1), (2, 1, -1)])
def test_bad_arguments(spark, k, parts, iters):
    pts = points_df(spark, [[0.0]])
    with pytest.raises(ValueError):
        kmedian.coreset_kmedian(pts, k, parts, iters)


def test_reproducible_under_partitioning(spark):
    pts = tables.embedding_points(spark, SF001)
    a = kmedian.coreset_kmedian(pts.coalesce(1), 4, 3, 1, seed=9)
    b = kmedian.coreset_kmedian(pts.repartition(13), 4, 3, 1, seed=9)
    assert a.objective == pytest.approx(b.objective, rel=1e-9)
    assert [(p, c, w) for p, c, _, w in a.coreset] == [(p, c, w) for p, c, _, w in b.coreset]
    for (_, _, va, _), (_, _, vb, _) in zip(a.coreset, b.coreset):
        assert np.allclose(va, vb, rtol=1e-9, atol=1e-12)


def test_coreset_weights_sum_to_n(spark):
    pts = kmedian.prepare_points(tables.embedding_points(spark, SF01), 4, 42)
    try:
        rows = kmedian.coreset(pts, 5, 2, 42)
    finally:
        pts.unpersist()
    assert sum(w for *_, w in rows) == 500
    assert {p for p, *_ in rows} == {0, 1, 2, 3}


def test_seeding_yields_distinct_input_points(spark):
    pts = tables.embedding_points(spark, SF01)
    prep = kmedian.prepare_points(pts, 1, 7)
    try:
        s = kmedian.seed_centres(prep, 6, 7, use_part=False)
    finally:
        prep.unpersist()
    ids = [i for _, _, i in s.chosen]
    assert len(ids) == 6 == len(set(ids)) and [c for _, c, _ in s.chosen] == list(range(6))


def test_lloyd_lowers_squared_cost(spark):
    """The weighted-mean update cannot raise the sum of squared distances."""
    rng = np.random.default_rng(0)
    X = np.vstack([rng.normal(loc=m, size=(40, 2)) for m in (0, 5, 10)])
    pts = points_df(spark, X.tolist())
    prep = kmedian.prepare_points(pts, 1, 0, persist=False)
    c = kmedian.seed_centres(prep, 3, 11, use_part=False).centres

    def sq_cost(cen):
        M = np.vstack([v for _, _, v in cen.rows()])
        return float((((X[:, None, :] - M[None]) ** 2).sum(-1)).min(1).sum())

    costs = [sq_cost(c)]
    for _ in range(3):
        c = kmedian.lloyd(prep, c, 1, use_part=False)
        costs.append(sq_cost(c))
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))


def test_objective_zero_when_every_point_is_a_centre(spark):
    pts = points_df(spark, [[float(i), 0.0] for i in range(6)])
    c = kmedian.weighted_kmedian(pts, 6, 0, seed=5)
    assert assign.kmedian_objective(pts, c).collect()[0].objective == 0.0


def test_merge_keeps_weight_and_k(spark):
    pts = kmedian.prepare_points(tables.embedding_points(spark, SF01), 4, 42)
    try:
        rows = kmedian.coreset(pts, 5, 2, 42)
    finally:
        kmedian.drop_points(pts)
    merged = kmedian.coreset_merge(spark, rows, 5, 2, 42)
    assert [c for _, c, _ in merged.rows()] == [0, 1, 2, 3, 4]
    same = kmedian.weighted_kmedian(
        kmedian.coreset_frame(spark, rows, 5).repartition(3), 5, 2, 42, tag="m")
    for (_, _, a), (_, _, b) in zip(merged.rows(), same.rows()):
        assert np.allclose(a, b, rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("bad", [[None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], [1.0], None])
def test_bad_vectors_raise_everywhere(spark, bad):
    rows = [(i, [float(i), 0.0], 1) for i in range(4)] + [(4, bad, 1)]
    pts = spark.createDataFrame(rows, "id bigint, v array<double>, w bigint")
    centres = centres_df(spark, [[0.0, 0.0], [3.0, 0.0]])
    calls = [lambda: kmedian.weighted_kmedian(pts, 2, 1, seed=1),
             lambda: kmedian.coreset_kmedian(pts, 2, 1, 1, seed=1),
             lambda: assign.pairwise_distance(pts, centres).collect(),
             lambda: assign.closest_center(pts, centres).collect(),
             lambda: assign.weighted_centroids(pts, centres).collect()]
    for call in calls:
        with pytest.raises(Exception, match="NULL|NaN|unequal|dimensions"):
            call()


@pytest.mark.parametrize("bad", [None, -1])
def test_bad_weights_raise_everywhere(spark, bad):
    rows = [(i, [float(i), 0.0], 1) for i in range(4)] + [(4, [9.0, 9.0], bad)]
    pts = spark.createDataFrame(rows, "id bigint, v array<double>, w bigint")
    centres = centres_df(spark, [[0.0, 0.0], [3.0, 0.0]])
    for call in (lambda: kmedian.weighted_kmedian(pts, 2, 1, seed=1),
                 lambda: kmedian.coreset_kmedian(pts, 2, 1, 1, seed=1),
                 lambda: assign.cluster_weights(pts, centres).collect(),
                 lambda: assign.closest_center(pts, centres, keep_weight=True).collect()):
        with pytest.raises(Exception, match="weight"):
            call()


def test_unequal_dimensions_raise(spark):
    pts = points_df(spark, [[1.0, 1.0], [3.0, 4.0]])
    one = centres_df(spark, [[0.0]])
    for call in (lambda: assign.pairwise_distance(pts, one).collect(),
                 lambda: assign.closest_center(pts, one).collect(),
                 lambda: assign.closest_center_sql(pts, one).collect()):
        with pytest.raises(Exception, match="dimension|length"):
            call()


def test_driver_steps_are_linear_in_the_parts():
    import time

    import pyarrow as pa
    parts, rounds, keep = 2000, 8, 5
    n = parts * rounds * keep
    rng = np.random.default_rng(1)
    table = pa.table({"part": np.repeat(np.arange(parts), rounds * keep).astype(np.int32),
                      "t": np.tile(np.repeat(np.arange(rounds), keep), parts).astype(np.int32),
                      "lb": rng.random(n), "id": np.arange(n), "e": rng.random(n),
                      "w": np.ones(n), "d": rng.random(n),
                      "v": pa.array(list(rng.random((n, 4))))})
    t = time.perf_counter()
    groups = kmedian._candidate_groups(table)
    assert time.perf_counter() - t < 1.0 and len(groups) == parts * rounds
    assert (np.diff(groups[7, 3][0]) >= 0).all()
    stats = {(p, c): (1, 1.0, 0.0, np.ones(4)) for p in range(parts) for c in range(25)}
    t = time.perf_counter()
    moved = kmedian._moved(stats)
    assert time.perf_counter() - t < 1.5 and moved.size == parts * 25


def test_passes_do_not_grow_with_the_parts(spark):
    line = tables.lineitem_points(spark, SF01)
    passes = {}
    for parts in (8, 256):
        pts = kmedian.prepare_points(line, parts, 42)
        passes[parts] = kmedian.seed_centres(pts, 16, 42).passes
        kmedian.drop_points(pts)
    assert passes[256] <= passes[8] + 1 < 9


def test_preparing_a_joined_input_starts_no_job(spark):
    from cairn.operators import sampling
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("no-jobs", "no-jobs")
    try:
        a = tables.table(spark, SF01, "orders")
        joined = a.join(tables.table(spark, SF01, "customer").hint("shuffle_hash"),
                        a["o_custkey"] == F.col("c_custkey")).select(
            F.col("o_orderkey").alias("id"), F.array(F.col("o_totalprice")).alias("v"))
        before = len(tracker.getJobIdsForGroup("no-jobs"))  # the footers of the two tables
        pts = kmedian.prepare_points(joined, 4, 1, persist=False, min_partitions=5)
        assert tables.spread(joined, "id") is joined
        sampling.default_buckets(joined)
        assert len(tracker.getJobIdsForGroup("no-jobs")) == before
        assert "hashpartitioning(id" in plan_text(pts)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_kernels_ship_without_the_package(tmp_path):
    """Task closures are pickled by value: a process without the package can run them."""
    import subprocess
    import sys
    from pyspark import cloudpickle
    from cairn.operators import assign  # noqa: F401  (registers the kernels by value)
    from cairn.operators.kernels import stats_kernel

    class BC:
        value = {0: (np.array([0], dtype=np.int32), np.zeros((1, 2)))}

    blob = tmp_path / "k.pkl"
    blob.write_bytes(cloudpickle.dumps(stats_kernel([BC()], True)))
    code = ("import pickle, pyarrow as pa, sys; f = pickle.loads(open(sys.argv[1], 'rb').read());"
            "b = pa.RecordBatch.from_pydict({'id': [1], 'v': [[3.0, 4.0]], 'w': [1], 'part': [0]});"
            "print(sum(x.num_rows for x in f([b])))")
    out = subprocess.run([sys.executable, "-c", code, str(blob)], cwd=str(tmp_path),
                         capture_output=True, text=True, timeout=60,
                         env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ""})
    assert out.returncode == 0, out.stderr
    assert out.stdout.strip() == "5"


def test_empty_input_gives_null_objective(spark):
    empty = spark.createDataFrame([], "id bigint, v array<double>, w bigint")
    res = kmedian.coreset_kmedian(empty, 3, 2, 1, seed=1)
    assert (res.n, res.objective, res.coreset) == (0, None, [])
    row = res.summary(spark).collect()[0]
    assert row.n == 0 and row.objective is None


@pytest.mark.parametrize("mode", ["memory", "checkpoint", "none"])
def test_storage_modes_agree(spark, mode):
    pts = tables.embedding_points(spark, SF001)
    res = kmedian.coreset_kmedian(pts, 3, 2, 1, seed=5, persist=mode)
    base = kmedian.coreset_kmedian(pts, 3, 2, 1, seed=5)
    assert res.objective == pytest.approx(base.objective, rel=1e-12)
    with pytest.raises(ValueError):
        kmedian.prepare_points(pts, 1, 0, persist="disk")


def _count_passes(monkeypatch):
    calls = []
    orig = kmedian.apply_kernel
    monkeypatch.setattr(kmedian, "apply_kernel", lambda *a, **kw: calls.append(1) or orig(*a, **kw))
    return calls


@pytest.mark.parametrize("parts,k", [(4, 5), (1, 12)])
def test_lookahead_seeding_draws_the_same_centres(spark, monkeypatch, parts, k):
    pts = kmedian.prepare_points(tables.embedding_points(spark, SF01), parts, 42)
    calls = _count_passes(monkeypatch)
    try:
        base = kmedian.seed_centres(pts, k, 42, use_part=parts > 1, lookahead=0)
        n_base = len(calls)
        for la, m in [(1, 1), (3, 2), (5, 6)]:
            del calls[:]
            got = kmedian.seed_centres(pts, k, 42, use_part=parts > 1, lookahead=la,
                                       candidates=m)
            assert got.chosen == base.chosen
            assert _vecs(got.centres) == _vecs(base.centres)
            assert len(calls) < n_base
    finally:
        pts.unpersist()


def test_lookahead_falls_back_when_the_bound_fails(spark, monkeypatch):
    """Two tight clusters far apart: once a centre lands in the second cluster, the
    candidates kept for the next round (all from that cluster) lose their lead, the bound
    cannot prove the draw and a new pass is made.  The centres stay the same."""
    rng = np.random.default_rng(5)
    X = np.vstack([rng.normal(0, 0.01, (60, 2)), rng.normal(100, 0.01, (60, 2))])
    pts = kmedian.prepare_points(points_df(spark, X.tolist()), 1, 0)
    calls = _count_passes(monkeypatch)
    try:
        base = kmedian.seed_centres(pts, 6, 3, use_part=False, lookahead=0)
        del calls[:]
        got = kmedian.seed_centres(pts, 6, 3, use_part=False, lookahead=4, candidates=1)
    finally:
        pts.unpersist()
    assert got.chosen == base.chosen
    assert len(calls) >= 2  # one pass could have settled all 5 rounds; the bound refused


def test_lookahead_with_fewer_distinct_points_than_k(spark):
    pts = kmedian.prepare_points(points_df(spark, [[0.0], [0.0], [1.0], [1.0], [5.0]]), 1, 0)
    try:
        a = kmedian.seed_centres(pts, 6, 9, use_part=False, lookahead=0)
        b = kmedian.seed_centres(pts, 6, 9, use_part=False, lookahead=3)
    finally:
        pts.unpersist()
    assert a.chosen == b.chosen and len(b.chosen) == 3


def test_coreset_kmedian_same_with_and_without_lookahead(spark):
    pts = tables.embedding_points(spark, SF001)
    a = kmedian.coreset_kmedian(pts, 4, 3, 2, 11, lookahead=0)
    b = kmedian.coreset_kmedian(pts, 4, 3, 2, 11)
    assert [(p, c, w) for p, c, _, w in a.coreset] == [(p, c, w) for p, c, _, w in b.coreset]
    assert a.objective == b.objective


def test_lookahead_pass_ships_a_bounded_candidate_table(spark, monkeypatch):
    """Per pass the driver receives at most L * rounds * (candidates + 1) rows, whatever
    the number of points or tasks."""
    sizes = []
    orig = kmedian._candidate_groups
    monkeypatch.setattr(kmedian, "_candidate_groups",
                        lambda table: sizes.append(table.num_rows) or orig(table))
    pts = kmedian.prepare_points(tables.embedding_points(spark, SF01).repartition(16), 3, 5)
    try:
        kmedian.seed_centres(pts, 9, 5, use_part=True, lookahead=3, candidates=2)
    finally:
        pts.unpersist()
    assert sizes and all(n <= 3 * 4 * 3 for n in sizes)


def coreset_rows(n=40, dim=3, parts=4, seed=5):
    rng = np.random.default_rng(seed)
    return [(i % parts, i // parts, [float(x) for x in rng.normal(size=dim)], int(rng.integers(1, 9)))
            for i in range(n)]


@pytest.mark.parametrize("k,iters", [(1, 0), (5, 2), (12, 3), (60, 1)])
def test_merge_in_one_task_draws_and_moves_like_the_passes(spark, k, iters):
    rows = coreset_rows()
    rows[7] = (*rows[7][:2], rows[3][2], rows[7][3])  # two equal centres
    whole = kmedian.coreset_merge(spark, rows, 60, iters, 9) if k == 60 else \
        kmedian.coreset_merge(spark, rows, k, iters, 9)
    passes = kmedian.coreset_merge(spark, rows, k, iters, 9, whole_bytes=0)
    assert whole.size == passes.size == min(k, 39)
    for (p, c, v), (q, d, u) in zip(whole.rows(), passes.rows()):
        assert (p, c) == (q, d) and v == pytest.approx(u, rel=1e-12)


def test_merge_is_one_job(spark):
    sc = spark.sparkContext
    sc.setJobGroup("merge", "round 2")
    try:
        kmedian.coreset_merge(spark, coreset_rows(), 5, 2, 9)
        jobs = sc.statusTracker().getJobIdsForGroup("merge")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1


def test_round_three_is_one_stage_and_counts_the_points(spark):
    sc = spark.sparkContext
    pts = points_df(spark, np.random.default_rng(1).normal(size=(300, 2)), [1 + i % 3 for i in range(300)])
    res = kmedian.coreset_kmedian(pts, 4, 3, 1, 7, persist=False)
    assert res.n == 300 and res.weight == 600 == sum(w for _, _, _, w in res.coreset)
    want = assign.kmedian_objective(pts, res.centres).collect()[0]
    assert want.n == 300 and res.objective == pytest.approx(want.objective, rel=1e-12)
    sc.setJobGroup("objective", "round 3")
    try:
        assert assign.observed_objective(pts, res.centres)[:2] == (300, 600)
        tracker = sc.statusTracker()
        jobs = tracker.getJobIdsForGroup("objective")
        assert len(jobs) == 1 and len(tracker.getJobInfo(jobs[0]).stageIds) == 1
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_an_input_that_changes_between_passes_is_noticed(spark, monkeypatch):
    pts = points_df(spark, np.random.default_rng(1).normal(size=(50, 2)))
    whole = kmedian.coreset
    monkeypatch.setattr(kmedian, "coreset", lambda *a: whole(*a)[1:])
    with pytest.raises(RuntimeError, match="changed"):
        kmedian.coreset_kmedian(pts, 3, 2, 1, 7)
