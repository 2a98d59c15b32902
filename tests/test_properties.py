"""Property tests against brute-force Python models (hypothesis, batched into few jobs)."""

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cairn.functions.tokens import space_tokens
from cairn.operators import assign, kmedian, sampling, wordcount
from conftest import centres_df, points_df

SETTINGS = settings(max_examples=8, deadline=None)


def java_split_space(s: str) -> list[str]:
    """Model of Java's String.split(" ") (limit 0)."""
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


texts = st.lists(st.text(alphabet="ab \tC", max_size=12), min_size=1, max_size=40)


@SETTINGS
@given(texts)
def test_tokens_match_java_split(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, t string")
    got = {r.i: r.tok for r in df.select("i", space_tokens("t").alias("tok")).collect()}
    assert all(got[i] == java_split_space(x) for i, x in enumerate(xs))


@SETTINGS
@given(texts, st.integers(1, 9), st.integers(1, 9))
def test_word_count_shapes_match_model(spark, xs, k, parts):
    docs = spark.createDataFrame(list(enumerate(xs)), "doc_id bigint, text string")
    model: dict = {}
    for x in xs:
        for w in java_split_space(x):
            model[w] = model.get(w, 0) + 1
    for df in (wordcount.word_count(docs), wordcount.word_count_salted(docs, k, k),
               wordcount.word_count_partitioned(docs, parts)):
        assert {r.word: r.n for r in df.collect()} == model


@SETTINGS
@given(st.lists(st.floats(0.0, 10.0), min_size=1, max_size=60).filter(lambda w: sum(w) > 0),
       st.integers(1, 6))
def test_running_share_matches_cumsum(spark, ws, buckets):
    df = spark.createDataFrame([(i, float(w)) for i, w in enumerate(ws)], "id bigint, w double")
    got = {r.id: r.cum for r in sampling.cumulative_share(df, F.col("w"), "id", buckets).collect()}
    cum = np.cumsum(ws) / sum(ws)
    assert all(abs(got[i] - cum[i]) <= 1e-9 for i in range(len(ws)))


@SETTINGS
@given(st.integers(0, 10_000), st.integers(1, 5), st.integers(1, 4))
def test_closest_centre_matches_brute_force(spark, seed, k, dim):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(40, dim))
    C = rng.normal(size=(k, dim))
    got = {r.id: (r.cid, r.d) for r in
           assign.closest_center(points_df(spark, X.tolist()), centres_df(spark, C.tolist())).collect()}
    D = np.sqrt(((X[:, None, :] - C[None]) ** 2).sum(-1))
    for i in range(40):
        assert got[i][0] == int(D[i].argmin())
        assert abs(got[i][1] - D[i].min()) <= 1e-12


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 5), st.integers(1, 4), st.integers(0, 2))
def test_coreset_invariants(spark, seed, k, parts, iters):
    rng = np.random.default_rng(seed)
    n = 30
    X = np.round(rng.normal(size=(n, 2)), 1)  # some duplicates
    pts = kmedian.prepare_points(points_df(spark, X.tolist()), parts, seed, persist=False)
    rows = kmedian.coreset(pts, k, iters, seed)
    assert sum(w for *_, w in rows) == n                         # C19
    per_part: dict = {}
    for p, c, _, _ in rows:
        per_part.setdefault(p, []).append(c)
    assert all(len(cs) <= k for cs in per_part.values())
    if iters == 0:  # seeds are input points
        inputs = {tuple(x) for x in X}
        assert all(tuple(np.round(v, 9)) in inputs for _, _, v, _ in rows)
