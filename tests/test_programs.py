"""The program-level reports."""

from cairn.plans import programs
from cairn.sources import tables
from conftest import SF001


def test_word_count_report(spark):
    docs = tables.documents(spark, SF001)
    rows = programs.word_count_report(docs, 4, seed=1, parts=3).collect()
    assert [r.shape for r in rows] == ["word_count", "word_count_salted", "word_count_partitioned"]
    assert len({r.n_words for r in rows}) == 1 and rows[0].n_words > 0
    assert all(r.seconds >= 0 for r in rows)


def test_kmedian_reports(spark):
    pts = tables.embedding_points(spark, SF001)
    r = programs.kmedian_report(pts, 3, 2, 1, seed=1).collect()[0]
    assert r.n == 500 and r.objective > 0 and min(r.round1_ms, r.round2_ms, r.round3_ms) >= 0
    s = programs.sequential_kmedian_report(pts, 4, 1, seed=1).collect()[0]
    assert s.n == 500 and s.k == 4 and s.objective > 0


def test_numeric_report(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    r = programs.numeric_report(df).collect()[0]
    assert (r.n, r.max_reduce, r.max_ordered, r.min_ordered) == (4, 4.0, 4.0, 1.0)
    assert abs(r.var_norm - 5 / 36) < 1e-12
