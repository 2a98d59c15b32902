"""C5-C9: statistics and the text sources."""

import math
import os

import pytest
from pyspark.sql import functions as F

from cairn.operators import stats
from cairn.sources import text as src


def col(spark, xs):
    return spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "id bigint, x double")


def test_one_to_four(spark):
    df = col(spark, [1.0, 2.0, 3.0, 4.0])
    assert stats.max_reduce(df).collect()[0].max_x == 4.0
    r = stats.extremes_by(df).collect()[0]
    assert (r.max_x, r.min_x) == (4.0, 1.0)
    norm = sorted(r.x_norm for r in stats.minmax_normalize(df).collect())
    assert norm == pytest.approx([0, 1 / 3, 2 / 3, 1])
    v = stats.normalized_variance(df).collect()[0]
    assert v.var_norm == pytest.approx(5 / 36)      # population variance (C6)
    s = stats.sum_mean(df).collect()[0]
    assert (s.n, s.sum_x, s.mean_x) == (4, 10.0, 2.5)


def test_constant_column_normalises_to_null(spark):
    df = col(spark, [3.0, 3.0, 3.0])
    assert all(r.x_norm is None for r in stats.minmax_normalize(df).collect())
    assert stats.normalized_variance(df).collect()[0].var_norm is None


def test_nan_is_the_largest(spark):
    df = col(spark, [float("nan"), 1.0, 2.0])
    assert math.isnan(stats.max_reduce(df).collect()[0].max_x)
    r = stats.extremes_by(df).collect()[0]
    assert math.isnan(r.max_x) and r.min_x == 1.0


def test_empty_column_gives_null(spark):
    df = col(spark, [])
    assert stats.max_reduce(df).collect()[0].max_x is None
    assert stats.normalized_variance(df).collect()[0].var_norm is None


def test_custom_order_key(spark):
    from pyspark.sql import functions as F
    df = col(spark, [-5.0, 1.0, 3.0])
    r = stats.extremes_by(df, key=F.abs("x")).collect()[0]
    assert (r.max_x, r.min_x) == (-5.0, 1.0)


def test_normalisation_plan_has_no_join(spark):
    df = stats.minmax_normalize(col(spark, [1.0, 2.0]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Subquery" in plan


def _write(tmp_path, name, text):
    p = os.path.join(tmp_path, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_read_numbers_mixed_whitespace(spark, tmp_path):
    p = _write(str(tmp_path), "n.txt", "1.5  2\t3\n\n 4 \n")
    assert sorted(r.x for r in src.read_numbers(spark, p).collect()) == [1.5, 2.0, 3.0, 4.0]


def test_read_numbers_bad_token(spark, tmp_path):
    p = _write(str(tmp_path), "bad.txt", "1 abc\n")
    with pytest.raises(Exception):
        src.read_numbers(spark, p).collect()
    got = [r.x for r in src.read_numbers(spark, p, on_error="null").collect()]
    assert sorted(got, key=lambda x: (x is None, x)) == [1.0, None]


def test_read_vectors(spark, tmp_path):
    p = _write(str(tmp_path), "v.txt", "1 2 \n3 4\n")
    got = sorted(r.v for r in src.read_vectors(spark, p).collect())
    assert got == [[1.0, 2.0], [3.0, 4.0]]


@pytest.mark.parametrize("line", [" 1 2", "1  2", ""])
def test_read_vectors_rejects_empty_tokens(spark, tmp_path, line):
    p = _write(str(tmp_path), "v.txt", line + "\n")
    with pytest.raises(Exception):
        src.read_vectors(spark, p).collect()
    rows = src.read_vectors(spark, p, on_error="null").collect()
    assert all(None in r.v for r in rows)


def test_read_lines_and_documents(spark, tmp_path):
    p = _write(str(tmp_path), "d.txt", "a b\r\nc\n")
    assert [r.value for r in src.read_lines(spark, p, min_partitions=2).collect()] == ["a b", "c"]
    docs = src.read_documents(spark, p).collect()
    assert [d.text for d in docs] == ["a b", "c"]
    df = spark.createDataFrame([(1, "x\r\ny\rz\n")], "doc_id bigint, text string")
    lines = [(r.line_no, r.line) for r in src.text_lines(df).collect()]
    assert lines == [(1, "x"), (2, "y"), (3, "z")]
    edge = spark.createDataFrame([(1, ""), (2, "\n"), (3, "a\n\n"), (4, None), (5, "a")],
                                 "doc_id bigint, text string")
    got = {(r.doc_id, r.line_no): r.line for r in src.text_lines(edge).collect()}
    assert got == {(2, 1): "", (3, 1): "a", (3, 2): "", (5, 1): "a"}
    assert src.read_documents(spark, p, min_partitions=3).count() == 2


def test_spread_only_splits_inputs_with_too_few_partitions(spark):
    from cairn.sources import tables
    from conftest import SF01, plan_text
    from cairn.operators import wordcount
    slots = spark.sparkContext.defaultParallelism
    base = tables.table(spark, SF01, "documents").select("doc_id", "text")
    few = base
    spread = tables.spread(few, "doc_id")
    assert spread.rdd.getNumPartitions() == slots
    assert tables.spread(few, "doc_id", 1) is few  # enough splits: left as it is
    derived = base.repartition(2, "doc_id")
    assert tables.spread(derived, "doc_id") is derived  # not a scan: never probed
    # whole results either way
    a = {r.word: r.n for r in wordcount.word_count(spread).collect()}
    b = {r.word: r.n for r in wordcount.word_count(few).collect()}
    assert a == b and sum(a.values()) > 0
    docs = tables.documents(spark, SF01)
    assert docs.rdd.getNumPartitions() >= slots
    assert "hashpartitioning(doc_id" in plan_text(docs)


def test_extremes_follow_the_given_order(spark):
    from cairn.operators import stats
    df = spark.createDataFrame([(1999.0,), (1005.0,), (3.0,), (2005.0,)], "x double")
    r = stats.extremes_by(df, key=F.struct((F.col("x") % 1000).alias("r"), F.col("x"))).first()
    assert (r.max_x, r.min_x) == (1999.0, 3.0)
    r = stats.extremes_by(df, key=-F.col("x")).first()
    assert (r.max_x, r.min_x) == (3.0, 2005.0)
