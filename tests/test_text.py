"""C1-C4: tokens, lengths and the three word-count shapes."""

import pytest
from pyspark.sql import functions as F

from cairn.functions.tokens import space_tokens, utf16_length
from cairn.operators import wordcount
from conftest import SF01, plan_text


def tokens(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(space_tokens("t").alias("x")).collect()[0].x


@pytest.mark.parametrize("text,expected", [
    ("a b ", ["a", "b"]),          # trailing space dropped
    ("", [""]),                    # empty document: one empty token
    ("   ", []),                   # spaces only: no token
    ("a  b", ["a", "", "b"]),      # interior empty kept
    (" a", ["", "a"]),             # leading empty kept
    ("a\tb", ["a\tb"]),            # tab is not a separator
    ("Cat cat", ["Cat", "cat"]),   # no case folding
    ("a b  ", ["a", "b"]),         # several trailing spaces
])
def test_java_split_contract(spark, text, expected):
    assert tokens(spark, text) == expected


def test_null_document_has_no_tokens(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "doc_id bigint, text string")
    assert sorted(tuple(r) for r in wordcount.word_count(df).collect()) == [("x", 1)]


def test_utf16_length(spark):
    df = spark.createDataFrame([("x\U0001F600",), ("abc",), ("",)], "w string")
    got = [r.n for r in df.select(utf16_length("w").alias("n")).collect()]
    assert got == [3, 3, 0]


def test_empty_token_is_a_counted_word(spark):
    df = spark.createDataFrame([(1, ""), (2, "a  a")], "doc_id bigint, text string")
    got = dict((r.word, r.n) for r in wordcount.word_count(df).collect())
    assert got == {"": 2, "a": 2}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")


def _as_dict(df):
    return {r.word: r.n for r in df.collect()}


def test_three_word_counts_agree(spark, docs):
    base = _as_dict(wordcount.word_count(docs))
    assert len(base) > 1000
    for k in (1, 4, 13):
        assert _as_dict(wordcount.word_count_salted(docs, k, seed=k)) == base
    for parts in (None, 1, 4, 13):
        assert _as_dict(wordcount.word_count_partitioned(docs, parts)) == base
    assert _as_dict(wordcount.word_count_partitioned(docs.repartition(13))) == base


def test_doc_counts_sum_to_corpus_counts(spark, docs):
    per_doc = wordcount.doc_word_counts(docs).groupBy("word").agg(F.sum("n").alias("n"))
    assert _as_dict(per_doc) == _as_dict(wordcount.word_count(docs))


def test_word_count_plan_has_partial_aggregate(spark, docs):
    df = wordcount.word_count(docs)
    df.collect()
    plan = plan_text(df)
    assert "partial_count" in plan
    assert "ReadSchema: struct<text:string>" in plan  # only the text column is read


def test_salted_plan_has_two_aggregation_levels(spark, docs):
    df = wordcount.word_count_salted(docs, 8, 1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 4


def test_avg_distinct_length(spark):
    df = spark.createDataFrame([(1, "ab ab c"), (2, "x\U0001F600")], "doc_id bigint, text string")
    r = wordcount.avg_distinct_word_length(df).collect()[0]
    assert r.n_words == 3 and abs(r.avg_len - (2 + 1 + 3) / 3) < 1e-12


def test_avg_distinct_length_empty_corpus_is_null(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    r = wordcount.avg_distinct_word_length(df).collect()[0]
    assert r.n_words == 0 and r.avg_len is None


def test_bad_arguments(spark, docs):
    with pytest.raises(ValueError):
        wordcount.word_count_salted(docs, 0)
    with pytest.raises(ValueError):
        wordcount.word_count_partitioned(docs, 0)


def test_partitioned_count_has_one_exchange(spark):
    from cairn.sources import tables
    from conftest import SF01, plan_text
    docs = tables.table(spark, SF01, "documents").select("doc_id", "text")
    for parts in (None, 3):
        plan = plan_text(wordcount.word_count_partitioned(docs, parts))
        assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(word" in plan
