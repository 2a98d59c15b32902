"""Exact dedup and mixing against brute force, with collisions, splits and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from cairn.llm import exact_dedup, mixing
from cases import EDGE, clashing, edge, empty  # noqa: F401

pytestmark = pytest.mark.filterwarnings("ignore")


def group_rows(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)
                   for r in df.collect()), key=repr)


@pytest.mark.parametrize("bits,bucket", [(64, 512), (64, 2), (3, 2), (1, 1)])
def test_exact_groups_match_brute_force(edge, bits, bucket):
    got = exact_dedup.exact_groups(edge, bucket_records=bucket, key_bits=bits)
    assert group_rows(got) == sorted(brute.exact_groups([r[:2] for r in EDGE]), key=repr)


def test_exact_groups_ignore_other_columns(clashing, empty):
    got = exact_dedup.exact_groups(clashing)
    assert group_rows(got) == sorted(brute.exact_groups([r[:2] for r in EDGE]), key=repr)
    assert exact_dedup.exact_groups(empty).count() == 0


def test_exact_dedup_keeps_one_row_and_all_columns(clashing, empty):
    out = exact_dedup.exact_dedup(clashing)
    assert out.columns == clashing.columns
    keep = {k for _, k, _, _, _ in brute.exact_groups([r[:2] for r in EDGE])}
    ids = [r.doc_id for r in out.collect()]
    assert sorted(ids, key=repr) == sorted(keep, key=repr)  # the repeated row came back once
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_directory_doubles_only_where_buckets_are_overfull():
    counts = np.array([9, 9, 1, 0, 0, 0, 0, 1])
    depth, slots = exact_dedup.build_directory(counts, 10)
    assert depth == 3 and slots.tolist() == [0, 1, 2, 2, 3, 3, 3, 3]
    assert exact_dedup.build_directory(counts, 100)[0] == 0
    depth, slots = exact_dedup.build_directory(np.array([50, 0]), 10)  # one prefix: chained
    assert depth == 1 and slots.tolist() == [0, 1]


def words(text):
    return len(brute.WORD.findall(text or ""))


def test_mix_plan_matches_brute_force(clashing, empty):
    sizes = {}
    for d, t, _, s, _ in EDGE:
        sizes[s] = sizes.get(s, 0) + words(t)
    target = brute.mix_targets(sizes)
    got = mixing.mix_plan(clashing).collect()
    assert len(got) == len(EDGE)
    rates = {r.source: r.target / r.source_size if r.source_size else 0.0 for r in got}
    want = brute.mix_copies([(r.doc_id, r.source, r.size) for r in got], rates)
    for r, copies in zip(got, want):
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
        assert r.copies == copies and r.taken == r.copies * r.size and r.taken <= 3 * r.size
    assert mixing.mix_plan(empty).count() == 0 and mixing.mix_documents(empty).count() == 0


def test_mix_documents_repeat_rows_as_planned(clashing):
    plan = {}
    for r in mixing.mix_plan(clashing).collect():
        plan[r.doc_id] = plan.get(r.doc_id, 0) + r.copies
    out = mixing.mix_documents(clashing)
    assert out.columns == clashing.columns
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {d: n for d, n in plan.items() if n}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_words_taken_miss_the_target_by_one_document_at_most(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    rows = mixing.mix_plan(docs).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("largest"),
        F.max(F.when(F.col("taken") > 3 * F.col("size"), 1).otherwise(0)).alias("above")).collect()
    assert len(rows) > 3
    for r in rows:
        assert abs(r.taken - r.target) <= r.largest and not r.above


@pytest.mark.parametrize("ranges", [1, 4, 1 << 16])
def test_draws_do_not_depend_on_hash_ranges_or_partitions(spark, monkeypatch, ranges):
    monkeypatch.setattr(mixing, "RANGES", ranges)
    rows = [(i % 900, "hot" if i % 3 else f"s{i % 5}", "w " * (i % 4)) for i in range(1000)]
    rows += [(None, None, "a b"), (1, None, None), (2, "", "x"), (3, "", "x y")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(5)
    got = mixing.mix_plan(df).collect()
    rates = {r.source: r.rate for r in got}
    assert [r.copies for r in got] == brute.mix_copies([(r.doc_id, r.source, r.size) for r in got], rates)
    monkeypatch.setattr(mixing, "MAX_SENT_DRAWS", 0)
    assert mixing.mix_documents(df).count() == sum(r.copies for r in got)


def test_targets_reshare_until_none_is_above(spark):
    sizes = {"a": 1, "b": 10, "c": 500, "d": 0, None: 7, "é": 1000}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = brute.mix_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s]) and got[s] <= 3 * sizes[s] + 1e-9
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))
