"""PHY1, PHY2, SRC3, AGG11: partitions as asked, without the plans they replace."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.operators import kmedian, placement, wordcount
from cairn.sources import tables, text as src
from conftest import SF01, plan_text, points_df


def ntile(keys, parts):
    keys = sorted(keys)
    size, more = divmod(len(keys), parts)
    out, at = {}, 0
    for p in range(parts):
        for k in keys[at:at + size + (p < more)]:
            out[k] = p
        at += size + (p < more)
    return out


@pytest.mark.parametrize("n,parts,ranges", [(100, 7, 3), (101, 1, 4), (5, 8, 2), (50, 50, 9),
                                            (400, 101, 5), (37, 36, 1), (0, 4, 3)])
def test_parts_are_those_of_ntile_and_lie_in_their_partitions(spark, n, parts, ranges):
    rng = np.random.default_rng(n)
    keys = [int(k) for k in rng.choice(10**12, n, replace=False) - 5 * 10**11]
    df = spark.createDataFrame([(k, str(k)) for k in keys], "id bigint, other string").repartition(5)
    placed = placement.repartition_exact(df, parts, ranges=ranges)
    assert placed.rdd.getNumPartitions() == parts
    rows = placed.select("id", "other", "part", F.spark_partition_id().alias("at")).collect()
    want = ntile(keys, parts)
    assert {r.id: r.part for r in rows} == want and len(rows) == n
    assert all(r["at"] == r.part and r.other == str(r.id) for r in rows)


def test_parts_by_other_key_types(spark):
    words = [f"w{i:03d}é" for i in range(90)]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    for parts in (4, 60):
        got = {r.word: r.part for r in placement.equal_parts(df, parts, "word").collect()}
        assert got == ntile(words, parts)
    values = [float(x) for x in range(20)] + [float("nan")]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    got = [(r.x, r.part) for r in placement.equal_parts(df, 3, "x").orderBy("x").collect()]
    assert [p for _, p in got] == [0] * 7 + [1] * 7 + [2] * 7


def test_null_and_equal_keys(spark):
    df = spark.createDataFrame([(None,)] + [(i,) for i in range(9)], "id bigint")
    got = {r.id: r.part for r in placement.equal_parts(df, 2).collect()}
    assert got[None] == 0 and [got[i] for i in range(9)] == [0] * 4 + [1] * 5
    same = spark.createDataFrame([(1,)] * 6 + [(2,)] * 2, "id bigint")
    with pytest.raises(ValueError, match="not unique"):
        placement.equal_parts(same, 2)
    apart = placement.equal_parts(spark.createDataFrame([(1,)] * 4 + [(2,)] * 4, "id bigint"), 2)
    assert sorted(r.part for r in apart.collect()) == [0] * 4 + [1] * 4
    with pytest.raises(ValueError):
        placement.equal_parts(same, 0)


def test_exact_placement_ranks_no_row_in_one_task(spark):
    df = tables.embedding_points(spark, SF01)
    plan = plan_text(placement.repartition_exact(df, 4))
    assert plan.count("Exchange") == 1 and "Window" not in plan and "SinglePartition" not in plan


def test_coreset_over_equal_parts(spark):
    pts = points_df(spark, np.random.default_rng(3).normal(size=(103, 2)))
    res = kmedian.coreset_kmedian(pts, 3, 4, 1, 5, equal=True)
    by_part = {}
    for part, _, _, w in res.coreset:
        by_part[part] = by_part.get(part, 0) + w
    assert by_part == {0: 26, 1: 26, 2: 26, 3: 25} and res.weight == 103


# ---- finer splits ----

def test_minimum_partitions_split_the_scan_without_a_shuffle(spark, tmp_path):
    path = tmp_path / "big"
    path.mkdir()
    for f in range(3):
        (path / f"part-{f}.txt").write_bytes(b"".join(b"line %d of %d\r\n" % (i, f) for i in range(5000)))
    want = sorted(f"line {i} of {f}" for i in range(5000) for f in range(3))
    for k in (1, 2, 8, 33):
        lines = src.read_lines(spark, str(path), min_partitions=k)
        assert lines.rdd.getNumPartitions() >= k
        assert "Exchange" not in plan_text(lines)
        assert sorted(r.value for r in lines.collect()) == want
    other = spark.createDataFrame([("line 3 of 1",)], "value string")  # of another session
    assert lines.join(other, "value").count() == 1 and other.join(lines, "value").count() == 1
    assert spark.conf.get("spark.sql.files.openCostInBytes") != "1"


def test_readers_pass_the_hint_on(spark, tmp_path):
    path = tmp_path / "v.txt"
    path.write_text("".join(f"{i} {i + 1}\n" for i in range(2000)))
    vec = src.read_vectors(spark, str(path), min_partitions=6)
    assert vec.rdd.getNumPartitions() >= 6 and "Exchange" not in plan_text(vec)
    assert sorted(r.v[0] for r in vec.collect()) == [float(i) for i in range(2000)]
    assert len({r.id for r in vec.collect()}) == 2000
    assert src.read_numbers(spark, str(path), min_partitions=6).count() == 4000
    with pytest.raises(ValueError):
        src.read_lines(spark, str(path), min_partitions=0)


@pytest.mark.parametrize("end", ["\n", "\r", "\r\n"])
def test_written_lines_come_back(spark, tmp_path, end):
    rows = [("a",), ("",), (None,), (" b ",), ("é😀",), ("",)]
    folder = src.write_lines(spark.createDataFrame(rows, "value string").coalesce(1),
                             str(tmp_path / "out"), end)
    got = [r.value for r in src.read_lines(spark, folder).collect()]
    assert sorted(got) == sorted(["a", "", "", " b ", "é😀", ""])
    data = b"".join(open(os.path.join(folder, f), "rb").read()
                    for f in sorted(os.listdir(folder)) if f.startswith("part-"))
    assert data.count(end.encode()) == 6


# ---- spread ----

def test_spread_reads_the_scan_not_the_names(spark):
    docs = tables.table(spark, SF01, "documents")
    odd = docs.select("doc_id", F.col("text").alias("SortKey"),
                      F.col("lang").alias("Join Aggregate Window Limit Union"))
    assert tables.scan_partitions(odd) == odd.rdd.getNumPartitions()
    assert tables.spread(odd, "doc_id", 4).rdd.getNumPartitions() == 4
    assert tables.scan_partitions(odd.where("doc_id > 3").select("doc_id")) is not None
    for derived in (docs.groupBy("lang").count(), docs.join(docs.select("doc_id"), "doc_id"),
                    docs.limit(3), docs.orderBy("doc_id"), docs.union(docs),
                    docs.repartition(3), spark.range(10), spark.createDataFrame([(1,)], "id int")):
        assert tables.scan_partitions(derived) is None
        assert tables.spread(derived, derived.columns[0], 50) is derived


# ---- partition-level count ----

def test_partition_count_is_its_own_plan(spark):
    docs = tables.table(spark, SF01, "documents").select("doc_id", "text")
    plan = plan_text(wordcount.word_count_partitioned(docs))
    assert "MapInArrow" in plan and "Generate" not in plan and plan.count("Exchange") == 1
    assert "Generate" in plan_text(wordcount.word_count(docs))


@pytest.mark.parametrize("hold", [1, 2000, 1 << 25])
def test_partition_count_beyond_its_memory_bound(spark, hold):
    texts = [" ".join(f"w{(i * j) % 300}" for j in range(200)) for i in range(100)]
    texts += ["", " ", "   ", None, " a  b ", "tab\tone", "é 😀", "x" * 3_000_000 + " end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    want = {r.word: r.n for r in wordcount.word_count(docs).collect()}
    got = wordcount.word_count_partitioned(docs, hold_bytes=hold)
    assert {r.word: r.n for r in got.collect()} == want
    with pytest.raises(ValueError):
        wordcount.word_count_partitioned(docs, hold_bytes=0)


def test_partition_count_sends_each_word_once_per_task(spark):
    from cairn.operators.token_kernels import word_count_kernel
    docs = spark.createDataFrame([(i, "a b a " + "c " * (i % 3)) for i in range(500)],
                                 "doc_id bigint, text string").coalesce(2)
    sent = docs.select("text").mapInArrow(word_count_kernel(1 << 25), "word string, n bigint")
    per_task = sent.groupBy(F.spark_partition_id().alias("p"), "word").count()
    assert per_task.where("count > 1").count() == 0
