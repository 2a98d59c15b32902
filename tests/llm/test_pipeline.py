"""The corpus pipeline, every stage against brute force on its own input; oracles; the entry."""

import os
import sys

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from cairn.llm import piece_sampling, storage
from cairn.llm.queries import ORACLE_SQL, QUERIES
from cases import EDGE, edge, empty  # noqa: F401

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))
from oracle_check import compare, duck  # noqa: E402

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_all_operators_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    numbers = {int(q[2:].split("_")[0]) for q in QUERIES}
    assert numbers == set(range(1, 14)) and len(QUERIES) == 13
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language id", "exact dedup", "near dedup", "source mix", "piece sampling"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck(SF01), name, QUERIES[name], ORACLE_SQL[name], SF01)
    assert r["ok"], r


def check_stages(spark, docs, sf_dir):
    """Runs the stages one by one and compares each with brute force on its input."""
    def rows(df):
        return [tuple(r) for r in df.select(*COLUMNS).collect()]

    stages = dict(corpus_pipeline.STAGES)

    def run(name, df):
        out = stages[name](spark, df, sf_dir)
        return storage.materialize(out, "test-stage")

    before, known = rows(docs), run("language id", docs)
    assert known.columns == COLUMNS
    letters = [r for r in before if any(c.isalpha() for c in r[1] or "")]
    got = rows(known)
    assert sorted((r[0] is None, r[0] or 0, r[1]) for r in got) == sorted(
        (r[0] is None, r[0] or 0, r[1]) for r in letters)
    assert all(r[2] is not None for r in got)

    unique = run("exact dedup", known)
    groups = brute.exact_groups([r[:2] for r in got])
    assert sorted((r[0] for r in rows(unique)), key=repr) == sorted(
        {k for _, k, *_ in groups}, key=repr)

    got, near = rows(unique), run("near dedup", unique)
    comp = brute.near_groups([r[:2] for r in got if r[0] is not None], percent=80)
    assert {r[0] for r in rows(near)} == ({d for d, (_, c) in comp.items() if c == d}
                                          | {r[0] for r in got if r[0] is None})

    got, mixed = rows(near), run("source mix", near)
    sizes = {}
    for r in got:
        sizes[r[3]] = sizes.get(r[3], 0) + len(brute.WORD.findall(r[1] or ""))
    target = brute.mix_targets(sizes)
    copies = brute.mix_copies([(r[0], r[3], len(brute.WORD.findall(r[1] or ""))) for r in got],
                              {s: target[s] / n if n else 0.0 for s, n in sizes.items()})
    want = [r for r, n in zip(got, copies) for _ in range(n)]
    assert mixed.columns == COLUMNS and sorted(rows(mixed), key=repr) == sorted(want, key=repr)

    pieces = run("piece sampling", mixed)
    assert pieces.where("not exact").count() == 0
    first = piece_sampling.decode_pieces(pieces.where("sample = 1"),
                                         piece_sampling.load_vocabulary(), ("doc_id", "source"))
    assert sorted(map(repr, (tuple(r) for r in first.collect()))) == sorted(
        repr((r[0], r[3], r[1] or "")) for r in want)
    return pieces


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(*COLUMNS)
    last = check_stages(spark, docs, SF001)
    whole = corpus_pipeline.run(spark, SF001)
    key = F.xxhash64("doc_id", "sample", "pieces").cast("decimal(38,0)")
    assert whole.agg(F.count("*"), F.sum(key)).first() == last.agg(F.count("*"), F.sum(key)).first()


def test_stages_on_edge_rows_and_nothing(spark, edge, empty):
    check_stages(spark, spark.createDataFrame([r for r in EDGE if r[0] != 7], edge.schema), SF001)
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = storage.materialize(stage(spark, docs, SF001), "test-empty")
        assert docs.count() == 0
