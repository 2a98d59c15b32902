"""Near duplicates, components, passages."""

import random

import numpy as np
import pytest

import brute
from pyspark.sql import functions as F

from cairn.llm import paragraph_dedup, storage, superminhash
from cairn.llm.components import connected_components
from cairn.llm.similarity import forest, link_matrix
from cases import EDGE, PROSE, clashing, empty, load  # noqa: F401
from cairn.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.001"


def near_rows(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_matches_brute_force(spark):
    want = brute.near_groups(load(spark, SF001, "documents", "doc_id", "text"))
    rows = QUERIES["op8_near_dedup"](spark, SF001).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def near_family(n, seed):
    """Copies of one text with a few words changed each: many links near the threshold."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(400)}" for _ in range(220)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rnd.randrange(0, 9)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(50)}"
        out.append((1000 - i, " ".join(words)))
    return out


@pytest.mark.parametrize("tile", [4, 256])
def test_large_group_split_in_tiles(spark, tile):
    docs = near_family(60, 3) + [(5000 + i, f"alone {i} " * 9) for i in range(5)]
    want = brute.near_groups(docs)
    assert len({c for _, c in want.values()}) > 6
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert near_rows(superminhash.near_groups(df, tile=tile)) == want


def test_edge_rows(clashing, empty):
    rows = superminhash.near_groups(clashing).collect()
    assert len(rows) == len(EDGE)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)]
    assert by[4] == [(1, 4, True)] and by[6] == [(1, 4, False)]  # one short shingle, equal
    assert by[None] == [(2, None, True)] and [r[1:] for r in by[7]] == [(-3, False)] * 2
    assert by[8][0][1:] == (-3, False) and by[9][0][1:] == (-3, False)
    assert by[12][0][1:] == (5, False)  # very long texts that differ in a word
    out = superminhash.near_dedup(clashing)
    assert out.columns == clashing.columns
    assert {r.doc_id for r in out.collect()} == {1, 2, 3, 4, 5, None, 10, 11, -3}
    assert superminhash.near_groups(empty).count() == 0
    assert superminhash.near_dedup(empty).count() == 0


def test_a_recurring_id_loses_only_its_near_copy(spark):
    a = " ".join(f"w{i}" for i in range(80))
    clean = " ".join(f"v{i}" for i in range(80))
    rows = [(1, a), (5, a + " now"), (5, clean), (5, clean), (None, a + " too"), (7, None), (7, ""),
            (8, "x y"), (8, "z"), (3, clean + " q")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in superminhash.near_dedup(df).collect()), key=repr)
    want = [r for r in rows if r not in [(5, a + " now"), (5, clean)]]  # 3 keeps the second group
    assert got == sorted(want, key=repr)
    found = {(r.doc_id, r.component_id) for r in superminhash.near_groups(df).collect()}
    assert found == {(1, 1), (5, 1), (5, 3), (None, None), (7, 7), (8, 8), (3, 3)}
    # two near texts under the least id itself: one of them stays
    df = spark.createDataFrame([(1, a), (1, a + " now"), (2, a + " then")], "doc_id bigint, text string")
    left = superminhash.near_dedup(df).collect()
    assert len(left) == 1 and left[0].doc_id == 1


def test_stage_similarity_is_eighty_percent(spark):
    base = [f"w{i}" for i in range(60)]
    other = base[:30] + ["changed"] + base[31:]  # 51 of 61 shingles: 0.836
    df = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(other))], "doc_id bigint, text string")
    assert superminhash.near_dedup(df, percent=80).count() == 1
    assert superminhash.near_dedup(df).count() == 2


def test_signature_estimates_jaccard():
    rng = np.random.default_rng(5)
    both = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    a, b = both[:700], both[200:]
    sig = superminhash.superminhash(np.concatenate([a, b]), np.array([0, 700, 1400]), 64)
    assert abs((sig[0] == sig[1]).mean() - 500 / 900) < 0.2
    one = superminhash.superminhash(a[:1], np.array([0, 1, 1]), 64)
    assert sorted(np.floor(one[0])) == list(range(64)) and np.isinf(one[1]).all()


def test_link_matrix_and_forest():
    rng = random.Random(2)
    sets = [np.unique(np.array(rng.sample(range(60), rng.randrange(0, 50)), np.uint64))
            for _ in range(20)]
    for some in (sets, sets[:6]):
        got = link_matrix(some, 50)
        for i, x in enumerate(some):
            for j, y in enumerate(some):
                s, t = set(x.tolist()), set(y.tolist())
                assert got[i, j] == (bool(s) and bool(t) and 100 * len(s & t) >= 50 * len(s | t))
    linked = np.zeros((5, 5), bool)
    for i, j in ((0, 3), (3, 4)):
        linked[i, j] = linked[j, i] = True
    assert sorted(forest(np.array([9, 5, 7, 2, 4]), linked)) == [(4, 2), (9, 2)]


def test_components_of_paths_stars_and_nothing(spark):
    links = ([(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(200, 260)]
             + [(3, 3), (7, 200), (200, 7), (None, 4), (300, -5)])
    df = spark.createDataFrame(links, "a bigint, b bigint")
    rows = connected_components(df).collect()
    got = {r.node: r.component for r in rows}
    assert len(rows) == len(got)
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == brute.components({x for e in real for x in e}, real)
    assert connected_components(df.limit(0)).count() == 0


PASSAGE = " ".join(f"p{i * 7919 % 10007}" for i in range(55))


def test_passages_are_found_wherever_they_stand(spark):
    rnd = random.Random(4)

    def noise(n, tag):
        return " ".join(f"{tag}{rnd.randrange(10 ** 6)}" for _ in range(n))

    docs = [(1, f"{noise(80, 'a')} {PASSAGE} {noise(30, 'b')}\n{noise(20, 'c')}"),
            (2, f"{noise(5, 'd')}\n{PASSAGE}\n{noise(40, 'e')}"),
            (3, f"{noise(60, 'f')} {PASSAGE.upper()}"),
            (4, noise(300, "g")), (5, noise(60, "h") + "\n" + "same line again\n" * 30)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = paragraph_dedup.repeated_spans(df).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3}  # not 4, nor repeats inside 5 alone
    assert all(r.keep_doc_id == 1 and r.removed == (r.doc_id != 1) for r in rows)
    text = dict(docs)
    for r in rows:
        assert text[r.doc_id][r.start:r.end].lower() in PASSAGE
    cut = {r.doc_id: r.text for r in paragraph_dedup.drop_repeats(df).collect()}
    assert cut[1] == text[1] and cut[4] == text[4] and cut[5] == text[5]
    for d in (2, 3):
        spans = sorted((r.start, r.end) for r in rows if r.doc_id == d)
        left, at = "", 0
        for a, b in spans:
            left, at = left + text[d][at:a], b
        assert cut[d] == left + text[d][at:]


def removed_words(spark, docs, **settings):
    """{doc_id: words of its removed spans, in order}"""
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    text, out = dict(docs), {}
    for r in sorted(paragraph_dedup.repeated_spans(df, **settings).collect()):
        assert len(text[r.doc_id][r.start:r.end].split()) == r.n_words
        if r.removed:
            out.setdefault(r.doc_id, []).extend(text[r.doc_id][r.start:r.end].split())
    return out


def test_passages_in_short_lines_are_found(spark):
    words = PASSAGE.split()
    verse = "\n".join(" ".join(words[i:i + 3]) for i in range(0, 55, 3))
    code = "\n".join(words)
    table, i = "", 0
    for n in [7, 2, 5, 1, 9, 3, 6, 2, 8, 1, 7, 3, 1]:
        table, i = table + " ".join(words[i:i + n]) + "\n", i + n
    assert i == 55
    for text in (verse, code, table):
        assert removed_words(spark, [(1, text), (2, text)]) == {2: words}
        assert removed_words(spark, [(1, "an end " + text), (2, "other words\n" + text + " x"),
                                     (3, PASSAGE)]) == {2: words, 3: words}


def test_passages_are_covered_to_both_ends(spark):
    rnd = random.Random(11)

    def noise(n):
        return " ".join(f"n{rnd.randrange(10 ** 6)}" for _ in range(n))

    periodic = " ".join(["left right left step"] * 13)
    for passage in (PASSAGE, periodic, " ".join(PASSAGE.split()[:16])):
        docs = [(i, f"{noise(rnd.randrange(70))} {passage} {noise(rnd.randrange(70))}")
                for i in range(1, 9)]
        assert removed_words(spark, docs) == {i: passage.split() for i in range(2, 9)}


def test_all_windows_that_repeat_are_covered(spark):
    rnd = random.Random(12)
    source = [f"s{i}" for i in range(120)]
    docs = []
    for d in range(40):
        text = []
        for _ in range(rnd.randrange(1, 6)):
            a = rnd.randrange(120)
            text += source[a:a + rnd.randrange(40)] if rnd.random() < .8 else source[:3] * 9
            text += [f"n{rnd.randrange(10 ** 6)}" for _ in range(rnd.randrange(3))]
        docs.append((d, "".join(w + rnd.choice([" ", " ", " ", "\n"]) for w in text)))
    docs = [(d, t.rstrip()) for d, t in docs]
    holders = {}
    for d, t in docs:
        w = t.split()
        for i in range(len(w) - 15):
            holders.setdefault(tuple(w[i:i + 16]), set()).add(d)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    spans = {}
    for r in paragraph_dedup.repeated_spans(df).collect():
        spans.setdefault(r.doc_id, []).append(r)
    for d, t in docs:
        w, gone, any_ = t.split(), set(), set()
        for r in spans.get(d, []):
            first = len(t[:r.start].split())
            any_.update(range(first, first + r.n_words))
            gone.update(range(first, first + r.n_words) if r.removed else ())
        for i in range(len(w) - 15):
            held = holders[tuple(w[i:i + 16])]
            if len(held) > 1:
                assert any_ >= set(range(i, i + 16))
                assert min(held) == d or gone >= set(range(i, i + 16))


def test_short_near_equal_paragraphs_are_reported(spark):
    line = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    docs = [(1, "some\n" + line), (2, "else here\n" + line + " fifteen\nend")]
    assert removed_words(spark, docs) == {2: (line + " fifteen").split()}


def test_short_whole_paragraphs_are_a_parameter(spark):
    line = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    docs = [(1, "some\n" + line), (2, "else here\n" + line + " fifteen\nend")]
    assert removed_words(spark, docs, whole_words=16) == {}
    long_ = line + " fifteen sixteen seventeen"
    docs = [(1, "some\n" + long_), (2, "else here\n" + long_ + " eighteen\nend")]
    assert removed_words(spark, docs, whole_words=16) == {2: (long_ + " eighteen").split()}


def test_a_line_that_many_documents_have_is_dealt_over_tasks(spark):
    line = " ".join(f"l{i}" for i in range(20))
    docs = [(i, f"{line}\n" + " ".join(f"n{i}x{j}" for j in range(12))) for i in range(6000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(8)
    rows = paragraph_dedup.repeated_spans(df).collect()
    assert len(rows) == 6000 and all(r.n_words == 20 and r.keep_doc_id == 0 for r in rows)
    side = storage.materialize(df.select(F.lit(1).alias("key"), F.lit(7).alias("v"),
                                         F.lit(6000).cast("bigint").alias("n")).limit(1), "test-side")
    joined = storage.spread_join(df.withColumn("key", F.lit(1)), side, "key")
    assert joined.count() == 6000 and joined.select("v").distinct().collect()[0].v == 7
    tasks = joined.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in tasks) < 3000


def test_edited_paragraphs_are_linked(spark):
    words = [f"word{i * 7 % 211}" for i in range(60)]
    edited = list(words)
    edited[30] = "changed"
    far = [w if i % 6 else "other" for i, w in enumerate(words)]
    docs = [(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(far))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = paragraph_dedup.repeated_spans(df).collect()
    assert [(r.doc_id, r.start, r.end, r.n_words, r.removed) for r in sorted(rows)] == [
        (1, 0, len(docs[0][1]), 60, False), (2, 0, len(docs[1][1]), 60, True)]


def test_passage_edge_rows(clashing, empty):
    rows = paragraph_dedup.repeated_spans(clashing).collect()
    assert {r.doc_id for r in rows} == {5, 12, 7, 8, 9, 10, -3}
    assert all(r.removed == (r.doc_id > r.keep_doc_id) for r in rows)
    assert paragraph_dedup.repeated_spans(empty).count() == 0
    out = paragraph_dedup.drop_repeats(clashing)
    assert out.columns == clashing.columns and out.count() == len(EDGE)
    assert {r.doc_id: r.text for r in out.collect()}[9] == ""
    assert PROSE in {r.text for r in out.where("doc_id = -3").collect()}
