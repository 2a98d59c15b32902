"""Language ID, the Pitman-Yor model and sampled segmentations."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from cairn.llm import lang_bloom, piece_sampling, pitman_yor
from cairn.llm.arrow_text import mix
from cairn.llm.queries import QUERIES
from cases import EDGE, clashing, empty, load  # noqa: F401

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# ---- language ID ----

def test_held_out_accuracy(spark):
    truth = dict(load(spark, SF01, "documents", "doc_id", "lang"))
    rows = QUERIES["op5_language_id"](spark, SF01).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 5 == 0}
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_filters_hold_every_gram_and_few_others():
    rng = np.random.default_rng(1)
    grams = np.unique(rng.integers(0, 1 << 32, 4000, dtype=np.uint64))
    model = lang_bloom.LanguageFilter(["a", "b"], [1, 2], [grams[::2], grams[1::2]])
    probes = lang_bloom.cells(grams, model.n_cells, model.probes)
    mask = np.bitwise_and.reduce([model.masks[c, 0] for c in probes])
    assert (mask[::2] & np.uint64(1)).all() and (mask[1::2] & np.uint64(2)).all()
    assert model.false_rate.max() < 0.01 and model.fallback == 1


def test_many_languages_use_more_mask_words():
    entries = [np.arange(i * 50, i * 50 + 50, dtype=np.uint64) for i in range(70)]
    model = lang_bloom.LanguageFilter([f"l{i:02}" for i in range(70)], [1] * 70, entries)
    assert model.masks.shape[1] == 2
    cell = lang_bloom.cells(entries[69], model.n_cells, model.probes)
    assert all((model.masks[c, 1] >> np.uint64(5) & np.uint64(1)).all() for c in cell)


def test_few_documents_and_long_ones_take_no_language_away(spark):
    rnd = np.random.default_rng(9)

    def vocabulary(letters):
        return ["".join(rnd.choice(list(letters), rnd.integers(2, 9))) for _ in range(1500)]

    def text(words, n):
        return " ".join(words[int(1500 * u * u)] for u in rnd.random(n))

    big, other = vocabulary("abcdefgh"), vocabulary("defghijk")
    rows = [("big", text(big, 60)) for _ in range(400)] + [("wrong", text(big, 20_000))]
    rows += [("long", text(other, 3000)) for _ in range(40)]
    rows += [("one", text(vocabulary("mnopqrs"), 300))]
    model = lang_bloom.train(spark.createDataFrame(rows, "lang string, text string"))
    new = ([("big", text(big, 40)) for _ in range(100)]
           + [("long", text(other, 40)) for _ in range(100)] + rows[-1:])
    df = spark.createDataFrame(new, "lang string, text string")
    found = lang_bloom.predict(df, model, ("lang",)).collect()
    wrong = collections.Counter((r.lang, r.lang_pred) for r in found if r.lang != r.lang_pred)
    assert sum(wrong.values()) <= 20, wrong
    assert [r.lang_pred for r in found if r.lang == "one"] == ["one"]


def test_language_edge_rows(clashing, empty):
    model = lang_bloom.train(clashing)
    rows = lang_bloom.predict(clashing, model).collect()
    got = collections.defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.lang_pred, r.score))
    assert len(rows) == len(EDGE)
    assert all(got[d] == [("und", 0.0)] for d in (1, 2, 3, 11))
    assert got[5][0][0] == "en" and got[9][0][0] == "en" and len(set(got[7])) == 1
    nothing = lang_bloom.train(empty)
    assert nothing.langs == []
    assert {r.lang_pred for r in lang_bloom.predict(clashing, nothing).collect()} == {"und"}
    assert lang_bloom.predict(empty, model).count() == 0


# ---- hierarchical Pitman-Yor model ----

def exact_tables(c, base, p, strength, d):
    """P(tables) of c customers of one dish: all arrangements, table by table."""
    weight = {(1,): 1.0}
    for _ in range(1, c):
        nxt = collections.defaultdict(float)
        for sizes, w in weight.items():
            nxt[sizes + (1,)] += w * (strength + d * (base + len(sizes))) * p
            for i, s in enumerate(sizes):
                nxt[sizes[:i] + (s + 1,) + sizes[i + 1:]] += w * (s - d)
        weight = nxt
    out = collections.defaultdict(float)
    for sizes, w in weight.items():
        out[len(sizes)] += w
    total = sum(out.values())
    return {t: w / total for t, w in out.items()}


@pytest.mark.parametrize("c", [1, 2, 3, 5, 8])
def test_seating_follows_the_restaurant(c):
    n, base, p, strength, d = 40_000, 4, 0.08, 1.0, 0.6
    t = pitman_yor.seat(np.full(n, c), mix(np.arange(n, dtype=np.uint64)), np.full(n, base),
                        np.full(n, p), strength, d, 3)
    for tables, want in exact_tables(c, base, p, strength, d).items():
        assert abs((t == tables).mean() - want) < 0.01


@pytest.mark.parametrize("c,base,p,d", [(70, 3, 0.05, 0.7), (200, 30, 0.01, 0.7), (500, 2000, 0.02, 0.8),
                                        (100, 60_000, 0.01, 0.75), (300, 20_000, 0.01, 0.75)])
def test_large_dishes_follow_their_limit(monkeypatch, c, base, p, d):
    n = 3000
    args = (np.full(n, c), mix(np.arange(n, dtype=np.uint64)), np.full(n, base), np.full(n, p), 1.0,
            d, 1)
    limit = pitman_yor.seat(*args)
    monkeypatch.setattr(pitman_yor, "_EXACT", 512)
    monkeypatch.setattr(pitman_yor, "_STIRLING", {})
    exact = pitman_yor.seat(*args)
    assert abs(limit.mean() - exact.mean()) < 0.03 * exact.mean()
    assert 0.6 * exact.std() < limit.std() < 1.3 * exact.std()
    huge = pitman_yor.seat(np.array([2_000_000]), np.array([9], np.uint64), np.array([1000]),
                           np.array([0.02]), 1.0, 0.8, 1)
    assert 5 < huge[0] < 60


def lm_docs(df):
    return df.select("doc_id", "text", lang_bloom.is_held_out("doc_id", 7, 2).alias("held_out"))


def test_lm_columns_match_brute_force_on_edge_rows(clashing, empty):
    docs = lm_docs(clashing.drop("held_out"))
    model = pitman_yor.fit(docs)
    rows = pitman_yor.score_texts(docs, model).collect()
    assert len(rows) == len(EDGE)
    tokens = [(d, brute.WORD.findall(brute.fold(t)) + [None]) for d, t, *_ in EDGE]
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in tokens}
    count = collections.Counter(w for d, ws in tokens if not held[d] for w in ws)
    n, v = sum(count.values()), len(count)
    assert (model.tokens, model.vocabulary) == (n, v)
    want = sorted((repr(d), held[d], len(ws), sum(count[w] > 0 for w in ws),
                   round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), 6))
                  for d, ws in tokens)
    assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6))
                  for r in rows) == want
    assert all(r.score < 0 for r in rows)
    none = lm_docs(empty)
    assert pitman_yor.score_texts(none, pitman_yor.fit(none)).count() == 0


def test_lm_predicts_better_than_its_base_and_sums_to_one(spark):
    docs = lm_docs(spark.read.parquet(f"{SF001}/documents.parquet"))
    model = pitman_yor.fit(docs)
    mass, words = np.zeros(3), 0
    for row in model.words.collect():
        hashes, c, t0, m1, t1, m2, t2, m3, t3 = pitman_yor.unpack(row.body)
        mass += [m.sum(dtype=float) for m in (m1, m2, m3)]
        words += int((c > 0).sum())
        assert (t3 >= 0).all() and (t3 <= c)[c > 0].all()  # tables of a context, its customers
    assert words == model.vocabulary
    for m, (add, total) in zip(mass, model.bases):  # all words and the unknown one sum to 1
        assert abs((m + (words + 1) * add) / total - 1) < 1e-4
    per = {r.held_out: r for r in pitman_yor.perplexity(pitman_yor.score_texts(docs, model))
           .collect()}
    assert per[True].perplexity < 0.6 * per[True].base_perplexity
    again = pitman_yor.score_texts(docs, pitman_yor.fit(docs)).agg(F.sum("score")).first()[0]
    first = pitman_yor.score_texts(docs, model).agg(F.sum("score")).first()[0]
    assert again == pytest.approx(first, rel=1e-12)


def plain_scores(train, texts, s=pitman_yor.Settings()):
    """One restaurant per context seated dish by dish, without chunks, parts and owners."""
    def hash_of(w):
        return pitman_yor.word_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]))[0][0]

    def sentence(t):
        return [pitman_yor.START] + [hash_of(w) for w in brute.WORD.findall(brute.fold(t))] + [pitman_yor.END]

    def one(c, key, base, p, d, sweep):
        return int(pitman_yor.seat(np.array([c]), np.array([key], np.uint64), np.array([max(base, 0)]),
                                   np.array([p]), s.strength, d, sweep)[0])

    def share(items):
        n1, n2 = sum(n == 1 for n in items), sum(n == 2 for n in items)
        return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5

    pairs = collections.Counter(p for t in train for p in zip(sentence(t), sentence(t)[1:]))
    count = collections.Counter(w for t in train for w in sentence(t)[1:])
    t = dict.fromkeys(pairs, 1)
    seed = mix(np.array([s.seed], np.uint64))[0]
    d1, base_p = share(list(pairs.values())), 1 / (len(count) + 1)
    eaten = collections.Counter(w for _, w in t)
    parent = dict.fromkeys(eaten, 1)
    d0 = share(list(eaten.values()))
    total = collections.Counter()
    for sweep in range(1, s.sweeps + 1):
        eaten, context = collections.Counter(), collections.Counter()
        for (u, w), k in t.items():
            eaten[w] += k
            context[u] += k
        seats = sum(parent.values())
        parent = {w: one(k, mix(np.array([w ^ seed]))[0], seats - parent[w], base_p, d0, sweep)
                  for w, k in eaten.items()}
        add = (s.strength + d0 * sum(parent.values())) * base_p
        mass = {w: float(np.float32(k - d0 * parent[w])) for w, k in eaten.items()}
        p = collections.defaultdict(lambda: add / (s.strength + sum(eaten.values())),
                                    {w: (m + add) / (s.strength + sum(eaten.values()))
                                     for w, m in mass.items()})
        t = {(u, w): one(c, mix(np.array([pitman_yor.bigram_key(np.array([u]), np.array([w]))[0] ^ seed]))[0],
                         context[u] - t[u, w], p[w], d1, sweep) if (c := pairs[u, w]) > 1 else 1
             for u, w in t}
        context = collections.Counter()
        for (u, w), k in t.items():
            context[u] += k
        if sweep > s.burn_in:
            for i, text in enumerate(texts):
                for j, (u, w) in enumerate(zip(sentence(text), sentence(text)[1:])):
                    customers = len(train) if u == pitman_yor.START else count[u]
                    total[i, j] += ((pairs[u, w] - d1 * t.get((u, w), 0)
                                     + (s.strength + d1 * context[u]) * p[w]) / (s.strength + customers))
    out = [0.0] * len(texts)
    for (i, _), x in total.items():
        out[i] += math.log10(x / (s.sweeps - s.burn_in))
    return out


def test_lm_scores_match_a_plain_sampler_and_any_table_can_be_scored(spark, clashing):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(12)]
    train = [" ".join(rnd.choices(words, weights=range(12, 0, -1), k=rnd.randrange(1, 30)))
             for _ in range(60)] + ["", "W1 w2"]
    other = ["w1 w2 w3", "", "never seen w1", train[5]]
    docs = spark.createDataFrame(
        [(i, t, False) for i, t in enumerate(train)] + [(100 + i, t, True) for i, t in enumerate(other)],
        "doc_id bigint, text string, held_out boolean").repartition(4, "doc_id")
    model = pitman_yor.fit(docs)
    want = plain_scores(train, train + other)
    own = {r.doc_id: r.score for r in pitman_yor.score_texts(docs, model).collect()}
    assert [own[i] for i in [*range(62), 100, 101, 102, 103]] == pytest.approx(want, rel=1e-6)
    # another table, without held_out, with other partitions and columns
    new = spark.createDataFrame([(i, t, "x") for i, t in enumerate(other * 30)],
                                "doc_id bigint, text string, frm string").repartition(3)
    got = pitman_yor.score_texts(new, model).collect()
    assert len(got) == 120 and all(r.held_out for r in got)
    assert [r.score for r in sorted(got, key=lambda r: r.doc_id)[:4]] == pytest.approx(want[62:], rel=1e-6)
    assert pitman_yor.score_texts(new.limit(0), model).count() == 0


# ---- sampled segmentations ----

PIECES = [b"a", b"b", b" ", b"ab", b" a", b"ba", b"aba", b" ab"]
LOGP = [-1.0, -1.2, -2.0, -1.5, -1.1, -2.2, -2.0, -1.7]


def sampled(text, n, k):
    v = piece_sampling.vocabulary_of(PIECES, LOGP)
    data = np.frombuffer(text * n, np.uint8)
    return v, piece_sampling.sample_chunk(piece_sampling.Lattice(v), data,
                                          np.arange(n + 1) * len(text),
                                          mix(np.arange(n, dtype=np.uint64)), k)


def test_samples_without_replacement_have_the_right_law():
    text, n, k = b" abab aba", 30_000, 3
    v, found = sampled(text, n, k)
    prob = {s: math.exp(sum(LOGP[i] for i in s)) for s in brute.segmentations(text, PIECES)}
    total = sum(prob.values())
    prob = {s: p / total for s, p in prob.items()}
    drawn, weighted = [], np.zeros(n)
    for here, pieces, cuts, phi, inclusion in found:
        rows = [tuple(pieces[a:b].tolist()) for a, b in zip(cuts[:-1], cuts[1:])]
        assert np.allclose(phi, [math.log(prob[r]) for r in rows])
        weighted[here] += np.exp(phi - inclusion)
        drawn.append(rows)
    assert all(len(set(r)) == k for r in zip(*drawn))
    first = collections.Counter(drawn[0])
    for s, p in prob.items():
        assert abs(first[s] / n - p) < 4.5 * math.sqrt(p / n)
    pairs = collections.Counter(zip(drawn[0], drawn[1]))
    best = sorted(prob, key=prob.get)[-6:]
    for s in best:
        for t in best:
            if s != t:
                p = prob[s] * prob[t] / (1 - prob[s])
                assert abs(pairs[s, t] / n - p) < 4.5 * math.sqrt(p / n)
    # Horvitz-Thompson with the inclusion scores: the estimate of the total mass has mean 1.
    assert abs(weighted.mean() - 1) < 4.5 * weighted.std() / math.sqrt(n)


def test_all_segmentations_come_out_when_there_are_few():
    _, found = sampled(b" ab", 5, 10)
    every = set(brute.segmentations(b" ab", PIECES))
    got = collections.defaultdict(set)
    for here, pieces, cuts, _, inclusion in found:
        assert (inclusion == 0).all()
        for i, a, b in zip(here, cuts[:-1], cuts[1:]):
            got[i].add(tuple(pieces[a:b].tolist()))
    assert all(got[i] == every for i in range(5))


def test_piece_query_round_trips_whole_texts(spark, clashing, empty):
    v = piece_sampling.load_vocabulary()
    rows = piece_sampling.sample_pieces(clashing, v, keep=("doc_id", "text")).cache()
    assert rows.where("not exact").count() == 0
    texts = piece_sampling.decode_pieces(rows, v, keep=("doc_id", "sample"))
    want = {d: t or "" for d, t, *_ in EDGE}
    for r in texts.collect():
        assert r.text == want[r.doc_id]
    by = collections.Counter((r.doc_id, r["sample"]) for r in rows.collect())
    assert by[1, 1] == by[2, 1] == 1 and by[1, 2] == by[2, 2] == 0
    assert by[7, 1] == by[7, 2] == 2 and by[5, 1] == by[5, 2] == 1
    assert piece_sampling.sample_pieces(empty, v).count() == 0
    real = QUERIES["op6_piece_sampling"](spark, SF001)
    bad = real.where("not exact or log_prob >= 0 or log_inclusion > 0").count()
    n = spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert bad == 0 and real.where("sample = 1").count() == n
    twice = real.agg(F.sum(F.xxhash64("doc_id", "sample", "pieces").cast("decimal(38,0)")))
    assert twice.first() == real.repartition(3).agg(
        F.sum(F.xxhash64("doc_id", "sample", "pieces").cast("decimal(38,0)"))).first()
