"""Centroid clustering, url filters and spelling variants against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm import orchard, spelling, url_rules
from cairn.llm.queries import QUERIES, URL_RULES
from cases import EDGE, clashing, edge, empty, load  # noqa: F401

SF001 = "/root/testdata/sf0.001"


# ---- centroid clustering ----

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_clusters(rows, k, rounds, dim):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (sha(f"2:{'null' if r[0] is None else r[0]}"), r[1]))
    now = [v for _, v in kept[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(now))

    for _ in range(rounds):
        held = {}
        for _, v in kept:
            held.setdefault(nearest(v)[1], []).append(v)
        for j, vs in held.items():
            now[j] = [sum(col) // len(vs) for col in zip(*vs)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in found:
        inertia[j] += d
    total = sum(inertia.values())
    return sorted(((i, j, d, inertia[j], total, tuple(now[j])) for i, d, j in found), key=repr)


def spark_clusters(df, k, rounds, dim):
    key = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    got = orchard.cluster(df, key, k, rounds, dim)
    return sorted(((r.id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid))
                   for r in got.collect()), key=repr)


def odd_vectors(dim=6):
    rnd = random.Random(5)
    rows = [(i, [rnd.randrange(-3, 4) / 256 for _ in range(dim)]) for i in range(200)]  # many ties
    rows += [(i, [0.25] * dim) for i in range(200, 330)]  # one very common vector
    rows += [(7, [0.5] * dim), (7, [0.5] * dim), (None, [-0.1] * dim), (None, [-0.1] * dim)]
    rows += [(900, None), (901, []), (902, [1.0] * (dim - 1)), (903, [1.0] * (dim + 1)),
             (904, [None] + [1.0] * (dim - 1)), (905, [math.nan] * dim),
             (906, [-math.inf] + [0.0] * (dim - 1))]
    return rows


@pytest.mark.parametrize("k,rounds", [(1, 2), (7, 3), (40, 5), (7, 0), (1000, 1)])
def test_clusters_match_plain_assignment(spark, k, rounds):
    rows = odd_vectors()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    for name in ("id", "x", "key", "cluster", "n", "number", "distance", "centroid", "pos"):
        df = df.withColumn(name, F.lit("extra"))
    assert spark_clusters(df, k, rounds, 6) == plain_clusters(rows, k, rounds, 6)


def test_cluster_query_on_the_table(spark):
    rows = load(spark, SF001, "embeddings", "vec_id", "embedding")
    got = sorted(tuple(r) for r in QUERIES["op11_centroid_clustering"](spark, SF001).collect())
    want = [(i, j, d, c, t, sha(",".join(map(str, v))))
            for i, j, d, c, t, v in plain_clusters(rows, 40, 5, 64)]
    assert got == sorted(want) and len(got) == len(rows)


def test_no_vectors_and_large_components(spark):
    df = spark.createDataFrame(odd_vectors(), "vec_id bigint, embedding array<double>")
    assert spark_clusters(df.limit(0), 5, 2, 6) == []
    assert spark_clusters(df, 5, 2, 33) == []  # nothing has 33 components
    big = spark.createDataFrame([(1, [3e5])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large for exact distances"):
        spark_clusters(big, 1, 1, 1)
    edge_size = spark.createDataFrame([(1, [-262144.0]), (2, [262144.0])],
                                      "vec_id bigint, embedding array<double>")
    assert spark_clusters(edge_size, 1, 0, 1)[0][4] == (2 ** 27) ** 2


@pytest.mark.parametrize("spread", [1, 30, 4000])
def test_orchard_search_is_exact_and_saves_distances(spread):
    rng = np.random.default_rng(spread)
    centres = rng.integers(-2000, 2000, (60, 4))
    x = centres[rng.integers(0, 60, 3000)] + rng.integers(-spread, spread + 1, (3000, 4))
    x = np.vstack([x, centres, (centres[:-1] + centres[1:]) // 2])  # and ties
    number, distance, measured = orchard.search(x, orchard.neighbour_lists(centres))
    full = ((x[:, None, :] - centres[None]) ** 2).sum(2)
    assert (number == full.argmin(1)).all() and (distance == full.min(1)).all()
    assert measured <= full.size
    if spread <= 30:
        assert measured < full.size / 2  # the stop rule leaves most centroids out


# ---- url filters ----

def plain_verdict(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = {}
    for h, p, v in rules:
        if h and (host == h or host.endswith("." + h)) and path.startswith(p):
            fit[h + p] = max(fit.get(h + p, ""), v)
    best = min(fit, key=lambda r: (-len(r), r), default=None)
    return host, path, best, fit.get(best, default)


ODD_URLS = [
    None, "", "no scheme", "http:/a.com/", "://com/", "http://", "http:///en/x", "http://com",
    "http://com/", "https://COM/x", "http://a.com?x=1", "http://a.com#/en/", "http://a.com/",
    "http://example.com/en/", "http://example.com/en", "http://example.com/EN/a",
    "http://WWW.example.com/en/a?b#c", "http://x.www.example.com/en/", "http://wwwexample.com/en/",
    "http://notexample.com/en/1", "http://.com/", "http://a..com/", "http://com./", "http://a.net/es/",
    "http://net/fr/", "http://a.net/fr", "http://a.net/es/://b.com/", "ftp://q.net/fr/é\n/x?y",
    "http://ÉXAMPLE.com/en/", "http://user@www.example.com:80/en/", "a://b.net/es/" + "z/" * 20000,
    "http://" + "a." * 5000 + "com/x", "http://a.net/es/?u=http://www.example.com/en/",
]


def url_rows(df):
    return sorted((r.page_id if r.page_id is not None else -1, r.host, r.path, r.rule or "", r.verdict)
                  for r in df.collect())


@pytest.mark.parametrize("sent", [100_000, 0])
def test_verdicts_match_plain_rules(spark, sent):
    rows = [(i, u) for i, u in enumerate(ODD_URLS)] + [(3, ODD_URLS[3]), (None, ODD_URLS[13])]
    rows += [(1000 + i, "http://www.example.com/en/") for i in range(400)]  # one very common url
    df = spark.createDataFrame(rows, "page_id bigint, url string")
    for name in ("host", "path", "rule", "verdict", "h", "p", "e", "d", "s", "l", "r", "short", "full"):
        df = df.withColumn(name, F.lit("extra"))
    got = url_rules.judge_urls(df, url_rules.rule_frame(spark, URL_RULES), max_sent_rules=sent)
    want = [(i if i is not None else -1, *[x or "" for x in plain_verdict(u, URL_RULES)])
            for i, u in rows]
    assert url_rows(got) == sorted(want)
    assert set(df.columns) == set(got.columns)


@pytest.mark.parametrize("sent", [100_000, 0])
def test_random_rules(spark, sent):
    rnd = random.Random(8)
    parts, cuts = ["a", "b", "é", "com"], ["", "/", "/a", "/a/", "/a/b", "/ab/"]
    rules = [(".".join(rnd.choices(parts, k=rnd.randrange(1, 4))), rnd.choice(cuts),
              rnd.choice(["allow", "block"])) for _ in range(40)]
    rules += [("", "/", "block"), ("A.com", "/A", "block")]
    folded = [(h.replace("A", "a"), p, v) for h, p, v in rules]
    urls = [(i, "x://" + ".".join(rnd.choices(parts, k=rnd.randrange(1, 5))) + rnd.choice(cuts)
             + rnd.choice(["", "b", "/a", "?a", "#"])) for i in range(500)]
    df = spark.createDataFrame(urls, "page_id bigint, url string")
    got = url_rules.judge_urls(df, url_rules.rule_frame(spark, rules), max_sent_rules=sent,
                               default="block")
    assert url_rows(got) == sorted((i, *[x or "" for x in plain_verdict(u, folded, "block")])
                                   for i, u in urls)


def test_no_rules_no_urls(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    none = url_rules.rule_frame(spark, URL_RULES).limit(0)
    assert url_rows(url_rules.judge_urls(df, none)) == [(1, "a.com", "/", "", "allow")]
    rules = url_rules.rule_frame(spark, URL_RULES)
    assert url_rules.judge_urls(df.limit(0), rules).count() == 0


# ---- spelling variants ----

def plain_words(docs):
    count = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(words):
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    form, out = {}, {}
    for w, n in words.items():
        found = [v for m in (len(w) - 1, len(w), len(w) + 1) for v in by_length.get(m, ())
                 if near(w, v)]
        best = min(found, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best
        out[w] = len(found)
    rows = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        rows.append((w, f, root, n, out[w], words.get(f)))
    return sorted(rows)


def spelling_rows(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


TEXTS = [
    (1, "letters letter leter lettre LETTER letters' letters, letters letters"),
    (2, "école ecole écoles ÉCOLE École êcole aaaaa aaaaaa aaaaaaa aaaa abcde abcdef bcdef abcdf"),
    (3, None), (4, ""), (5, "123 -- ×××××× ÷÷÷÷÷ naïvetés naivetés a" + "\n" + "x" * 3000),
    (6, "ababababab babababa ababababa abababab bababab abcabcabc abcabcab bcabcabc"),
    (None, "letters école abcde aaaaa"), (8, "lettersaletters letters😀letters lettersßletters"),
]


def test_groups_match_plain_search(spark):
    rnd = random.Random(4)
    docs = [r for r in TEXTS for _ in range(3)]
    stems = ["".join(rnd.choices("abé", k=rnd.randrange(5, 8))) for _ in range(300)]
    docs += [(i, " ".join(rnd.choices(stems, k=400))) for i in range(100, 110)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    for name in ("word", "n", "key", "a", "b", "near", "form", "root", "id", "last"):
        df = df.withColumn(name, F.lit("extra"))
    want = plain_groups(plain_words(docs))
    assert spelling_rows(spelling.variant_groups(df)) == want
    assert any(r[2] not in (r[0], r[1]) for r in want)  # some roots are forms of forms


def test_spelling_query_on_the_table(spark):
    docs = load(spark, SF001, "documents", "doc_id", "text")
    got = spelling_rows(QUERIES["op13_spelling_variants"](spark, SF001))
    assert got == plain_groups(plain_words(docs))


def test_spelling_of_edge_rows(edge, clashing, empty):
    want = plain_groups(plain_words([r[:2] for r in EDGE]))
    assert spelling_rows(spelling.variant_groups(edge)) == want
    assert spelling_rows(spelling.variant_groups(clashing)) == want
    assert spelling.variant_groups(empty).count() == 0


def test_runs_and_checksums():
    text = "aÀb×c Éa  zz\u0100ÿ"
    data = np.frombuffer(text.encode(), np.uint8)
    start, end, doc, points = spelling.letter_runs(data, np.array([0, len(data)]))
    runs = [bytes(data[s:e]).decode() for s, e in zip(start, end)]
    assert runs == re.findall("[A-Za-z\u00C0-\u00FF]+", text) and points.tolist() == [5, 2, 2, 1]
    seeds = np.full(len(runs), zlib.crc32(b"12:"), np.uint32)
    assert spelling.checksums(data, start, end, seeds).tolist() == [
        zlib.crc32(f"12:{r}".encode()) for r in runs]


def tables_of(words):
    counted = Counter(g for w in words for g in {w[i:i + 2] for i in range(len(w) - 1)})
    order, often = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64)
    for rank, (n, g) in enumerate(sorted((n, g) for g, n in counted.items())):
        order[ord(g[0]) * 256 + ord(g[1])], often[ord(g[0]) * 256 + ord(g[1])] = rank, n
    return order, often


def test_pivots_are_disjoint_and_least_frequent_in_the_prefix():
    rnd = random.Random(9)
    words = sorted({"".join(rnd.choices("abcé", k=7)) for _ in range(400)})
    order, often = tables_of(words)
    codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(-1, 7)
    two, prefix, last = spelling.pivots_and_prefix(codes, order, often)
    for i, w in enumerate(words):
        grams = [ord(w[j]) * 256 + ord(w[j + 1]) for j in range(6)]
        ranks = [order[g] for g in grams]
        assert last[i] == sorted(ranks)[2]
        held = [j for j in range(6) if ranks[j] <= last[i]]
        assert np.flatnonzero(prefix[i]).tolist() == held
        least = min(often[grams[a]] + often[grams[b]] for a in held for b in held if b - a >= 2)
        a, b = two[i]
        assert a in held and b in held and b - a >= 2 and often[grams[a]] + often[grams[b]] == least


def test_candidates_do_not_grow_with_a_common_pivot(spark):
    rnd = random.Random(6)
    words = sorted({"zq" + "".join(rnd.choices("abcdefghij", k=8)) for _ in range(4000)})
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    sent = spark.sparkContext.broadcast(tables_of(words))
    pivots = df.mapInArrow(spelling._key_kernel(sent, True), spelling.KEYS).select("key")
    prefixes = df.mapInArrow(spelling._key_kernel(sent, False), spelling.KEYS).select("key")
    assert pivots.join(prefixes, "key").count() < 60 * len(words)
    got = {(r.word, r.near) for r in spelling.near_pairs(df).collect()}
    held = set(words)
    assert got == {(a, b) for a in words for b in variants(a) if b in held}


def variants(w):
    return {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in "abcdefghijqz"} - {w}


def test_too_short_words_are_refused(empty):
    with pytest.raises(ValueError):
        spelling.variant_groups(empty, min_length=3)
