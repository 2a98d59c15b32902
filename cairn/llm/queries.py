"""The registered queries ``opN_<name>`` and their DuckDB oracles where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from cairn.llm import (exact_dedup, html_mincut, lang_bloom, mixing, orchard, paragraph_dedup,
                       piece_sampling, pitman_yor, secret_scan, spelling, superminhash, topk_nra,
                       url_rules)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_mincut.extract_pages(table(spark, sf_dir, "pages"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), topk_nra.quantized("embedding").alias("x"))
    return topk_nra.topk(rows.where("id % 100 = 0"), rows, 10)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", lang_bloom.is_held_out("doc_id", 5, 0).alias("held_out"))
    model = lang_bloom.train(docs.where("not held_out"))
    found = lang_bloom.predict(docs, model)
    return found.select("doc_id", lang_bloom.is_held_out("doc_id", 5, 0).alias("held_out"),
                        "lang_pred", "score")


def op6_piece_sampling(spark: SparkSession, sf_dir: str,
                       model_path: str = piece_sampling.MODEL_PATH) -> DataFrame:
    return piece_sampling.sample_pieces(table(spark, sf_dir, "documents"),
                                        piece_sampling.load_vocabulary(model_path))


def op7_pitman_yor_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", lang_bloom.is_held_out("doc_id", 7, 2).alias("held_out"))
    model = pitman_yor.fit(docs)
    return pitman_yor.score_texts(docs, model).withColumn(
        "train_tokens", F.lit(model.tokens).cast("bigint"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_groups(table(spark, sf_dir, "documents"))


def op9_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.repeated_spans(table(spark, sf_dir, "documents"),
                                          whole_words=paragraph_dedup.MIN_WORDS)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    counts = [count(kind).alias("n_" + kind) for kind in secret_scan.BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


# Fixed values of the two queries below: centroids, rounds and url rules (host, path, verdict).
CENTROIDS, CENTROID_ROUNDS, CENTROID_DIM = 40, 5, 64
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))),
                 256)
    found = orchard.cluster(table(spark, sf_dir, "embeddings"), key, CENTROIDS, CENTROID_ROUNDS,
                            CENTROID_DIM)
    text = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia",
                        "inertia", F.sha2(text, 256).alias("centroid_sha256"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_rules.judge_urls(pages, url_rules.rule_frame(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_html_main_text": op2_html_main_text,
    "op3_source_mix": op3_source_mix,
    "op4_exact_topk": op4_exact_topk,
    "op5_language_id": op5_language_id,
    "op6_piece_sampling": op6_piece_sampling,
    "op7_pitman_yor_lm": op7_pitman_yor_lm,
    "op8_near_dedup": op8_near_dedup,
    "op9_passage_dedup": op9_passage_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_url_filter": op12_url_filter,
    "op13_spelling_variants": op13_spelling_variants,
}

def _orchard_sql() -> str:
    """Assign and move as plain minimum over all centroids, the rounds written out one by one."""
    steps = []
    for r in range(CENTROID_ROUNDS + 1):
        steps.append(f"""
             a{r} AS (SELECT rid, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
                          SELECT v.rid, m.c, list_sum(list_transform(list_zip(v.x, m.x),
                                 lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
                          FROM v, m{r} m) GROUP BY rid)""")
        if r < CENTROID_ROUNDS:
            steps.append(f"""
             t{r} AS (SELECT c, pos, sum(e)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (
                          SELECT a.c, unnest(v.x) AS e, unnest(range({CENTROID_DIM})) AS pos
                          FROM a{r} a JOIN v USING (rid)) GROUP BY c, pos),
             n{r} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS x
                      FROM t{r} GROUP BY c),
             m{r + 1} AS (SELECT m.c, coalesce(n.x, m.x) AS x FROM m{r} m LEFT JOIN n{r} n USING (c))""")
    last = CENTROID_ROUNDS
    return f"""
        WITH v AS (SELECT row_number() OVER () AS rid, vec_id, embedding,
                          list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x
                   FROM embeddings WHERE len(embedding) = {CENTROID_DIM}
                   AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
             m0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, 'null')),
                                              embedding) - 1 AS c, x
                    FROM v ORDER BY c LIMIT {CENTROIDS}),{",".join(steps)}
        SELECT v.vec_id, a.c::INTEGER AS cluster, a.d AS distance,
               sum(a.d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
               sum(a.d) OVER ()::BIGINT AS inertia,
               sha256(array_to_string(m.x, ',')) AS centroid_sha256
        FROM a{last} a JOIN v USING (rid) JOIN m{last} m ON m.c = a.c"""


def _url_sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return f"""
        WITH r(rhost, rpath, rverdict) AS (VALUES {rules}),
             u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0
                          THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
             h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS host, rest FROM u),
             p AS (SELECT row_number() OVER () AS rid, page_id,
                          translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                              AS host,
                          regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') AS path FROM h),
             b AS (SELECT rid, rhost || rpath AS rule, rverdict FROM p JOIN r
                   ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
                   QUALIFY row_number() OVER (PARTITION BY rid
                                              ORDER BY length(rhost || rpath) DESC, rule) = 1)
        SELECT page_id, host, path, rule, coalesce(rverdict, '{url_rules.DEFAULT_VERDICT}') AS verdict
        FROM p LEFT JOIN b USING (rid)"""


_SPELLING_SQL = f"""
        WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8),
                 lambda s, i: CASE WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END, n))
                 AS crc),
             r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS w
                   FROM documents),
             o AS (SELECT coalesce(doc_id::VARCHAR, 'null') AS id, count(*) AS k,
                          translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
                   FROM r GROUP BY ALL),
             h AS (SELECT w, k, xor(list_reduce(list_transform(flatten(list_transform(
                              string_split(id || ':' || w, ''), lambda c: CASE WHEN ord(c) < 128
                              THEN [ord(c)] ELSE [195, ord(c) - 64] END)), lambda b: b::BIGINT),
                          lambda s, b: xor(s // 256, t.crc[1 + xor(s % 256, b)]), 4294967295),
                          4294967295) AS h
                   FROM o, t WHERE length(w) >= {spelling.MIN_LENGTH}),
             x AS (SELECT k, CASE WHEN h % {spelling.MISSPELT_OF} = 0 THEN
                          substr(w, 1, (h % length(w))::INTEGER)
                          || substr(w, (h % length(w))::INTEGER + 2) ELSE w END AS word FROM h),
             w AS (SELECT word, sum(k)::BIGINT AS n FROM x WHERE length(word) >= {spelling.MIN_LENGTH}
                   GROUP BY word HAVING sum(k) >= {spelling.MIN_COUNT}),
             d AS (SELECT word, n, i, substr(word, 1, i::INTEGER) || substr(word, i::INTEGER + 2)
                          AS rest
                   FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
             p AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n
                   FROM d a JOIN d b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
                   UNION SELECT d.word, d.n, w.word, w.n FROM d JOIN w ON d.rest = w.word
                   UNION SELECT w.word, w.n, d.word, d.n FROM d JOIN w ON d.rest = w.word),
             b AS (SELECT word, n, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near,
                          max(near_n) AS near_n FROM p GROUP BY word, n),
             f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                          CASE WHEN near_n >= 2 * w.n THEN near END AS form,
                          CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
                   FROM w LEFT JOIN b USING (word)),
             c AS (SELECT word, word AS at FROM f
                   UNION ALL SELECT c.word, f.form FROM c JOIN f ON c.at = f.word
                   WHERE f.form IS NOT NULL),
             e AS (SELECT c.word, c.at AS root FROM c JOIN f ON c.at = f.word WHERE f.form IS NULL)
        SELECT word, form, root, n, n_near, form_n FROM f JOIN e USING (word)"""


ORACLE_SQL = {
    "op1_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(
                       coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
                   FROM documents),
             k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256
                              ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
                          count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
               text_sha256 FROM k""",
    "op3_source_mix": r"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''),
                       '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
             s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
             w AS (SELECT *, 3 * source_size AS cap, [5, 2, 1][1 + (row_number() OVER (
                       ORDER BY source IS NULL, source) - 1) % 3]::BIGINT AS weight FROM s),
             l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE
                       / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE
                       AS level
                   FROM w WINDOW before AS (ORDER BY cap::DOUBLE / weight, source IS NULL, source
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
             o AS (SELECT level AS open FROM l WHERE level * weight <= cap
                   ORDER BY cap::DOUBLE / weight, source IS NULL, source LIMIT 1),
             t AS (SELECT source, source_size, least(cap::DOUBLE, coalesce(
                       (SELECT open FROM o) * weight, cap::DOUBLE)) AS target FROM l),
             r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END
                       AS rate FROM t),
             u AS (SELECT d.doc_id, d.size, r.source, r.source_size, r.target, r.rate,
                          (('0x' || substr(md5('17:mix:' || coalesce(d.doc_id::VARCHAR, 'null')),
                            1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u,
                          (('0x' || substr(md5('17:mix-start:' || coalesce(r.source, '')), 1, 13))
                            ::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS start
                   FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
             c AS (SELECT source, size, count(*) AS n, any_value(rate - floor(rate)) AS part,
                          any_value(start) AS start FROM u GROUP BY source, size),
             k AS (SELECT source, size, floor(upto * part + start)
                          - floor((upto - n) * part + start) AS k
                   FROM (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY size)::BIGINT AS upto
                         FROM c)),
             p AS (SELECT *, row_number() OVER (PARTITION BY source, size ORDER BY u) AS place
                   FROM u),
             h AS (SELECT p.source, p.size, max(p.u) AS threshold FROM p JOIN k
                   ON p.source IS NOT DISTINCT FROM k.source AND p.size = k.size
                   WHERE place <= k GROUP BY p.source, p.size)
        SELECT u.doc_id, u.size, u.source_size, u.target, (floor(u.rate)::BIGINT
               + coalesce(u.u <= h.threshold, false)::BIGINT) * u.size AS taken
        FROM u LEFT JOIN h ON u.source IS NOT DISTINCT FROM h.source AND u.size = h.size""",
    "op4_exact_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)) AS x
                   FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
                   AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
             p AS (SELECT DISTINCT q.vec_id AS query_id, c.vec_id,
                          list_inner_product(q.x, c.x)::BIGINT AS score
                   FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
                   WHERE q.vec_id % 100 = 0),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id
                                                ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op11_centroid_clustering": _orchard_sql(),
    "op12_url_filter": _url_sql(),
    "op13_spelling_variants": _SPELLING_SQL,
}
