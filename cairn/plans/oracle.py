"""DuckDB oracle SQL for every named query.

Independent formulations over the pre-registered views (``embeddings``, ``orders``,
``documents``, ``lineitem``): plain joins, windows and ``QUALIFY`` instead of the Spark kernels.
The k-median chains are generated as ``AS MATERIALIZED`` CTEs, one per seeding round and Lloyd
step, with the same hashed uniforms as the Spark side.
"""

from __future__ import annotations

from cairn.plans.params import (CDF_X, DIGITS, ITER, K, L, N_CENTRES, NORM_DIGITS, SALT_K,
                                SEED, SEQ_ITER, SEQ_K)

del SALT_K  # the salted count equals the plain count

# Fixed value: 2**52, the scale of the 13-hex-digit uniform.
_SCALE = "4503599627370496"


def _u(tag: str, key: str) -> str:
    return (f"(((('0x' || substr(md5('{SEED}:{tag}:' || CAST({key} AS VARCHAR)), 1, 13))"
            f"::BIGINT)::DOUBLE + 0.5) / {_SCALE})")


def _part(key: str, parts: int) -> str:
    return (f"((('0x' || substr(md5('{SEED}:part:' || CAST({key} AS VARCHAR)), 1, 8))"
            f"::BIGINT % {parts})::INT)")


def _tokens(col: str) -> str:
    return (f"CASE WHEN {col} <> '' AND rtrim({col}, ' ') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim({col}, ' '), ' ') END")


_WORDS = f"SELECT unnest({_tokens('text')}) AS word FROM documents"

_PRICES = """mm AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
z AS (SELECT o_orderkey AS id, o_totalprice AS x,
             (o_totalprice - lo) / NULLIF(hi - lo, 0) AS z FROM orders, mm)"""

_POINTS = "pts AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, 1::BIGINT AS w FROM embeddings)"
_WPOINTS = ("pts AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, (label + 1)::BIGINT AS w "
            "FROM embeddings)")


def _first(n: int = N_CENTRES) -> str:
    return (f"c AS (SELECT (row_number() OVER (ORDER BY id) - 1)::INT AS cid, id AS cpid, v AS cv "
            f"FROM pts ORDER BY id LIMIT {n})")


_CLOSEST = """a AS (SELECT p.id, p.w, p.v, c.cid, list_distance(p.v, c.cv) AS d FROM pts p, c
             QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY d, c.cid) = 1)"""


# ----------------------------------------------------------------------------- k-median

def _seeding(src: str, k: int, tag: str, pre: str) -> list[str]:
    """CTEs ``{pre}s0 .. {pre}s{k-1}`` (part, cid, id, v) and ``{pre}seeds``."""
    ctes = [f"""{pre}s0 AS MATERIALIZED (SELECT part, 0 AS cid, id, v FROM {src}
      QUALIFY row_number() OVER (PARTITION BY part ORDER BY -ln({_u(tag + '0', 'id')}), id) = 1)"""]
    for i in range(1, k):
        if i == 1:
            dsrc = (f"SELECT p.part, p.id, p.v, p.w, list_distance(p.v, c.v) AS d "
                    f"FROM {src} p JOIN {pre}s0 c ON p.part = c.part")
        else:
            dsrc = (f"SELECT p.part, p.id, p.v, p.w, least(p.d, list_distance(p.v, c.v)) AS d "
                    f"FROM {pre}d{i - 1} p LEFT JOIN {pre}s{i - 1} c ON p.part = c.part")
        ctes.append(f"{pre}d{i} AS MATERIALIZED ({dsrc})")
        ctes.append(f"""{pre}s{i} AS MATERIALIZED (SELECT part, {i} AS cid, id, v FROM {pre}d{i}
      WHERE w * d > 0
      QUALIFY row_number() OVER (PARTITION BY part
                                 ORDER BY -ln({_u(tag + str(i), 'id')}) / (w * d), id) = 1)""")
    union = " UNION ALL ".join(f"SELECT * FROM {pre}s{i}" for i in range(k))
    ctes.append(f"{pre}seeds AS MATERIALIZED ({union})")
    return ctes


def _assign(src: str, cen: str) -> str:
    return (f"SELECT p.part, p.id, p.w, p.v, c.cid FROM {src} p JOIN {cen} c ON p.part = c.part "
            f"QUALIFY row_number() OVER (PARTITION BY p.part, p.id "
            f"ORDER BY list_distance(p.v, c.v), c.cid) = 1")


def _lloyd(src: str, start: str, iters: int, pre: str) -> tuple[list[str], str]:
    """CTEs of ``iters`` Lloyd steps from centres ``start`` (part, cid, v); returns the name
    of the final centre CTE."""
    ctes, cen = [], start
    for j in range(iters):
        ctes.append(f"{pre}a{j} AS MATERIALIZED ({_assign(src, cen)})")
        ctes.append(f"""{pre}m{j} AS MATERIALIZED (
      SELECT part, cid, pos, sum(w * x) / sum(w) AS x
      FROM (SELECT part, cid, w, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM {pre}a{j})
      GROUP BY part, cid, pos HAVING sum(w) > 0)""")
        ctes.append(f"""{pre}c{j + 1} AS MATERIALIZED (
      SELECT part, (dense_rank() OVER (PARTITION BY part ORDER BY cid) - 1)::INT AS cid,
             list(x ORDER BY pos) AS v
      FROM {pre}m{j} GROUP BY part, cid)""")
        cen = f"{pre}c{j + 1}"
    return ctes, cen


def _cluster(src: str, k: int, iters: int, tag: str, pre: str) -> tuple[list[str], str]:
    ctes = _seeding(src, k, tag, pre)
    ctes.append(f"{pre}c0 AS MATERIALIZED (SELECT part, cid, v FROM {pre}seeds)")
    more, final = _lloyd(src, f"{pre}c0", iters, pre)
    return ctes + more, final


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _long(cen: str, with_part: bool = False) -> str:
    part = "part, " if with_part else ""
    return (f"SELECT {part}cid, pos::INT AS pos, round(x, {DIGITS}) AS x FROM "
            f"(SELECT {part}cid, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM {cen})")


_PTS1 = ("P AS MATERIALIZED (SELECT 0 AS part, vec_id AS id, embedding::DOUBLE[] AS v, "
         "1::BIGINT AS w FROM embeddings)")
_PTSL = (f"P AS MATERIALIZED (SELECT {_part('vec_id', L)} AS part, vec_id AS id, "
         f"embedding::DOUBLE[] AS v, 1::BIGINT AS w FROM embeddings)")


def _coreset_ctes() -> tuple[list[str], str]:
    ctes, final = _cluster("P", K, ITER, "s", "r1")
    ctes.append(f"r1w AS MATERIALIZED (SELECT part, cid, sum(w)::BIGINT AS w FROM "
                f"({_assign('P', final)}) GROUP BY part, cid)")
    ctes.append(f"core AS MATERIALIZED (SELECT c.part, c.cid, c.v, r1w.w FROM {final} c "
                f"JOIN r1w ON c.part = r1w.part AND c.cid = r1w.cid WHERE r1w.w > 0)")
    return [_PTSL] + ctes, "core"


def _merge_ctes() -> tuple[list[str], str]:
    ctes, _ = _coreset_ctes()
    ctes.append(f"M AS MATERIALIZED (SELECT 0 AS part, (part * {K} + cid)::BIGINT AS id, v, w "
                f"FROM core)")
    more, final = _cluster("M", K, ITER, "m", "r2")
    return ctes + more, final


def _objective(points: str, cen: str) -> str:
    return (f"SELECT count(*)::BIGINT AS n, avg(d) AS objective FROM "
            f"(SELECT p.id, min(list_distance(p.v, c.v)) AS d FROM {points} p, {cen} c "
            f"GROUP BY p.id)")


def _kmedian_seed() -> str:
    return _with([_PTS1] + _seeding("P", K, "s", "r1"),
                 "SELECT cid::INT AS cid, id FROM r1seeds")


def _lloyd_refine() -> str:
    start = (f"st AS MATERIALIZED (SELECT 0 AS part, (row_number() OVER (ORDER BY id) - 1)::INT "
             f"AS cid, v FROM P ORDER BY id LIMIT {K})")
    more, final = _lloyd("P", "st", ITER, "r1")
    return _with([_PTS1, start] + more, _long(final))


def _weighted_kmedian() -> str:
    ctes, final = _cluster("P", K, ITER, "s", "r1")
    return _with([_PTS1] + ctes, _long(final))


def _sequential_kmedian() -> str:
    ctes, final = _cluster("P", SEQ_K, SEQ_ITER, "s", "r1")
    o = _objective("P", final)
    return _with([_PTS1] + ctes,
                 f"SELECT n, {SEQ_K}::INT AS k, {SEQ_ITER}::INT AS iter, "
                 f"round(objective, {DIGITS}) AS objective FROM ({o})")


def _coreset() -> str:
    ctes, core = _coreset_ctes()
    return _with(ctes, f"SELECT part::INT AS part, cid::INT AS cid, w, pos::INT AS pos, "
                       f"round(x, {DIGITS}) AS x FROM (SELECT part, cid, w, unnest(v) AS x, "
                       f"generate_subscripts(v, 1) AS pos FROM {core})")


def _coreset_merge() -> str:
    ctes, final = _merge_ctes()
    return _with(ctes, _long(final))


def _coreset_kmedian() -> str:
    ctes, final = _merge_ctes()
    o = _objective("P", final)
    return _with(ctes, f"SELECT n, {K}::INT AS k, {L}::INT AS parts, {ITER}::INT AS iter, "
                       f"round(objective, {DIGITS}) AS objective FROM ({o})")


# ----------------------------------------------------------------------------- all queries

def oracle_sql() -> dict[str, str]:
    wc = f"SELECT word, count(*)::BIGINT AS n FROM ({_WORDS}) GROUP BY word"
    first = _first()
    wd = f"WITH {_WPOINTS}, {first}, {_CLOSEST}, wd AS (SELECT id, w * d AS wd FROM a)"
    cum = (f"{wd}, cum AS (SELECT id, wd / sum(wd) OVER () AS p, sum(wd) OVER (ORDER BY id "
           f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(wd) OVER () AS cum FROM wd)")
    return {
        "num_parse": r"""
            WITH t AS (SELECT unnest(regexp_split_to_array(
                CAST(l_partkey AS VARCHAR) || ' ' || CAST(l_suppkey AS VARCHAR) || chr(9) ||
                CAST(l_linenumber AS VARCHAR) || '  ', '\s+')) AS tok FROM lineitem)
            SELECT CAST(tok AS DOUBLE) AS x, count(*)::BIGINT AS n FROM t WHERE tok <> ''
            GROUP BY 1""",
        "max_reduce": "SELECT max(o_totalprice) AS max_x FROM orders",
        "min_max_custom_order":
            """SELECT first(x ORDER BY x % 1000 DESC, x DESC) AS max_x,
                first(x ORDER BY x % 1000, x) AS min_x
                FROM (SELECT o_totalprice AS x FROM orders)""",
        "row_count_sum_mean": f"""WITH {_PRICES}
            SELECT count(*)::BIGINT AS n, round(sum(x), 2) AS sum_x, round(avg(x), 4) AS mean_x,
                   round(sum(z), {DIGITS}) AS sum_norm, round(avg(z), {NORM_DIGITS}) AS mean_norm
            FROM z""",
        "minmax_normalize": f"WITH {_PRICES} SELECT id, round(z, {NORM_DIGITS}) AS x_norm FROM z",
        "normalized_variance": f"""WITH {_PRICES}
            SELECT count(*)::BIGINT AS n, round(avg(z), {NORM_DIGITS}) AS mean_norm,
                   round(var_pop(z), {NORM_DIGITS}) AS var_norm FROM z""",
        "lines": r"""SELECT doc_id, generate_subscripts(l, 1)::INT AS line_no, unnest(l) AS line
            FROM (SELECT doc_id, CASE WHEN l[-1] = '' THEN l[:-2] ELSE l END AS l FROM (SELECT doc_id,
                  regexp_split_to_array(text, '\r\n|\r|\n') AS l FROM documents))""",
        "tokenize": f"""SELECT doc_id, generate_subscripts(t, 1)::INT AS pos, unnest(t) AS word
            FROM (SELECT doc_id, {_tokens('text')} AS t FROM documents)""",
        "doc_word_count": f"""SELECT doc_id, word, count(*)::BIGINT AS n FROM
            (SELECT doc_id, unnest({_tokens('text')}) AS word FROM documents)
            GROUP BY doc_id, word""",
        "word_count": wc,
        "word_count_salted": wc,
        "word_count_partitioned": wc,
        "distinct_words": f"SELECT DISTINCT word, length(word)::INT AS len FROM ({_WORDS})",
        "avg_distinct_word_length": f"""SELECT count(*)::BIGINT AS n_words,
            round(avg(length(word)), {DIGITS}) AS avg_len FROM (SELECT DISTINCT word FROM ({_WORDS}))""",
        "vector_parse": f"""SELECT id, generate_subscripts(v, 1)::INT AS pos, unnest(v) AS x FROM
            (SELECT id, list_transform({_tokens('line')}, lambda t: CAST(t AS DOUBLE)) AS v FROM
              (SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) || ' ' ||
                      CAST(o_orderkey AS VARCHAR) ||
                      CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE '' END AS line FROM orders))""",
        "repartition_balance": f"""SELECT {_part('vec_id', L)} AS part, count(*)::BIGINT AS n
            FROM embeddings GROUP BY 1""",
        "repartition_exact": f"""SELECT vec_id AS id, (ntile({L}) OVER (ORDER BY vec_id) - 1)::INT
            AS part FROM embeddings""",
        "file_numbers": """SELECT x, count(*)::BIGINT AS n FROM
            (SELECT o_orderkey::DOUBLE AS x FROM orders UNION ALL SELECT o_totalprice FROM orders)
            GROUP BY x""",
        "file_lines": r"""
            WITH f AS (SELECT coalesce(text, '') || CASE doc_id % 3 WHEN 0 THEN chr(10)
                       WHEN 1 THEN chr(13) ELSE chr(13) || chr(10) END AS t FROM documents),
                 l AS (SELECT unnest(regexp_split_to_array(t, '\r\n|\r|\n')[:-2]) AS line FROM f
                       UNION ALL SELECT unnest(['', '', '']))
            SELECT line, count(*)::BIGINT AS n FROM l GROUP BY line""",
        "file_vectors": """SELECT vec_id AS id, generate_subscripts(embedding, 1)::INT AS pos,
            unnest(embedding)::DOUBLE AS x FROM embeddings""",
        "unit_weights": "SELECT vec_id AS id, 1::BIGINT AS w FROM embeddings",
        "pairwise_distance": f"""WITH {_POINTS}, {first}
            SELECT p.id, c.cid, round(list_distance(p.v, c.cv), {DIGITS}) AS d FROM pts p, c""",
        "closest_center": f"""WITH {_POINTS}, {first}, {_CLOSEST}
            SELECT id, cid, round(d, {DIGITS}) AS d FROM a""",
        "cluster_members": f"WITH {_POINTS}, {first}, {_CLOSEST} SELECT cid, id FROM a",
        "cluster_weights": f"""WITH {_POINTS}, {first}, {_CLOSEST}
            SELECT c.cid, coalesce(sum(a.w), 0)::BIGINT AS w FROM c LEFT JOIN a ON a.cid = c.cid
            GROUP BY c.cid""",
        "remaining_points": f"""WITH {_POINTS}, {first}
            SELECT id FROM pts WHERE id NOT IN (SELECT cpid FROM c)""",
        "weights_lookup": """SELECT p.vec_id AS id, q.w FROM embeddings p
            JOIN (SELECT vec_id, (label + 1)::BIGINT AS w FROM embeddings) q ON p.vec_id = q.vec_id""",
        "weighted_distance_total": f"""WITH {_WPOINTS}, {first}, {_CLOSEST}
            SELECT round(sum(w * d), {DIGITS}) AS total FROM a""",
        "cumulative_probability": f"""{cum}
            SELECT id, round(p, {NORM_DIGITS}) AS p, round(cum, {NORM_DIGITS}) AS cum FROM cum""",
        "weighted_draw_cdf": f"{cum} SELECT min(id) AS id FROM cum WHERE cum >= {CDF_X}",
        "uniform_draw": f"""SELECT vec_id AS id FROM embeddings
            ORDER BY -ln({_u('u', 'vec_id')}), vec_id LIMIT 1""",
        "weighted_draw_race": f"""{wd} SELECT id FROM wd WHERE wd > 0
            ORDER BY -ln({_u('r', 'id')}) / wd, id LIMIT 1""",
        "weighted_centroid": f"""WITH {_WPOINTS}, {first}, {_CLOSEST}
            SELECT cid, pos::INT AS pos, round(sum(w * x) / sum(w), {DIGITS}) AS x FROM
              (SELECT cid, w, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a)
            GROUP BY cid, pos""",
        "kmedian_objective": f"""WITH {_POINTS}, {first}, {_CLOSEST}
            SELECT count(*)::BIGINT AS n, round(avg(d), {DIGITS}) AS objective FROM a""",
        "union_weighted_points": f"""WITH {_WPOINTS}, {first}
            SELECT id, w, 'remaining' AS src FROM pts WHERE id NOT IN (SELECT cpid FROM c)
            UNION ALL
            SELECT id, w, 'chosen' AS src FROM pts WHERE id IN (SELECT cpid FROM c)""",
        "kmedian_seed": _kmedian_seed(),
        "lloyd_refine": _lloyd_refine(),
        "weighted_kmedian": _weighted_kmedian(),
        "sequential_kmedian": _sequential_kmedian(),
        "coreset": _coreset(),
        "coreset_merge": _coreset_merge(),
        "coreset_kmedian": _coreset_kmedian(),
        "numeric_statistics": f"""WITH {_PRICES}
            SELECT count(*)::BIGINT AS n, max(x) AS max_reduce, max(x) AS max_ordered,
                   min(x) AS min_ordered, round(avg(z), {NORM_DIGITS}) AS mean_norm,
                   round(var_pop(z), {NORM_DIGITS}) AS var_norm FROM z""",
        "word_count_summary": f"""SELECT sum(n)::BIGINT AS n_tokens, count(*)::BIGINT AS n_words,
            round(avg(length(word)), {DIGITS}) AS avg_len FROM ({wc})""",
    }
