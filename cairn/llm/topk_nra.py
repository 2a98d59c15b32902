"""Exact top-k inner products by no-random-access aggregation.

For a query every dimension is a list of the candidates' contributions q_d * x_d in falling order,
which is the dimension's order by x_d or its reverse.  The lists are read in step, in blocks.  Of a
candidate some contributions are then known; an unread one is at most the list's current value and
at least its last one, which gives the candidate a lower and an upper bound.  Candidates whose upper
bound is under the k-th best lower bound cannot qualify and are dropped; reading stops when few
are left, and only their final scores are resolved.

A position in a list does not depend on the query but on the sign of q_d, so the bounds of all
queries of a block come from a few matrix products over the entries read so far.

Scale: vectors are dealt into blocks of bounded size by a hash; every pair of a query block and a
candidate block is one task-sized group, and per query only k rows leave it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cairn.llm import storage

SCALE = 1024
BLOCK = 4096
_QUERIES_AT_ONCE = 256
_DEPTHS = (0.125, 0.25, 0.5, 0.75)
_EXACT = float(1 << 53)


def quantized(vector: Column | str, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component x as double; null for a null vector, an empty one or one
    with a null or non-finite component."""
    v = F.col(vector) if isinstance(vector, str) else vector
    v = v.cast("array<double>")
    fine = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return F.when(fine & (F.size(v) > 0),
                  F.transform(v, lambda e: F.floor(F.lit(float(scale)) * e).cast("bigint")))


class Lists:
    """The sorted lists of a block of candidates: ``x`` (n, d), ``rank`` by rising x_d."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.sorted = np.sort(x, axis=0)
        order = np.argsort(x, axis=0, kind="stable")
        self.rank = np.empty(order.shape, np.int64)
        np.put_along_axis(self.rank, order, np.arange(len(x))[:, None], axis=0)

    def bounds(self, q: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper), each (n, queries), after ``depth`` entries of every list."""
        n = len(self.x)
        up, down = np.maximum(q, 0).T, np.minimum(q, 0).T  # lists from the top, from the bottom
        top, bottom = self.rank >= n - depth, self.rank < depth
        known = (self.x * top) @ up + (self.x * bottom) @ down
        top, bottom = top.astype(self.x.dtype), bottom.astype(self.x.dtype)

        def unread(from_top, from_bottom):
            """Sum over each candidate's unread lists of these values times the query's."""
            a, b = from_top[:, None] * up, from_bottom[:, None] * down
            return (a + b).sum(axis=0) - top @ a - bottom @ b

        most = unread(self.sorted[n - 1 - depth], self.sorted[depth])
        least = unread(self.sorted[0], self.sorted[n - 1])
        return known + least, known + most


def block_topk(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray,
               k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, candidate id, score) of each query's k best candidates of the block, ties to the
    smaller id, the query's own id left out."""
    peak = max(abs(int(q.max())), abs(int(q.min()))) * max(abs(int(x.max())), abs(int(x.min())))
    kind = np.float64 if peak * x.shape[1] < _EXACT else object  # doubles hold these sums exactly
    q, x = q.astype(kind), x.astype(kind)
    n = len(x)
    lists = Lists(x) if kind is np.float64 else None
    out = ([], [], [])
    for lo in range(0, len(q), _QUERIES_AT_ONCE):
        part, part_ids = q[lo:lo + _QUERIES_AT_ONCE], q_ids[lo:lo + _QUERIES_AT_ONCE]
        open_ = np.ones((n, len(part)), bool) & (ids[:, None] != part_ids[None, :])
        for share in _DEPTHS if lists is not None and n > 8 * k else ():
            lower, upper = lists.bounds(part, int(n * share))
            lower[~open_] = -np.inf
            kth = np.partition(lower, n - k, axis=0)[n - k]
            open_ &= upper >= kth
            if open_.sum() <= 8 * k * len(part):
                break
        for j, qid in enumerate(part_ids):
            at = np.flatnonzero(open_[:, j])
            score = x[at] @ part[j]
            best = np.lexsort((ids[at], -score))[:k]
            out[0].append(np.full(len(best), qid, np.int64))
            out[1].append(ids[at][best])
            out[2].append(np.array([min(max(int(s), -1 << 63), (1 << 63) - 1)
                                    for s in score[best]], np.int64))
    return tuple(np.concatenate(c) if c else np.zeros(0, np.int64) for c in out)


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) without rows that repeat an id and a vector."""
    ids = table.column("id").to_numpy()
    flat = table.column("x").combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    x = flat.flatten().to_numpy().reshape(len(ids), -1)
    if len(np.unique(ids)) < len(ids):
        both = np.unique(np.column_stack([ids, x]), axis=0)
        ids, x = both[:, 0], both[:, 1:]
    return ids, x


def topk(queries: DataFrame, candidates: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best candidates of every query.

    Both inputs are ``id bigint, x array<bigint>``; null ids and null vectors take no part, vectors
    of another dimension than the query's are not compared with it, and a candidate with the
    query's id is its own.  Rows that repeat id and vector count once."""
    def dealt(df):
        df = df.where("id is not null and x is not null and size(x) > 0").select("id", "x")
        n = max(1, -(-df.count() // block))
        return df.select("id", "x", F.size("x").alias("dim"),
                         F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("b")), n

    q, nq = dealt(queries)
    c, nc = dealt(candidates)
    q = q.select("id", "x", "dim", F.col("b").alias("qb"),
                 F.explode(F.sequence(F.lit(0), F.lit(nc - 1))).alias("cb"))
    c = c.select("id", "x", "dim", F.col("b").alias("cb"),
                 F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("qb"))

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            cols = (np.zeros(0, np.int64),) * 3
        else:
            cols = block_topk(*_matrix(left), *_matrix(right), k)
        return pa.table([pa.array(x, pa.int64()) for x in cols],
                        names=["query_id", "vec_id", "score"])

    storage.ship_package(queries.sparkSession)
    keys = ["dim", "qb", "cb"]
    found = q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInArrow(
        pair, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
