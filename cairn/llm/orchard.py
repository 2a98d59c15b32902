"""Centroid clustering with Orchard's search for the nearest centroid.

Vectors are turned into integers floor(scale * x), so distances, sums and centroids are exact and do
not depend on the partitioning.  The driver sorts, for every centroid, the other centroids by
distance (k x k numbers, k is a parameter) and sends centroids and lists to the tasks.  A search for
a point's nearest centroid walks the list of the best centroid so far; a centroid already measured
is skipped by its mark; a nearer one (or one as near with a smaller number) becomes the best, and
the walk goes on in its list from the start.  It stops at the first entry strictly farther from the
best than twice the point's distance to it: by the triangle inequality all later entries are farther
from the point than the best, so ties are still seen.  All points of a block walk in step.

A round is one scan of the table: the tasks return sums per centroid, at most k * (d + 2) rows each,
so no vector is shuffled, whatever its cluster's size.  A lost executor costs its tasks only.

Defined results: rows whose vector is null, has another number of components, or a null, NaN or
infinite one take no part.  Repeated rows count as often as they occur; a null id is hashed as the
text ``null``.  Fewer vectors than k give as many centroids; an empty table gives no row.  Extra
columns go.  A component beyond +-2**26 after scaling raises ``ValueError`` with its value, as
squared distances are returned as 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cairn.llm import storage

MAX_COMPONENT = 1 << 26  # 64 squares of twice that, times 4, still fit 63 bits
BLOCK_CELLS = 1 << 21    # marks of a block of points, and components gathered at once


def whole_vectors(vectors: DataFrame, vector: str, dim: int) -> DataFrame:
    """The rows with exactly ``dim`` components, none null or non-finite."""
    x = F.col(vector)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return vectors.where((F.size(x) == dim) & ~bad)


def _integers(column: pa.Array, dim: int, scale: float) -> np.ndarray:
    """(rows, dim) int64 components floor(scale * x), x as double."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(flat * scale)
    if len(whole) and np.abs(whole).max() > MAX_COMPONENT:
        raise ValueError(f"component {flat[np.abs(whole).argmax()]!r} is too large for exact distances")
    return whole.astype(np.int64).reshape(-1, dim)


@dataclass
class Lists:
    """Centroids with, for each, all centroids by distance (itself first) and these distances."""

    centroids: np.ndarray  # (k, d) int64
    order: np.ndarray      # (k, k) int32
    apart: np.ndarray      # (k, k) int64, squared, in the order of ``order``


def neighbour_lists(centroids: np.ndarray) -> Lists:
    k = len(centroids)
    order, apart = np.zeros((k, k), np.int32), np.zeros((k, k), np.int64)
    for c in range(k):
        diff = centroids - centroids[c]
        sq = np.einsum("ij,ij->i", diff, diff)
        sq_order = np.lexsort((np.arange(k), sq))
        order[c], apart[c] = sq_order, sq[sq_order]
    return Lists(centroids, order, apart)


def _distance(x: np.ndarray, centroids: np.ndarray, number: np.ndarray) -> np.ndarray:
    diff = x - centroids[number]
    return np.einsum("ij,ij->i", diff, diff)


def search(x: np.ndarray, lists: Lists) -> tuple[np.ndarray, np.ndarray, int]:
    """(number, squared distance, distances computed) of each point's nearest centroid, the smaller
    number on ties."""
    n, k = len(x), len(lists.centroids)
    number, distance, measured = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    block = max(1, BLOCK_CELLS // max(k, x.shape[1]))
    for lo in range(0, n, block):
        points = x[lo:lo + block]
        m = len(points)
        best = np.zeros(m, np.int64)
        d = _distance(points, lists.centroids, best)
        seen = np.zeros((m, k), bool)
        seen[:, 0] = True
        place = np.zeros(m, np.int64)
        live = np.arange(m)
        measured += m
        while len(live):
            live = live[place[live] < k]
            live = live[lists.apart[best[live], place[live]] <= 4 * d[live]]
            if not len(live):
                break
            to = lists.order[best[live], place[live]]
            place[live] += 1
            new = ~seen[live, to]
            at, to = live[new], to[new]
            if not len(at):
                continue
            seen[at, to] = True
            measured += len(at)
            there = _distance(points[at], lists.centroids, to)
            nearer = (there < d[at]) | ((there == d[at]) & (to < best[at]))
            at = at[nearer]
            best[at], d[at], place[at] = to[nearer], there[nearer], 0
        number[lo:lo + block], distance[lo:lo + block] = best, d
    return number, distance, measured


SUMS = "number int, n bigint, apart decimal(38,0), total array<bigint>"


def _sums_kernel(sent, dim: int, scale: float):
    """Per task and centroid: points, their distances' sum and their components' sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = sent.value
        k = len(lists.centroids)
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        apart = [0] * k  # Python integers: a sum of distances may pass 63 bits
        for batch in batches:
            x = _integers(batch.column(0), dim, scale)
            if not len(x):
                continue
            number, distance, _ = search(x, lists)
            order = np.argsort(number, kind="stable")
            held, first = np.unique(number[order], return_index=True)
            count[held] += np.diff(np.append(first, len(x)))
            total[held] += np.add.reduceat(x[order], first, axis=0)
            # two 32-bit halves, so that no sum of a batch passes 63 bits
            high = np.add.reduceat(distance[order] >> 32, first)
            low = np.add.reduceat(distance[order] & 0xFFFFFFFF, first)
            for c, h, rest in zip(held.tolist(), high.tolist(), low.tolist()):
                apart[c] += (h << 32) + rest
        held = np.flatnonzero(count)
        if len(held):
            yield pa.RecordBatch.from_arrays(
                [pa.array(held.astype(np.int32)), pa.array(count[held]),
                 pa.array([apart[c] for c in held], pa.decimal128(38, 0)),
                 pa.array(list(total[held]), pa.list_(pa.int64()))],
                names=["number", "n", "apart", "total"])

    return run


def _assign_kernel(sent, dim: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = sent.value
        for batch in batches:
            x = _integers(batch.column(1), dim, scale)
            number, distance, _ = search(x, lists)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(number.astype(np.int32)), pa.array(distance)],
                names=["id", "cluster", "distance"])

    return run


def first_centroids(points: DataFrame, key: Column, k: int) -> list[list[float]]:
    """The vectors with the k smallest keys, rows with equal keys by their components."""
    rows = points.select(key.alias("key"), "x").orderBy("key", "x").limit(k).collect()
    return [r.x for r in rows]


def _round(points: DataFrame, lists: Lists, dim: int, scale: float):
    """{number: (points, sum of distances, component sums)} after assigning every vector."""
    sent = points.sparkSession.sparkContext.broadcast(lists)
    try:
        part = storage.arrow(points.select("x"), _sums_kernel(sent, dim, scale), SUMS)
        summed = (part.select("number", "n", "apart", F.posexplode("total").alias("pos", "v"))
                  .groupBy("number", "pos")
                  .agg(F.sum("n").alias("n"), F.sum("apart").alias("apart"),
                       F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))).collect()
    finally:
        sent.destroy()
    out: dict[int, tuple] = {}
    for r in summed:  # k * d rows
        out.setdefault(r.number, (int(r.n), int(r.apart), [0] * dim))[2][r.pos] = int(r.v)
    return out


def cluster(vectors: DataFrame, key: Column, k: int, rounds: int, dim: int, scale: float = 256.0,
            ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid)`` of every vector after
    ``rounds`` of assigning and moving: centroids start as the k vectors with the least ``key`` (a
    column of ``vectors``) and move to the floor of their vectors' mean; ``centroid`` is the final
    one as array<bigint>."""
    if k < 1 or rounds < 0 or dim < 1:
        raise ValueError("k and dim must be at least 1, rounds at least 0")
    if dim > 64:
        raise ValueError("exact 64-bit distances need at most 64 components")
    points = whole_vectors(vectors, vector, dim).select(
        F.col(ident).alias("id"), F.col(vector).alias("x"), key.alias("key"))
    first = first_centroids(points, F.col("key"), k)
    points = points.drop("key")
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    ident_type = dict(vectors.dtypes)[ident]
    if not first:
        return points.select("id", F.lit(None).cast("int").alias("cluster"),
                             F.lit(None).cast("bigint").alias("distance"),
                             F.lit(None).cast("bigint").alias("cluster_inertia"),
                             F.lit(None).cast("bigint").alias("inertia"),
                             F.lit(None).cast("array<bigint>").alias("centroid")).where("false")
    now = _integers(pa.array(first, pa.list_(pa.float64())), dim, scale)
    for _ in range(rounds):
        for number, (n, _, total) in _round(points, neighbour_lists(now), dim, scale).items():
            now[number] = [v // n for v in total]
    lists = neighbour_lists(now)
    last = _round(points, lists, dim, scale)
    inertia = sum(apart for _, apart, _ in last.values())
    spark = vectors.sparkSession
    table = spark.createDataFrame([(c, apart, inertia, now[c].tolist())
                                   for c, (_, apart, _) in last.items()], schema)
    sent = spark.sparkContext.broadcast(lists)  # lives as long as the returned plan
    rows = storage.arrow(points, _assign_kernel(sent, dim, scale),
                         f"id {ident_type}, cluster int, distance bigint")
    return rows.join(F.broadcast(table), "cluster").select(  # k rows
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
