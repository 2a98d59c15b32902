"""Weighted k-median clustering (KM1-KM7).

All L parts of a coreset are clustered *in lock-step*: every seeding pass (one or more
rounds, see ``_seed_lookahead``) and every Lloyd step is one Spark job over all points
(scan -> Arrow kernel -> aggregate keyed by part), so a part is
never gathered into one task, whatever its size, and the points are never shuffled by part.  What
stays on the driver is only the centre table, at most k centres of d doubles for each of L
parts, and during a seeding pass (lookahead + 1) * (candidates + 1) candidate rows per part:
sizes fixed by the parameters, and driver work linear in them.  Each job's lineage is the scan
of the points plus that table, so a lost executor costs a re-run of its tasks, never a replay
of earlier rounds.

Semantics (see README): seeding picks the first centre uniformly and each next one with
probability proportional to w * (distance to the closest chosen centre), over a running
minimum of all chosen centres (C10, C11); points at distance 0 are not candidates, so a set
with fewer than k distinct points yields fewer centres (C16).  Lloyd assigns every point to
its closest centre, lowest id on ties (C12, C15), and moves each centre to the weighted mean
of its cluster (C18); empty clusters are dropped and ids re-numbered densely (C14).  Coreset
weights are the total weight of the points closest to each final centre (C19); a centre that
ends up with weight 0 represents no point and is left out of the coreset.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cairn.functions.random import hashed_bucket, hashed_digits, hashed_uniform, race_key
from cairn.operators.assign import (RACE_SCHEMA, Centres, apply_kernel, cluster_stats,
                                    observed_objective, release)
from cairn.operators.kernels import (list_array, lookahead_kernel, nearest, race_kernel,
                                     vector_matrix, whole_table_kernel)
from cairn.operators.placement import equal_parts
from cairn.session import delete_folder, tag_dir


def check_params(k: int, parts: int = 1, iters: int = 0) -> None:
    """C21: reject any invalid argument (not only when all are invalid)."""
    if int(k) < 1:
        raise ValueError("k must be >= 1")
    if int(parts) < 1:
        raise ValueError("parts (L) must be >= 1")
    if int(iters) < 0:
        raise ValueError("iter must be >= 0")


def prepare_points(points: DataFrame, parts: int = 1, seed: int = 0,
                   persist: bool | str = True, min_partitions: int | None = None,
                   equal: bool = False) -> DataFrame:
    """``(id, v, w, part)``: ``part`` is a hash of (seed, id) in [0, parts), balanced
    whatever the ids look like and independent of the physical layout (PHY2 as a column); with
    ``equal`` the parts are cut in id order and their sizes differ by at most one.
    Rows stay where they are: the kernels group each Arrow batch by part themselves, so no
    sort or shuffle by part is needed.  ``min_partitions`` deals the points out to that many
    partitions by id once, for inputs known to have too few (C24); nothing is probed."""
    w = F.col("w").cast("bigint") if "w" in points.columns else F.lit(1).cast("bigint")
    if equal and parts > 1:
        pts = equal_parts(points.select("id", "v", w.alias("w")), parts)
    else:
        part = F.lit(0) if parts == 1 else hashed_bucket(seed, F.col("id"), parts)
        pts = points.select("id", "v", w.alias("w"), part.cast("int").alias("part"))
    if min_partitions:
        pts = pts.repartition(min_partitions, "id")
    return _store(pts, persist)


def _store(pts: DataFrame, persist: bool | str) -> DataFrame:
    """Keep the prepared points for their passes (seeding, Lloyd, weights, objective).

    ``True``/``'memory'``: ``persist(MEMORY_AND_DISK)``, right while the points fit the
    executors (lost blocks are recomputed from the source).  ``'checkpoint'``: one Parquet
    table in the shared ``spark.checkpoint.dir``, removed by ``drop_points``; the choice when
    the points are the costly result of a join.  ``False``/``'none'``: every pass re-reads the
    source with column pruning, the choice for 100 TB of points in a columnar source."""
    mode = {True: "memory", False: "none"}.get(persist, persist)
    if mode == "memory":
        return pts.persist(StorageLevel.MEMORY_AND_DISK)
    if mode == "checkpoint":
        path = tag_dir(pts.sparkSession, f"points-{uuid.uuid4().hex}")
        pts.write.parquet(path)
        kept = pts.sparkSession.read.schema(pts.schema).parquet(path)
        kept._cairn_path = path
        return kept
    if mode == "none":
        return pts
    raise ValueError("persist must be True, False, 'memory', 'checkpoint' or 'none'")


def drop_points(pts: DataFrame) -> None:
    """Let go of what ``prepare_points`` kept."""
    path = getattr(pts, "_cairn_path", None)
    if path:
        delete_folder(pts.sparkSession, path)
    else:
        pts.unpersist()


@dataclass
class Seeding:
    centres: Centres
    chosen: list = field(default_factory=list)  # (part, cid, id) in draw order
    passes: int = 0  # jobs over the points


# Seeding rounds looked ahead per pass, and candidates kept per part and round.
DEFAULT_LOOKAHEAD = 7
DEFAULT_CANDIDATES = 4
LOOKAHEAD_SCHEMA = ("part int, t int, lb double, id bigint, e double, w double, d double, "
                    "v array<double>")


def seed_centres(pts: DataFrame, k: int, seed: int, tag: str = "s",
                 use_part: bool = True, lookahead: int = DEFAULT_LOOKAHEAD,
                 candidates: int = DEFAULT_CANDIDATES) -> Seeding:
    """Weighted D-seeding of every part at once (KM1).

    ``lookahead=0``: one pass per round, each returning <= L rows.  Otherwise a pass at
    round j also settles rounds j+1 .. j+lookahead when it can prove the draw (see
    ``_seed_lookahead``); the centres are the same either way."""
    check_params(k)
    if lookahead < 0 or candidates < 1:
        raise ValueError("lookahead must be >= 0 and candidates >= 1")
    src = pts if use_part else pts.withColumn("part", F.lit(0))
    if lookahead > 0:
        return _seed_lookahead(pts, src, k, seed, tag, lookahead, candidates)
    rows: list = []
    chosen: list = []
    for i in range(k):
        table = Centres.from_rows(rows)
        u = hashed_uniform(seed, f"{tag}{i}", F.col("id"))
        held: list = []
        if i == 0:  # uniform draw of the first centre of each part: no distances, JVM only
            partial = src.select("part", race_key(u).alias("key"), "id", "v")
        else:
            partial = apply_kernel(src, table, lambda b: race_kernel(b, True),
                                   RACE_SCHEMA, use_part=True, extra={"u": u}, broadcasts=held)
        try:
            if use_part:  # one winner per part: partial aggregation, <= L rows per task
                best = (partial.groupBy("part")
                        .agg(F.min(F.struct("key", "id", "v")).alias("b"))
                        .select("part", "b.id", "b.v").collect())
            else:  # one winner: TakeOrderedAndProject, no shuffle stage
                best = (partial.orderBy("key", "id").limit(1).select("part", "id", "v")
                        .collect())
        finally:
            release(held)
        if not best:
            break  # every remaining point coincides with a centre (C16)
        rows += [(r.part, i, r.v) for r in best]
        chosen += [(r.part, i, r.id) for r in best]
    return Seeding(Centres.from_rows(rows), chosen, i + 1)


def _first_draw(src: DataFrame, seed: int, tag: str) -> list:
    """Round 0: the uniform draw of each part's first centre, a JVM aggregate."""
    u = hashed_uniform(seed, f"{tag}0", F.col("id"))
    return (src.select("part", race_key(u).alias("key"), "id", "v").groupBy("part")
            .agg(F.min(F.struct("key", "id", "v")).alias("b"))
            .select("part", "b.id", "b.v").collect())


def _seed_lookahead(pts: DataFrame, src: DataFrame, k: int, seed: int, tag: str,
                    lookahead: int, candidates: int) -> Seeding:
    """Seeding with fewer passes, same centres.

    A pass computes every point's distance d to the chosen centres of its part.  With j the
    part's next round, the race key ``-ln(u)/(w*d)`` of round j is exact; for rounds j+t it
    is a lower bound, since d can only shrink.  Per (part, t) the pass returns the
    ``candidates + 1`` rows with the smallest bound (a group-limited window, so each task
    ships at most that many).  On the driver, round j takes its exact winner; then each round
    j+t recomputes the candidates' keys with the centres chosen since the pass and accepts the
    best one only if it is strictly below the bound of the first row left out: every other
    point has a key at least that large, so the draw (ties by id included) is exactly the one
    a full pass would make.

    Parts advance on their own: a part goes on while its draws are proven, and the next pass
    starts it at its own round, which is joined to the points as a table of one row per
    unfinished part.  So the number of passes is that of the slowest part, and points of
    finished parts are not read into the kernel again."""
    best = _first_draw(src, seed, tag)
    rows = {r.part: [(0, r.v)] for r in best}
    chosen = [(r.part, 0, r.id) for r in best]
    keep = candidates + 1
    todo = sorted(rows) if k > 1 else []
    spark = pts.sparkSession
    passes = 1
    while todo:
        passes += 1
        rounds = min(lookahead + 1, k - min(len(rows[p]) for p in todo))  # no further than k
        table = Centres.from_rows((p, i, v) for p in todo for i, v in rows[p])
        at = spark.createDataFrame([(p, len(rows[p])) for p in todo], "part int, rnd int")
        src_at = src.join(F.broadcast(at), "part")  # one row per part
        extra = {"u": hashed_digits(seed, [
            F.concat(F.lit(tag), (F.col("rnd") + t).cast("string")) for t in range(rounds)],
            F.col("id"))}
        held: list = []
        partial = apply_kernel(src_at, table, lambda b: lookahead_kernel(b, rounds, keep),
                               LOOKAHEAD_SCHEMA, use_part=True, extra=extra, broadcasts=held)
        rank = F.row_number().over(Window.partitionBy("part", "t").orderBy("lb", "id"))
        try:
            got = (partial.withColumn("r", rank).where(F.col("r") <= keep).drop("r")
                   .toArrow())
        finally:
            release(held)
        groups = _candidate_groups(got)
        left = []
        for part in todo:
            if _settle(part, rows[part], chosen, groups, k, rounds, keep):
                left.append(part)
        todo = left
    flat = [(p, i, v) for p in sorted(rows) for i, v in rows[p]]
    return Seeding(Centres.from_rows(flat), sorted(chosen, key=lambda c: (c[1], c[0])), passes)


def _settle(part: int, rows: list, chosen: list, groups: dict, k: int, rounds: int,
            keep: int) -> bool:
    """Take a part's proven draws of one pass; True if it needs another pass."""
    new: list = []
    for t in range(rounds):
        cid = len(rows)
        if cid >= k:
            return False
        group = groups.get((part, t))
        if group is None:  # no candidate: every point coincides with a centre (C16)
            return False
        lb, ids, e, w, d, X = group
        if t == 0:  # exact keys
            j = 0
        else:
            full = len(ids) == keep
            threshold, n = (lb[-1], keep - 1) if full else (np.inf, len(ids))
            dn, _ = nearest(X[:n], np.zeros(n, dtype=np.int64),
                            [{0: (np.arange(len(new)), np.vstack(new))}])
            wd = w[:n] * np.minimum(d[:n], dn)
            ok = (wd > 0) & np.isfinite(wd)
            if not ok.any():
                return full
            key = np.full(n, np.inf)
            key[ok] = e[:n][ok] / wd[ok]
            j = np.lexsort((ids[:n], key))[0]
            if key[j] >= threshold:
                return True
        new.append(X[j])
        rows.append((cid, X[j]))
        chosen.append((part, cid, int(ids[j])))
    return len(rows) < k


def _candidate_groups(table) -> dict:
    """``{(part, t): (lb, id, e, w, d, X)}`` sorted by (lb, id): one sort, then slices."""
    if table.num_rows == 0:
        return {}
    part, t, lb, ids, e, w, d = (table.column(c).to_numpy()
                                 for c in ("part", "t", "lb", "id", "e", "w", "d"))
    X = vector_matrix(table.column("v"))
    order = np.lexsort((ids, lb, t, part))
    part, t, lb, ids, e, w, d, X = (a[order] for a in (part, t, lb, ids, e, w, d, X))
    starts = np.flatnonzero(np.concatenate(([True], (np.diff(part) != 0) | (np.diff(t) != 0))))
    out = {}
    for a, b in zip(starts, np.concatenate((starts[1:], [len(part)]))):
        out[(int(part[a]), int(t[a]))] = tuple(x[a:b] for x in (lb, ids, e, w, d, X))
    return out


def lloyd(pts: DataFrame, centres: Centres, iters: int, use_part: bool = True) -> Centres:
    """``iters`` Lloyd steps (KM2): one job each, O(L*k*d) rows collected."""
    check_params(1, 1, iters)
    src = pts if use_part else pts.withColumn("part", F.lit(0))
    for _ in range(iters):
        centres = _moved(cluster_stats(src, centres, use_part=True))
    return centres


def _moved(stats: dict) -> Centres:
    """The weighted means of the non-empty clusters, ids renumbered densely per part."""
    rows, count = [], {}
    for (part, _), (_, sw, _, swv) in sorted(stats.items()):
        if sw > 0:
            rows.append((part, count.get(part, 0), swv / sw))
            count[part] = count.get(part, 0) + 1
    return Centres.from_rows(rows)


def centre_weights(pts: DataFrame, centres: Centres, use_part: bool = True) -> dict:
    """``{(part, cid): total weight}`` of the points closest to each centre (AGG14)."""
    src = pts if use_part else pts.withColumn("part", F.lit(0))
    stats = cluster_stats(src, centres, use_part=True)
    return {key: s[1] for key, s in stats.items()}


def weighted_kmedian(points: DataFrame, k: int, iters: int, seed: int = 0, tag: str = "s",
                     prepared: bool = False, persist: bool | str = True,
                     lookahead: int = DEFAULT_LOOKAHEAD,
                     candidates: int = DEFAULT_CANDIDATES) -> Centres:
    """Seeding + Lloyd over one weighted table (KM3, KM7); returns the centres (part 0)."""
    check_params(k, 1, iters)
    pts = points if prepared else prepare_points(points, 1, seed, persist)
    try:
        seeded = seed_centres(pts, k, seed, tag, use_part=False, lookahead=lookahead,
                              candidates=candidates)
        return lloyd(pts, seeded.centres, iters, use_part=False)
    finally:
        if not prepared:
            drop_points(pts)


@dataclass
class KMedianResult:
    centres: Centres
    coreset: list            # (part, cid, v, w)
    n: int
    objective: float | None  # None (NULL) for an empty input (C8)
    timings: dict            # seconds of rounds 1, 2, 3 (MET2)
    k: int
    parts: int
    iters: int
    weight: int = 0          # total weight of the points, equal to the coreset's

    def summary(self, spark: SparkSession) -> DataFrame:
        """One row ``(n, k, parts, iter, objective)`` (SNK2)."""
        return spark.createDataFrame(
            [(self.n, self.k, self.parts, self.iters, self.objective)],
            "n bigint, k int, parts int, iter int, objective double")


def coreset(pts: DataFrame, k: int, iters: int, seed: int,
            lookahead: int = DEFAULT_LOOKAHEAD, candidates: int = DEFAULT_CANDIDATES) -> list:
    """Round 1 (KM4): cluster each part on its own; returns ``(part, cid, v, w)`` rows with
    w > 0.  Sum of w equals the number of points (C19).

    All parts run in lock-step: every seeding pass or Lloyd step is one Spark job over all
    points, so no part is ever held by one task or one group, whatever its size."""
    seeded = seed_centres(pts, k, seed, "s", use_part=True, lookahead=lookahead,
                          candidates=candidates)
    centres = lloyd(pts, seeded.centres, iters, use_part=True)
    weights = centre_weights(pts, centres, use_part=True)
    out = []
    for part, cid, v in centres.rows():
        w = int(round(weights.get((part, cid), 0.0)))
        if w > 0:
            out.append((part, cid, v, w))
    return out


def coreset_frame(spark: SparkSession, rows: list, k: int) -> DataFrame:
    """The coreset as weighted points: ``id = part * k + cid`` is unique and reproducible."""
    part, cid, v, w = zip(*rows) if rows else ((), (), (), ())
    part, cid = np.array(part, dtype=np.int64), np.array(cid, dtype=np.int64)
    table = pa.table({"id": pa.array(part * k + cid, pa.int64()),
                      "v": list_array(np.array(v, dtype=np.float64)),
                      "w": pa.array(w, pa.int64()), "part": pa.array(part, pa.int32()),
                      "cid": pa.array(cid, pa.int32())})
    return spark.createDataFrame(table)


# Largest coreset (vectors and uniforms, 8 bytes each) that one task clusters as a whole.
WHOLE_TABLE_BYTES = 64 << 20


def coreset_merge(spark: SparkSession, rows: list, k: int, iters: int, seed: int,
                  whole_bytes: int = WHOLE_TABLE_BYTES) -> Centres:
    """Round 2 (KM5): cluster the <= k*L weighted coreset centres into k (tags ``m<i>``).

    The table's size is set by the parameters.  Up to ``whole_bytes`` all seeding rounds and
    Lloyd steps run inside one task of one job; a larger one goes through the same passes as a
    table of points.  Draws and steps are the same either way."""
    if not rows:
        return Centres({})
    check_params(k, 1, iters)
    cs = coreset_frame(spark, rows, k).select("id", "v", "w")
    if len(rows) * (len(rows[0][2]) + k) * 8 > whole_bytes:
        return weighted_kmedian(cs, k, iters, seed, tag="m")
    u = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: hashed_uniform(
        seed, F.concat(F.lit("m"), i.cast("string")), F.col("id")))
    got = (cs.withColumn("u", u).coalesce(1)
           .mapInArrow(whole_table_kernel(k, iters), "cid int, v array<double>").collect())
    return Centres.from_rows((0, r.cid, r.v) for r in got)


def coreset_kmedian(points: DataFrame, k: int, parts: int, iters: int, seed: int = 0,
                    persist: bool | str = True, lookahead: int = DEFAULT_LOOKAHEAD,
                    candidates: int = DEFAULT_CANDIDATES,
                    min_partitions: int | None = None, equal: bool = False) -> KMedianResult:
    """3-round k-median (KM6): coreset of each part, merge, objective over all points.

    ``persist`` chooses how the prepared points are kept for their passes
    (``True``/``'memory'``, ``'checkpoint'`` into the shared checkpoint dir, or
    ``False``/``'none'`` to re-read the source each pass); ``lookahead`` and
    ``candidates`` tune the seeding passes of round 1 (``lookahead=0``: one per round).

    Number and weight of the points are metrics of round 3's pass; the coreset's weight must
    equal the points' (C19), or the input changed between the passes."""
    check_params(k, parts, iters)
    spark = points.sparkSession
    pts = prepare_points(points, parts, seed, persist, min_partitions, equal)
    try:
        t0 = time.perf_counter()
        rows = coreset(pts, k, iters, seed, lookahead, candidates)
        t1 = time.perf_counter()
        centres = coreset_merge(spark, rows, k, iters, seed)
        t2 = time.perf_counter()
        n, weight, objective = observed_objective(pts, centres)
        t3 = time.perf_counter()
    finally:
        drop_points(pts)
    # sums of weights are exact in the kernels up to 2**53
    if weight < 1 << 53 and weight != sum(w for _, _, _, w in rows):
        raise RuntimeError("the coreset's weight differs from the points': the input changed "
                           "between two passes")
    return KMedianResult(centres, rows, n, objective,
                         {"round1": t1 - t0, "round2": t2 - t1, "round3": t3 - t2},
                         k, parts, iters, weight)


def centres_long(spark: SparkSession, centres: Centres, with_part: bool = False) -> DataFrame:
    """Centres as ``([part,] cid, pos, x)`` rows (vectors in long form)."""
    data = []
    for part, cid, v in centres.rows():
        for pos, x in enumerate(v, start=1):
            data.append((part, cid, pos, float(x)))
    df = spark.createDataFrame(data, "part int, cid int, pos int, x double")
    return df if with_part else df.drop("part")

