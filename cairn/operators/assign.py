"""Closest-centre assignment and the aggregates built on it (PRJ6, PRJ7, JN1, TOP3,
AGG13-AGG17).

Points are rows ``(id bigint, v array<double>, w bigint[, part int])``.  Centres are a small
table ``(part, cid, v)``: at most k centres for each of L parts, a size fixed by the
parameters and not by the data.  It is collected to the driver and shipped to the tasks as
broadcast variables of at most ``cairn.maxCentreBytes`` each: a larger table is cut by part and,
inside a part, by centre id, and the kernels keep the smallest (distance, id) over the pieces.

The hot loop is an Arrow kernel (``mapInArrow`` + numpy): one batch of points against the
centres of their part, distances computed as ``sqrt(sum((x - c)^2))`` (no expansion, so the
values agree with a plain SQL evaluation to the last few bits).  Ties go to the lowest centre
id (C15).  The kernel pre-aggregates per batch wherever the caller only needs an aggregate, so
only O(L*k*d) rows per task reach the shuffle.  ``closest_center_sql`` is the same assignment
written with Spark SQL higher-order functions only, used to cross-check the kernel.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F

from cairn.functions.vectors import checked_vector, euclidean
from cairn.operators import kernels
from cairn.operators.kernels import (POS_COUNT, POS_WDIST, POS_WEIGHT, objective_kernel,
                                     pairs_kernel, rows_kernel, stats_kernel)

# Ship the kernels with the task closures instead of requiring the package on executors.
cloudpickle.register_pickle_by_value(kernels)

# Default size of one broadcast piece of the centre table.
DEFAULT_MAX_CENTRE_BYTES = 256 << 20
STATS_SCHEMA = "part int, cid int, pos int, val double"
RACE_SCHEMA = "part int, key double, id bigint, v array<double>"
ROWS_SCHEMA = "id bigint, part int, cid int, d double, w bigint"
PAIRS_SCHEMA = "id bigint, cid int, d double"
OBJECTIVE_SCHEMA = "n bigint, sum_w bigint, sum_d double, sum_wd double"


def max_centre_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get("cairn.maxCentreBytes", str(DEFAULT_MAX_CENTRE_BYTES)))


@dataclass
class Centres:
    """Centres per part on the driver: ``{part: (cids int32[m] ascending, mat float64[m, d])}``."""

    by_part: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    @property
    def nbytes(self) -> int:
        return sum(c.nbytes + m.nbytes for c, m in self.by_part.values())

    @property
    def size(self) -> int:
        return sum(len(c) for c, _ in self.by_part.values())

    def parts(self) -> list[int]:
        return sorted(self.by_part)

    @classmethod
    def from_rows(cls, rows) -> "Centres":
        """From an iterable of ``(part, cid, vector)``."""
        acc: dict[int, list] = {}
        for part, cid, v in rows:
            acc.setdefault(int(part), []).append((int(cid), np.asarray(v, dtype=np.float64)))
        out = {}
        for part, items in acc.items():
            items.sort(key=lambda t: t[0])
            out[part] = (np.array([c for c, _ in items], dtype=np.int32),
                         np.vstack([v for _, v in items]))
            if not np.isfinite(out[part][1]).all():
                raise ValueError("NULL, NaN or infinite element in a centre")
        return cls(out)

    @classmethod
    def collect(cls, df: DataFrame, part_col: str | None = "part", cid_col: str = "cid",
                v_col: str = "v") -> "Centres":
        """Collect a centre DataFrame (its size is the caller's parameter, not the data's)."""
        part = F.col(part_col) if part_col else F.lit(0)
        rows = df.select(part.alias("part"), F.col(cid_col).alias("cid"),
                         F.col(v_col).alias("v")).collect()
        return cls.from_rows((r.part, r.cid, r.v) for r in rows)

    def rows(self):
        for part in self.parts():
            cids, mat = self.by_part[part]
            for c, v in zip(cids, mat):
                yield int(part), int(c), [float(x) for x in v]

    def chunks(self, max_bytes: int) -> list["Centres"]:
        """Pieces of at most ``max_bytes`` each (one centre at least), cut by part and, where a
        part is larger, by centre id in ascending order."""
        out, cur, size = [], {}, 0
        for part in self.parts():
            c, m = self.by_part[part]
            each = max(1, (c.nbytes + m.nbytes) // max(1, len(c)))
            step = max(1, max_bytes // each)
            for lo in range(0, len(c), step):
                piece = (c[lo:lo + step], m[lo:lo + step])
                b = piece[0].nbytes + piece[1].nbytes
                if cur and (size + b > max_bytes or part in cur):
                    out.append(Centres(cur))
                    cur, size = {}, 0
                cur[part] = piece
                size += b
        if cur or not out:
            out.append(Centres(cur))
        return out


# --------------------------------------------------------------------------- Spark side

def _with_part(points: DataFrame, use_part: bool, extra: dict) -> DataFrame:
    cols = ["id", "v", "w"] + (["part"] if use_part else [])
    pts = points
    if "w" not in points.columns:
        pts = pts.withColumn("w", F.lit(1).cast("bigint"))
    return pts.select(*cols, *[c.alias(name) for name, c in extra.items()])


def apply_kernel(points: DataFrame, centres: Centres, factory, schema: str,
                 use_part: bool = True, extra: dict | None = None,
                 broadcasts: list | None = None) -> DataFrame:
    """Run ``factory(broadcasts)`` over the points with the centres broadcast.

    ``factory`` gets the list of broadcast pieces of the centre table.  Callers that execute the
    result eagerly pass ``broadcasts`` to collect the handles and destroy them afterwards
    (``release``); the pieces of a lazy result live as long as its plan.
    """
    spark = points.sparkSession
    pts = _with_part(points, use_part, extra or {})
    bcs = [spark.sparkContext.broadcast(c.by_part) for c in centres.chunks(max_centre_bytes(spark))]
    if broadcasts is not None:
        broadcasts += bcs
    return pts.mapInArrow(factory(bcs), schema)


def release(broadcasts: list) -> None:
    """Drop finished broadcasts on the executors and the driver."""
    for bc in broadcasts:
        bc.destroy()
    broadcasts.clear()


def cluster_stats(points: DataFrame, centres: Centres, use_part: bool = True) -> dict:
    """``{(part, cid): (count, sum_w, sum_wd, sum_wv[d])}`` after assignment (one job).

    The merged partial sums (at most L*k*(d+3) numbers, set by the parameters) come back as
    one Arrow table, not as Python rows."""
    held: list = []
    partial = apply_kernel(points, centres, stats_kernel, STATS_SCHEMA, use_part,
                           broadcasts=held)
    try:
        table = (partial.groupBy("part", "cid", "pos").agg(F.sum("val").alias("val"))
                 .toArrow())
    finally:
        release(held)
    if table.num_rows == 0:
        return {}
    part = table.column("part").to_numpy()
    cid = table.column("cid").to_numpy()
    pos = table.column("pos").to_numpy()
    val = table.column("val").to_numpy()
    order = np.lexsort((pos, cid, part))
    part, cid, pos, val = part[order], cid[order], pos[order], val[order]
    starts = np.flatnonzero(np.concatenate(
        ([True], (np.diff(part) != 0) | (np.diff(cid) != 0))))
    ends = np.concatenate((starts[1:], [len(part)]))
    out = {}
    for s_, e_ in zip(starts, ends):
        m = dict(zip(pos[s_:e_].tolist(), val[s_:e_]))
        dim = int(pos[e_ - 1]) + 1 if pos[e_ - 1] >= 0 else 0
        vec = val[e_ - dim:e_] if dim else np.zeros(0)
        out[(int(part[s_]), int(cid[s_]))] = (int(round(m[POS_COUNT])), float(m[POS_WEIGHT]),
                                              float(m[POS_WDIST]), np.array(vec))
    return out


def centres_of(centres_df: DataFrame, part_col: str | None = None) -> Centres:
    return Centres.collect(centres_df, part_col=part_col)


def pairwise_distance(points: DataFrame, centres_df: DataFrame) -> DataFrame:
    """Distance of every point to each of the (few) centres: ``(id, cid, d)`` (PRJ6)."""
    c = centres_of(centres_df)
    return apply_kernel(points, c, pairs_kernel, PAIRS_SCHEMA, use_part=False)


def closest_center(points: DataFrame, centres_df: DataFrame, keep_weight: bool = False) -> DataFrame:
    """``(id, cid, d[, w])``: the closest centre of every point, lowest cid on ties (JN1, TOP3).
    ``keep_weight`` passes the point's weight through, so no join back is needed."""
    c = centres_of(centres_df)
    cols = ["id", "cid", "d"] + (["w"] if keep_weight else [])
    return (apply_kernel(points, c, lambda b: rows_kernel(b, False), ROWS_SCHEMA,
                         use_part=False).select(*cols))


def closest_center_sql(points: DataFrame, centres_df: DataFrame) -> DataFrame:
    """The same assignment in Spark SQL only: the centres become a literal array and each
    row takes ``array_min`` of (distance, cid) structs.  Slow for large k*d; for checks."""
    c = centres_of(centres_df)
    cids, M = c.by_part[0]
    lit = F.array(*[F.struct(F.lit(int(i)).alias("cid"),
                             F.array(*[F.lit(float(x)) for x in row]).alias("cv"))
                    for i, row in zip(cids, M)])
    v = checked_vector("v", M.shape[1])
    best = F.array_min(F.transform(lit, lambda s: F.struct(
        euclidean(v, s["cv"]).alias("d"), s["cid"].alias("cid"))))
    return points.select("id", best.alias("b")).select(
        "id", F.col("b.cid").alias("cid"), F.col("b.d").alias("d"))


def cluster_members(points: DataFrame, centres_df: DataFrame) -> DataFrame:
    """Membership rows ``(cid, id)`` (AGG13).  Kept as rows: a cluster may hold a third of
    all points, so it is never gathered into one list."""
    return closest_center(points, centres_df).select("cid", "id")


def cluster_weights(points: DataFrame, centres_df: DataFrame) -> DataFrame:
    """``(cid, w)``: total weight of the points closest to each centre, 0 for none (AGG14).

    The per-task partial sums are merged by a tiny aggregate and joined to the centre ids, which
    are on the driver already, so that empty clusters appear with 0."""
    c = centres_of(centres_df)
    partial = apply_kernel(points, c, lambda b: stats_kernel(b, False), STATS_SCHEMA,
                           use_part=False)
    sums = (partial.where(F.col("pos") == POS_WEIGHT).groupBy("cid")
            .agg(F.sum("val").alias("sw")))
    ids = points.sparkSession.createDataFrame([(cid,) for _, cid, _ in c.rows()], "cid int")
    return (ids.join(sums, "cid", "left")
            .select("cid", F.coalesce(F.col("sw"), F.lit(0.0)).cast("bigint").alias("w")))


def weighted_centroids(points: DataFrame, centres_df: DataFrame) -> DataFrame:
    """Weighted mean of each non-empty cluster, ``(cid, pos, x)`` long form (AGG15, PRJ7).

    Partial sums of w*v per batch are exploded by coordinate and summed; empty clusters
    produce no rows."""
    c = centres_of(centres_df)
    partial = apply_kernel(points, c, lambda b: stats_kernel(b, False), STATS_SCHEMA,
                           use_part=False)
    sums = partial.where((F.col("pos") >= 0) | (F.col("pos") == POS_WEIGHT)) \
        .groupBy("cid", "pos").agg(F.sum("val").alias("val"))
    # the cluster weight is a row of the same (k * (d + 1)-row) aggregate: one scan
    sw = F.max(F.when(F.col("pos") == POS_WEIGHT, F.col("val"))).over(Window.partitionBy("cid"))
    return (sums.withColumn("sw", sw)
            .where((F.col("pos") >= 0) & (F.col("sw") > 0))
            .select("cid", "pos", (F.col("val") / F.col("sw")).alias("x")))


def kmedian_objective(points: DataFrame, centres_df: DataFrame | Centres) -> DataFrame:
    """``(n, objective)``: mean distance of the points to their closest centre (AGG16)."""
    c = centres_df if isinstance(centres_df, Centres) else centres_of(centres_df)
    part = apply_kernel(points, c, lambda b: objective_kernel(b, False), OBJECTIVE_SCHEMA,
                        use_part=False)
    return part.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                    F.try_divide(F.sum("sum_d"), F.sum("n")).alias("objective"))


def observed_objective(points: DataFrame, centres: Centres) -> tuple[int, int, float | None]:
    """``(n, total weight, objective)`` of one pass over the points, taken as observed metrics: the
    tasks' partial sums ride on their results, so there is no aggregate after the pass.  The pass
    is a single stage, whose tasks each count once however often they are tried."""
    held: list = []
    partial = apply_kernel(points, centres, lambda b: objective_kernel(b, False), OBJECTIVE_SCHEMA,
                           use_part=False, broadcasts=held)
    seen = Observation()
    try:
        (partial.observe(seen, F.sum("n").alias("n"), F.sum("sum_w").alias("w"),
                         F.sum("sum_d").alias("d"))
         .write.format("noop").mode("overwrite").save())
    finally:
        release(held)
    got = seen.get
    n = int(got["n"] or 0)
    return n, int(got["w"] or 0), got["d"] / n if n else None


def weighted_distance_total(points: DataFrame, centres_df: DataFrame) -> DataFrame:
    """``(total)``: sum of w * closest distance, the normaliser of a weighted draw (AGG17)."""
    c = centres_of(centres_df)
    part = apply_kernel(points, c, lambda b: objective_kernel(b, False), OBJECTIVE_SCHEMA,
                        use_part=False)
    return part.agg(F.sum("sum_wd").alias("total"))
