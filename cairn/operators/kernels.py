"""Arrow/numpy kernels run inside ``mapInArrow`` tasks.

This module depends on numpy and pyarrow only.  It is serialised *by value* with the task
closures, so executors need no copy of the package.  The centres come as a list of broadcast
pieces, each a plain ``{part: (cids int32[m] ascending, mat float64[m, d])}`` dict; a part may be
spread over several pieces, in ascending order of the centre ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Elements of the (rows x centres x dim) difference block computed at once in a task.
_BLOCK_ELEMS = 1 << 21

# Pseudo positions of the per-cluster scalars in the long-form partial sums.
POS_COUNT, POS_WEIGHT, POS_WDIST = -3, -2, -1

def vector_matrix(col) -> np.ndarray:
    """An Arrow list<float or double> column as an (n, d) float64 matrix.  NULL vectors, NULL, NaN
    or infinite elements and vectors of unequal length are errors (C23)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if n == 0:
        return np.empty((0, 0), dtype=np.float64)
    if col.null_count:
        raise ValueError("NULL vector in point set")
    lens = pc.list_value_length(col).to_numpy(zero_copy_only=False)
    d = int(lens[0])
    if (lens != d).any():
        raise ValueError("vectors of unequal length in point set")
    items = col.flatten()
    if items.null_count:
        raise ValueError("NULL element in a vector of the point set")
    flat = items.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if not np.isfinite(flat).all():
        raise ValueError("NaN or infinite element in a vector of the point set")
    return flat.reshape(n, d)


def weights(batch: pa.RecordBatch) -> np.ndarray:
    """The weight column as float64; NULL, NaN and negative weights are errors."""
    col = batch.column("w")
    if col.null_count:
        raise ValueError("NULL weight in point set")
    w = col.to_numpy(zero_copy_only=False).astype(np.float64)
    if not (w >= 0).all():
        raise ValueError("negative or NaN weight in point set")
    return w


# 13 hex digits = 52 bits a uniform, as in the SQL form of the draws.
_HEX_DIGITS = 13
_NIBBLE = np.zeros(256, dtype=np.float64)
_NIBBLE[np.frombuffer(b"0123456789abcdef", dtype=np.uint8)] = np.arange(16)
_PLACES = 16.0 ** np.arange(_HEX_DIGITS - 1, -1, -1)


def uniforms(col: pa.Array, rows: np.ndarray, rounds: int) -> np.ndarray:
    """(rows, rounds) uniforms from a column of ``rounds`` * 13 hex digits; every sum is below
    2**52, so the doubles are those of the integer computation."""
    width = rounds * _HEX_DIGITS
    _, offset, data = col.buffers()
    first = np.frombuffer(offset, dtype=np.int32)[col.offset]
    text = np.frombuffer(data, dtype=np.uint8)[first:first + len(col) * width]
    digits = text.reshape(len(col), rounds, _HEX_DIGITS)[rows]
    return (_NIBBLE[digits] @ _PLACES + 0.5) / 4503599627370496.0


def pieces(broadcasts) -> list:
    return [b.value for b in broadcasts]


def list_array(mat: np.ndarray) -> pa.Array:
    n, d = mat.shape if mat.ndim == 2 else (0, 0)
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * d, type=pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(mat.reshape(-1), type=pa.float64()))


def _block_distances(X: np.ndarray, M: np.ndarray):
    """Yield (start, end, dist[r, m]) blocks of Euclidean distances."""
    m, dim = M.shape
    if dim != X.shape[1]:
        raise ValueError("point and centre dimensions differ")
    step = max(1, _BLOCK_ELEMS // max(1, m * max(dim, 1)))
    for s in range(0, X.shape[0], step):
        diff = X[s:s + step, None, :] - M[None, :, :]
        yield s, min(s + step, X.shape[0]), np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))


def _part_groups(parts: np.ndarray):
    """Yield (part, row indices) for each part present in the batch."""
    order = np.argsort(parts, kind="stable")
    sp = parts[order]
    cuts = np.flatnonzero(np.diff(sp)) + 1
    starts = np.concatenate(([0], cuts))
    ends = np.concatenate((cuts, [len(sp)]))
    for s, e in zip(starts, ends):
        yield int(sp[s]), order[s:e]


def nearest(X: np.ndarray, parts: np.ndarray, tables: list):
    """Distance to and id of the closest centre of each row's part (lowest id on ties) over all
    pieces of the centre table.  Rows of a part without centres get (inf, -1)."""
    n = X.shape[0]
    dist = np.full(n, np.inf)
    cid = np.full(n, -1, dtype=np.int32)
    for part, idx in _part_groups(parts):
        entries = [t[part] for t in tables if part in t]
        Xp = X[idx] if entries else None
        for cids, M in entries:
            for s, e, D in _block_distances(Xp, M):
                j = D.argmin(axis=1)
                d, rows = D[np.arange(e - s), j], idx[s:e]
                closer = d < dist[rows]  # pieces hold ascending ids, so ties stay
                dist[rows] = np.where(closer, d, dist[rows])
                cid[rows] = np.where(closer, cids[j], cid[rows])
    return dist, cid


def _batch_parts(batch: pa.RecordBatch, use_part: bool) -> np.ndarray:
    if use_part:
        return batch.column("part").to_numpy(zero_copy_only=False).astype(np.int64)
    return np.zeros(batch.num_rows, dtype=np.int64)


# --------------------------------------------------------------------------- kernels

def _group_sums(parts, cid, w, d, X):
    """Sums per (part, cid): keys, count, sum w, sum w*d, sum w*v."""
    order = np.lexsort((cid, parts))
    gp, gc = parts[order], cid[order]
    new = np.concatenate(([True], (np.diff(gp) != 0) | (np.diff(gc) != 0)))
    starts = np.flatnonzero(new)
    cnt = np.diff(np.concatenate((starts, [len(order)]))).astype(np.float64)
    sw = np.add.reduceat(w[order], starts)
    swd = np.add.reduceat((w * d)[order], starts)
    swv = np.add.reduceat(X[order] * w[order, None], starts, axis=0)
    return gp[starts], gc[starts], cnt, sw, swd, swv


def _merge_sums(acc):
    """Re-reduce a list of partial group sums into one."""
    if len(acc) == 1:
        return acc[0]
    gp = np.concatenate([a[0] for a in acc])
    gc = np.concatenate([a[1] for a in acc])
    order = np.lexsort((gc, gp))
    gp, gc = gp[order], gc[order]
    new = np.concatenate(([True], (np.diff(gp) != 0) | (np.diff(gc) != 0)))
    starts = np.flatnonzero(new)
    out = [gp[starts], gc[starts]]
    for j in range(2, 6):
        vals = np.concatenate([a[j] for a in acc])[order]
        out.append(np.add.reduceat(vals, starts, axis=0))
    return tuple(out)


def stats_kernel(bcs, use_part: bool = True):
    """Per (part, cid) partial sums of count, w, w*d and w*v as long-form rows.

    Sums are kept across all batches of the task and emitted once, so a task sends at most
    (parts x k x (d + 3)) rows to the shuffle whatever its size."""

    def run(batches):
        table = pieces(bcs)
        acc = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            X = vector_matrix(batch.column("v"))
            parts = _batch_parts(batch, use_part)
            w = weights(batch)
            d, cid = nearest(X, parts, table)
            ok = cid >= 0
            if not ok.all():
                X, parts, w, d, cid = X[ok], parts[ok], w[ok], d[ok], cid[ok]
            if len(cid) == 0:
                continue
            acc.append(_group_sums(parts, cid, w, d, X))
            if len(acc) >= 16:
                acc = [_merge_sums(acc)]
        if not acc:
            return
        gp, gc, cnt, sw, swd, swv = _merge_sums(acc)
        g, dim = len(gp), swv.shape[1]
        pos = np.concatenate([np.full(g, POS_COUNT), np.full(g, POS_WEIGHT),
                              np.full(g, POS_WDIST), np.repeat(np.arange(dim), g)])
        val = np.concatenate([cnt, sw, swd, swv.T.reshape(-1)])
        reps = 3 + dim
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.tile(gp, reps).astype(np.int32)),
             pa.array(np.tile(gc, reps).astype(np.int32)),
             pa.array(pos.astype(np.int32)), pa.array(val)],
            names=["part", "cid", "pos", "val"])

    return run


def race_kernel(bcs, use_part: bool = True):
    """Per part, the task's best candidate of the weighted race ``-ln(u)/(w*d)`` (lowest id
    on equal keys); points at distance 0 from a chosen centre (or of weight 0) are not
    candidates."""

    def run(batches):
        table = pieces(bcs)
        best = None  # (parts, keys, ids, vectors) of the current best per part
        for batch in batches:
            if batch.num_rows == 0:
                continue
            X = vector_matrix(batch.column("v"))
            parts = _batch_parts(batch, use_part)
            ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            w = weights(batch)
            u = batch.column("u").to_numpy(zero_copy_only=False)
            d, _ = nearest(X, parts, table)
            wd = w * d
            ok = (wd > 0) & np.isfinite(wd)
            if not ok.any():
                continue
            key = -np.log(u[ok]) / wd[ok]
            p, i, Xo = parts[ok], ids[ok], X[ok]
            if best is not None:
                p = np.concatenate((best[0], p))
                key = np.concatenate((best[1], key))
                i = np.concatenate((best[2], i))
                Xo = np.vstack((best[3], Xo))
            order = np.lexsort((i, key, p))
            sel = order[np.concatenate(([True], np.diff(p[order]) != 0))]
            best = (p[sel], key[sel], i[sel], Xo[sel])
        if best is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(best[0].astype(np.int32)), pa.array(best[1]),
                 pa.array(best[2]), list_array(best[3])],
                names=["part", "key", "id", "v"])

    return run


def rows_kernel(bcs, use_part: bool = True):
    """Per point: ``(id, part, cid, d, w)`` of its closest centre (w passed through)."""

    def run(batches):
        table = pieces(bcs)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            X = vector_matrix(batch.column("v"))
            weights(batch)  # checked, then passed through
            parts = _batch_parts(batch, use_part)
            d, cid = nearest(X, parts, table)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(parts.astype(np.int32)), pa.array(cid),
                 pa.array(d), batch.column("w")], names=["id", "part", "cid", "d", "w"])

    return run


def pairs_kernel(bcs):
    """Per point and centre: ``(id, cid, d)``; k is bounded by the centre table."""

    def run(batches):
        tables = pieces(bcs)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            X = vector_matrix(batch.column("v"))
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            for cids, M in (t[0] for t in tables if 0 in t):
                for s, e, D in _block_distances(X, M):
                    r = e - s
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(ids[s:e], len(cids))),
                         pa.array(np.tile(cids, r)), pa.array(D.reshape(-1))],
                        names=["id", "cid", "d"])

    return run


def objective_kernel(bcs, use_part: bool = False):
    """Per task: number of points, their weight, sum of closest distances and of w * distance."""

    def run(batches):
        table = pieces(bcs)
        n, sw, sd, swd = 0, 0, 0.0, 0.0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            X = vector_matrix(batch.column("v"))
            parts = _batch_parts(batch, use_part)
            w = weights(batch)
            d, _ = nearest(X, parts, table)
            n += batch.num_rows
            sw += pc.sum(batch.column("w")).as_py()
            sd += float(d.sum())
            swd += float((w * d).sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int64()), pa.array([sw], pa.int64()), pa.array([sd]),
             pa.array([swd])], names=["n", "sum_w", "sum_d", "sum_wd"])

    return run


def whole_table_kernel(k: int, iters: int):
    """Seeding and Lloyd steps of one whole weighted table of bounded size, inside one task.

    Batch columns ``id, v, w, u`` with ``u`` the uniforms of rounds 0 .. k-1.  The draws and
    steps are those of the passes over a distributed table: the first centre races on
    ``-ln(u)``, later ones on ``-ln(u) / (w * d)`` over the running minimum ``d``, ties by id;
    a step moves every centre to the weighted mean of its points and drops empty clusters.
    Output rows: ``(cid, v)``."""

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        X = np.vstack([vector_matrix(b.column("v")) for b in held])
        ids = np.concatenate([b.column("id").to_numpy(zero_copy_only=False) for b in held])
        w = np.concatenate([weights(b) for b in held])
        e = -np.log(np.vstack([vector_matrix(b.column("u")) for b in held]))
        zero = np.zeros(len(ids), dtype=np.int64)
        M = np.empty((0, X.shape[1]))
        d = np.full(len(ids), np.inf)
        for i in range(k):
            if i == 0:
                rows, key = np.arange(len(ids)), e[:, 0]
            else:
                d = np.minimum(d, nearest(X, zero, [{0: (np.zeros(1, np.int32), M[-1:])}])[0])
                wd = w * d
                rows = np.flatnonzero((wd > 0) & np.isfinite(wd))
                key = e[rows, i] / wd[rows]
            if len(rows) == 0:
                break
            M = np.vstack((M, X[rows[np.lexsort((ids[rows], key))[0]]]))
        for _ in range(iters):
            near, cid = nearest(X, zero, [{0: (np.arange(len(M), dtype=np.int32), M)}])
            _, _, _, sw, _, swv = _group_sums(zero, cid, w, near, X)
            M = swv[sw > 0] / sw[sw > 0][:, None]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(M), dtype=np.int32)), list_array(M)], names=["cid", "v"])

    return run


def lookahead_kernel(bcs, rounds: int, keep: int):
    """Race of the current seeding round plus lower bounds for the next ones, one pass.

    Batch columns ``id, v, w, part, u`` with ``u`` the digits of the uniforms ``u_t`` of rounds
    ``j + t`` and ``e_t = -ln(u_t)``.  With ``d`` the distance to the closest chosen centre, ``e_t / (w * d)`` is the
    exact race key of round ``j`` (t = 0) and a lower bound of the key of round ``j + t``
    (distances only shrink as centres are added).  Per (part, t) the task keeps the
    ``keep`` rows with the smallest ``(bound, id)``; rows with w * d <= 0 are never
    candidates.  Output rows: ``(part, t, lb, id, e, w, d, v)``."""

    def run(batches):
        table = pieces(bcs)
        best = limit = None  # [part, t, lb, id, e, w, d, X] of the kept rows; their bounds
        for batch in batches:
            if batch.num_rows == 0:
                continue
            X = vector_matrix(batch.column("v"))
            parts = _batch_parts(batch, True)
            ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            w = weights(batch)
            d, _ = nearest(X, parts, table)
            wd = w * d
            rows = np.flatnonzero((wd > 0) & np.isfinite(wd))
            if len(rows) == 0:
                continue
            p, i, wdo = parts[rows], ids[rows], wd[rows]
            us = uniforms(batch.column("u"), rows, rounds)
            picked = []
            for t in range(rounds):  # select on the small key arrays, gather vectors once
                u = us[:, t]
                if best is None:
                    near = np.arange(len(rows))
                else:  # -ln(u) >= 1 - u: most rows cannot pass the kept bounds, without a logarithm
                    near = np.flatnonzero(1.0 - u <= limit[p, t] * wdo * (1 + 1e-9))
                e = -np.log(u[near])
                lb = e / wdo[near]
                sel = _smallest_per_group(p[near], lb, i[near], keep)
                picked.append((np.full(len(sel), t), lb[sel], e[sel], rows[near[sel]]))
            r = np.concatenate([x[3] for x in picked])
            new = [parts[r], np.concatenate([x[0] for x in picked]),
                   np.concatenate([x[1] for x in picked]), ids[r],
                   np.concatenate([x[2] for x in picked]), w[r], d[r], X[r]]
            if best is not None:
                new = [np.concatenate((a, b)) for a, b in zip(best, new)]
            group = new[0].astype(np.int64) * rounds + new[1]
            sel = _smallest_per_group(group, new[2], new[3], keep)
            best = [a[sel] for a in new]
            limit = _kept_limits(best, rounds, keep)
        if best is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(best[0].astype(np.int32)), pa.array(best[1].astype(np.int32)),
                 pa.array(best[2]), pa.array(best[3]), pa.array(best[4]), pa.array(best[5]),
                 pa.array(best[6]), list_array(best[7])],
                names=["part", "t", "lb", "id", "e", "w", "d", "v"])

    return run


def _kept_limits(best: list, rounds: int, keep: int) -> "_Limits":
    """The largest kept bound of every full (part, t) group."""
    group = best[0].astype(np.int64) * rounds + best[1]
    starts = np.flatnonzero(np.concatenate(([True], np.diff(group) != 0)))
    sizes = np.diff(np.concatenate((starts, [len(group)])))
    full = sizes >= keep
    return _Limits(group[starts[full]], np.maximum.reduceat(best[2], starts)[full], rounds)


class _Limits:
    """Bounds by (part, t), infinite where a group is not full."""

    def __init__(self, groups: np.ndarray, bounds: np.ndarray, rounds: int):
        self.groups, self.bounds, self.rounds = groups, bounds, rounds

    def __getitem__(self, at) -> np.ndarray:
        part, t = at
        out = np.full(len(part), np.inf)
        if len(self.groups):
            group = part * self.rounds + t
            j = np.minimum(np.searchsorted(self.groups, group), len(self.groups) - 1)
            held = self.groups[j] == group
            out[held] = self.bounds[j[held]]
        return out


def _smallest_per_group(group: np.ndarray, key: np.ndarray, ids: np.ndarray,
                        keep: int) -> np.ndarray:
    """Indices of the ``keep`` rows with the smallest ``(key, id)`` in each group."""
    order = np.lexsort((ids, key, group))
    g = group[order]
    start = np.concatenate(([True], g[1:] != g[:-1]))
    first = np.maximum.accumulate(np.where(start, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - first < keep]
