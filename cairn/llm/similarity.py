"""Exact Jaccard links inside blocks of hashed sets, as numpy kernels for one task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_COLUMNS = 4096


def pair_overlap(a: np.ndarray, b: np.ndarray) -> int:
    """|a & b| of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a)) if len(b) else 0


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of all |i & j|, from 0/1 blocks of the elements that at least two sets hold."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], column[shared]
    column = np.cumsum(np.concatenate([[0], np.diff(column) > 0])) if len(column) else column
    out = np.zeros((n, n), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, width, _COLUMNS):
        i, j = np.searchsorted(column, [lo, lo + _COLUMNS])
        block = np.zeros((n, _COLUMNS), np.float32)
        block[owner[i:j], column[i:j] - lo] = 1
        out += block @ block.T
    return out.astype(np.int64)


def link_matrix(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix: 100 * |i & j| >= percent * |i | j| for sets that are not empty."""
    size = np.array([len(s) for s in sets], np.int64)
    if len(sets) <= 8:
        inter = np.diag(size)
        for i in range(len(sets)):
            for j in range(i):
                lo, hi = sorted((size[i], size[j]))
                if 100 * lo >= percent * hi:
                    inter[i, j] = inter[j, i] = pair_overlap(sets[i], sets[j])
    else:
        inter = overlaps(sets)
    union = size[:, None] + size[None, :] - inter
    return (100 * inter >= percent * union) & (size[:, None] > 0) & (size[None, :] > 0)


def forest(node: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """(member, least member) pairs that span the components of a link matrix."""
    left, out = np.ones(len(node), bool), []
    for start in np.argsort(node, kind="stable"):
        if not left[start]:
            continue
        reach = np.zeros(len(node), bool)
        reach[start] = True
        edge = reach
        while edge.any():
            grown = linked[edge].any(axis=0) & ~reach
            reach = reach | grown
            edge = grown
        left &= ~reach
        out += [(int(x), int(node[start])) for x in node[reach] if x != node[start]]
    return out


def unit_links(percent: int):
    """mapInArrow kernel: rows (unit, node, items) sorted by unit -> spanning links (a, b) of each
    unit.  A unit holds at most two tiles of a bucket, so its rows fit in memory."""
    def run(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def solve(nodes, sets):
            if len(nodes) < 2:
                return []
            return forest(np.array(nodes, np.int64), link_matrix(sets, percent))

        unit, nodes, sets, out = None, [], [], []
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)) for c in ("unit", "node", "items")]
            for u, node, items in zip(cols[0].to_pylist(), cols[1].to_pylist(), cols[2]):
                if u != unit:
                    out += solve(nodes, sets)
                    unit, nodes, sets = u, [], []
                nodes.append(node)
                sets.append(np.frombuffer(items.as_buffer(), np.uint64))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()),
                                                  pa.array([x[1] for x in out], pa.int64())],
                                                 schema=schema)
                out = []
            sets = [s.copy() for s in sets]  # do not hold the batch
        out = solve(nodes, sets)
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()),
                                          pa.array([x[1] for x in out], pa.int64())],
                                         schema=schema)
    return run
