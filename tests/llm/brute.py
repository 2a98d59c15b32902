"""Plain single-process versions of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k=5):
    w = WORD.findall(fold(text))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_groups(docs, percent=85):
    """docs: list of (doc_id, text) with distinct ids -> {doc_id: (n_shingles, component)}."""
    sets = {d: frozenset(shingles(t)) for d, t in docs}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    links = []
    ids = sorted(sets)
    for i, a in enumerate(ids):
        common = defaultdict(int)
        for x in sets[a]:
            for b in holders[x]:
                if b < a:
                    common[b] += 1
        links += [(a, b) for b, c in common.items()
                  if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c)]
    comp = components(ids, links)
    return {d: (len(sets[d]), comp[d]) for d in ids}


BASE_SECRETS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                          r"([A-Za-z0-9+/_.=-]+)", re.I | re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def secrets(text):
    """Base spans (kind, start, end) by start, then kind as listed."""
    out = [(m.start(), i, m.end()) for i, (_, p, ok) in enumerate(BASE_SECRETS)
           for m in p.finditer(text or "") if ok(m)]
    return [(BASE_SECRETS[i][0], a, b) for a, i, b in sorted(out)]


def secrets_digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def exact_groups(docs):
    """docs: list of (doc_id, text) -> list of (doc_id, keep_id, group_size, kept, sha256)."""
    groups = defaultdict(list)
    for d, t in docs:
        body = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        groups[hashlib.sha256(body.encode()).hexdigest()].append((d, len(t or "")))
    out = []
    for sha, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        out += [(d, keep, len(members), d == keep, sha) for d, _ in members]
    return out


def mix_targets(sizes, weights=(5, 2, 1), cap=3):
    """sizes: {source: words} -> {source: target}, by sharing out again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), {}, set(names)
    while open_:
        rest = total - sum(target.values())
        share = sum(weight[s] for s in open_)
        above = {s for s in open_ if rest * weight[s] / share > cap * sizes[s]}
        if not above:
            target.update({s: rest * weight[s] / share for s in open_})
            break
        target.update({s: float(cap * sizes[s]) for s in above})
        open_ -= above
    return target


def mix_copies(rows, rates, seed=17):
    """rows: [(doc_id, source, size)], rates: {source: rate} -> copies of each row: along the sizes of
    a source as many extra copies as the running count times the fraction, the least hashes first."""
    def uniform(tag, key):
        return (int(hashlib.md5(f"{seed}:{tag}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / 2.0 ** 52

    held = defaultdict(list)
    u = [uniform("mix", "null" if d is None else d) for d, _, _ in rows]
    for (_, source, size), x in zip(rows, u):
        held[source, size].append(x)
    limit, below = {}, defaultdict(int)
    for source, size in sorted(held, key=lambda c: c[1]):
        xs, part = sorted(held[source, size]), rates[source] % 1
        start = uniform("mix-start", source or "")
        k = int((below[source] + len(xs)) * part + start) - int(below[source] * part + start)
        below[source] += len(xs)
        limit[source, size] = xs[k - 1] if k else -1.0
    return [int(rates[s]) + (x <= limit[s, n]) for (_, s, n), x in zip(rows, u)]


def topk(vectors, k, every=100):
    """vectors: list of (id, list) -> {query: [(score, id), ...]}."""
    ok = {}
    for i, v in vectors:
        if i is not None and v and all(x is not None and abs(x) < float("inf") for x in v):
            ok[i] = [int(1024 * x // 1) for x in v]
    out = {}
    for q in ok:
        if q % every == 0:
            s = [(-sum(a * b for a, b in zip(ok[q], ok[c])), c) for c in ok
                 if c != q and len(ok[c]) == len(ok[q])]
            out[q] = [(-x, c) for x, c in sorted(s)[:k]]
    return out


def segmentations(text, pieces):
    """All ways to write ``text`` (bytes) as pieces, as tuples of indices."""
    if not text:
        yield ()
    for i, p in enumerate(pieces):
        if p and text.startswith(p):
            for rest in segmentations(text[len(p):], pieces):
                yield (i, *rest)
