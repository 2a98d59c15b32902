"""SentencePiece segmentations sampled without replacement by perturbed A* search.

The pieces of a public vocabulary span a lattice over a text; a segmentation is a path and has the
product of its pieces' probabilities, normalised over all paths.  Perturbing the log probabilities
with Gumbel noise and taking the k largest draws k distinct segmentations without replacement.  The
search never lists paths: a subset of paths (a common prefix and some edges excluded behind it) has
a known total mass, and the largest perturbed value in it is one Gumbel draw at the log of that
mass, truncated by the value of the subset it was split from.  The agenda pops the subset of the
largest value; its best path is an ancestral sample behind the prefix, whose nodes split the rest of
the subset into new ones.  After k pops the best value left is the threshold kappa, and a path of
log probability phi was included with probability 1 - exp(-exp(phi - kappa)).

Text.  A space is put before a text that is not empty and taken off when decoding; spaces stand for
the vocabulary's space mark.  Characters that are no piece of their own (the space mark itself too)
become byte pieces, so decoding returns the exact text.  The vocabulary file has merge ranks instead
of probabilities; a piece of rank r gets the weight (r + ``RANK_OFFSET``) ** -``alpha``.

No piece has a space behind another character or a line feed beside one, so the lattice of a text is
the chain of its units (spaces and what follows), and the sums over paths are computed once per
distinct unit of a chunk, all units in step.  Draws are hashes of the row's key, the sample and the
byte position: reruns and any partitioning give the same samples.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cairn.llm import storage
from cairn.llm.arrow_text import SpanHasher, chunks, hash_spans, mix, uniform

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
RANK_OFFSET, ALPHA = 10.0, 1.0
SAMPLES, SEED = 2, 11
CHUNK_BYTES = 1 << 18
ROOM = 1 << 20  # byte positions of distinct units that a task keeps, about 50 MB with their edges
_STEP, _ROUND = np.uint64(0x9E3779B97F4A7C15), 0xD6E8FEB86659FD93
_ROOT, _WALK, _SPLIT, _TURN = 0, 1, 2, 3  # what a draw is for


@dataclass
class Vocabulary:
    """``pieces[id]`` as bytes with spaces (None: not in the lattice), ``logp[id]``, ``byte_id``."""
    pieces: list
    logp: np.ndarray
    byte_id: np.ndarray

    def __post_init__(self):
        data = b"".join(p or b"" for p in self.pieces)
        self.flat = np.frombuffer(data, np.uint8)
        self.length = np.array([len(p or b"") for p in self.pieces], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        # The trie of the pieces as an open hash table of prefix hashes.
        nodes: dict[bytes, int] = {}
        for i, p in enumerate(self.pieces):
            if p and not (len(p) == 1 and self.byte_id[p[0]] == i):
                for n in range(1, len(p)):
                    nodes.setdefault(p[:n], -1)
                nodes[p] = i
        keys = list(nodes)
        raw = np.frombuffer(b"".join(keys), np.uint8)
        end = np.cumsum([len(k) for k in keys])
        start = end - np.array([len(k) for k in keys])
        hashes = np.concatenate([hash_spans(raw[start[lo]:end[min(lo + 4096, len(keys)) - 1]],
                                            start[lo:lo + 4096] - start[lo],
                                            end[lo:lo + 4096] - start[lo])
                                 for lo in range(0, len(keys), 4096)])
        bits = int(4 * len(keys)).bit_length()
        self.mask = np.uint64((1 << bits) - 1)
        self.slot_key = np.zeros(1 << bits, np.uint64)
        self.slot_piece = np.full(1 << bits, -2, np.int32)  # -2: empty
        for h, piece in zip(hashes.tolist(), nodes.values()):
            at = h & int(self.mask)
            while self.slot_piece[at] != -2:
                at = (at + 1) & int(self.mask)
            self.slot_key[at], self.slot_piece[at] = h, piece
        self.longest = max(map(len, keys))

    def find(self, h: np.ndarray) -> np.ndarray:
        """For each hash the piece id, -1 for a prefix of pieces only, -2 for neither."""
        at = (h & self.mask).astype(np.int64)
        out = self.slot_piece[at]
        todo = np.flatnonzero((out != -2) & (self.slot_key[at] != h))
        while len(todo):
            at[todo] = (at[todo] + 1) & int(self.mask)
            out[todo] = self.slot_piece[at[todo]]
            todo = todo[(out[todo] != -2) & (self.slot_key[at[todo]] != h[todo])]
        return out


def load_vocabulary(path: str = MODEL_PATH, alpha: float = ALPHA) -> Vocabulary:
    """Read a SentencePiece model file (on the driver)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces, rank, byte_id = [None] * n, np.full(n, float(n)), np.full(256, -1)
    for i in range(n):
        name = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte = int(name[3:5], 16)
            byte_id[byte], pieces[i] = i, bytes([byte])
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            p = name.replace("▁", " ").encode()
            if b" " not in p.lstrip(b" ") and (p == b"\n" or b"\n" not in p):
                pieces[i], rank[i] = p, max(0.0, -sp.get_score(i))
    if (byte_id < 0).any():
        raise ValueError("the vocabulary has no byte pieces")
    logp = -alpha * np.log(rank + RANK_OFFSET)
    return Vocabulary(pieces, logp, byte_id)


def vocabulary_of(pieces: list[bytes | None], logp: list[float]) -> Vocabulary:
    """A vocabulary of given pieces (spaces as spaces) with the 256 byte pieces behind them."""
    n = len(pieces)
    return Vocabulary(list(pieces) + [bytes([b]) for b in range(256)],
                      np.concatenate([np.asarray(logp, float), np.full(256, min(logp) - 2.0)]),
                      np.arange(n, n + 256))


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for every (start, length), one after the other."""
    total = int(length.sum())
    lead = np.concatenate([[0], np.cumsum(length)])[:-1]
    return np.arange(total) + np.repeat(start - lead, length)


class Lattice:
    """The edges of distinct units, kept by a task from chunk to chunk.

    Units are laid out one after the other; per byte position there are its first edge and their
    number, per edge its target position, piece, log probability given the position (summed over all
    ways to go on) and the running sum of probabilities.  Up to ``room`` positions are kept; beyond,
    units last for one chunk, so a task's memory is bounded."""

    def __init__(self, v: Vocabulary, room: int = ROOM):
        self.v, self.room = v, room
        self.hashes, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.n = {"unit": 0, "pos": 0, "edge": 0}
        self.kept = dict(self.n)
        self.kind = {"unit_start": "unit", "unit_end": "unit", "first": "pos", "degree": "pos",
                     "target": "edge", "piece": "edge", "logq": "edge", "upto": "edge"}
        types = {"degree": np.uint8, "logq": np.float64, "upto": np.float32}
        for name in self.kind:
            setattr(self, name, np.zeros(1 << 12, types.get(name, np.int32)))

    def _append(self, kind: str, **arrays):
        at = self.n[kind]
        size = len(next(iter(arrays.values())))
        for name, x in arrays.items():
            have = getattr(self, name)
            if at + size > len(have):
                grown = np.zeros(max(at + size, 2 * len(have)), have.dtype)
                grown[:at] = have[:at]
                setattr(self, name, have := grown)
            have[at:at + size] = x
        self.n[kind] = at + size

    def units(self, text: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, unit number) of the units of the texts, new ones added."""
        self.n = dict(self.kept)
        n = len(text)
        cut = np.zeros(n + 1, bool)
        space, feed = text == 32, text == 10
        cut[1:n] = (space[1:] & ~space[:-1]) | feed[1:] | feed[:-1]
        cut[bounds[:-1]] = True
        begin = np.flatnonzero(cut[:n])
        end = np.concatenate([begin[1:], [n]])
        h, pick, which = np.unique(hash_spans(text, begin, end), return_index=True,
                                   return_inverse=True)
        at = np.searchsorted(self.hashes, h)
        known = np.zeros(len(h), bool)
        if len(self.hashes):
            known = self.hashes[np.minimum(at, len(self.hashes) - 1)] == h
        number = np.empty(len(h), np.int64)
        number[known] = self.ids[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            number[new] = self.n["unit"] + np.arange(len(new))
            length = (end - begin)[pick[new]]
            self._build(text[_ranges(begin[pick[new]], length)], length)
            if self.n["pos"] <= self.room:
                self.kept = dict(self.n)
                self.hashes = np.insert(self.hashes, at[new], h[new])
                self.ids = np.insert(self.ids, at[new], number[new])
        return begin, number[which]

    def _build(self, data: np.ndarray, length: np.ndarray) -> None:
        """Add the units whose bytes are laid end to end in ``data``."""
        v, m = self.v, len(data)
        unit_end = np.cumsum(length)
        stop = np.repeat(unit_end, length)
        source, size, piece = [], [], []
        at = np.flatnonzero((data & 0xC0) != 0x80)
        lead = data[at]
        wide = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        width = np.zeros(m, np.int64)
        width[at] = np.minimum(wide, stop[at] - at)
        whole = np.zeros(m, bool)
        hasher = SpanHasher(data)
        for k in range(1, v.longest + 1):
            at = at[at + k <= stop[at]]
            found = v.find(hasher(at, at + k))
            hit = found >= 0
            source.append(at[hit])
            size.append(k)
            piece.append(found[hit])
            whole[at[hit & (width[at] == k)]] = True
            at = at[found != -2]
            if not len(at):
                break
        bare = np.flatnonzero((width > 0) & ~whole)
        raw = _ranges(bare, width[bare])
        if width.sum() < m:  # bytes outside any character
            inside = np.zeros(m, bool)
            inside[_ranges(np.flatnonzero(width), width[width > 0])] = True
            raw = np.concatenate([raw, np.flatnonzero(~inside)])
        source.append(raw)
        size.append(1)
        piece.append(v.byte_id[data[raw]])
        # Edges by position, positions by their distance to the end of the unit.
        degree = np.zeros(m, np.int64)
        for s in source:
            degree[s] += 1
        far = stop - np.arange(m)
        order = np.argsort(np.minimum(far, 65535).astype(np.uint16), kind="stable")
        if far.max() >= 65535:
            order = order[np.argsort(far[order], kind="stable")]
        order = order[degree[order] > 0]
        deg = degree[order]
        open_at = np.cumsum(deg) - deg
        first = np.zeros(m, np.int64)
        first[order] = open_at
        total = int(deg.sum())
        target, of_piece = np.empty(total, np.int64), np.empty(total, np.int64)
        fill = first.copy()
        for s, k, p in reversed(list(zip(source, size, piece))):  # long, likely pieces first
            e = fill[s]
            target[e], of_piece[e] = s + k, p
            fill[s] += 1
        # Log of the summed probability of all ways from a position to the end of its unit.
        score = v.logp[of_piece]
        beta = np.zeros(m + 1)
        distance = far[order]
        final = target == np.repeat(stop[order], deg)
        step = np.flatnonzero(np.diff(distance, prepend=-1))
        for a, b in zip(step, np.concatenate([step[1:], [len(order)]])):
            lo, hi = open_at[a], open_at[b - 1] + deg[b - 1]
            score[lo:hi] += np.where(final[lo:hi], 0.0, beta[target[lo:hi]])
            beta[order[a:b]] = np.logaddexp.reduceat(score[lo:hi], open_at[a:b] - lo)
        logq = np.minimum(score - np.repeat(beta[order], deg), 0.0)
        q = np.exp(logq)
        running = np.cumsum(q)
        upto = running - np.repeat(running[open_at] - q[open_at], deg)
        upto[open_at + deg - 1] = np.inf
        pos, edge = self.n["pos"], self.n["edge"]
        self._append("edge", target=target + pos, piece=of_piece, logq=logq, upto=upto)
        self._append("pos", first=first + edge, degree=degree)
        self._append("unit", unit_start=unit_end - length + pos, unit_end=unit_end + pos)

    def walk(self, unit: np.ndarray, at: np.ndarray, key: np.ndarray, shift: np.ndarray):
        """Ancestral samples from positions ``at`` to the ends of their units: (edges, places,
        bounds), a place being ``shift`` + position, the byte position in the text."""
        count = np.zeros(len(at), np.int64)
        live, steps = np.arange(len(at)), []
        end = self.unit_end[unit]
        while len(live):
            place = shift[live] + at
            u = _draw(key[live], place, _WALK).astype(np.float32)
            e = self.first[at]
            more = np.flatnonzero(u > self.upto[e])
            while len(more):
                beyond = e[more] + 1
                e[more] = beyond
                more = more[u[more] > self.upto[beyond]]
            steps.append((live, e, place))
            count[live] += 1
            at = self.target[e]
            go = at < end[live]
            live, at = live[go], at[go]
        bounds = np.concatenate([[0], np.cumsum(count)])
        edges, places = np.empty(bounds[-1], np.int32), np.empty(bounds[-1], np.int64)
        for i, (rows, e, place) in enumerate(steps):
            to = bounds[rows] + i
            edges[to], places[to] = e, place
        return edges, places, bounds


def _draw(key: np.ndarray, position: np.ndarray, purpose: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return uniform(mix(key + (position.astype(np.uint64) * np.uint64(4) + np.uint64(purpose))
                           * _STEP))


def _truncated(mass: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel draws at location ``mass``, not above ``top``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return -np.logaddexp(-top, np.log(-np.log(u)) - mass)


def _log_rest(q: np.ndarray) -> np.ndarray:
    """log(1 - q), minus infinity if nothing but rounding is left."""
    with np.errstate(divide="ignore"):
        return np.where(q < 1 - 1e-12, np.log1p(-np.minimum(q, 1 - 1e-13)), -np.inf)


def sample_chunk(lat: Lattice, text: np.ndarray, bounds: np.ndarray, key: np.ndarray, k: int):
    """``k`` segmentations without replacement of each text ``text[bounds[i]:bounds[i+1]]`` (none
    empty).  Returns per sample (texts, pieces, piece bounds, log probability, log inclusion);
    a text with fewer segmentations is missing from the later samples."""
    begin, unit_at = lat.units(text, bounds)
    docs = len(bounds) - 1
    unit_doc = np.searchsorted(bounds, begin, "right") - 1
    lo = np.searchsorted(begin, bounds[:-1])
    hi = np.concatenate([lo[1:], [len(begin)]])
    shift = begin - bounds[unit_doc] - lat.unit_start[unit_at]

    def keyed(i):
        return mix(key ^ np.uint64(i * _ROUND & 0xFFFFFFFFFFFFFFFF))

    # The agenda: per text at most k + 1 subsets, the best first: value, path, node, exclusions.
    width = k + 1
    value = np.full((docs, width), -np.inf)
    path_of, node = np.zeros((docs, width), np.int64), np.zeros((docs, width), np.int64)
    out_edges = np.full((docs, width, k + 1), -1)
    with np.errstate(divide="ignore"):
        value[:, 0] = -np.log(-np.log(_draw(keyed(0), np.zeros(docs, np.int64), _ROOT)))
    node[:, 0] = -1  # the whole lattice
    paths, results = [], []
    for i in range(k):
        here = np.flatnonzero(value[:, 0] > -np.inf)
        if not len(here):
            break
        top, ki = value[here, 0], keyed(i)
        if i == 0:
            units = np.arange(len(begin))
            edges, places, b = lat.walk(unit_at, lat.unit_start[unit_at], ki[unit_doc], shift)
            of_unit = np.repeat(units, np.diff(b))
            cuts = b[np.concatenate([lo, [len(units)]])]
            turn, new = np.zeros(docs, np.int64), np.zeros((docs, k + 1), np.int64) - 1
            banned = None
        else:
            src, at = path_of[here, 0], node[here, 0]
            turn = at
            old, unit, turn_place = (np.empty(len(here), np.int64) for _ in range(3))
            for s in np.unique(src):
                m = src == s
                old[m] = paths[s][3][here[m]] + at[m]
                unit[m], turn_place[m] = paths[s][1][old[m]], paths[s][2][old[m]]
            banned = out_edges[here, 0]
            edge = _turn(lat, turn_place - shift[unit], banned,
                         _draw(ki[here], turn_place, _TURN))
            # What follows the turn: the rest of its unit, then the units behind it.
            inside = lat.target[edge] < lat.unit_end[unit_at[unit]]
            n_units = hi[here] - unit - 1
            seq = _ranges(unit + 1 - inside, n_units + inside)
            starts = lat.unit_start[unit_at[seq]]
            head = np.concatenate([[0], np.cumsum(n_units + inside)])[:-1]
            starts[head[inside]] = lat.target[edge[inside]]
            of_doc = np.repeat(here, n_units + inside)
            tail, tail_places, tb = lat.walk(unit_at[seq], starts, ki[of_doc], shift[seq])
            tail_n = tb[np.concatenate([head, [len(seq)]])]
            tail_len = np.diff(tail_n)
            cuts = np.concatenate([[0], np.cumsum(at + 1 + tail_len)])
            edges = np.empty(cuts[-1], np.int32)
            of_unit, places = np.empty(cuts[-1], np.int64), np.empty(cuts[-1], np.int64)
            for s in np.unique(src):  # prefixes from the path they share
                m = src == s
                get = _ranges((old - at)[m], at[m])
                put = _ranges(cuts[:-1][m], at[m])
                for whole, part in zip((edges, of_unit, places), paths[s]):
                    whole[put] = part[get]
            put = cuts[:-1] + at
            edges[put], of_unit[put], places[put] = edge, unit, turn_place
            put = _ranges(put + 1, tail_len)
            edges[put], of_unit[put], places[put] = tail, np.repeat(seq, np.diff(tb)), tail_places
        lead = np.zeros(docs, np.int64)
        lead[here] = cuts[:-1]
        paths.append((edges, of_unit, places, lead))
        # Split the rest of the popped subset at the nodes from the turn on.
        logq = lat.logq[edges]
        size = np.diff(cuts)
        before = np.cumsum(logq) - logq
        before -= np.repeat(before[cuts[:-1]], size)
        phi = np.add.reduceat(logq, cuts[:-1])
        gone = np.exp(logq)
        if banned is not None:
            t = cuts[:-1] + turn
            gone[t] += np.where(banned >= 0, np.exp(lat.logq[banned]), 0.0).sum(axis=1)
        mass = before + _log_rest(gone)
        doc = np.repeat(here, size)
        g = _truncated(mass, np.repeat(top, size),
                       _draw(ki[doc], places, _SPLIT))
        g[np.arange(len(g)) < np.repeat(cuts[:-1] + turn, size)] = -np.inf
        # The best k + 1 - i - 1 of them join the agenda in place of the popped one.
        value[here, 0] = -np.inf
        for _ in range(k - i):
            best = np.maximum.reduceat(g, cuts[:-1])
            ok = best > -np.inf
            if not ok.any():
                break
            flat = np.flatnonzero(g == np.repeat(np.where(ok, best, np.nan), size))
            row = np.searchsorted(cuts, flat, "right") - 1
            flat = flat[np.unique(row, return_index=True)[1]]
            row = np.searchsorted(cuts, flat, "right") - 1
            d = here[row]
            spot = value[d].argmin(axis=1)
            better = g[flat] > value[d, spot]
            d, spot, f, r = d[better], spot[better], flat[better], row[better]
            value[d, spot], path_of[d, spot], node[d, spot] = g[f], i, f - cuts[r]
            out_edges[d, spot] = -1
            if banned is not None:
                same = f == cuts[r] + turn[r]
                out_edges[d[same], spot[same]] = banned[r[same]]
            free = (out_edges[d, spot] >= 0).sum(axis=1)
            out_edges[d, spot, free] = edges[f]
            g[flat] = -np.inf
        order = np.argsort(-value, axis=1, kind="stable")
        value = np.take_along_axis(value, order, 1)
        path_of, node = np.take_along_axis(path_of, order, 1), np.take_along_axis(node, order, 1)
        out_edges = np.take_along_axis(out_edges, order[:, :, None], 1)
        results.append((here, lat.piece[edges], cuts, phi))
    kappa = value[:, 0]
    return [(here, pieces, cuts, phi, _log_inclusion(phi, kappa[here]))
            for here, pieces, cuts, phi in results]


def _turn(lat: Lattice, pos: np.ndarray, banned: np.ndarray, u: np.ndarray) -> np.ndarray:
    """An edge out of each position that is not banned there, in proportion to the rest."""
    left = 1.0 - np.where(banned >= 0, np.exp(lat.logq[banned]), 0.0).sum(axis=1)
    goal, total = u * left, np.zeros(len(pos))
    edge, done = np.full(len(pos), -1), np.zeros(len(pos), bool)
    for j in range(int(lat.degree[pos].max())):
        e = lat.first[pos] + j
        ok = (j < lat.degree[pos]) & ~done
        e = np.where(ok, e, 0)
        ok &= ~(banned == e[:, None]).any(axis=1)
        total += np.where(ok, np.exp(lat.logq[e]), 0.0)
        edge = np.where(ok, e, edge)  # the last allowed one if rounding leaves the goal open
        done |= ok & (total >= goal)
    return edge


def _log_inclusion(phi: np.ndarray, kappa: np.ndarray) -> np.ndarray:
    """log(1 - exp(-exp(phi - kappa))); 0 without a further segmentation."""
    with np.errstate(over="ignore", divide="ignore"):
        x = phi - kappa
        exact = np.log(-np.expm1(-np.exp(np.clip(x, -40, 40))))
    return np.where(np.isinf(kappa), 0.0, np.where(x < -30, x, exact))


def with_space(data: np.ndarray, offsets: np.ndarray):
    """(text, bounds, which): the texts that are not empty, each with a space before it."""
    size = np.diff(offsets)
    which = np.flatnonzero(size > 0)
    bounds = np.concatenate([[0], np.cumsum(size[which] + 1)])
    text = np.full(bounds[-1], 32, np.uint8)
    text[_ranges(bounds[:-1] + 1, size[which])] = data
    return text, bounds, which


def decode_bytes(v: Vocabulary, pieces: np.ndarray) -> np.ndarray:
    """The bytes of a run of pieces, spaces for space marks."""
    return v.flat[_ranges(v.start[pieces], v.length[pieces])]


_OUT = [T.StructField("sample", T.IntegerType()), T.StructField("n_pieces", T.LongType()),
        T.StructField("log_prob", T.DoubleType()), T.StructField("log_inclusion", T.DoubleType()),
        T.StructField("exact", T.BooleanType()), T.StructField("pieces", T.ArrayType(T.IntegerType()))]


def sample_pieces(docs: DataFrame, vocabulary: Vocabulary, k: int = SAMPLES, seed: int = SEED,
                  keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Up to ``k`` rows per row of ``docs``: the columns ``keep`` and ``sample`` (from 1, in falling
    perturbed value), ``n_pieces``, ``log_prob`` of the segmentation, ``log_inclusion``, ``exact``
    (decoding the pieces gives the text back) and ``pieces`` (ids).

    A text with fewer than ``k`` segmentations gives them all; a null or empty one gives one row
    without pieces.  Rows are keyed by doc_id, so rows that repeat an id and text sample alike; a
    null doc_id is one key."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the vocabulary's size
    text_name, key_name = storage.fresh_names(docs, "piece_text", "piece_key")
    rows = docs.select(*[docs[c] for c in keep], docs["text"].alias(text_name),
                       F.xxhash64(F.lit(seed), docs["doc_id"]).alias(key_name))
    schema = T.StructType([*rows.schema.fields[:len(keep)], *_OUT])

    def run(batches):
        v = shared.value
        lattice = Lattice(v)
        for part, data, offsets in chunks(batches, text_name, CHUNK_BYTES):
            text, bounds, which = with_space(data, offsets)
            key = part.column(key_name).to_numpy().view(np.uint64)[which]
            empty = np.flatnonzero(np.diff(offsets) == 0)
            found = sample_chunk(lattice, text, bounds, key, k) if len(which) else []
            if len(empty):
                yield _rows(part, keep, schema, empty, 1, np.zeros(0, np.int64),
                            np.zeros(len(empty) + 1, np.int64), np.zeros(len(empty)),
                            np.zeros(len(empty)), np.ones(len(empty), bool))
            for i, (here, pieces, cuts, phi, inclusion) in enumerate(found):
                back = decode_bytes(v, pieces)
                size = np.diff(bounds)[here]
                length = np.add.reduceat(v.length[pieces], cuts[:-1])
                exact = length == size
                if exact.all():
                    same = back == text[_ranges(bounds[here], size)]
                    exact = np.logical_and.reduceat(same, np.cumsum(size) - size)
                yield _rows(part, keep, schema, which[here], i + 1, pieces, cuts, phi, inclusion,
                            exact)
    return storage.arrow(rows, run, schema)


def _rows(part, keep, schema, at, sample, pieces, cuts, phi, inclusion, exact):
    n = len(at)
    index = pa.array(at)
    columns = [part.column(i).take(index) for i in range(len(keep))]
    ids = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)),
                                   pa.array(pieces.astype(np.int32)))
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(np.full(n, sample, np.int32)), pa.array(np.diff(cuts)), pa.array(phi),
         pa.array(inclusion), pa.array(exact), ids], names=[f.name for f in schema.fields])


def decode_pieces(rows: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ("doc_id",),
                  column: str = "pieces") -> DataFrame:
    """The columns ``keep`` and the decoded ``text`` of every row; null pieces give a null text."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    cols = rows.select(*[rows[c] for c in keep], rows[column].alias("__pieces"))
    schema = T.StructType([*cols.schema.fields[:len(keep)], T.StructField("text", T.StringType())])

    def run(batches):
        v = shared.value
        for batch in batches:
            texts = [None if ids is None else
                     decode_bytes(v, np.array(ids, np.int64)).tobytes()[1:].decode("utf-8", "replace")
                     for ids in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(texts, pa.string())],
                                             names=[f.name for f in schema.fields])
    return storage.arrow(cols, run, schema)
