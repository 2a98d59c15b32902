"""Hierarchical Pitman-Yor language model of word bigrams.

Every context (the word before) is a Chinese restaurant whose customers are the words seen after
it; each of its tables sends one customer to the parent restaurant, which all contexts share and
whose own tables are drawn from the uniform distribution over the vocabulary and one unknown word.
A Gibbs sweep seats the customers of every dish anew given the state of everything else: first the
parent's dishes, then those of all contexts.  Only the number t of a dish's tables matters: of c
customers in a restaurant of discount d, strength s and T tables of other dishes, with the dish's
probability P under the parent, it has weight S(c, t) P**t (s + d T)(s + d (T + 1))...(s + d (T + t -
1)), S a generalised Stirling number.  Dishes of up to 64 customers are drawn
from exactly that, larger ones from its limit for many customers (see ``_seat_many``).  A text's
predictive probabilities are averaged over the sweeps after the burn-in.

Dishes are reseated in parallel within a sweep, as if each saw the others' tables of the sweep
before.  Draws are hashes of (context, word, sweep, step): any task that knows a dish's count and
its restaurant's state gets the same seating, so seatings are recomputed where texts are scored and
never shipped.

Scale.  Words are 64-bit hashes.  Texts are cut into chunks; a chunk sends its distinct bigrams once
to their owners ("parts", by hash of the bigram, so a frequent context spreads over all parts) and
gets their counts back in the order it sent them.  Bigrams seen once have one table whatever the
draw, so only their numbers per word matter; those seen more often stay with their part.  Words have
owners too (by hash of the word): in a sweep the parts send them the tables of their dishes summed by
word, the owners seat the parent's dishes and answer with each word's state, and the parts seat
theirs.  All of this travels as rows of packed, compressed arrays, a row per pair of sender and
receiver, dealt out by Spark; every step's output is a table in the shared folder.  Nothing of the
model is collected but a handful of sums per step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cairn.llm import storage
from cairn.llm.arrow_text import LOWER, buffers, chunks, hash_spans, mix, uniform, words

CHUNK_BYTES, PIECE_BYTES = 4 << 20, 1 << 18
# Two values no word hash is expected to take: the context before the first word, and the end.
START, END = np.uint64(0x5354415254000001), np.uint64(0x454E44454E440001)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_EXACT = 64  # up to so many customers a dish's tables are drawn from their exact distribution


@dataclass(frozen=True)
class Settings:
    """``sweeps`` Gibbs sweeps of which the first ``burn_in`` are not averaged; strength of both
    levels; discounts come from the counts of counts, n1 / (n1 + 2 n2), within (0.05, 0.95)."""
    sweeps: int = 3
    burn_in: int = 1
    strength: float = 1.0
    seed: int = 7


# ---- seating ------------------------------------------------------------------------------

def _nth(j: int) -> np.uint64:
    return np.uint64(j * int(_GOLD) & 0xFFFFFFFFFFFFFFFF)


_STIRLING: dict[float, np.ndarray] = {}


def _log_stirling(d: float) -> np.ndarray:
    """[c, t]: log of the generalised Stirling number, the summed weight of all ways to seat c
    customers at t tables where a table of n customers weighs (1 - d)(2 - d)...(n - 1 - d)."""
    if d not in _STIRLING:
        s = np.full((_EXACT + 1, _EXACT + 2), -np.inf)
        s[1, 1] = 0.0
        t = np.arange(1, _EXACT + 1)
        for c in range(1, _EXACT):
            with np.errstate(divide="ignore"):
                stay = np.where(t <= c, np.log(np.maximum(c - d * t, 1e-300)), -np.inf)
            s[c + 1, 1:-1] = np.logaddexp(s[c, :-2], s[c, 1:-1] + stay)
        _STIRLING[d] = s
    return _STIRLING[d]


def _seat_few(c, u, base, p, strength, d):
    """Tables of dishes with up to _EXACT customers, from their conditional distribution
    S(c, t) * p**t * (strength + d base)(strength + d (base + 1))...; all ``c`` are equal."""
    t = np.arange(1, c + 1)
    log_s = _log_stirling(d)[c, 1:c + 1]
    out = np.empty(len(u), np.int64)
    step = max(1, (1 << 17) // c)
    for lo in range(0, len(u), step):
        at = slice(lo, lo + step)
        opens = (strength + d * (base[at, None] + t - 1)) * p[at, None]
        if c <= 16:  # products of so few factors stay in range
            opens[:, 1:] *= np.exp(np.diff(log_s))
            opens[:, 0] = 1.0
            w = np.cumprod(opens, axis=1)
        else:
            w = np.cumsum(np.log(opens), axis=1) + log_s
            w = np.exp(w - w.max(axis=1, keepdims=True))
        w = np.cumsum(w, axis=1)
        out[at] = np.minimum((w < u[at, None] * w[:, -1:]).sum(axis=1) + 1, c)
    return out


def _poisson(mean: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Poisson draws by the distribution function, for means up to about ten."""
    out, at = np.zeros(len(mean)), np.arange(len(mean))
    term = np.exp(-mean)
    total, k = term.copy(), 0
    while len(at):
        go = (u[at] > total) & (k < 200)
        at, term, total, mean = at[go], term[go], total[go], mean[go]
        k += 1
        term = term * mean / k
        total = total + term
        out[at] = k
    return out


def _seat_many(c, key, base, p, strength, d):
    """Tables of dishes with more customers, from the large-number limit of the same distribution.

    Given the final count, customer j opens a table with odds a g / x, a = (strength + d T) p, x = j
    - d t, where g is the effect on the totals of all later places and solves dg/dj = d g / (a g +
    x), g = 1 at the end.  Then x + a g grows as g ** (1 / d), and g goes from
    g0 = (a / (x_c + a)) ** (d / (1 - d)), x_c = c - d t, to 1 while a / d * (1 - g0) tables are
    opened besides the first; the sum of the openings' variances has a closed form too."""
    n = np.zeros(len(c))
    for _ in range(30):
        a = (strength + d * (base + 1 + n)) * p
        x = np.maximum(c - d * (1 + n), 1e-9)
        g = (a / (x + a)) ** (d / (1 - d))
        n = (n + np.minimum(a / d * (1 - g), c - 1)) / 2
    e = 2 - 1 / d
    part = -np.log(g) if abs(e) < 1e-6 else (1 - g ** e) / e
    var = np.maximum(a / d * ((1 - g) - a / (x + a) * part), 0) / (1 - p)
    u, u2 = uniform(mix(key)), uniform(mix(key + _GOLD))
    out = np.rint(n + np.sqrt(var) * np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * u2))
    few = n < 9
    out[few] = _poisson(n[few], u[few])
    return (1 + np.clip(out, 0, c - 1)).astype(np.int64)


def seat(c: np.ndarray, key: np.ndarray, base: np.ndarray, p: np.ndarray, strength: float,
         d: float, sweep: int) -> np.ndarray:
    """Tables of each dish after its ``c`` >= 1 customers sat down anew, given ``base`` tables of
    other dishes and the parent's probability ``p``; ``key`` seeds the draws."""
    c, p, base = c.astype(np.int64), p.astype(float), base.astype(float)
    key = mix(key + _nth(sweep))
    out = np.ones(len(c), np.int64)
    order = np.argsort(-c, kind="stable")
    sizes, starts = np.unique(-c[order], return_index=True)
    many = int((c > _EXACT).sum())
    if many:
        i = order[:many]
        out[i] = _seat_many(c[i], key[i], base[i], p[i], strength, d)
    for size, a, b in zip(-sizes, starts, [*starts[1:], len(c)]):
        if 1 < size <= _EXACT:
            i = order[a:b]
            out[i] = _seat_few(int(size), uniform(key[i]), base[i], p[i], strength, d)
    return out


def bigram_key(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix(u) * _GOLD + w)


# ---- packing ------------------------------------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed body: their number, types and lengths, then their bytes."""
    head = np.array([len(arrays)] + [x for a in arrays for x in (a.dtype.num, len(a))], np.int64)
    raw = head.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


_TYPES = {np.dtype(t).num: np.dtype(t) for t in (np.uint8, np.uint16, np.uint32, np.uint64, np.int64,
                                                 np.float32, np.float64, np.bool_)}


def unpack(body: bytes | pa.Buffer) -> list[np.ndarray]:
    body = memoryview(body)
    raw = pa.decompress(pa.py_buffer(body[8:]), decompressed_size=int.from_bytes(body[:8], "little"),
                        codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * n, 8)
    at, out = 8 + 16 * n, []
    for kind, length in head.reshape(-1, 2):
        t = _TYPES[int(kind)]
        out.append(np.frombuffer(raw, t, int(length), at))
        at += t.itemsize * int(length)
    return out


def small(x: np.ndarray) -> np.ndarray:
    """Non-negative integers in the narrowest type that holds them."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else
                    np.uint32 if top < 1 << 32 else np.uint64)


# ---- a chunk of texts ---------------------------------------------------------------------

def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every word, A-Z lower-cased; hashed piece by piece, with small tables and
    arrays that fit the cache."""
    n_docs, lo = len(offsets) - 1, 0
    hashes, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    while lo < n_docs:
        hi = int(np.searchsorted(offsets, offsets[lo] + PIECE_BYTES, "right")) - 1
        hi = min(max(hi, lo + 1), n_docs)
        part = LOWER[data[offsets[lo]:offsets[hi]]]
        start, end, doc = words(part, offsets[lo:hi + 1] - offsets[lo])
        hashes.append(hash_spans(part, start, end))
        docs.append(doc + lo)
        lo = hi
    return np.concatenate(hashes), np.concatenate(docs)


class Chunk:
    """The distinct words and bigrams of a chunk and, per token, its bigram."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, parts: int):
        n_docs = len(offsets) - 1
        h, doc = word_hashes(data, offsets)
        per_doc = np.bincount(doc, minlength=n_docs)
        first = np.concatenate([[0], np.cumsum(per_doc + 1)])
        tokens = np.full(first[-1] + 1, END)
        tokens[np.arange(len(h)) + doc] = h
        tokens[-1] = START
        self.per_doc = per_doc + 1
        self.vocab, code = np.unique(tokens, return_inverse=True)
        w = code[:-1].astype(np.uint64)
        u = np.empty_like(w)
        u[1:] = w[:-1]
        u[first[:-1]] = code[-1]
        del tokens, code, h, doc
        pair, self.token = np.unique(u << np.uint64(32) | w, return_inverse=True)
        del u, w
        self.u = (pair >> np.uint64(32)).astype(np.int64)
        self.w = (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
        self.key = bigram_key(self.vocab[self.u], self.vocab[self.w])
        part = (self.key % np.uint64(parts)).astype(np.int64)
        self.order = np.argsort(part, kind="stable")
        self.cuts = np.searchsorted(part[self.order], np.arange(parts + 1))

    def segments(self):
        """(part, bigrams) in the order in which they are sent and answered."""
        for part in np.flatnonzero(np.diff(self.cuts)):
            yield int(part), self.order[self.cuts[part]:self.cuts[part + 1]]


def _chunks(batches):
    """(chunk number, rows, bytes, offsets): small batches of a scan task put together to chunks of
    CHUNK_BYTES.  The number names the task and counts its chunks, so another scan of the same files
    yields the same chunks (their keys are compared)."""
    def gathered():
        held, size = [], 0
        for rows, data, _ in chunks(batches, size=CHUNK_BYTES):
            if held and size + len(data) > CHUNK_BYTES:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(rows)
            size += len(data)
        if held:
            yield pa.Table.from_batches(held)

    lead = TaskContext.get().partitionId() << 32
    for i, table in enumerate(gathered()):
        rows = table.combine_chunks().to_batches()[0]
        data, offsets = buffers(rows.column("text"))
        yield lead + i, rows, data, offsets


# ---- messages -----------------------------------------------------------------------------

# A row: receiver, kind, sender, packed arrays, and sums for the driver.
_ROW = "to bigint, kind int, frm bigint, body binary, sums array<bigint>"
_ARROW = pa.schema([("to", pa.int64()), ("kind", pa.int32()), ("frm", pa.int64()),
                    ("body", pa.binary()), ("sums", pa.list_(pa.int64()))])
BLOB, REPLY, DISH, FIRST, ASK, WORD, ANSWER, TEXT, WANT, GIVE = range(10)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t.type) for i, t in enumerate(_ARROW)], schema=_ARROW)


def _receivers(kernel):
    """mapInArrow: rows sorted by receiver -> kernel(receiver, {kind: [(sender, body)]}), which
    yields rows.  A receiver's messages are one part's or owner's share of the data; their bodies
    stay packed in the batches they came in."""
    def run(batches):
        at, held = None, {}
        for batch in batches:
            bodies = batch.column(3)
            for i, (to, kind, frm) in enumerate(zip(*(batch.column(i).to_pylist()
                                                      for i in range(3)))):
                if to != at:
                    if held:
                        yield from (_batch([r]) for r in kernel(at, held))
                    at, held = to, {}
                held.setdefault(kind, []).append((frm, bodies[i].as_buffer()))
            del batch, bodies
        if held:
            yield from (_batch([r]) for r in kernel(at, held))
    return run


def _step(rows: DataFrame, kernel, name: str) -> str:
    """Deal the rows out to their receivers, run the kernel there, keep its rows as a table."""
    dealt = rows.repartition("to").sortWithinPartitions("to", "kind", "frm")
    path = storage.write_table(storage.arrow(dealt, _receivers(kernel), _ROW), name)
    storage.release(rows.sparkSession)
    return path


_TRAINING = 1 << 62  # chunk numbers of training texts beside those of texts to score


def _send(parts: int, lead: int = 0):
    """Each chunk's distinct bigrams with their training counts, one row per part."""
    def run(batches):
        for number, rows, data, offsets in _chunks(batches):
            number += lead
            c = Chunk(data, offsets, parts)
            train = ~np.array(rows.column("held_out").to_pylist(), bool)
            count = np.bincount(c.token, weights=np.repeat(train, c.per_doc),
                                minlength=len(c.u)).astype(np.int64)
            out = []
            for part, at in c.segments():
                u, w = c.u[at], c.w[at]
                used = np.unique(np.concatenate([u, w]))
                out.append((part, BLOB, number, pack(
                    c.vocab[used], small(np.diff(np.searchsorted(used, u), prepend=0)),
                    small(np.searchsorted(used, w)), small(count[at])), []))
            yield _batch(out)
    return run


def _by_owner(vocab: np.ndarray, owners: int):
    """(owner, positions) of the words of each owner: the low bits of the hash."""
    owner = (vocab & np.uint64(owners - 1)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(owners + 1))
    for o in np.flatnonzero(np.diff(cuts)):
        yield int(o), order[cuts[o]:cuts[o + 1]]


def _ask(part: int, vocab, u, w, t, owners: int):
    """The tables of a part's dishes summed by word, as eaten and as context, to the owners."""
    as_word = np.bincount(w, weights=t, minlength=len(vocab)).astype(np.int64)
    as_context = np.bincount(u, weights=t, minlength=len(vocab)).astype(np.int64)
    for o, at in _by_owner(vocab, owners):
        yield o, ASK, part, pack(vocab[at], small(as_word[at]), small(as_context[at])), []


def _count(owners: int):
    """A part adds up its bigrams: replies to the chunks, sums per word to the owners (count,
    bigrams seen once after and before it), and the dishes seen more often, with one table each."""
    def kernel(part, held):
        # Messages are unpacked one at a time: first for the keys of their bigrams, then for the
        # words of those that occur in them for the first time.
        keys, counts = [], []
        for _, body in held[BLOB]:
            vocab, du, w, c = unpack(body)
            keys.append(bigram_key(vocab[np.cumsum(du, dtype=np.int64)], vocab[w]))
            counts.append(c)
        ends = np.cumsum([len(k) for k in keys])
        keys = np.concatenate(keys)
        order = np.argsort(keys, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = np.diff(keys[order]) != 0
        at = np.empty(len(order), np.uint32)
        at[order] = np.cumsum(new) - 1
        first = order[new]
        del order, new
        count = np.zeros(len(first), np.int64)
        for a, c in zip(np.concatenate([[0], ends[:-1]]), counts):
            here = at[a:a + len(c)]  # a message names a bigram once
            count[here] += c.astype(np.int64)
        for (number, _), a, b in zip(held[BLOB], np.concatenate([[0], ends[:-1]]), ends):
            with np.errstate(over="ignore"):
                check = keys[a:b].sum(dtype=np.uint64)
            yield (number, REPLY, part,
                   pack(np.array([check], np.uint64), small(count[at[a:b]])), [])
        del keys, at, counts
        by_place = np.argsort(first)
        cuts = np.searchsorted(first[by_place], np.concatenate([[0], ends]))
        u, w = np.empty(len(first), np.uint64), np.empty(len(first), np.uint64)
        for (_, body), a, lo, hi in zip(held[BLOB], np.concatenate([[0], ends[:-1]]), cuts, cuts[1:]):
            if lo < hi:
                vocab, du, dw, _ = unpack(body)
                g = by_place[lo:hi]
                i = first[g] - a
                u[g], w[g] = vocab[np.cumsum(du, dtype=np.int64)[i]], vocab[dw[i]]
        del first, by_place
        vocab, code = np.unique(np.concatenate([u, w]), return_inverse=True)
        u, w = code[:len(u)], code[len(u):]
        n, once = len(vocab), count == 1
        total = np.bincount(w, weights=count, minlength=n).astype(np.int64)
        after, before = np.bincount(w[once], minlength=n), np.bincount(u[once], minlength=n)
        seen = np.flatnonzero((total > 0) | (before > 0)
                              | (np.bincount(u, weights=count, minlength=n) > 0))
        for o, i in _by_owner(vocab[seen], owners):
            i = seen[i]
            yield (o, FIRST, part, pack(vocab[i], small(total[i]), small(after[i]),
                                        small(before[i])), [])
        more = count > 1
        if more.any():
            used, code = np.unique(np.concatenate([u[more], w[more]]), return_inverse=True)
            du, dw = code[:int(more.sum())], code[int(more.sum()):]
            t = np.ones(len(du), np.int64)
            yield (part, DISH, part, pack(vocab[used], small(du), small(dw), small(count[more]),
                                          small(t)), [int((count == 2).sum())])
            yield from _ask(part, vocab[used], du, dw, t, owners)
    return kernel


# ---- sweeps -------------------------------------------------------------------------------

def _added(words: np.ndarray, asked) -> tuple[np.ndarray, np.ndarray]:
    """The tables of the parts' dishes summed by the words of an owner."""
    as_word, as_context = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    for _, body in asked:
        seg, a, b = unpack(body)
        i = np.searchsorted(words, seg)
        as_word[i] += a.astype(np.int64)
        as_context[i] += b.astype(np.int64)
    return as_word, as_context


def _merge(owner, held):
    """An owner's words: hash, count, bigrams seen once after and before, tables (one where there
    is a customer); sums: tokens, words, seen-once bigrams, words of one, two and any customers."""
    parts = [unpack(b) for _, b in held[FIRST]]
    words, code = np.unique(np.concatenate([x[0] for x in parts]), return_inverse=True)
    c, after, before = (np.bincount(code, weights=np.concatenate([x[i] for x in parts]),
                                    minlength=len(words)).astype(np.int64) for i in (1, 2, 3))
    cust = after + _added(words, held.get(ASK, []))[0]
    yield (owner, WORD, owner, pack(words, c, after, before, (cust > 0).astype(np.int64)),
           [int(c.sum()), int((c > 0).sum()), int(after.sum()), int((cust == 1).sum()),
            int((cust == 2).sum()), int((cust > 0).sum())])


def _parent(base_p: float, strength: float, d: float, sweep: int, seed: int, seats: int):
    """An owner seats the parent's customers of its words (``seats``: all tables of the sweep
    before) and answers the parts; its state grows by the words' tables as contexts and the mass
    cust - d * tables.  Sums: customers, tables."""
    def kernel(owner, held):
        (_, body), = held[WORD]
        words, c, after, before, last, *rest = unpack(body)
        asked = held.get(ASK, [])
        as_word, as_context = _added(words, asked)
        cust, tables = after + as_word, before + as_context
        t = np.zeros(len(words), np.int64)
        at = cust > 0
        t[at] = seat(cust[at], mix(words[at] ^ mix(np.array([seed], np.uint64))),
                     np.maximum(seats - last[at], 0), np.full(int(at.sum()), base_p), strength, d,
                     sweep)
        mass = (cust - d * t).astype(np.float32)
        yield (owner, WORD, owner, pack(words, c, after, before, t, *rest, tables, mass),
               [int(cust.sum()), int(t.sum())])
        for part, body in asked:
            i = np.searchsorted(words, unpack(body)[0])
            yield part, ANSWER, owner, pack(mass[i], small(tables[i])), []
    return kernel


def _dishes(base: tuple[float, float], strength: float, d: float, sweep: int, seed: int,
            owners: int):
    """A part seats the customers of its dishes and tells the owners."""
    def kernel(part, held):
        if DISH not in held:
            return
        (_, body), = held[DISH]
        vocab, u, w, c, t = unpack(body)
        u, w, c, t = (x.astype(np.int64) for x in (u, w, c, t))
        mass, tables = np.zeros(len(vocab), np.float32), np.zeros(len(vocab), np.int64)
        answers = dict(held[ANSWER])
        for o, at in _by_owner(vocab, owners):
            mass[at], tables[at] = unpack(answers[o])
        t = dish_tables(vocab[u], vocab[w], c, t, tables[u], parent_p(mass[w], base), strength, d,
                        sweep, seed)
        yield part, DISH, part, pack(vocab, small(u), small(w), small(c), small(t)), []
        yield from _ask(part, vocab, u, w, t, owners)
    return kernel


def _last(owner, held):
    """The words' tables as contexts after the last sweep complete their state."""
    (_, body), = held[WORD]
    words, c, after, before, t, *rest = unpack(body)
    tables = before + _added(words, held.get(ASK, []))[1]
    yield owner, WORD, owner, pack(words, c, *rest, tables), []


def parent_p(mass: np.ndarray, base: tuple[float, float]) -> np.ndarray:
    """The parent's probability of words from their mass; an unseen word has mass 0."""
    return (mass.astype(np.float64) + base[0]) / base[1]


def dish_tables(u, w, c, t, rest, p, strength, d, sweep, seed):
    """The tables of dishes after ``sweep`` from those before; ``rest``: all of the restaurant."""
    key = mix(bigram_key(u, w) ^ mix(np.array([seed], np.uint64)))
    return seat(c, key, np.maximum(rest - t, 0), p, strength, d, sweep)


def _discount(n1: int, n2: int) -> float:
    return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5


@dataclass
class Model:
    """``words``: the owners' rows (words, c, tables as context t0, mass m1, t1, m2, ... after each
    sweep); ``replies``: counts per (chunk, part) of ``docs``, the rows the model was fitted on.
    The rest are sums; ``bases`` turn a sweep's
    masses into the parent's probabilities."""
    words: DataFrame
    replies: DataFrame
    docs: DataFrame
    parts: int
    owners: int
    tokens: int
    vocabulary: int
    documents: int
    discount: float
    bases: list[tuple[float, float]]
    settings: Settings


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Train on the rows of ``docs(doc_id, text, held_out)`` that are not held out; the bigrams of
    the held-out rows take part in the exchange with count 0, so they are answered too."""
    spark = docs.sparkSession
    n, s = storage.shuffle_partitions(spark), settings
    parts, owners = n, 1 << max(2, ((n + 3) // 4 - 1).bit_length())

    def rows(path, kind):
        return (spark.read.schema(_ROW).parquet(path).where(F.col("kind") == kind)
                .select("to", "kind", "frm", "body", "sums"))

    def summed(df, size):
        got = df.agg(*[F.sum(F.get("sums", i)) for i in range(size)]).first()
        return [int(x or 0) for x in got]

    counted = _step(storage.arrow(docs, _send(parts), _ROW), _count(owners), "lm-counted")
    dish, asked = rows(counted, DISH), rows(counted, ASK)
    merged = _step(rows(counted, FIRST).unionByName(asked), _merge, "lm-words")
    word = rows(merged, WORD)
    tokens, v, once, one, two, seats = summed(word, 6)
    d1, d0 = _discount(once, *summed(dish, 1)), _discount(one, two)
    base_p, bases, old = 1.0 / (v + 1), [], [merged]
    for sweep in range(1, s.sweeps + 1):
        parent = _step(word.unionByName(asked),
                       _parent(base_p, s.strength, d0, sweep, s.seed, seats), "lm-words")
        word = rows(parent, WORD)
        cust, seats = summed(word, 2)
        bases.append(((s.strength + d0 * seats) * base_p, s.strength + cust))
        seated = _step(dish.unionByName(rows(parent, ANSWER)),
                       _dishes(bases[-1], s.strength, d1, sweep, s.seed, owners), "lm-dishes")
        dish, asked = rows(seated, DISH), rows(seated, ASK)
        storage.drop_table(spark, *old)
        old = [parent, seated]
    last = _step(word.unionByName(asked), _last, "lm-model")
    storage.drop_table(spark, *old)
    return Model(rows(last, WORD), rows(counted, REPLY), docs, parts, owners, tokens, v,
                 docs.where("not held_out").count(), d1, bases, s)


# ---- scoring ------------------------------------------------------------------------------

def _texts(batches):
    """One row per chunk: ids, held-out flags and the texts themselves."""
    for number, rows, data, offsets in _chunks(batches):
        ids = rows.column("doc_id")
        known = np.array([x is not None for x in ids.to_pylist()], bool)
        yield _batch([(number, TEXT, 0, pack(
            ids.fill_null(0).to_numpy(), known,
            np.array(rows.column("held_out").to_pylist(), bool), offsets, data), [])])


def _want(owners: int):
    """The words of each chunk, one row per owner."""
    def run(batches):
        for number, _, data, offsets in _chunks(batches):
            vocab = np.unique(np.append(word_hashes(data, offsets)[0], [START, END]))
            yield _batch([(o, WANT, number, pack(vocab[at]), [])
                          for o, at in _by_owner(vocab, owners)])
    return run


def _give(sweeps: int):
    """An owner answers the chunks: count, tables and masses of the words in the order asked; zeros
    for words without training tokens."""
    def kernel(owner, held):
        state = unpack(held[WORD][0][1]) if WORD in held else None
        for number, body in held.get(WANT, []):
            (want,) = unpack(body)
            if state is None:
                columns = ([np.zeros(len(want), np.int64)] * 2
                           + [np.zeros(len(want), np.float32), np.zeros(len(want), np.int64)] * sweeps)
            else:
                words = state[0]
                at = np.minimum(np.searchsorted(words, want), len(words) - 1)
                hit = words[at] == want
                columns = [np.where(hit, x[at], x.dtype.type(0)) for x in state[1:]]
            yield number, GIVE, owner, pack(*[x if x.dtype == np.float32 else small(x)
                                              for x in columns]), []
    return kernel


_SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
           "score double")


class _Scorer:
    """The sums of a model that scoring needs (a few numbers)."""

    def __init__(self, m: Model):
        self.parts, self.owners, self.tokens, self.v = m.parts, m.owners, m.tokens, m.vocabulary
        self.documents, self.d, self.s, self.bases = m.documents, m.discount, m.settings, m.bases

    def score(self, texts: bytes, counts: dict[int, bytes], answers: dict[int, bytes]):
        ids, known, held, offsets, data = unpack(texts)
        chunk = Chunk(data, offsets, self.parts)
        vocab, u, w, key, s = chunk.vocab, chunk.u, chunk.w, chunk.key, self.s
        values = [np.zeros(len(vocab), np.float32 if i > 1 and i % 2 == 0 else np.int64)
                  for i in range(2 * s.sweeps + 2)]
        for o, at in _by_owner(vocab, self.owners):
            for column, got in zip(values, unpack(answers[o])):
                column[at] = got
        c_word, tables, mass = values[0], values[1::2], values[2::2]
        count = np.zeros(len(u), np.int64)
        for p, at in chunk.segments():
            check, got = unpack(counts[p])
            with np.errstate(over="ignore"):
                if len(got) != len(at) or check[0] != key[at].sum(dtype=np.uint64):
                    raise RuntimeError("the documents changed between two scans")
            count[at] = got
        # Customers of a context: its training tokens; of the start, the training documents.
        total = np.where(vocab == START, self.documents, c_word)[u]
        often = np.flatnonzero(count > 1)
        t = np.ones(len(often), np.int64)
        average = np.zeros(len(u))
        for sweep in range(1, s.sweeps + 1):
            p = parent_p(mass[sweep - 1], self.bases[sweep - 1])[w]
            t = dish_tables(vocab[u[often]], vocab[w[often]], count[often], t,
                            tables[sweep - 1][u[often]], p[often], s.strength, self.d, sweep, s.seed)
            if sweep <= s.burn_in:
                continue
            seated = (count > 0).astype(float)
            seated[often] = t
            average += ((count - self.d * seated
                         + (s.strength + self.d * tables[sweep][u]) * p) / (s.strength + total))
        average /= s.sweeps - s.burn_in
        token, per_doc = chunk.token, chunk.per_doc
        first = np.cumsum(per_doc) - per_doc
        base = np.log10((c_word + 1.0) / (self.tokens + (self.v + 1)))[w][token]
        return [pa.array(ids, mask=~known), pa.array(held), pa.array(per_doc),
                pa.array(np.add.reduceat((c_word > 0)[w][token].astype(np.int64), first)),
                pa.array(np.add.reduceat(base, first)),
                pa.array(np.add.reduceat(np.log10(average)[token], first))]


def _score(scorer: _Scorer):
    """Rows sorted by chunk -> one row per document."""
    names = [x.split()[0] for x in _SCORES.split(", ")]

    def run(batches):
        chunk, held = None, {}
        for batch in batches:
            bodies = batch.column(3)
            for i, (number, kind, frm) in enumerate(zip(*(batch.column(i).to_pylist()
                                                          for i in range(3)))):
                if number != chunk:
                    if TEXT in held:
                        yield pa.RecordBatch.from_arrays(
                            scorer.score(held[TEXT][0], held[REPLY], held[GIVE]), names=names)
                    chunk, held = number, {}
                held.setdefault(kind, {})[frm] = bodies[i].as_buffer()
            del batch, bodies
        if TEXT in held:
            yield pa.RecordBatch.from_arrays(
                scorer.score(held[TEXT][0], held[REPLY], held[GIVE]), names=names)
    return run


def _counts_for(docs: DataFrame, model: Model) -> DataFrame:
    """The counts of the bigrams of other texts: these and the training texts once more to the
    parts, which reply to both."""
    spark = docs.sparkSession
    train = model.docs.where("not held_out").select("text", F.lit(False).alias("held_out"))
    asking = docs.select("text", F.lit(True).alias("held_out"))
    sent = storage.arrow(asking, _send(model.parts), _ROW).unionByName(
        storage.arrow(train, _send(model.parts, _TRAINING), _ROW))
    path = _step(sent, _count(model.owners), "lm-asked")
    return (spark.read.schema(_ROW).parquet(path)
            .where((F.col("kind") == REPLY) & (F.col("to") < _TRAINING)))


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, base_score, score`` for every row of
    ``docs(doc_id, text[, held_out])``.  The table the model was fitted on finds its bigrams'
    counts kept by ``fit``; any other table has them counted (one exchange more).

    A text's tokens are its words with A-Z lower-cased and one end.  ``score`` is the sum over them
    of log10 of the averaged predictive probability, ``base_score`` that of (c + 1) / (N + V + 1).
    A null text counts as empty and has the end only; repeated rows are scored each; a null doc_id
    is never held out; other columns are ignored; an empty table gives an empty result."""
    spark = docs.sparkSession
    replies = model.replies if docs is model.docs else _counts_for(docs, model)
    if "held_out" not in docs.columns:
        docs = docs.withColumn("held_out", F.lit(True))
    docs = docs.select("doc_id", "text", "held_out")
    want = storage.arrow(docs, _want(model.owners), _ROW)
    give = _step(want.unionByName(model.words), _give(model.settings.sweeps), "lm-given")
    give = spark.read.schema(_ROW).parquet(give)
    dealt = (storage.arrow(docs, _texts, _ROW).unionByName(give).unionByName(replies)
             .repartition("to").sortWithinPartitions("to", "kind", "frm"))
    return storage.arrow(dealt, _score(_Scorer(model)), _SCORES)


def perplexity(scored: DataFrame) -> DataFrame:
    """``held_out, tokens, perplexity, base_perplexity`` of scored texts."""
    per = F.sum("n_tokens")
    return scored.groupBy("held_out").agg(
        per.alias("tokens"), F.pow(F.lit(10.0), -F.sum("score") / per).alias("perplexity"),
        F.pow(F.lit(10.0), -F.sum("base_score") / per).alias("base_perplexity"))
