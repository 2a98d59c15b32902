"""Secret scan with one combined deterministic automaton.

The rules are byte regular expressions.  Their reversals become one nondeterministic automaton,
subset construction makes it deterministic and partition refinement minimises it; the result is a
transition array over byte classes.  One pass over a text, from its last byte to its first, then
marks for every rule all positions where a match starts (the automaton may begin anywhere, so an
accepting state at a position means that some text from here on matches).  From the leftmost mark
the rule's own small automaton is run forward to the end of the longest match, and the scan
continues behind it: leftmost non-overlapping matches, as a regex engine finds them.

Bytes after which the automaton is in its start state whatever came before (line feeds, most
punctuation, all non-ASCII bytes) cut a batch into independent segments, which are advanced in
lock step, one array operation per byte position for thousands of segments of many documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cairn.llm import storage
from cairn.llm.arrow_text import chunks

_FEW = 24  # segments still running when the lock step gives way to a loop per segment


# ---- regular expressions as nested tuples -------------------------------------------------

def chars(spec: str) -> tuple:
    """A byte class: ranges such as ``a-z`` and single characters, ``-`` last for itself."""
    out, i = set(), 0
    while i < len(spec):
        if i + 2 < len(spec) and spec[i + 1] == "-":
            out.update(range(ord(spec[i]), ord(spec[i + 2]) + 1))
            i += 3
        else:
            out.add(ord(spec[i]))
            i += 1
    return ("set", frozenset(out))


def text(s: str, any_case: bool = False) -> tuple:
    both = (lambda c: c.lower() + c.upper()) if any_case else (lambda c: c)
    return ("seq", tuple(("set", frozenset(map(ord, both(c)))) for c in s))


def seq(*x) -> tuple:
    return ("seq", x)


def alt(*x) -> tuple:
    return ("alt", x)


def star(x) -> tuple:
    return ("star", x)


def opt(x) -> tuple:
    return ("alt", (x, ("seq", ())))


def plus(x, least: int = 1) -> tuple:
    return ("seq", (x,) * least + (star(x),))


def reverse(x) -> tuple:
    kind, arg = x
    if kind == "seq":
        return ("seq", tuple(reverse(y) for y in reversed(arg)))
    if kind == "alt":
        return ("alt", tuple(reverse(y) for y in arg))
    return x if kind == "set" else (kind, reverse(arg))


# ---- automata -----------------------------------------------------------------------------

class _Nfa:
    def __init__(self):
        self.eps: list[list[int]] = []
        self.step: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.eps.append([])
        self.step.append(None)
        return len(self.eps) - 1

    def add(self, x, end: int) -> int:
        """The entry state of ``x`` when what follows begins in ``end``."""
        kind, arg = x
        if kind == "seq":
            for y in reversed(arg):
                end = self.add(y, end)
            return end
        at = self.state()
        if kind == "set":
            self.step[at] = (arg, end)
        elif kind == "alt":
            self.eps[at] = [self.add(y, end) for y in arg]
        else:
            self.eps[at] = [self.add(arg, at), end]
        return at

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.eps[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


@dataclass
class Dfa:
    """``classes[byte]`` -> class, ``table[state * width + class]`` -> state, ``accept[state]`` ->
    bit set of rules.  State 0 is the start; accepting states have the highest numbers, from
    ``first`` on."""
    classes: np.ndarray
    table: np.ndarray
    width: int
    accept: np.ndarray
    first: int
    dead: int  # a state that never leaves and never accepts, or -1


def compile_rules(rules: list[tuple], anywhere: bool) -> Dfa:
    """One minimal automaton for all rules; with ``anywhere`` a match may begin at each byte."""
    nfa = _Nfa()
    final = [nfa.state() for _ in rules]
    starts = [nfa.add(x, f) for x, f in zip(rules, final)]
    used = [s[0] for s in nfa.step if s]
    kinds: dict[tuple, int] = {}
    classes = np.zeros(256, np.int32)
    for b in range(256):
        classes[b] = kinds.setdefault(tuple(b in s for s in used), len(kinds))
    width = len(kinds)
    one = [int(np.flatnonzero(classes == c)[0]) for c in range(width)]

    # Subset construction.
    start = nfa.closure(starts)
    number, todo, rows = {start: 0}, [start], []
    while todo:
        here = todo.pop(0)
        row = []
        for b in one:
            to = {nfa.step[s][1] for s in here if nfa.step[s] and b in nfa.step[s][0]}
            nxt = nfa.closure(to | set(starts) if anywhere else to)
            if nxt not in number:
                number[nxt] = len(number)
                todo.append(nxt)
            row.append(number[nxt])
        rows.append(row)
    table = np.array(rows)
    accept = np.zeros(len(rows), np.int64)
    for states, i in number.items():
        accept[i] = sum(1 << r for r, f in enumerate(final) if f in states)

    # Partition refinement: states stay together while they accept alike and lead alike.
    block = np.unique(accept, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1]
        finer = finer.ravel()
        if finer.max() == block.max():
            break
        block = finer
    keep = np.array([int(np.flatnonzero(block == b)[0]) for b in range(block.max() + 1)])
    order = sorted(range(len(keep)), key=lambda b: (accept[keep[b]] != 0, b != block[0], b))
    rank = np.argsort(order)
    small = rank[block[table[keep[order]]]]
    acc = accept[keep[order]]
    dead = [s for s in range(len(acc)) if not acc[s] and (small[s] == s).all()]
    return Dfa(classes, small.astype(np.int32).ravel(), width, acc, int((acc == 0).sum()),
               dead[0] if dead and not anywhere else -1)


# ---- rules --------------------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """``least``: bytes that the match, or its value part for ``valued`` rules, must have;
    shorter matches are dropped after matching, so they still use up their text."""
    kind: str
    pattern: tuple
    least: int = 0
    valued: bool = False


# The patterns of the kinds; assign, access and hex are the base.
_QUOTE, _SPACE = chars("\"'"), chars(" ")
RULES = (
    Rule("assign", seq(alt(text("password", True), text("passwd", True), text("secret", True),
                           text("token", True),
                           seq(text("api", True), opt(chars("_")), text("key", True))),
                       opt(_QUOTE), star(_SPACE), chars(":="), star(_SPACE), opt(_QUOTE),
                       plus(chars("A-Za-z0-9+/_.=-"))), 6, True),
    Rule("access", seq(text("AKIA"), plus(chars("A-Z0-9"))), 20),
    Rule("hex", plus(chars("0-9a-f"), 24)),
    Rule("github", seq(text("gh"), chars("pousr"), text("_"), plus(chars("A-Za-z0-9"))), 40),
    Rule("slack", seq(text("xox"), chars("abprs"), text("-"), plus(chars("A-Za-z0-9-"))), 20),
    Rule("jwt", seq(text("eyJ"), plus(chars("A-Za-z0-9_-")), text("."),
                    plus(chars("A-Za-z0-9_-")), text("."), plus(chars("A-Za-z0-9_-"))), 30),
    Rule("pem", seq(text("-----BEGIN "), star(chars("A-Z ")), text("PRIVATE KEY-----"))),
)
BASE = ("assign", "access", "hex")


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.back = compile_rules([reverse(r.pattern) for r in rules], anywhere=True)
        self.ahead = [compile_rules([r.pattern], anywhere=False) for r in rules]
        grid = self.back.table.reshape(-1, self.back.width)
        self.resets = (grid == 0).all(axis=0)[self.back.classes]

    def marks(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, rule bits) of every byte where a match of some rule starts, in order."""
        n = len(data)
        if n == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        live = ~self.resets[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        begin, end = live.copy(), live.copy()
        begin[1:] &= ~live[:-1] | edge[1:n]
        end[:-1] &= ~live[1:] | edge[1:n]
        lo, hi = np.flatnonzero(begin), np.flatnonzero(end)
        order = np.argsort(lo - hi, kind="stable")  # longest first
        lo, hi = lo[order], hi[order]
        length = hi - lo + 1
        column = self.back.classes[data]
        table, width, first = self.back.table, self.back.width, self.back.first
        state = np.zeros(len(lo), np.int32)
        found, bits = [], []
        t, running = 0, len(lo)
        at = hi.copy()
        while running >= _FEW:
            state = table[state[:running] * width + column[at[:running]]]
            hit = state >= first
            if hit.any():
                found.append(at[:running][hit])
                bits.append(self.back.accept[state[hit]])
            at = at[:running] - 1
            t += 1
            running = int(np.searchsorted(-length[:running], -t, "left"))
        flat = table.tolist()
        for i in range(running):
            s = int(state[i])
            for p in range(int(at[i]), int(lo[i]) - 1, -1):
                s = flat[s * width + column[p]]
                if s >= first:
                    found.append(np.array([p]))
                    bits.append(self.back.accept[s:s + 1])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        p, b = np.concatenate(found), np.concatenate(bits)
        order = np.argsort(p, kind="stable")
        return p[order], b[order]

    def match_end(self, rule: int, data: bytes, at: int) -> int:
        """End of the longest match of the rule that starts at ``at``."""
        dfa = self.ahead[rule]
        s, end = 0, -1
        for p in range(at, len(data)):
            s = int(dfa.table[s * dfa.width + dfa.classes[data[p]]])
            if s == dfa.dead:
                break
            if s >= dfa.first:
                end = p + 1
        return end

    def spans(self, raw: bytes, at: np.ndarray, bits: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes of one document from its marks, by start, then rule."""
        out = []
        for r, rule in enumerate(self.rules):
            done = 0
            for p in at[(bits >> r) & 1 == 1].tolist():
                if p < done:
                    continue
                done = self.match_end(r, raw, p)
                size = done - p
                if rule.valued:
                    match = raw[p:done]
                    sep = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
                    value = match[sep + 1:].lstrip(b" ")
                    size = len(value) - (value[:1] in (b'"', b"'"))
                if size >= rule.least:
                    out.append((p, r, done))
        return sorted(out)


_SCANNER: dict[tuple, Scanner] = {}


def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    """The compiled scanner, once per worker process."""
    if rules not in _SCANNER:
        _SCANNER[rules] = Scanner(rules)
    return _SCANNER[rules]


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: ``doc_id, spans``, spans an array of (kind, start, end, text) in code
    points, end exclusive, by start, then by the order of the rules.

    Kinds are scanned on their own, so spans of different kinds may overlap; matches of one kind
    are leftmost and do not overlap.  A null or empty text has no spans; rows that repeat an id
    each come back; other columns are ignored."""
    def run(batches):
        scan = scanner(rules)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                          ("text", pa.string())])
        for rows, data, offsets in chunks(batches):
            at, bits = scan.marks(data, offsets)
            cut = np.searchsorted(at, offsets)
            out = []
            for i in range(len(offsets) - 1):
                a, b = cut[i], cut[i + 1]
                if a == b:
                    out.append([])
                    continue
                raw = data[offsets[i]:offsets[i + 1]].tobytes()
                lead = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
                points = np.concatenate([[0], np.cumsum(lead)])
                out.append([{"kind": scan.rules[r].kind, "start": int(points[p]),
                             "end": int(points[e]), "text": raw[p:e].decode("utf-8", "replace")}
                            for p, r, e in scan.spans(raw, at[a:b] - offsets[i], bits[a:b])])
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(out, pa.list_(kind))],
                                             names=["doc_id", "spans"])
    return storage.arrow(
        docs.select("doc_id", "text"), run,
        "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint,text:string>>")

