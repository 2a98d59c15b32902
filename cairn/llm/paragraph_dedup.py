"""Substring dedup by paragraph MinHash banding and repeated word windows.

Paragraphs are lines.  Their word 5-shingles get short SuperMinHash signatures whose every value is
a band (the tuning for recall: a pair at similarity s shares one of b bands of one value with
probability 1 - (1 - s)**b, .9997 at s = .8 and b = 5); colliding paragraphs are joined, verified by
the exact Jaccard similarity of their shingle sets and grouped by connected components.

A passage may also stand inside longer paragraphs that differ around it, or in many short lines.  A
document's whole word sequence, regardless of line feeds, is therefore searched for windows of
``min_words`` words that another document has too; the words of all such windows are repeats, so a
passage is covered from its first word to its last.  In every window the first least hash of its
runs of SEED_WORDS words is a seed: equal windows have equal seeds.  A seed is shared if at least
two documents have it.  If all its occurrences go on alike up to the next seed (or come alike from
the one before), the words between are a repeat and need no windows; the windows that are not settled
by walking so from their seed to both ends, those around the ends of passages, are hashed and
counted one by one.  All documents with a window take the same walk, so they decide alike.

Words are repeats if their window, their words between seeds or the component of their paragraph
has occurrences in at least two documents; they stay in the one with the least doc_id and are
removed from the others.  Adjacent repeats make spans, reported from ``min_words`` words on or if
they hold a whole repeated paragraph.  Repeats inside one document only are left alone.

Scale: classes are aggregated before any join; bands exist per distinct paragraph; a bucket is split
into tiles as for documents; texts move once, to their own shared seeds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cairn.llm import similarity, storage
from cairn.llm.arrow_text import (LOWER, _power_tables, chunks, hash_spans, mix, ngram_hashes,
                                  words)
from cairn.llm.components import connected_components
from cairn.llm.superminhash import (MAX_BROADCAST_IDS, band_keys, candidate_units, superminhash)

BANDS, SHINGLE_WORDS, PERCENT = 5, 5, 80
LINE_WORDS = 8      # shorter lines have no bands; their words still count in windows
SEED_WORDS = 6
MIN_WORDS = 16
TILE = 256
_AT = ("doc_id", "body", "lo", "hi", "start", "end", "before", "after")
_SPAN = ("doc_id bigint, body bigint, lo int, hi int, start int, end int, before int, after int")
_LINES = _SPAN + ", line bigint, bands array<bigint>"
_SEEDS = "fp bigint, doc_id bigint"
_COVER = _SPAN + ", class bigint, keep bigint"
_RESULT = ("doc_id bigint, start int, end int, n_words bigint, removed boolean, keep_doc_id bigint")


class RunHasher:
    """64-bit hashes of runs of words, from prefix sums that are made once."""

    def __init__(self, h: np.ndarray):
        up, self.down = _power_tables(len(h) + 1)
        self.prefix = np.zeros(len(h) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(mix(h) * up[:len(h)], out=self.prefix[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.prefix[end] - self.prefix[start]) * self.down[start]
                       + (end - start).astype(np.uint64))


class Paragraphs:
    """Words and lines of a chunk: words [line_lo, line_hi) of every line with a word, words
    [first, last) of every document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = LOWER[data]
        self.start, self.end, self.doc = words(data, offsets)
        n = len(self.start)
        self.h = hash_spans(data, self.start, self.end)
        feeds = np.cumsum(data == 10)
        head = np.ones(n, bool)
        if n:
            row = feeds[self.start]
            head[1:] = (row[1:] != row[:-1]) | (self.doc[1:] != self.doc[:-1])
        self.line_lo = np.flatnonzero(head)
        self.line_hi = np.concatenate([self.line_lo[1:], [n]]) if n else self.line_lo
        self.line = np.cumsum(head) - 1
        at = np.searchsorted(self.doc, np.arange(len(offsets)))
        self.first, self.last = at[:-1], at[1:]
        self.points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        self.base = self.points[offsets[:-1]]
        self.runs = RunHasher(self.h)
        self.body = self.runs(self.first, self.last).view(np.int64)

    def seeds(self, k: int, size: int):
        """(position of a seed, hash of its k words, starts of all windows of ``size`` words, the
        number of each window's seed among the seeds)."""
        n, width = len(self.h), size - k + 1
        at = np.arange(n - size + 1)
        start = at[at + size <= self.last[self.doc[:len(at)]]]
        if not len(start):
            return start, np.zeros(0, np.uint64), start, start
        pick = np.arange(n - k + 1)
        value = best = self.runs(pick, pick + k)
        have = 1
        while have < width:  # the first least of ``have`` values, doubled
            step = min(have, width - have)
            less = best[step:] < best[:-step]
            pick = np.where(less, pick[step:], pick[:-step])
            best = np.where(less, best[step:], best[:-step])
            have += step
        chosen = np.zeros(len(value), bool)
        chosen[pick[start]] = True
        pos = np.flatnonzero(chosen)
        return pos, value[pos], start, (np.cumsum(chosen) - 1)[pick[start]]

    def spans(self, ids, lo: np.ndarray, hi: np.ndarray) -> list:
        """Columns ``_AT`` of the runs of words [lo, hi), none across documents."""
        doc = self.doc[lo]
        base = self.base[doc]

        def point(at):
            return pa.array((self.points[at] - base).astype(np.int32))

        first, last = self.first[doc], self.last[doc]
        before = np.where(lo > first, self.end[lo - 1], self.start[lo])
        after = np.where(hi < last, self.start[np.minimum(hi, len(self.start) - 1)],
                         self.end[hi - 1])
        return [ids.take(pa.array(doc)), pa.array(self.body[doc]),
                pa.array((lo - first).astype(np.int32)), pa.array((hi - first).astype(np.int32)),
                point(self.start[lo]), point(self.end[hi - 1]), point(before), point(after)]


def _lines(bands: int, k: int):
    """The lines with bands."""
    def run(batches):
        for rows, data, offsets in chunks(batches):
            p = Paragraphs(data, offsets)
            long_ = p.line_hi - p.line_lo >= LINE_WORDS
            if not long_.any():
                continue
            flat, bounds = ngram_hashes(p.h, p.line, len(p.line_lo), k)
            pick = np.repeat(long_, np.diff(bounds))
            size = np.diff(bounds)[long_]
            sig = superminhash(flat[pick], np.concatenate([[0], np.cumsum(size)]), bands)
            keys = band_keys(sig, 1).view(np.int64)
            lo, hi = p.line_lo[long_], p.line_hi[long_]
            yield pa.RecordBatch.from_arrays(
                [*p.spans(rows.column("doc_id"), lo, hi),
                 pa.array(p.runs(lo, hi).view(np.int64)),
                 pa.ListArray.from_arrays(
                     pa.array(np.arange(len(lo) + 1, dtype=np.int32) * keys.shape[1]),
                     pa.array(keys.ravel()))], names=[*_AT, "line", "bands"])
    return run


def _seeds(k: int, size: int, around: bool):
    """Every seed and, if ``around``, the words up to the seed before and after it, hashed (0 if
    there is none)."""
    def run(batches):
        for rows, data, offsets in chunks(batches):
            p = Paragraphs(data, offsets)
            pos, fp, _, _ = p.seeds(k, size)
            if not len(pos):
                continue
            doc = p.doc[pos]
            columns = [pa.array(fp.view(np.int64)), rows.column("doc_id").take(pa.array(doc))]
            if not around:
                yield pa.RecordBatch.from_arrays(columns, names=["fp", "doc_id"])
                continue
            near = doc[1:] == doc[:-1]
            between = np.zeros(len(near), np.int64)
            between[near] = p.runs(pos[:-1][near], pos[1:][near] + k).view(np.int64)
            none = np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.concatenate([none, between])),
                 pa.array(np.concatenate([between, none]))],
                names=["fp", "doc_id", "prev", "next"])
    return run


def _cover(k: int, size: int):
    """Rows (doc_id, text, shared seeds) -> the repeats between seeds, with ``keep``, and the
    windows that their seeds do not settle, with ``class``."""
    def run(batches):
        for rows, data, offsets in chunks(batches):
            p = Paragraphs(data, offsets)
            pos, fp, start, own = p.seeds(k, size)
            if not len(pos):
                continue
            doc = p.doc[pos]
            found = rows.column("found")
            owner = np.repeat(np.arange(rows.num_rows), found.value_lengths().to_numpy())
            found = found.flatten()
            with np.errstate(over="ignore"):
                known = mix(found.field("fp").to_numpy().view(np.uint64)
                            + mix(owner.astype(np.uint64)))
                mine = mix(fp + mix(doc.astype(np.uint64)))
            order = np.argsort(known)
            at = order[np.minimum(np.searchsorted(known[order], mine), len(known) - 1)]
            shared = known[at] == mine
            keep = found.field("seed_keep").to_numpy()[at]
            left = shared & found.field("left").to_numpy(zero_copy_only=False)[at]
            right = shared & found.field("right").to_numpy(zero_copy_only=False)[at]

            top = np.iinfo(np.int64).max
            stays = np.minimum(np.where(right[:-1], keep[:-1], top),
                               np.where(left[1:], keep[1:], top))
            covered = (doc[1:] == doc[:-1]) & (right[:-1] | left[1:])
            runs = covered.copy()
            runs[1:] &= ~(covered[:-1] & (stays[1:] == stays[:-1]))
            head = np.flatnonzero(runs)
            tails = covered.copy()
            tails[:-1] &= ~covered[1:] | runs[1:]
            tail = np.flatnonzero(tails)

            # From a window's own seed on, only seeds that every document with the window has.
            a = np.minimum(np.searchsorted(pos, start, "right"), own + 1)
            b = np.maximum(np.searchsorted(pos, start + size - k), own)
            lefts = np.concatenate([[0], np.cumsum(~left)])
            rights = np.concatenate([[0], np.cumsum(~right)])
            settled = (lefts[own + 1] == lefts[a]) & (rights[b] == rights[own])
            open_ = start[shared[own] & ~settled]
            lo = np.concatenate([pos[head], open_])
            if not len(lo):
                continue
            hi = np.concatenate([pos[tail + 1] + k, open_ + size])
            window = np.arange(len(lo)) >= len(head)
            classes = p.runs(lo, hi).view(np.int64)
            kept = np.concatenate([stays[head], np.zeros(len(open_), np.int64)])
            yield pa.RecordBatch.from_arrays(
                [*p.spans(rows.column("doc_id"), lo, hi), pa.array(classes, mask=~window),
                 pa.array(kept, mask=window)], names=[*_AT, "class", "keep"])
    return run


def _united(spans):
    """Overlapping and adjacent spans made one: [lo, hi, start, end, before, after, keep, whole]."""
    out = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1]:
            last = out[-1]
            if s[1] > last[1]:
                last[1], last[3], last[5] = s[1], s[3], s[5]
            last[6], last[7] = min(last[6], s[6]), last[7] or s[7]
        else:
            out.append(list(s))
    return out


def _islands(doc_id: int, spans: list[tuple], min_words: int):
    """(start, end, words, removed, keep) of one document's repeats.  Words that both stay and go
    go; what stays is reported around them."""
    gone = [s for s in _united(s for s in spans if s[6] < doc_id)
            if s[1] - s[0] >= min_words or s[7]]
    yield from ((s[2], s[3], s[1] - s[0], True, s[6]) for s in gone)
    i = 0
    for lo, hi, start, end, _, _, keep, whole in _united(s for s in spans if s[6] == doc_id):
        if hi - lo < min_words and not whole:
            continue
        while i and gone[i - 1][1] > lo:
            i -= 1
        while i < len(gone) and gone[i][0] < hi:
            g = gone[i]
            if g[0] > lo:
                yield start, g[4], g[0] - lo, False, keep
            if g[1] > lo:
                lo, start = g[1], g[5]
            i += 1
        if lo < hi:
            yield start, end, hi - lo, False, keep


def _report(min_words: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            lists = batch.column(1)
            flat = lists.flatten()
            cols = [flat.field(c).to_pylist() for c in (*_AT[2:], "keep", "whole")]
            rows = list(zip(*cols))
            out, at = [], 0
            for doc_id, n in zip(ids, lists.value_lengths().to_pylist()):
                out += [(doc_id, *x) for x in _islands(doc_id, rows[at:at + n], min_words)]
                at += n
            yield pa.RecordBatch.from_pylist([dict(zip(_OUT.names, x)) for x in out], schema=_OUT)
    return run


_OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                  ("n_words", pa.int64()), ("removed", pa.bool_()), ("keep_doc_id", pa.int64())])


def _line_sets(k: int, wanted: np.ndarray | None):
    """(node, items): shingle sets of the wanted paragraphs (all with bands if none are named)."""
    def run(batches):
        for _, data, offsets in chunks(batches):
            p = Paragraphs(data, offsets)
            if not len(p.line_lo):
                continue
            node = p.runs(p.line_lo, p.line_hi).view(np.int64)
            ok = p.line_hi - p.line_lo >= LINE_WORDS
            if wanted is not None and len(wanted):
                ok &= wanted[np.minimum(np.searchsorted(wanted, node), len(wanted) - 1)] == node
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            flat, bounds = ngram_hashes(p.h, p.line, len(p.line_lo), k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[at]), pa.array([np.unique(flat[bounds[i]:bounds[i + 1]]).tobytes()
                                               for i in at], pa.binary())], names=["node", "items"])
    return run


def repeated_spans(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS,
                   k: int = SHINGLE_WORDS, min_words: int = MIN_WORDS, tile: int = TILE,
                   whole_words: int = LINE_WORDS) -> DataFrame:
    """``doc_id, start, end, n_words, removed, keep_doc_id``: the repeated spans of all documents,
    in code points, end exclusive.

    Spans have at least ``min_words`` words, whole paragraphs near-equal to another document's at
    least ``whole_words``.  ``keep_doc_id`` is the least document that a part of the span stays in, ``removed`` is false in
    that document itself.  Documents without repeats have no row, nor have null and empty texts and
    rows with a null doc_id; rows that share a doc_id are one document, whose equal spans come back
    once.  Letters A-Z compare without case."""
    spark = docs.sparkSession
    n = storage.shuffle_partitions(spark)
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    lines = storage.materialize(storage.arrow(docs, _lines(bands, k), _LINES), "passage-lines")

    # Paragraph classes: colliding ones verified, components over the links.
    classes = storage.materialize(
        lines.groupBy(F.col("line").alias("node"))
        .agg(F.first("bands").alias("bands"), F.min("doc_id").alias("lo"),
             F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n")), "passage-classes")
    units = storage.materialize(candidate_units(classes.select("node", "bands"), tile),
                                "passage-units")
    ids = storage.materialize(units.select("node").distinct(), "passage-ids")
    storage.release(spark)
    wanted = None
    if ids.count() <= MAX_BROADCAST_IDS:
        wanted = np.sort(ids.toPandas()["node"].to_numpy(np.int64))  # at most 8 MB
    sets = (storage.arrow(docs, _line_sets(k, wanted), "node bigint, items binary")
            .join(ids, "node", "left_semi").groupBy("node").agg(F.first("items").alias("items")))
    dealt = (sets.join(units, "node").repartition(n, "unit").sortWithinPartitions("unit")
             .select("unit", "node", "items"))
    comps = connected_components(
        storage.arrow(dealt, similarity.unit_links(percent), "a bigint, b bigint"))
    storage.release(spark)
    per = classes.select("node", "lo", "hi", "n").join(comps, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    groups = per.groupBy("component").agg(F.min("lo").alias("keep"), F.max("hi").alias("hi")).where(
        "keep < hi").select("component", "keep")
    line_keep = storage.materialize(
        per.select("node", "component", "n").join(groups, "component").select(
            F.col("node").alias("line"), "keep", "n"), "passage-line-keep")
    storage.drop(units, ids, classes, comps)

    # Seeds in at least two documents, and whether all their occurrences go on alike.
    if min_words < 1:
        raise ValueError("min_words must be positive")
    seed = min(SEED_WORDS, min_words)
    seeds = storage.arrow(docs, _seeds(seed, min_words, True),
                          _SEEDS + ", prev bigint, next bigint")
    shared = storage.materialize(
        seeds.groupBy("fp").agg(
            F.min("doc_id").alias("seed_keep"), F.max("doc_id").alias("hi"),
            F.min("prev").alias("p"), F.max("prev").alias("q"),
            F.min("next").alias("r"), F.max("next").alias("s"))
        .where("seed_keep < hi")
        .select("fp", "seed_keep", F.expr("p = q and p <> 0").alias("left"),
                F.expr("r = s and r <> 0").alias("right")), "passage-seeds")
    storage.release(spark)
    found = (storage.arrow(docs, _seeds(seed, min_words, False), _SEEDS).join(shared, "fp")
             .groupBy("doc_id").agg(F.collect_list(F.struct("fp", "seed_keep", "left", "right"))
                                    .alias("found")))
    cover = storage.materialize(
        storage.arrow(docs.join(found, "doc_id").select("doc_id", "text", "found"),
                      _cover(seed, min_words), _COVER), "passage-cover")
    storage.drop(shared)
    storage.release(spark)
    window_keep = storage.materialize(
        cover.where("class is not null").groupBy("class")
        .agg(F.min("doc_id").alias("keep"), F.max("doc_id").alias("hi"),
             F.count(F.lit(1)).alias("n"))
        .where("keep < hi").select("class", "keep", "n"), "passage-window-keep")
    at = [*_AT, "keep"]
    repeats = (cover.where("class is null").select(*at)
               .unionByName(storage.spread_join(cover.where("class is not null").drop("keep"),
                                                window_keep, "class").select(*at))
               .withColumn("whole", F.lit(False))
               .unionByName(storage.spread_join(lines.drop("bands"), line_keep, "line")
                            .select(*at).withColumn("whole", F.col("hi") - F.col("lo")
                                                    >= whole_words)))
    spans = (repeats.groupBy("doc_id", "body")
             .agg(F.collect_list(F.struct(*_AT[2:], "keep", "whole")).alias("spans"))
             .select("doc_id", "spans"))
    return storage.arrow(spans, _report(min_words), _RESULT).distinct()


def drop_repeats(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with the removed spans cut out of their texts (the white space around a span stays);
    other columns and documents without removed spans are unchanged."""
    ident, held, cut_text = storage.fresh_names(docs, "span_id", "spans", "cut_text")
    spans = (repeated_spans(docs, **settings).where("removed").groupBy(F.col("doc_id").alias(ident))
             .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(held)))
    joined = docs.join(spans, docs["doc_id"] == spans[ident], "left")
    text = docs["text"]
    edges = F.concat(F.array(F.lit(0)), F.transform(held, lambda s: s["end"]))
    pieces = F.zip_with(edges, F.concat(F.transform(held, lambda s: s["start"]),
                                        F.array(F.length(text))),
                        lambda a, b: F.substring(text, a + 1, b - a))
    cut = F.when(F.col(held).isNull(), text).otherwise(F.array_join(pieces, ""))
    return joined.withColumn(cut_text, cut).select(
        *[F.col(cut_text).alias("text") if c == "text" else docs[c] for c in docs.columns])
