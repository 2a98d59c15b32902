"""MinHash near-dedup with SuperMinHash signatures.

Each element of a document's set of word 5-shingles deals the ranks 0, 1, 2, ... to the slots in a
random order of its own; a slot keeps its least rank + fraction.  Since every element reaches each
slot exactly once, slots are correlated and the estimate varies less than with independent hashes,
and once every slot is below level j no later level can change anything, so the loop stops early
(for documents of some hundred shingles after one or two levels of 64).

Signatures are cut into bands; documents that agree on a band are candidates, their links are
confirmed on the full shingle sets, and linked documents are grouped.

Scale: documents with equal sets are one class before any bucket is built, equal buckets of several
bands are verified once, and a bucket over ``tile`` classes is split into tiles whose pairs are
compared in separate tasks, so neither a hot bucket nor a group of copies lands in one task.  A task
returns only links that span its components, not all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cairn.llm import similarity, storage
from cairn.llm.arrow_text import (LOWER, chunks, hash_spans, mix, ngram_hashes, uniform, words)
from cairn.llm.components import connected_components

SLOTS, BAND_ROWS = 64, 4
SHINGLE_WORDS = 5
PERCENT = 85
TILE = 256
MAX_BROADCAST_IDS = 1 << 20  # 8 MB

_LEVEL = np.uint64(0xD1B54A32D192ED03)
_SIG = "doc_id bigint, print bigint, n bigint, fa bigint, fb bigint, bands array<bigint>"


def superminhash(h: np.ndarray, bounds: np.ndarray, m: int = SLOTS) -> np.ndarray:
    """(sets, m) signatures of the hashed sets ``h[bounds[i]:bounds[i+1]]``; inf for empty ones."""
    n = len(bounds) - 1
    sig = np.full(n * m, np.inf)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    perm = first = None
    for level in range(m):
        if level:
            worst = sig.reshape(n, m).max(axis=1)
            go = (worst > level) & (np.diff(bounds) > 0)
            stay = go[owner]
            if not stay.any():
                break
            if perm is None:
                h, owner, first = h[stay], owner[stay], first[stay]
                perm = np.tile(np.arange(m, dtype=np.uint8), (len(h), 1))
                perm[:, 0] = first
                perm[np.arange(len(h)), first] = 0
            elif not stay.all():
                h, owner, perm = h[stay], owner[stay], perm[stay]
        with np.errstate(over="ignore"):
            x = mix(h + np.uint64(2 * level + 1) * _LEVEL)
        r = uniform(x) + level
        pick = level + (((mix(x) >> np.uint64(32)) * np.uint64(m - level)) >> np.uint64(32)).astype(
            np.int64)
        if level == 0:
            first = slot = pick
        else:
            rows = np.arange(len(h))
            slot = perm[rows, pick].astype(np.int64)
            perm[rows, pick] = perm[:, level]
            perm[:, level] = slot
        np.minimum.at(sig, owner * m + slot, r)
    return sig.reshape(n, m)


def band_keys(sig: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """(sets, bands) 64-bit keys: equal keys mean equal signature values in the band."""
    bits = sig.view(np.uint64).reshape(len(sig), sig.shape[1] // rows, rows)
    key = np.zeros(bits.shape[:2], np.uint64)
    for j in range(rows):
        key = mix(key ^ bits[:, :, j])
    return key


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS):
    """(elements, bounds): each document's distinct word shingles, sorted, A-Z lower-cased."""
    data = LOWER[data]
    start, end, doc = words(data, offsets)
    n_docs = len(offsets) - 1
    flat, bounds = ngram_hashes(hash_spans(data, start, end), doc, n_docs, k)
    sets = [np.unique(flat[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    size = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else flat), np.concatenate([[0], np.cumsum(size)])


def set_prints(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set's elements that tell sets apart; 0 for empty ones."""
    filled = np.diff(bounds) > 0
    fa, fb = np.zeros(len(filled), np.uint64), np.zeros(len(filled), np.uint64)
    if filled.any():
        at = bounds[:-1][filled]
        with np.errstate(over="ignore"):
            fa[filled] = np.add.reduceat(mix(flat), at)
            fb[filled] = np.add.reduceat(mix(flat ^ _LEVEL), at)
    return fa, fb


def _signatures(slots: int, rows_per_band: int, k: int):
    def run(batches):
        for rows, data, offsets in chunks(batches):
            flat, bounds = shingle_sets(data, offsets, k)
            size = np.diff(bounds)
            fa, fb = set_prints(flat, bounds)
            keys = band_keys(superminhash(flat, bounds, slots), rows_per_band)
            width = keys.shape[1]
            bands = pa.ListArray.from_arrays(
                pa.array(np.arange(len(size) + 1, dtype=np.int32) * width),
                pa.array(keys.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("print"), pa.array(size),
                 pa.array(fa.view(np.int64)), pa.array(fb.view(np.int64)), bands],
                names=["doc_id", "print", "n", "fa", "fb", "bands"])
    return run


def _sets(k: int):
    def run(batches):
        for rows, data, offsets in chunks(batches):
            flat, bounds = shingle_sets(data, offsets, k)
            fa, fb = set_prints(flat, bounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.diff(bounds)), pa.array(fa.view(np.int64)), pa.array(fb.view(np.int64)),
                 pa.array([flat[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])],
                          pa.binary())], names=["n", "fa", "fb", "items"])
    return run


def candidate_units(classes: DataFrame, tile: int) -> DataFrame:
    """``unit, node``: the tasks that together compare every two nodes sharing a band.

    ``classes`` has ``node`` and ``bands``.  Buckets with the same members (count, least member and
    sum of hashes agree) are verified once.  A bucket of more than ``tile`` members is dealt into
    tiles by a hash and every pair of tiles is a unit."""
    member = classes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = (member.groupBy("band", "key")
               .agg(F.count("*").alias("size"), F.min("node").alias("least"),
                    F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("print"))
               .where("size > 1")
               .groupBy("size", "least", "print")
               .agg(F.min(F.struct("band", "key")).alias("b"))
               .select("size", F.col("b.band").alias("band"), F.col("b.key").alias("key")))
    tiles = F.ceil(F.col("size") / tile).cast("int")
    mine = F.pmod(F.hash("node"), tiles)
    rows = member.join(buckets, ["band", "key"]).select(
        "band", "key", "node", mine.alias("mine"),
        F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"))
    return rows.select(F.xxhash64("band", "key", F.least("mine", "other"),
                                  F.greatest("mine", "other")).alias("unit"), "node")


def _grouped(docs: DataFrame, percent: int, k: int, slots: int, band_rows: int,
             tile: int) -> DataFrame:
    """Per row ``doc_id, print, n, group, component``: ``print`` hashes the text, ``group`` names the
    component of the row's set (null for an empty one, and where only null ids have the set), and
    ``component`` is its least doc_id.  Nodes are the distinct sets, not the ids: a doc_id that
    recurs with another text is another node."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    printed = docs.withColumn("print", F.xxhash64(F.coalesce("text", F.lit(""))))
    sigs = storage.materialize(storage.arrow(printed, _signatures(slots, band_rows, k), _SIG),
                               "near-sigs")
    node = F.xxhash64("n", "fa", "fb")
    classes = storage.materialize(
        sigs.where("n > 0 and doc_id is not null").groupBy("n", "fa", "fb")
        .agg(F.min(F.struct("doc_id", "bands")).alias("r"))
        .select(node.alias("node"), F.col("r.doc_id").alias("least"),
                F.col("r.bands").alias("bands")), "near-classes")
    units = storage.materialize(candidate_units(classes, tile), "near-units")
    wanted = storage.materialize(
        classes.join(units.select("node").distinct(), "node", "left_semi")
        .select(F.col("least").alias("doc_id")).distinct(), "near-ids")
    if wanted.count() <= MAX_BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    sets = storage.arrow(docs.join(wanted, "doc_id", "left_semi"), _sets(k),
                         "n bigint, fa bigint, fb bigint, items binary")
    dealt = (sets.where("n > 0").select(node.alias("node"), "items").join(units, "node")
             .repartition(storage.shuffle_partitions(spark), "unit").sortWithinPartitions("unit")
             .select("unit", "node", "items"))
    comps = connected_components(
        storage.arrow(dealt, similarity.unit_links(percent), "a bigint, b bigint"))
    member = classes.select("node", "least").join(comps, "node", "left").select(
        "node", "least", F.col("component").alias("group"))
    linked = member.where(F.col("group").isNotNull())
    first = linked.groupBy("group").agg(F.min("least").alias("component"))
    grouped = (linked.join(first, "group").select("node", "group", "component")
               .unionByName(member.where(F.col("group").isNull()).select(
                   "node", F.col("node").alias("group"), F.col("least").alias("component"))))
    rows = sigs.select("doc_id", "print", "n", F.when(F.col("n") > 0, node).alias("at"))
    return rows.join(grouped, rows["at"] == grouped["node"], "left").select(
        "doc_id", "print", "n", "group", F.coalesce("component", "doc_id").alias("component"))


def near_groups(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE_WORDS,
                slots: int = SLOTS, band_rows: int = BAND_ROWS, tile: int = TILE) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents whose sets have 100 * |A & B| >= percent * |A | B| are linked, ``component_id`` is
    the least doc_id reachable.  Fewer than ``k`` words are one shingle; a null text or one without
    words has an empty set and no link.  Every row of a doc_id that recurs is linked by its own
    text; a row with a null doc_id makes no link and takes the component of an equal set, if any.
    At the defaults a pair at the threshold shares a band with probability 1 - (1 - .85**4)**16 =
    .999993, at 80 percent .9998."""
    return _grouped(docs, percent, k, slots, band_rows, tile).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"))


def near_dedup(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE_WORDS,
               slots: int = SLOTS, band_rows: int = BAND_ROWS, tile: int = TILE) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with the least doc_id, and of
    several texts under that id the one whose hash is least.  Rows are told apart by doc_id and
    text, so a text that is near no other stays whatever its id; documents with a null doc_id
    stay."""
    found = _grouped(docs, percent, k, slots, band_rows, tile).where(
        "doc_id is not null and group is not null")
    found = storage.materialize(found.select("doc_id", "print", "group", "component").distinct(),
                                "near-groups")
    first = found.where("doc_id = component")
    several = (first.groupBy("group").agg(F.min("print").alias("keep"), F.max("print").alias("last"))
               .where("keep <> last").select("group", "keep"))
    drop = (found.where("doc_id <> component").select("doc_id", "print")
            .unionByName(first.join(several, "group").where("print <> keep")
                         .select("doc_id", "print")).distinct())
    drop = drop.toDF(*storage.fresh_names(docs, "near_id", "near_print"))
    ident, text = (F.col(c) for c in drop.columns)
    mine = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(drop, (docs["doc_id"] == ident) & (mine == text), "left_anti")
