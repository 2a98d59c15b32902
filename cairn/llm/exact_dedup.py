"""Exact dedup over an extendible-hash index kept on shared files.

Texts are equal when their bytes agree after deleting ``[\\x20\\x09-\\x0D]``.  The index maps the
leading bits of a 64-bit key to buckets through a directory: it starts with one bucket and doubles
whenever an overfull bucket already uses all directory bits, so a bucket owns one key range.
Owner tasks read their buckets' records sorted by key, chain records of equal keys and compare
their bytes; the index entry of a record is (bucket, key, chain number).

Scale: a task forwards a text once however many copies it holds, so a hot group sends one record
per task; group sizes and winners are summed by Spark's partial aggregates over rows without
texts.  The directory is built on the driver from a histogram of key prefixes with at most
8 * max(records / bucket_records, 1) entries, never from the keys.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cairn.llm import storage
from cairn.llm.arrow_text import SPACES, chunks

_ENTRY = "doc_id bigint, n_chars bigint, key bigint, prefix int, sha string, body binary"
_INDEX = "bucket int, key bigint, chain int, sha string"
_SEEN = 1 << 16  # digests a task remembers to forward a repeated text once
_PREFIX_BITS = 30


def key_of(digest: bytes, bits: int = 64) -> int:
    """The index key: the first ``bits`` bits of the digest, left-aligned in 64 bits."""
    k = int.from_bytes(digest[:8], "big")
    return k >> (64 - bits) << (64 - bits)


def _entries(bits: int):
    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("key", pa.int64()),
                            ("prefix", pa.int32()), ("sha", pa.string()), ("body", pa.binary())])
        seen: set[bytes] = set()
        for rows, _, _ in chunks(batches, size=4 << 20):
            keys, prefixes, shas, bodies = [], [], [], []
            for raw in rows.column("text").cast(pa.binary()).to_pylist():
                body = (raw or b"").translate(None, SPACES)
                digest = hashlib.sha256(body).digest()
                key = key_of(digest, bits)
                keys.append(key - (1 << 64) if key >> 63 else key)
                prefixes.append(key >> (64 - _PREFIX_BITS))
                shas.append(digest.hex())
                if digest in seen:
                    bodies.append(None)
                else:
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add(digest)
                    bodies.append(body)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("n_chars"), pa.array(keys, pa.int64()),
                 pa.array(prefixes, pa.int32()), pa.array(shas, pa.string()),
                 pa.array(bodies, pa.binary())], schema=schema)
    return run


def build_directory(counts: np.ndarray, capacity: int) -> tuple[int, np.ndarray]:
    """(depth, bucket of each directory slot) from the record counts of the 2**p key prefixes.

    A bucket over ``capacity`` splits on its next key bit; the directory doubles when that bucket
    already used every directory bit.  A bucket of a single prefix cannot split: it is chained."""
    p = int(math.log2(len(counts)))
    total = np.concatenate([[0], np.cumsum(counts)])
    depth, todo, done = 0, [(0, 0)], []
    while todo:
        prefix, local = todo.pop()
        lo, hi = prefix << (p - local), (prefix + 1) << (p - local)
        if total[hi] - total[lo] > capacity and local < p:
            depth = max(depth, local + 1)  # the directory doubles
            todo += [(2 * prefix, local + 1), (2 * prefix + 1, local + 1)]
        else:
            done.append((lo, hi))
    slots = np.zeros(1 << depth, np.int32)
    for bucket, (lo, hi) in enumerate(sorted(done)):
        slots[lo >> (p - depth):max(hi >> (p - depth), (lo >> (p - depth)) + 1)] = bucket
    return depth, slots


def _owner(batches):
    """Records of whole buckets, sorted by (bucket, key): chain equal keys, compare bytes."""
    at, chain = None, []
    for rows, _, _ in chunks(batches, "body", 4 << 20):
        out = ([], [], [], [])
        for bucket, key, sha, body in zip(*(rows.column(c).to_pylist()
                                            for c in ("bucket", "key", "sha", "body"))):
            if (bucket, key) != at:
                at, chain = (bucket, key), []
            if body not in chain:
                chain.append(body)
                for column, value in zip(out, (bucket, key, len(chain) - 1, sha)):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()),
             pa.array(out[2], pa.int32()), pa.array(out[3], pa.string())],
            names=["bucket", "key", "chain", "sha"])


def build_index(docs: DataFrame, bucket_records: int = 512, key_bits: int = 64):
    """(entries, index) tables on the shared folder: one entry per document and one index row
    (bucket, key, chain, sha) per distinct text.

    ``bucket_records`` is a bucket's capacity; beyond 2**16 buckets it grows so the directory
    stays near 2**16 slots.  ``key_bits`` < 64 makes keys collide (for tests)."""
    spark = docs.sparkSession
    src = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("bigint")
                      .alias("n_chars"), "text")
    entries = storage.materialize(storage.arrow(src, _entries(key_bits), _ENTRY), "dedup-entries")
    records = entries.where(F.col("body").isNotNull())
    n = records.count()
    capacity = max(bucket_records, n >> 16)
    p = min(_PREFIX_BITS, max(1, math.ceil(math.log2(max(2, n / capacity))) + 2))
    slot = F.shiftright("prefix", _PREFIX_BITS - p)
    histogram = records.groupBy(slot.alias("slot")).count().toPandas()
    counts = np.zeros(1 << p, np.int64)
    counts[histogram["slot"].to_numpy(np.int64)] = histogram["count"].to_numpy(np.int64)
    depth, slots = build_directory(counts, capacity)
    directory = spark.createDataFrame(  # 2**depth slots, bounded above
        [(i, int(b)) for i, b in enumerate(slots)], "slot int, bucket int")
    owned = (records.withColumn("slot", F.shiftright("prefix", _PREFIX_BITS - depth))
             .join(F.broadcast(directory), "slot")
             .select("bucket", "key", "sha", "body")
             .repartition(storage.shuffle_partitions(spark), "bucket")
             .sortWithinPartitions("bucket", "key"))
    return entries, storage.materialize(storage.arrow(owned, _owner, _INDEX), "dedup-index")


def exact_groups(docs: DataFrame, bucket_records: int = 512, key_bits: int = 64) -> DataFrame:
    """One row per document: ``doc_id, n_chars, text_sha256, keep_id, group_size, kept``.

    Of equal texts the one with the most code points stays, then the smallest doc_id (null ids
    last).  A null text equals an empty one.  Rows that repeat a doc_id with an equal text count
    as members of the group, and each comes back; all of them are ``kept`` if their id is the
    keeper's.  Other columns of ``docs`` are ignored; an empty table gives an empty result."""
    entries, index = build_index(docs, bucket_records, key_bits)
    best = F.struct((-F.col("n_chars")).alias("short"), F.col("doc_id").isNull().alias("anon"),
                    F.col("doc_id"))
    stats = (entries.groupBy("key", "sha").agg(F.count("*").alias("n"), F.min(best).alias("best"))
             .join(index.select("key", "sha", "chain"), ["key", "sha"]))
    groups = stats.groupBy("key", "chain").agg(F.sum("n").alias("group_size"),
                                               F.min("best").alias("best"))
    members = stats.select("key", "sha", "chain").join(
        groups.select("key", "chain", "group_size", F.col("best.doc_id").alias("keep_id")),
        ["key", "chain"]).select("key", "sha", "group_size", "keep_id")
    return entries.select("doc_id", "n_chars", "key", "sha").join(members, ["key", "sha"]).select(
        "doc_id", "n_chars", F.col("sha").alias("text_sha256"), "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"))


def exact_dedup(docs: DataFrame, bucket_records: int = 512) -> DataFrame:
    """``docs`` without the documents whose text equals a kept one; all columns stay.

    Rows that share both doc_id and text are one document, of which one row stays; a null doc_id
    counts as one id."""
    by = storage.fresh_names(docs, "dedup_id", "dedup_sha")
    ident = F.coalesce(docs["doc_id"], F.lit(-(1 << 63)))
    keep = (exact_groups(docs, bucket_records).where("kept")
            .select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias(by[0]),
                    F.col("text_sha256").alias(by[1])).distinct())
    body = F.regexp_replace(F.coalesce(docs["text"], F.lit("")), r"[\x20\x09-\x0D]", "")
    keyed = docs.withColumns({by[0]: ident, by[1]: F.sha2(body, 256)})
    return keyed.join(keep, by, "left_semi").dropDuplicates(by).drop(*by)
