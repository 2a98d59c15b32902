"""Language ID with language-bitmask n-gram filters.

A Bloom filter whose cells are bit masks, one bit per language: testing an n-gram combines the
masks of its cells with AND and returns all languages that contain it at once.  A text's n-grams
give one count per language; the count expected from false positives, known from the share of
cells with the language's bit, is taken off, and the language with the most n-grams left is the
prediction.

N-grams are runs of four bytes of the text with A-Z lower-cased and white space and digits made
one class, so a word's start and end count.  Which n-grams a language contains is decided by
their rates per n-gram occurrence, so documents of any length compare.  The rate of a language with
few documents is shrunk towards the mean rate of all (a language weighs as many as it has documents),
as if it had PRIOR_DOCS documents more of that kind: one long text, perhaps under a wrong label, neither claims its rare n-grams nor takes
n-grams from others.  A language contains an n-gram if its shrunk rate gives at least ``min_share``
occurrences in a text of mean length, and its own rate is at least ``min_ratio`` of the highest
shrunk rate in any language.  Both tests are rates, so the filter behaves alike at every corpus
size, and its number of n-grams per language is bounded by the mean number of n-grams of a document
divided by ``min_share``, not by the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cairn.llm import storage
from cairn.llm.arrow_text import IS_SPACE, LOWER, chunks, mix

MIN_SHARE, MIN_RATIO = 0.01, 0.3
PRIOR_DOCS = 10
CELLS_PER_GRAM, PROBES = 16, 3
MAX_GRAMS = 1 << 22  # documented bound of the collected filter entries, 64 MB

# Byte classes: lower case, one space class, one class for digits.
_FOLD = LOWER.copy()
_FOLD[IS_SPACE] = 32
_FOLD[48:58] = 48
_HELD = 500_000  # counts a task holds per language before it merges them
_SALT = np.uint64(0xA0761D6478BD642F)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram, document) of every run of four bytes of a document with a space put on either side;
    runs of white space, digits or both do not count."""
    n_docs = len(offsets) - 1
    b = np.full(len(data) + 2 * n_docs, 32, np.uint32)
    pad = 2 * np.arange(n_docs + 1)
    b[np.arange(len(data)) + np.repeat(pad[:-1] + 1, np.diff(offsets))] = _FOLD[data]
    offsets = offsets + pad
    n = len(b) - 3
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    g = (b[:n] << 24) | (b[1:n + 1] << 16) | (b[2:n + 2] << 8) | b[3:]
    inside = np.ones(len(b), bool)
    for k in (1, 2, 3):
        cut = offsets[1:-1] - k
        inside[cut[cut >= 0]] = False
    plain = (b == 32) | (b == 48)
    inside[:n] &= ~(plain[:n] & plain[1:n + 1] & plain[2:n + 2] & plain[3:])
    at = np.flatnonzero(inside[:n])
    return g[at], np.searchsorted(offsets, at, "right") - 1


def cells(gram: np.ndarray, n_cells: int, probes: int) -> list[np.ndarray]:
    """The filter cells of each gram (``n_cells`` is a power of two): double hashing."""
    h = mix(gram.astype(np.uint64) ^ _SALT)
    a, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return [((a + np.uint64(i) * step) & np.uint64(n_cells - 1)).astype(np.int64)
            for i in range(probes)]


def _occurrences(batches):
    """(lang, gram, n): occurrences of every gram in a task's documents."""
    held: dict[str, list[np.ndarray]] = {}
    size: dict[str, int] = {}

    def merged(parts):
        g = np.concatenate([p[0] for p in parts])
        c = np.concatenate([p[1] for p in parts])
        keys, inverse = np.unique(g, return_inverse=True)
        return keys, np.bincount(inverse, weights=c).astype(np.int64)

    for rows, data, offsets in chunks(batches):
        gram, doc = grams(data, offsets)
        langs = rows.column("lang").to_pylist()
        names = sorted(set(langs))
        index = {x: i for i, x in enumerate(names)}
        code = np.array([index[x] for x in langs], np.uint64)
        pair, count = np.unique((code[doc] << np.uint64(32)) | gram, return_counts=True)
        at = np.searchsorted(pair, np.arange(len(names) + 1, dtype=np.uint64) << np.uint64(32))
        for i, lang in enumerate(names):
            keys, n = pair[at[i]:at[i + 1]].astype(np.uint32), count[at[i]:at[i + 1]]
            held.setdefault(lang, []).append((keys, n))
            size[lang] = size.get(lang, 0) + len(keys)
            if size[lang] > _HELD + len(held[lang][0][0]):
                held[lang] = [merged(held[lang])]
                size[lang] = len(held[lang][0][0])
    for lang, parts in held.items():
        keys, n = merged(parts)
        for lo in range(0, len(keys), 100_000):
            k = keys[lo:lo + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(k)), pa.array(k.astype(np.int64)),
                 pa.array(n[lo:lo + 100_000].astype(np.int64))], names=["lang", "gram", "n"])


def _lengths(batches):
    """(lang, docs, occ): documents and grams of every language of a chunk."""
    for rows, data, offsets in chunks(batches):
        _, doc = grams(data, offsets)
        size = np.bincount(doc, minlength=len(offsets) - 1)
        docs: dict[str, int] = {}
        occ: dict[str, int] = {}
        for lang, n in zip(rows.column("lang").to_pylist(), size.tolist()):
            docs[lang] = docs.get(lang, 0) + 1
            occ[lang] = occ.get(lang, 0) + n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(docs), pa.string()), pa.array(list(docs.values()), pa.int64()),
             pa.array(list(occ.values()), pa.int64())], names=["lang", "docs", "occ"])


class LanguageFilter:
    """``langs`` by code point, ``masks`` (cells x words of 64 languages), the share of set bits
    of each language and the language with most training documents (the answer without evidence).
    """

    def __init__(self, langs: list[str], totals: list[int], entries: list[np.ndarray],
                 probes: int = PROBES):
        self.langs, self.probes = langs, probes
        self.totals = np.array(totals, np.int64)
        self.fallback = max(range(len(langs)), key=lambda i: (totals[i], -i)) if langs else -1
        total = max(1, sum(map(len, entries)))
        self.n_cells = 1 << max(6, int(total * CELLS_PER_GRAM - 1).bit_length())
        self.masks = np.zeros((self.n_cells, -(-max(1, len(langs)) // 64)), np.uint64)
        for i, gram in enumerate(entries):
            for cell in cells(gram, self.n_cells, probes):
                self.masks[cell, i // 64] |= np.uint64(1 << (i % 64))
        self.false_rate = np.array([
            ((self.masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() ** probes
            for i in range(len(langs))])

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(documents, languages): contained n-grams less the expected false positives."""
        gram, doc = grams(data, offsets)
        n_docs = len(offsets) - 1
        at = cells(gram, self.n_cells, self.probes)
        mask = self.masks[at[0]]
        for cell in at[1:]:
            mask &= self.masks[cell]
        n = np.bincount(doc, minlength=n_docs).astype(float)
        out = np.zeros((n_docs, len(self.langs)))
        for i in range(len(self.langs)):
            bit = (mask[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            hits = np.bincount(doc, weights=bit, minlength=n_docs)
            q = self.false_rate[i]
            out[:, i] = np.maximum(0.0, (hits - q * n) / (1.0 - q)) if q < 1 else 0.0
        return out

    def best(self, count: np.ndarray) -> np.ndarray:
        """The language of each row of ``counts``: the highest, where counts less than one n-gram
        apart are equal and go to the language with most training documents."""
        near = (count > 0) & (count > count.max(axis=1, keepdims=True) - 1.0)
        return np.where(near, self.totals, -1).argmax(axis=1)


def train(docs: DataFrame, min_share: float = MIN_SHARE, min_ratio: float = MIN_RATIO,
          probes: int = PROBES) -> LanguageFilter:
    """Fit the filters on all rows of ``docs`` with a lang; a null text is an empty document."""
    labelled = docs.where("lang is not null").select("lang", "text")
    rows = (storage.arrow(labelled, _lengths, "lang string, docs bigint, occ bigint").groupBy("lang")
            .agg(F.sum("docs").alias("docs"), F.sum("occ").alias("occ")).collect())  # one a language
    totals, occ = {r["lang"]: r["docs"] for r in rows}, {r["lang"]: r["occ"] for r in rows}
    freq = (storage.arrow(labelled, _occurrences, "lang string, gram bigint, n bigint")
            .groupBy("gram", "lang").agg(F.sum("n").alias("n")))
    spark = docs.sparkSession
    all_docs, all_occ = max(1, sum(totals.values())), max(1, sum(occ.values()))
    sizes = spark.createDataFrame([(x, totals[x], occ[x]) for x in occ] or [("", 1, 1)],
                                  "lang string, docs bigint, occ bigint")
    by = (freq.join(F.broadcast(sizes), "lang")  # one row per language
          .withColumn("rate", F.col("n") / F.col("occ")).groupBy("gram")
          .agg((F.sum(F.col("docs") * F.col("rate")) / all_docs).alias("pooled"),
               F.collect_list(F.struct("lang", "docs", "rate")).alias("by")))
    shrunk = F.transform("by", lambda b: F.struct(
        b["lang"].alias("lang"), b["rate"].alias("rate"),
        ((b["docs"] * b["rate"] + PRIOR_DOCS * F.col("pooled")) / (b["docs"] + PRIOR_DOCS))
        .alias("shrunk")))
    top = by.select("gram", shrunk.alias("by")).withColumn("top", F.array_max(F.col("by.shrunk")))
    kept = (top.select("gram", "top", F.explode("by").alias("b"))
            .where((F.col("b.shrunk") * (all_occ / all_docs) >= min_share)
                   & (F.col("b.rate") >= min_ratio * F.col("top")))
            .select(F.col("b.lang").alias("lang"), "gram"))
    table = kept.toPandas()  # per language at most n-grams per document / min_share
    if len(table) > MAX_GRAMS:
        raise ValueError(f"{len(table)} filter entries; raise min_share")
    langs = sorted(totals)
    by = dict(list(table.groupby("lang")["gram"]))
    entries = [by[x].to_numpy(np.uint64) if x in by else np.zeros(0, np.uint64) for x in langs]
    return LanguageFilter(langs, [totals[x] for x in langs], entries, probes)


def has_letter(text: Column | str) -> Column:
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))


def predict(docs: DataFrame, model: LanguageFilter, keep: tuple[str, ...] = ("doc_id",),
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` with the predicted language and its score.

    The score is the best language's part of all corrected counts.  A null text or one without a
    letter is ``und`` with score 0, as is every text if nothing was learned; a text whose n-grams
    are in no filter gets the language with most training documents and score 0, as do counts less
    than one n-gram apart with their score; then the first language by code point.  Rows that repeat
    an id each come back."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_GRAMS
    text = docs["text"]
    text_name, letter_name = storage.fresh_names(docs, "lang_text", "lang_letter")
    rows = docs.select(*[docs[c] for c in keep], text.alias(text_name),
                       has_letter(text).alias(letter_name))

    def run(batches):
        m = shared.value
        for part, data, offsets in chunks(batches, text_name):
            count = m.counts(data, offsets)
            total = count.sum(axis=1)
            best = m.best(count) if m.langs else np.zeros(len(count), int)
            pred, score = [], []
            for ok, i, row, t in zip(part.column(letter_name).to_pylist(), best, count, total):
                if not ok or not m.langs:
                    pred.append("und")
                    score.append(0.0)
                else:
                    pred.append(m.langs[i if t > 0 else m.fallback])
                    score.append(float(row[i] / t) if t > 0 else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:len(keep)], pa.array(pred, pa.string()),
                 pa.array(score, pa.float64())], names=[*keep, *names])

    schema = T.StructType([*rows.schema.fields[:len(keep)], T.StructField(names[0], T.StringType()),
                           T.StructField(names[1], T.DoubleType())])
    return storage.arrow(rows, run, schema)


def is_held_out(doc_id: Column | str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text modulo ``modulus`` equals ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder,
                      F.lit(False))
