"""Word counting over a document table ``(doc_id, text)`` (PRJ3-PRJ5, AGG8-AGG12).

Tokens follow the Java ``split(" ")`` contract (C1, C2, C4).  The three shapes of the
reference are kept as distinct physical plans:

* ``word_count``: explode + one aggregate; Spark's partial HashAggregate is the in-mapper
  combiner, so only (task, word) partial counts are shuffled.
* ``word_count_salted``: two aggregation levels keyed by a salt, so that a word holding a
  third of all occurrences is summed by ``k`` tasks before its final merge.  The salt is a
  hash of (seed, doc_id), not ``rand()``: a re-run task sends rows to the same place.
* ``word_count_partitioned``: every task counts its whole partition in one Arrow pass and sends
  (word, n) pairs, then one exchange by word.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from cairn.functions.tokens import space_tokens, utf16_length
from cairn.operators import token_kernels
from cairn.operators.token_kernels import word_count_kernel

# Ship the kernel with the task closures instead of requiring the package on executors.
cloudpickle.register_pickle_by_value(token_kernels)


def tokenize(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, pos, word)`` with ``pos`` the 1-based token position (PRJ3, PRJ4)."""
    return (docs.select(id_col, F.posexplode(space_tokens(text_col)).alias("p", "word"))
                .select(id_col, (F.col("p") + 1).cast("int").alias("pos"), "word"))


def _words(docs: DataFrame, text_col: str, id_col: str | None = None) -> DataFrame:
    cols = [id_col] if id_col else []
    return docs.select(*cols, F.explode(space_tokens(text_col)).alias("word"))


def doc_word_counts(docs: DataFrame, text_col: str = "text",
                    id_col: str = "doc_id") -> DataFrame:
    """Per-document word frequencies ``(doc_id, word, n)`` (AGG8)."""
    return (_words(docs, text_col, id_col).groupBy(id_col, "word")
            .agg(F.count(F.lit(1)).alias("n")))


def word_count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, n)`` over the whole corpus (AGG9)."""
    return _words(docs, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_salted(docs: DataFrame, k: int, seed: int = 0, text_col: str = "text",
                      id_col: str = "doc_id") -> DataFrame:
    """Two-round word count with ``k`` salt values (AGG10).

    Each document gets a salt in [0, k) (one hash per document, computed before the
    tokens are generated); round one counts by (salt, word), round two by word, so a word
    found in many documents is summed by up to k tasks before its final merge."""
    if k < 1:
        raise ValueError("k must be >= 1")
    salt = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(k))
    return (docs.select(salt.alias("salt"), F.explode(space_tokens(text_col)).alias("word"))
            .groupBy("salt", "word").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("word").agg(F.sum("n").alias("n")))


# Counts a task of ``word_count_partitioned`` holds before it sends them on.
DEFAULT_HOLD_BYTES = 32 << 20


def word_count_partitioned(docs: DataFrame, parts: int | None = None, text_col: str = "text",
                           hold_bytes: int = DEFAULT_HOLD_BYTES) -> DataFrame:
    """Count inside each partition of the input, then by word: one exchange (AGG11, UDF3).

    A task reads its partition as Arrow batches and keeps one table of its words' counts, each
    word coded once; past ``hold_bytes`` the table is sent on and begun anew, so a task needs
    about twice that, whatever its partition holds.  Only its (word, n) rows are exchanged.
    ``parts`` merges the input's partitions into at most that many without a shuffle."""
    if parts is not None and parts < 1:
        raise ValueError("parts must be >= 1")
    if hold_bytes < 1:
        raise ValueError("hold_bytes must be >= 1")
    if parts:
        docs = docs.coalesce(parts)
    counts = docs.select(text_col).mapInArrow(word_count_kernel(hold_bytes),
                                              "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def distinct_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct words with their UTF-16 length ``(word, len)`` (AGG12, PRJ5)."""
    return (_words(docs, text_col).distinct()
            .select("word", utf16_length("word").alias("len")))


def avg_distinct_word_length(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(n_words, avg_len)``: all distributed; an empty corpus gives NULL (not 0/0)."""
    return distinct_words(docs, text_col).agg(F.count(F.lit(1)).alias("n_words"),
                                              F.avg("len").alias("avg_len"))
