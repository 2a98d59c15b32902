"""Corpus pipeline over the operators of ``cairn.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the documents
it keeps, which are written as Parquet and reread as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cairn.llm import (exact_dedup, lang_bloom, mixing, piece_sampling, storage,
                       superminhash)
from cairn.llm.queries import table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: a document whose language it cannot tell (``und``: no text or no letter) goes; a
    null lang becomes the predicted one.  The filters are learned from the rows with a lang."""
    lang, score = storage.fresh_names(docs, "lang_found", "lang_score")
    found = lang_bloom.predict(docs, lang_bloom.train(docs), tuple(docs.columns), (lang, score))
    return (found.where(F.col(lang) != "und").withColumn("lang", F.coalesce("lang", lang))
            .select(*docs.columns))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: one document of each group of equal texts stays."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8, five words and a similarity of 0.8: the document with the least doc_id of each
    near-duplicate group stays."""
    return superminhash.near_dedup(docs, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: the documents repeated so that the sources meet their target weights."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: sampled segmentations of every document, with its id, language and source."""
    return piece_sampling.sample_pieces(docs, piece_sampling.load_vocabulary(),
                                        keep=("doc_id", "lang", "source"))


STAGES = [
    ("language id", known_language),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("piece sampling", encode),
]

ORACLE_SQL = None  # SQL cannot express the stages; tests/llm checks them by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = storage.materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
