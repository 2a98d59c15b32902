"""Mixing sources to target weights.

Words are summed per source, a water-filling step turns the weights into a target per source, and
each document is emitted floor(rate) times plus one more copy with probability rate - floor(rate),
rate = target / source size.  The copies are drawn so that a source's words come near its target
whatever its documents' sizes: along the source's documents in order of size, the number of copies
so far is the running number of documents times the fraction, up to a start that the source's hash
decides, and among documents of one size a hash of the doc_id decides which.  So every document
has the same probability, and the words taken miss the target by at most about one document.

Everything is DataFrame code: partial aggregates per source, per (source, size) and per hash range
of these, windows over their rows, and a join back.  Which hashes of a size are drawn is a threshold,
found by counts per hash range and a rank inside the one range it lies in, so no source and no size
is ever ranked in one task, and texts are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cairn.functions.random import hashed_uniform
from cairn.llm import storage

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 17
MAX_SENT_DRAWS = 100_000  # some 10 MB of names, sizes and rates


def word_count(text: Column | str) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")),
                      F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   cap: int = CAP) -> DataFrame:
    """``source, source_size, weight, target``, one row per source of ``sizes(source, size)``.

    Sources by code point, null last, take the weights in turn.  All words are shared by weight;
    a target stops at ``cap`` times its source's size and the excess goes to the others by weight
    until none is above.  That fixed point caps the sources of least size / weight first: with the
    first j of them capped the level is (all - capped words) / (all - capped weights), and j is
    the first for which the next source stays under its cap.  The windows run over one row per
    source, so they are as large as the number of sources, not of documents."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    kinds = F.array(*[F.lit(w) for w in weights])
    per = (per.withColumn("weight", F.get(kinds, turn % len(weights)).cast("bigint"))
           .withColumn("cap", F.col("source_size") * F.lit(cap)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = ((F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             .cast("double")
             / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
             .cast("double"))
    per = per.withColumn("level", level)
    open_level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"),
                              F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(),
                                       F.col("source"), F.col("level")))).over(whole)
    per = per.withColumn("open", open_level["level"])
    return per.select("source", "source_size", "weight", F.least(
        F.col("cap").cast("double"),
        F.coalesce(F.col("open") * F.col("weight"), F.col("cap").cast("double"))).alias("target"))


RANGES = 1 << 16  # hash ranges of a (source, size) in which documents are counted


def _sized(docs: DataFrame, keep: list, seed: int) -> DataFrame:
    """``keep`` and the columns that decide a document's copies: ``sn`` and ``sk`` (its source, null
    or not), ``size`` and ``u``, the hash of its doc_id."""
    u = hashed_uniform(seed, "mix", F.coalesce(docs["doc_id"].cast("string"), F.lit("null")))
    return docs.select(*keep, docs["source"].isNull().alias("sn"),
                       F.coalesce(docs["source"], F.lit("")).alias("sk"),
                       word_count(docs["text"]).alias("size"), u.alias("u"))


def draw_table(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP,
               seed: int = SEED) -> DataFrame:
    """``sn, sk, size, source_size, target, rate, threshold``, one row per source and size of
    ``rows(sn, sk, size, u)``: documents whose ``u`` is at most ``threshold`` get the copy more."""
    source = F.when(~F.col("sn"), F.col("sk"))
    classes = storage.materialize(
        rows.groupBy("sn", "sk", "size").agg(F.count(F.lit(1)).alias("n")), "mix-classes")
    targets = source_targets(classes.select(source.alias("source"),
                                            (F.col("n") * F.col("size")).alias("size")), weights, cap)
    targets = targets.select(
        F.col("source").isNull().alias("sn"), F.coalesce("source", F.lit("")).alias("sk"),
        "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(F.lit(0.0)).alias("rate"))
    before = Window.partitionBy("sn", "sk").orderBy("size").rowsBetween(
        Window.unboundedPreceding, -1)
    start = hashed_uniform(seed, "mix-start", F.col("sk"))
    part = F.col("rate") - F.floor("rate")

    def drawn(count):
        return F.floor(count * part + start)

    table = (classes.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0)))
             .join(targets, ["sn", "sk"])
             .withColumn("k", drawn(F.col("below") + F.col("n")) - drawn(F.col("below"))))
    table = storage.materialize(table, "mix-draws")
    by = ["sn", "sk", "size"]
    ranged = rows.select(*by, "u", F.floor(F.col("u") * RANGES).alias("range"))
    counts = ranged.groupBy(*by, "range").agg(F.count(F.lit(1)).alias("m"))
    upto = F.sum("m").over(Window.partitionBy(*by).orderBy("range"))
    open_ = table.where("k > 0 and k < n").select(*by, "k")
    at = (counts.withColumn("upto", upto).join(open_, by)
          .where("upto >= k and upto - m < k")
          .select(*by, "range", (F.col("k") - F.col("upto") + F.col("m")).alias("need")))
    place = F.row_number().over(Window.partitionBy(*by, "range").orderBy("u"))
    last = (ranged.join(at, [*by, "range"]).withColumn("place", place).where("place = need")
            .select(*by, F.col("u").alias("last")))
    threshold = F.when(F.col("k") <= 0, F.lit(-1.0)).otherwise(F.coalesce("last", F.lit(2.0)))
    return storage.materialize(
        table.join(last, by, "left").select(*by, "source_size", "target", "rate",
                                            threshold.alias("threshold")), "mix-thresholds")


def _with_draws(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows(sn, sk, size, u)`` with their row of the draw table and ``copies``."""
    if table.count() <= MAX_SENT_DRAWS:
        table = F.broadcast(table)
    copies = F.floor("rate") + (F.col("u") <= F.col("threshold")).cast("bigint")
    return rows.join(table, ["sn", "sk", "size"]).withColumn("copies", copies)


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP,
             seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, rate, copies, taken``.

    ``taken`` = copies * size.  A null text has size 0, a source without words rate 0; rows with the
    same doc_id, source and size draw alike.  An empty table gives an empty result."""
    rows = storage.materialize(_sized(docs, [docs["doc_id"], docs["source"]], seed), "mix-sizes")
    plan = _with_draws(rows, draw_table(rows, weights, cap, seed))
    return plan.select("doc_id", "source", "size", "source_size", "target", "rate", "copies",
                       (F.col("copies") * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP,
                  seed: int = SEED) -> DataFrame:
    """The mixed corpus: every document row as often as its copies say, all columns kept.

    The draw table, one row per source and size, is computed first; up to MAX_SENT_DRAWS rows of
    it are sent to every task, so no text is shuffled, and more are joined."""
    sized = storage.materialize(_sized(docs, [], seed), "mix-sizes")
    table = draw_table(sized, weights, cap, seed)
    held = [f"c{i}" for i in range(len(docs.columns))]  # given names cannot clash with ours
    keep = [docs[c].alias(name) for c, name in zip(docs.columns, held)]
    rows = _with_draws(_sized(docs, keep, seed), table).where("copies > 0")
    return (rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(*[F.col(name).alias(c) for c, name in zip(docs.columns, held)]))
