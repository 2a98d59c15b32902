"""Edge-case rows shared by the tests, and fixtures that the test modules import."""

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns whose names the operators use themselves.
CLASHING = ("n", "size", "key", "node", "component", "kept", "rank", "score", "bands", "held_out",
            "target", "rate", "copies", "unit", "sha", "lang_pred", "sample", "pieces", "keep_id",
            "mix_source", "Mix_Rate", "mix_copies", "mix_copy", "dedup_id", "DEDUP_SHA", "lang_text",
            "lang_letter", "lang_found", "lang_score", "piece_text", "piece_key", "near_id",
            "near_print", "print", "group", "span_id", "spans", "cut_text", "__text", "__spans",
            "__lang", "__mix_rate", "__dedup_id")

LONG = " ".join(f"word{i % 977} the{i % 13}" for i in range(30_000))
PROSE = ("the quick brown fox jumps over the lazy dog while many other animals look on from the "
         "far side of the river and wonder about it all day long")
EDGE = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t \r\n", "en", None, 6),
    (4, "a", "de", "a", 1),
    (5, LONG, "en", "b", len(LONG)),
    (6, "a", "fr", "b", 1),
    (None, "a b c d e f", "en", "c", 11),
    (7, PROSE + " token = \"0123456789abcdef0123456789abcdef\" end", "en", "c", 1),
    (7, PROSE + " token = \"0123456789abcdef0123456789abcdef\" end", "en", "c", 1),
    (8, "  " + PROSE + "\n", "en", "a", 1),
    (9, PROSE, "en", None, 1),
    (10, PROSE.upper() + "\nécole ▁ été 😀\n\n\tfin", None, "b", 1),
    (11, "12 34 -- ?", "de", "a", 10),
    (12, LONG + " more", "en", "b", 1),
    (-3, PROSE, "en", "a", 1),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark):
    from pyspark.sql import functions as F
    return spark.createDataFrame(EDGE, SCHEMA).withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def load(spark, sf_dir, table, *columns):
    return [tuple(r) for r in
            spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns).collect()]
