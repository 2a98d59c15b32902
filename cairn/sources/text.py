"""Text sources.

All readers return lazy DataFrames over ``spark.read.text``; nothing is read on the driver.
A file may be a directory of part files (unlike the single-file readers this replaces).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cairn.functions.tokens import line_split, whitespace_tokens
from cairn.functions.vectors import parse_vector


def parse_numbers(lines: DataFrame, col: str = "value", on_error: str = "raise") -> DataFrame:
    """Whitespace-separated numbers, any number per line, as ``x double`` rows (SRC1).

    A token that is not a number fails the job (ANSI cast, C9) unless ``on_error='null'``.
    """
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be 'raise' or 'null'")
    tok = F.explode(whitespace_tokens(F.col(col))).alias("tok")
    x = F.col("tok").cast("double") if on_error == "raise" else F.col("tok").try_cast("double")
    return lines.select(tok).select(x.alias("x"))


def finer_scans(spark: SparkSession, min_partitions: int) -> SparkSession:
    """A session beside ``spark`` (same context, tables and settings) whose file scans are cut into
    at least ``min_partitions`` splits: the split size is the files' bytes over that number, with
    no allowance for opening a file."""
    finer = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if finer.conf.isModifiable(key):
            finer.conf.set(key, value)
    finer.conf.set("spark.sql.files.minPartitionNum", str(min_partitions))
    finer.conf.set("spark.sql.files.openCostInBytes", "1")
    return finer


def read_lines(spark: SparkSession, path: str | list[str],
               min_partitions: int | None = None) -> DataFrame:
    """One row per text line of a file, folder or list of them (SRC3).

    ``min_partitions`` is a hint as for ``textFile`` (C24): the files are cut into at least that
    many splits where they are read, with no shuffle.  A file in a format that cannot be cut stays
    whole, and a split inside a long line has no row."""
    if min_partitions is None:
        return spark.read.text(path)
    if min_partitions < 1:
        raise ValueError("min_partitions must be >= 1")
    return finer_scans(spark, min_partitions).read.text(path)


def read_numbers(spark: SparkSession, path: str | list[str], on_error: str = "raise",
                 min_partitions: int | None = None) -> DataFrame:
    return parse_numbers(read_lines(spark, path, min_partitions), "value", on_error)


def text_lines(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Split a text column into ``(id, line_no, line)`` rows on CRLF, CR or LF (SRC3 on a
    column), as a line reader does: a break at the very end opens no further line and an empty
    text has none.  ``line_no`` starts at 1."""
    return df.select(id_col, F.posexplode(line_split(F.col(text_col))).alias("pos", "line")) \
             .select(id_col, (F.col("pos") + 1).cast("int").alias("line_no"), "line")


def read_documents(spark: SparkSession, path: str | list[str], min_partitions: int | None = None) -> DataFrame:
    """A text file with one document per line as ``(doc_id, text)``.

    ``doc_id`` is a generated increasing id, the same for a fixed layout of the input."""
    return read_lines(spark, path, min_partitions).select(
        F.monotonically_increasing_id().alias("doc_id"), F.col("value").alias("text"))


def parse_vectors(lines: DataFrame, col: str = "value", on_error: str = "raise",
                  id_col: str | None = None) -> DataFrame:
    """Dense vectors from single-space separated lines (SRC4) as ``(id, v)``."""
    ident = F.col(id_col) if id_col else F.monotonically_increasing_id()
    return lines.select(ident.alias("id"), parse_vector(F.col(col), on_error).alias("v"))


def read_vectors(spark: SparkSession, path: str | list[str], on_error: str = "raise",
                 min_partitions: int | None = None) -> DataFrame:
    """Read a vector file (SRC5) as ``(id bigint, v array<double>)``; directories allowed."""
    return parse_vectors(read_lines(spark, path, min_partitions), "value", on_error)


def write_lines(df: DataFrame, path: str, line_sep: str = "\n", col: str = "value") -> str:
    """Write a text column as the lines of part files in the folder ``path``, which is returned; a
    NULL is an empty line."""
    df.select(F.col(col).cast("string").alias("value")).write.option("lineSep", line_sep).text(path)
    return path
