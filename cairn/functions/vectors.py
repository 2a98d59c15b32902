"""Dense vectors as ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cairn.functions.tokens import space_tokens


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_vector(v: Column | str) -> Column:
    """Cast any numeric array to array<double> (float32 embeddings are widened first)."""
    return _col(v).cast("array<double>")


def checked_vector(v: Column | str, dim: int) -> Column:
    """Fail the job on a vector whose length is not ``dim`` (C23: ragged input is an error)."""
    c = _col(v)
    return F.when(F.size(c) == F.lit(dim), c).otherwise(
        F.raise_error(F.concat(F.lit(f"vector length differs from {dim}: "),
                               F.size(c).cast("string"))))


def parse_vector(line: Column | str, on_error: str = "raise") -> Column:
    """Parse a line of single-space separated numbers (SRC4).

    Tokens follow the Java split contract (C1), so a leading or double space or a blank line
    yields an empty token, which fails to parse (C9).  ``on_error='null'`` turns such a
    token into NULL instead of failing the job.
    """
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be 'raise' or 'null'")
    if on_error == "raise":
        return F.transform(space_tokens(line), lambda t: t.cast("double"))
    return F.transform(space_tokens(line), lambda t: t.try_cast("double"))


def euclidean(a: Column | str, b: Column | str) -> Column:
    """Euclidean distance of two equal-length vectors, fully in Spark SQL (PRJ6).

    The readable form; the clustering hot loop uses the Arrow kernel instead.
    """
    sq = F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, x: acc + x))

