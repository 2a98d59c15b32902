"""Reproducible randomness that does not depend on partitioning (C22).

A draw is a pure function of (seed, round tag, row key): the first 52 bits of an MD5 digest
mapped into the open interval (0, 1).  Re-executed tasks and any number of partitions give the
same numbers, and DuckDB can compute the identical value, which is what the SQL oracle relies
on.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# 13 hex digits = 52 bits, so the integer is exact in a double; 2**52.
_HEX_DIGITS = 13
_SCALE = 4503599627370496.0


def _key(seed: int, tag: str | Column, key: Column) -> Column:
    """The text that is hashed; a NULL row key is an error, as it would win every draw."""
    text = F.coalesce(key.cast("string"), F.raise_error(F.lit("NULL id in a draw")).cast("string"))
    if isinstance(tag, str):
        return F.concat(F.lit(f"{seed}:{tag}:"), text)
    return F.concat(F.lit(f"{seed}:"), tag, F.lit(":"), text)


def hashed_uniform(seed: int, tag: str | Column, key: Column | str) -> Column:
    """Uniform double in (0, 1) for the row ``key`` in round ``tag`` (a column if rows are in
    different rounds)."""
    k = F.col(key) if isinstance(key, str) else key
    digits = F.substring(F.md5(_key(seed, tag, k)), 1, _HEX_DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(_SCALE)


def hashed_digits(seed: int, tags: list[str | Column], key: Column) -> Column:
    """The hexadecimal digits of the uniforms of several rounds, one after the other, for a kernel
    that makes the numbers itself (``kernels.uniforms``): text is cheaper than ``conv``."""
    return F.concat(*[F.substring(F.md5(_key(seed, t, key)), 1, _HEX_DIGITS) for t in tags])


def hashed_bucket(seed: int, key: Column | str, buckets: int, tag: str = "part") -> Column:
    """Integer in [0, buckets) from the first 32 bits of the same digest (balanced parts)."""
    k = F.col(key) if isinstance(key, str) else key
    digits = F.substring(F.md5(_key(seed, tag, k)), 1, 8)
    return (F.conv(digits, 16, 10).cast("bigint") % F.lit(buckets)).cast("int")


def race_key(u: Column, weight: Column | None = None) -> Column:
    """Exponential race key -ln(u)/weight: the row with the smallest key is a draw with
    probability proportional to ``weight`` (Efraimidis-Spirakis).  Rows with weight <= 0
    must be filtered out by the caller."""
    k = -F.log(u)
    return k if weight is None else k / weight
