"""Statistics of a numeric column (AGG1-AGG7, PRJ1, PRJ2).

The extremes feed the normalisation as scalar subqueries: Spark runs the (merged) min/max
aggregate once and substitutes it as a literal, so there is no join and the whole pass stays
in one codegen stage.  NaN orders above every number (C7); an empty column gives NULL (C8);
a constant column normalises to NULL instead of 0/0 (C5).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def max_reduce(df: DataFrame, col: str = "x") -> DataFrame:
    """Maximum by pairwise reduce (AGG1): a partial + final ``max``."""
    return df.agg(F.max(col).alias("max_x"))


def extremes_by(df: DataFrame, col: str = "x", key: Column | None = None) -> DataFrame:
    """Maximum and minimum of ``col`` under the order of ``key`` (AGG2, AGG3, UDF5).

    A comparator becomes a sort-key expression; the default key is the value itself.
    """
    k = F.col(col) if key is None else key
    return df.agg(F.max_by(col, k).alias("max_x"), F.min_by(col, k).alias("min_x"))


def normalized(df: DataFrame, col: str = "x") -> Column:
    """``(x - min) / (max - min)`` with min and max as scalar subqueries (PRJ1)."""
    lo = df.select(F.min(col)).scalar()
    hi = df.select(F.max(col)).scalar()
    return F.try_divide(F.col(col) - lo, hi - lo)


def minmax_normalize(df: DataFrame, col: str = "x", keep: tuple[str, ...] = ("id",)) -> DataFrame:
    return df.select(*keep, normalized(df, col).alias("x_norm"))


def sum_mean(df: DataFrame, col: str = "x") -> DataFrame:
    """Row count, sum and mean of the raw and of the normalised values (AGG4-AGG6)."""
    z = normalized(df, col)
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(col).alias("sum_x"),
                  F.avg(col).alias("mean_x"), F.sum(z).alias("sum_norm"),
                  F.avg(z).alias("mean_norm"))


def normalized_variance(df: DataFrame, col: str = "x") -> DataFrame:
    """Population variance of the normalised values (PRJ2, AGG7); divides by n (C6)."""
    z = normalized(df, col)
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(z).alias("mean_norm"),
                  F.var_pop(z).alias("var_norm"))
