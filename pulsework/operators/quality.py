"""Checks of the constraints that result tables declare. No rows means the check holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row; a key with a NULL part is never a duplicate."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(whole).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def check_domain(df: DataFrame, column: str, allowed: list) -> DataFrame:
    """Values outside the allowed ones, with their row counts."""
    return df.filter(~F.col(column).isin(allowed)).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows lacking a required value, counted per column."""
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    named = F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(c) for c in columns]))
    return df.agg(*counts).select(F.explode(named).alias("column", "rows")).filter("rows > 0")
