"""Sums kept up by differences: what a load changes is taken out as it was and put in as it is."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsework.operators.merge import not_older, upsert

ROWS = "rows"


def _sums(sums: list[str], sign: Column) -> list[Column]:
    return [F.sum(sign).alias(ROWS), *[F.sum(sign * F.col(c)).alias(c) for c in sums]]


def totals(rows: DataFrame, by: list[str], sums: list[str]) -> DataFrame:
    """Rows and sums per group; a NULL adds nothing, and a group of NULLs alone sums to 0."""
    return rows.na.fill(0, sums).groupBy(*by).agg(*_sums(sums, F.lit(1)))


def signed_deltas(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    by: list[str],
    sums: list[str],
    update_cols: list[str] | None = None,
    newer_by: str | None = None,
) -> DataFrame:
    """By how much an upsert of ``source`` into ``target`` changes the rows and sums of each group.

    Only rows that the upsert adds or changes are summed: as they were with a minus, as they are with a plus. A row that
    moves to another group leaves its old one. Groups that stay as they are do not appear.
    """
    changed = source if newer_by is None else not_older(source, target, keys, newer_by)
    before = target.join(changed.select(*keys).distinct(), keys, "left_semi")
    after = upsert(before, changed, keys, update_cols, newer_by)
    needed = list(dict.fromkeys([*by, *sums]))
    both = before.select(*needed, F.lit(-1).alias("_sign")).unionAll(after.select(*needed, F.lit(1).alias("_sign")))
    found = both.na.fill(0, sums).groupBy(*by).agg(*_sums(sums, F.col("_sign")))
    return found.filter(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in [ROWS, *sums]]))


def summed(deltas: DataFrame, by: list[str], sums: list[str]) -> DataFrame:
    """Totals from any number of deltas, the first of them taken from an empty table; groups without rows are gone."""
    return deltas.groupBy(*by).agg(*[F.sum(c).alias(c) for c in [ROWS, *sums]]).filter(F.col(ROWS) != 0)
