"""Joins of intervals that overlap, as plain equality joins.

Whole numbers are cut into aligned blocks of 1, 2, 4 ... numbers. An interval is made up of few blocks, at most two of each size, and a
number lies in one block of each size; so a number lies in an interval if, and only if, exactly one block is common to both. Two
intervals overlap if the one that begins later begins within the other. This gives two equality joins, in which each pair meets once: no
pair is tried in vain and none has to be told from its copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks have up to ``2**LEVELS`` numbers: days of eleven years. Longer intervals take several of the largest ones.
LEVELS = 12


def _key(place: Column, level: int) -> Column:
    return place * 64 + level


def dyadic_path(at: Column, levels: int = LEVELS) -> Column:
    """Keys of the blocks that a number lies in."""
    at = at.cast("bigint")
    return F.array(*[_key(F.shiftright(at, k), k) for k in range(levels + 1)])


def dyadic_cover(first: Column, last: Column, levels: int = LEVELS) -> Column:
    """Keys of the fewest blocks that make up the numbers ``first`` to ``last``; none if there are no such numbers."""
    first, end = first.cast("bigint"), last.cast("bigint") + 1

    def whole(k: int) -> tuple[Column, Column]:
        """The first block of a size that begins within the interval, and the first one that does not end within it."""
        return -F.shiftright(-first, k), F.shiftright(end, k)

    single = []
    for k in range(levels):
        low, high = whole(k)
        # An odd block at either end is no half of a larger one within the interval.
        single.append(F.when((low < high) & (low % 2 != 0), _key(low, k)))
        single.append(F.when((low < high) & (high % 2 != 0), _key(high - 1, k)))
    low, high = whole(levels)
    largest = F.transform(F.sequence(low, F.greatest(low, high - 1), F.lit(1).cast("bigint")), lambda place: _key(place, levels))
    none = F.array().cast("array<bigint>")
    return F.concat(F.array_compact(F.array(*single)), F.when(low < high, largest).otherwise(none))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[Column, Column],
    right_span: tuple[Column, Column],
    on: list[str] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """The pairs of rows whose spans have a number in common, each pair once, with all columns of both.

    A span is the pair of its first and last number, both inclusive (days: ``unix_date``). Rows whose span is empty or has an unknown end meet
    nothing. ``on`` names columns that must be equal besides. Rows are repeated ``levels + 1`` times where they are looked up by
    their beginning, so select the columns that are needed first. Neither side is ever broadcast.
    """
    equal = on or []
    clash = (set(left.columns) & set(right.columns)) - set(equal)
    if clash:
        raise ValueError(f"both sides have the columns {sorted(clash)}")
    columns = [*left.columns, *[c for c in right.columns if c not in equal]]
    left = left.select("*", left_span[0].alias("_first"), left_span[1].alias("_last")).filter("_first <= _last")
    right = right.select("*", right_span[0].alias("_from"), right_span[1].alias("_to")).filter("_from <= _to")
    keys = [*equal, "_block"]

    def met(points: DataFrame, at: str, spans: DataFrame, first: str, last: str) -> DataFrame:
        one = points.withColumn("_block", F.explode(dyadic_path(F.col(at), levels)))
        other = spans.withColumn("_block", F.explode(dyadic_cover(F.col(first), F.col(last), levels)))
        # Spark's estimates leave out what explode adds, so it would take repeated rows for few and collect them on the driver.
        return one.join(other.hint("merge"), keys)

    later_left = met(left, "_first", right, "_from", "_to").select(*columns)
    later_right = met(right, "_from", left, "_first", "_last").filter("_from > _first").select(*columns)
    return later_left.unionAll(later_right)
