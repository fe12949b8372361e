"""What a table looks like after an upsert, a window replacement or an expiry."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsework.functions import not_in_days
from pulsework.operators.columns import comparable


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def not_older(source: DataFrame, target: DataFrame, keys: list[str], newer_by: str) -> DataFrame:
    """The source's rows that a guarded upsert would add to the target or change it by.

    Rows lacking a part of their key match nothing; they pass by the join, which would send them all to one task.
    """
    held = target.select(*[F.col(k).alias(f"_held_{k}") for k in keys], F.col(newer_by).alias("_held"))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_held_{k}") for k in keys])
    older = ~F.coalesce(F.col(newer_by) > F.col("_held"), F.lit(False))
    whole = source.filter(~_any_null(keys)).join(held, same & older, "left_anti")
    return whole.unionByName(source.filter(_any_null(keys)))


def _side(df: DataFrame, keys: list[str], name: str, null_keys: bool) -> DataFrame:
    """Key columns, the row as one struct, and a spread for rows that lack a key.

    Those rows match nothing; the hash keeps an outer join from sending all of them to one
    task.
    """
    spread = F.when(_any_null(keys), F.xxhash64(*comparable(df))).otherwise(F.lit(0))
    extra = [spread.alias("_spread")] if null_keys else []
    return df.select(*keys, *extra, F.struct(*df.columns).alias(name))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str] | None = None,
    newer_by: str | None = None,
    small_source: bool = False,
    null_keys: bool = True,
    null_safe: bool = False,
) -> DataFrame:
    """The target with new keys added and matched rows changed in ``update_cols``.

    With ``newer_by`` a matched row changes only if the source's value is greater than the
    target's; NULL on either side keeps the target row, and the guard column is always
    among the changed ones. Keys compare as in SQL, so a NULL key never matches, unless
    ``null_safe`` makes NULL equal to NULL. The source must hold each key once (see ``dedupe``).

    The plan is one full outer join. Where keys are never NULL, ``null_keys=False`` joins on
    the keys alone, so that a side already bucketed by them is not shuffled again. With ``small_source`` the target is probed instead of
    shuffled: two joins that Spark runs as broadcasts while the source is below
    ``spark.sql.autoBroadcastJoinThreshold``, and as shuffles beyond.
    """
    columns = target.columns
    changed = set(update_cols) if update_cols is not None else set(columns) - set(keys)
    if newer_by is not None:
        changed.add(newer_by)
    source = source.select(*columns)
    if null_safe:
        # Structs are equal where their fields are equal or both NULL.
        target, source = (df.withColumn("_whole_key", F.struct(*keys)) for df in (target, source))
        joined = upsert(target, source, ["_whole_key"], list(changed), newer_by, small_source, null_keys=False)
        return joined.select(*columns)

    def merged(matched: Column) -> list[Column]:
        takes = matched
        if newer_by is not None:
            takes = takes & F.coalesce(F.col(f"s.{newer_by}") > F.col(f"t.{newer_by}"), F.lit(False))
        return [
            F.when(F.col("t").isNull(), F.col(f"s.{c}")).when(takes, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            if c in changed
            else F.when(F.col("t").isNull(), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            for c in columns
        ]

    both = F.col("s").isNotNull() & F.col("t").isNotNull()
    if not small_source:
        on = [*keys, "_spread"] if null_keys else keys
        joined = _side(target, keys, "t", null_keys).join(_side(source, keys, "s", null_keys), on, "full_outer")
        return joined.select(*merged(both))

    incoming = source.select(*keys, F.struct(*columns).alias("s"))
    current = target.select(*keys, F.struct(*columns).alias("t"))
    kept = current.join(incoming, keys, "left").select(*merged(both))
    present = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    return kept.unionByName(source.join(present, keys, "left_anti").select(*columns))


def replace_days(target: DataFrame, source: DataFrame, time: str, first_day: str, last_day: str) -> DataFrame:
    """Drop the target's rows of these days, then add the source. Rows without a time stay."""
    kept = target.filter(not_in_days(F.col(time), first_day, last_day))
    return kept.unionByName(source.select(*target.columns))


def expire(target: DataFrame, time: str | Column, as_of: str, days: int = 90) -> DataFrame:
    """Rows from ``as_of`` minus ``days`` on. Rows without a time stay."""
    column = F.col(time) if isinstance(time, str) else time
    cutoff = (date.fromisoformat(as_of) - timedelta(days=days)).isoformat()
    return target.filter(column.isNull() | (column >= F.lit(cutoff)))
