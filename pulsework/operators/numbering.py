"""Consecutive numbers and fixed-size batches without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_index(ids: DataFrame, column: str, name: str = "index", digits: int = 3) -> DataFrame:
    """Adds 0, 1, 2, … without gaps to distinct ids, in the order of their MD5.

    The first hex digits of the hash cut the ids into ``16 ** digits`` even ranges. Each
    range numbers its own rows; how many rows the ranges before it hold is a running sum
    over the per-range counts, a table of at most that many rows. The result depends on the
    ids alone, so lost tasks and reruns give the same numbers.
    """
    hashed = ids.withColumn("_hash", F.md5(F.col(column).cast("string"))).withColumn(
        "_range", F.substring("_hash", 1, digits)
    )
    counts = hashed.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_range").orderBy("_hash", column)
    numbered = hashed.withColumn("_place", F.row_number().over(within) - 1)
    return numbered.join(offsets, "_range").select(*ids.columns, (F.col("_offset") + F.col("_place")).alias(name))


def grow_index(known: DataFrame, ids: DataFrame, column: str, name: str = "index") -> DataFrame:
    """Ids that ``known`` (``column`` and ``name``) lacks, numbered on from its largest number; numbers once given stay."""
    fresh = ids.select(column).filter(F.col(column).isNotNull()).distinct().join(known.select(column), column, "left_anti")
    first = F.coalesce(known.agg(F.max(name)).scalar(), F.lit(-1).cast("bigint")) + 1
    return dense_index(fresh, column, "_fresh").select(column, (first + F.col("_fresh")).alias(name))


def batch_ids(ids: DataFrame, column: str, size: int = 50) -> DataFrame:
    """Distinct ids in arrays of ``size``; only the last may be shorter."""
    distinct = ids.select(column).filter(F.col(column).isNotNull()).distinct()
    indexed = dense_index(distinct, column)
    batch = F.floor(F.col("index") / size).cast("bigint")
    return (
        indexed.groupBy(batch.alias("batch"))
        .agg(F.array_sort(F.collect_list(F.struct("index", column))).alias("items"))
        .select("batch", F.col(f"items.{column}").alias("ids"))
    )


def sync_registry(registry: DataFrame, current: DataFrame | None) -> DataFrame:
    """Event types with stable ids: present ones active, vanished ones inactive, new ones appended.

    New ids go on from the largest known id, or from 1 when there is none, so that the
    first id given out is 2. Without a current list the registry stays as it is.
    """
    columns = ["event_type", "event_type_id", "is_active"]
    if current is None:
        return registry.select(*columns)
    current = current.select("event_type").filter(F.col("event_type").isNotNull()).distinct()
    known = registry.select("event_type", "event_type_id").distinct()
    listed = current.withColumn("is_active", F.lit(True))
    kept = known.join(listed, "event_type", "left").withColumn("is_active", F.coalesce("is_active", F.lit(False)))
    fresh = dense_index(current.join(known, "event_type", "left_anti"), "event_type")
    largest: Column = F.coalesce(known.agg(F.max("event_type_id")).scalar(), F.lit(1).cast("bigint"))
    added = fresh.select(
        "event_type", (largest + 1 + F.col("index")).alias("event_type_id"), F.lit(True).alias("is_active")
    )
    return kept.select(*columns).unionByName(added)
