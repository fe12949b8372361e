"""Equi joins that stay even when one key holds much of the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsework.operators.columns import comparable
from pulsework.operators.latest import latest_then_filter

HOT_ROWS = 5_000_000


def skew_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join facts with many rows per key to a lookup side, cutting hot keys into slices.

    A key with more than ``hot_rows`` facts is dealt over ``ceil(rows / hot_rows)`` slices
    by a hash of the row, and the lookup row of that key alone is repeated once per slice.
    The hash depends on the row alone, so a task that runs again deals alike; the facts
    should keep a column that tells equal-looking rows apart, such as an event id.
    At most ``all facts / hot_rows`` keys can be hot, which is what bounds the broadcast
    list of them; counting combines on the map side and reads only the key columns.
    """
    hot = F.broadcast(
        facts.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > hot_rows)
        .select(*on, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_slices"))
    )
    slices = F.coalesce("_slices", F.lit(1))
    # A NULL key matches nothing, so its rows may go anywhere; an outer join must not heap them up.
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    left = (
        facts.join(hot, on, "left")
        .withColumn("_slice", F.pmod(F.xxhash64(*comparable(facts)), F.when(no_key, 1024).otherwise(slices)).cast("int"))
        .drop("_slices")
    )
    right = (
        lookup.join(hot, on, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("_slices")
    )
    return left.join(right, [*on, "_slice"], how).drop("_slice")


def active_connectors(connectors: DataFrame, organisations: DataFrame, tools: DataFrame) -> DataFrame:
    """Active tools of active organisations.

    Rows are the newest connector per organisation and tool; the three tables are small and
    Spark broadcasts the two dimensions when their measured size allows.
    """
    current = latest_then_filter(connectors, ["org_id", "tool_id"], ["updated_at"], F.col("active"))
    orgs = organisations.filter("active").select(F.col("id").alias("org_id"), "domain")
    names = tools.filter("active").select(F.col("id").alias("tool_id"), F.col("name").alias("tool_name"))
    return (
        current.join(orgs, "org_id")
        .join(names, "tool_id")
        .select("id", "tool_id", "org_id", "config", "domain", "tool_name")
    )
