"""Arrays that hold one number per day, oldest first, to one row per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsework.functions import days_before
from pulsework.schemas import CHANNEL_ARRAYS, JOURNEY_ARRAYS


def _unpivot(rows: DataFrame, arrays: list[str], keep: list[Column]) -> DataFrame:
    """The last element belongs to ``endAt``. The first array sets the number of days; shorter ones give NULL."""
    parsed = rows.select("endAt", *keep, *[F.from_json(a, "ARRAY<BIGINT>").alias(a) for a in arrays])
    names = [c for c in parsed.columns if c != "endAt" and c not in arrays]
    # The outer form keeps Spark from guarding the explode with a second copy of all the parsing;
    # rows without days fail the comparison.
    days = parsed.select(
        "endAt", *names, F.size(arrays[0]).alias("n"), F.posexplode_outer(F.arrays_zip(*arrays)).alias("i", "v")
    ).filter("i < n")
    return days.select(
        *names,
        days_before(F.col("endAt"), F.col("n") - 1 - F.col("i")).alias("date"),
        *[F.col(f"v.{a}").alias(a) for a in arrays],
    )


def journey_days(rows: DataFrame) -> DataFrame:
    """Seven journey counts per playbook and day."""
    return _unpivot(rows, JOURNEY_ARRAYS, [F.col("playbook_id").cast("int").alias("playbook_id"), F.col("type")])


def channel_days(rows: DataFrame) -> DataFrame:
    """Fourteen delivery counts per playbook, channel and day."""
    keep = [
        F.col("playbook_id").cast("int").alias("playbook_id"),
        F.col("type"),
        F.nullif(F.col("channel").cast("string"), F.lit("")).cast("int").alias("channel"),
        F.nullif(F.col("channel_name"), F.lit("")).alias("channel_name"),
    ]
    return _unpivot(rows, CHANNEL_ARRAYS, keep).withColumnRenamed("opened", "open")
