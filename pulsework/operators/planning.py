"""Which days and windows a run has to fetch, and what is still missing."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The longest span one request may ask for.
CAMPAIGN_WINDOW_DAYS = 100
CANVAS_WINDOW_DAYS = 14


def run_window(start_day: str, end_day: str, lag: int = 1) -> tuple[str, str]:
    """Data days of a run: the run day itself is still incomplete, so a run works on the day before."""
    back = timedelta(days=lag)
    return (date.fromisoformat(start_day) - back).isoformat(), (date.fromisoformat(end_day) - back).isoformat()


def plan_backfill(
    entities: DataFrame,
    entity: str,
    end_day: str,
    max_days: int,
    created_at: str = "created_at",
    start_day: str | None = None,
    length: int | None = None,
) -> DataFrame:
    """Windows that tile each entity's span up to ``end_day``, latest first.

    A window ends before ``ending_at`` and covers ``length`` days. The span starts at the
    entity's creation day or, with ``length``, that many days before ``start_day``.
    """
    end = F.lit(end_day).cast("date")
    if length is None:
        first = F.to_date(created_at)
    else:
        first = F.date_sub(F.lit(start_day).cast("date"), length)
    return _tiles(entities.select(entity, end.alias("end"), F.date_diff(end, first).alias("days")).filter("days > 0"), entity, max_days)


def _tiles(spans: DataFrame, entity: str, max_days: int) -> DataFrame:
    """Windows that tile the ``days`` before ``end``, of which there are some in each span, latest first."""
    last = F.ceil(F.col("days") / max_days).cast("int") - 1
    steps = spans.select(entity, "end", "days", F.explode(F.sequence(F.lit(0), last)).alias("step"))
    return steps.select(
        entity,
        F.date_sub("end", F.col("step") * max_days).alias("ending_at"),
        F.least(F.lit(max_days), F.col("days") - F.col("step") * max_days).alias("length"),
    )


def plan_daily(runs: DataFrame, start_day: str, end_day: str, lag: int = 1, offset: int | None = None) -> DataFrame:
    """One row per day to fetch for each run.

    ``start_day`` and ``end_day`` name the run's columns. With ``offset`` the run goes back
    over older days for late data: from that many days before the start to that many before
    the end, but not past the start.
    """
    first, last = F.to_date(start_day), F.to_date(end_day)
    if offset is not None:
        last = F.least(F.date_sub(last, offset), first)
        first = F.date_sub(first, offset)
    planned = runs.withColumn("_first", F.date_sub(first, lag)).withColumn("_last", F.date_sub(last, lag))
    return (
        planned.filter("_first <= _last")
        .withColumn("day", F.explode(F.sequence("_first", "_last")))
        .drop("_first", "_last")
    )


def incomplete_windows(planned: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """Planned requests for which nothing has landed."""
    return planned.join(landed.select(*keys).distinct(), keys, "left_anti")


def uncovered_windows(planned: DataFrame, landed: DataFrame, entity: str, max_days: int) -> DataFrame:
    """What no landed window covers of the planned ones, as windows of at most ``max_days`` days, latest first.

    Both tables hold ``entity``, ``ending_at`` and ``length``: a window is the ``length`` days before ``ending_at``. Windows of either may
    overlap, touch, repeat or be cut in any way; a day planned twice is asked for once. A window without an end, or of
    no days, holds nothing. A landed window of no entity covers nothing; planned ones of no entity are taken together.

    Both sides are reduced to signed steps per entity and day before the shuffle, so an entity has at most as many rows as its history has days,
    however many requests there were, and no two windows are ever joined.
    """
    steps = _steps(planned, entity, 1, 0).unionByName(_steps(landed.filter(F.col(entity).isNotNull()), entity, 0, 1))
    edges = steps.groupBy(entity, "at").agg(F.sum("asked").alias("asked"), F.sum("held").alias("held"))
    in_time = Window.partitionBy(entity).orderBy("at")
    so_far = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = edges.select(
        entity,
        "at",
        F.lead("at").over(in_time).alias("until"),
        ((F.sum("asked").over(so_far) > 0) & (F.sum("held").over(so_far) == 0)).alias("open"),
    )
    begins = F.col("open") & ~F.lag("open", 1, False).over(in_time)
    runs = parts.withColumn("run", F.count_if(begins).over(so_far)).filter("open")
    spans = runs.groupBy(entity, "run").agg(F.max("until").alias("end"), F.date_diff(F.max("until"), F.min("at")).alias("days"))
    return _tiles(spans, entity, max_days)


def _steps(windows: DataFrame, entity: str, asked: int, held: int) -> DataFrame:
    """Where a window begins one more counts, where it ends one less."""
    begin, end = F.expr("date_sub(ending_at, length)"), F.col("ending_at").cast("date")
    edges = F.array(F.struct(begin.alias("at"), F.lit(1).alias("sign")), F.struct(end.alias("at"), F.lit(-1).alias("sign")))
    known = windows.filter("length > 0 and ending_at is not null").select(entity, F.explode(edges).alias("edge"))
    sign = F.col("edge.sign")
    return known.select(entity, F.col("edge.at").alias("at"), (sign * asked).alias("asked"), (sign * held).alias("held"))
