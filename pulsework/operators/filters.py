"""Row filters of the jobs, each a condition that reaches the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsework.functions import in_days
from pulsework.sources.files import spans_days


def on_days(df: DataFrame, time: str, first_day: str, last_day: str) -> DataFrame:
    """Rows whose time lies on the days, both whole days included."""
    return df.filter(in_days(F.col(time), first_day, last_day))


def any_on_days(df: DataFrame, times: list[str], first_day: str, last_day: str) -> DataFrame:
    """Rows with at least one of the times on the days."""
    condition = in_days(F.col(times[0]), first_day, last_day)
    for time in times[1:]:
        condition = condition | in_days(F.col(time), first_day, last_day)
    return df.filter(condition)


def spanning_days(df: DataFrame, times: list[str], first_day: str, last_day: str) -> DataFrame:
    """Rows whose span from earliest to latest time touches the days."""
    return df.filter(spans_days([F.col(t) for t in times], first_day, last_day))


def after_cursor(df: DataFrame, column: str, cursor) -> DataFrame:
    """Rows past the stored high-water mark; all rows when there is none yet."""
    return df if cursor is None else df.filter(F.col(column) > F.lit(cursor))


def with_payload(df: DataFrame, payload: str) -> DataFrame:
    """Rows whose JSON payload holds something."""
    return df.filter(F.col(payload).isNotNull() & ~F.trim(payload).isin("", "[]", "{}", "null"))
