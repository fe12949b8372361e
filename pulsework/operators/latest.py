"""Latest row per key, the base of every view on a raw table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsework.operators.columns import comparable


@dataclass(frozen=True)
class LatestKey:
    keys: list[str]
    newest_by: list[str]


# What identifies a row of each raw table, and what makes it the newest.
PRESETS = {
    "campaign_list": LatestKey(["id"], ["created_at"]),
    "canvas_list": LatestKey(["id"], ["created_at"]),
    "campaign_details": LatestKey(["campaign_id"], ["created_at"]),
    "canvas_details": LatestKey(["canvas_id"], ["created_at"]),
    "campaign_series": LatestKey(["campaign_id", "start_date"], ["created_at"]),
    "canvas_series": LatestKey(["canvas_id", "start_date"], ["created_at"]),
    "user_export": LatestKey(["user_id"], ["created_at"]),
    "deliveries": LatestKey(["delivery_id"], ["inserted_at"]),
    "metrics": LatestKey(["event_id"], ["inserted_at"]),
    "outputs": LatestKey(["subject_name"], ["inserted_at"]),
    "subjects": LatestKey(["subject_name"], ["inserted_at"]),
    "people": LatestKey(["internal_customer_id"], ["updated_at", "inserted_at"]),
    "processed_files": LatestKey(["file_name"], ["inserted_at"]),
    "mixpanel_events": LatestKey(["event", "time", "distinct_id", "insert_id"], ["created_at"]),
    "cio_campaigns": LatestKey(["campaign_id"], ["updated_at"]),
    "channel_touch": LatestKey(["internal_customer_id", "playbook_id"], ["created_at"]),
}


def latest_by_key(
    df: DataFrame, keys: list[str], newest_by: list[str], tie_break: list[str] | None = None
) -> DataFrame:
    """The row of each key that comes first by ``newest_by``, descending.

    Ties go to the largest remaining columns in table order, so that a rerun picks the same
    row. ``row_number() = 1`` lets Spark keep one row per key and map task before the
    shuffle, hence a key that holds much of the table sends one row per task.
    """
    ordered = set(keys) | set(newest_by)
    rest = [c for c in comparable(df) if c not in ordered]
    ties = rest if tie_break is None else tie_break
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in [*newest_by, *ties]])
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest(df: DataFrame, preset: str) -> DataFrame:
    spec = PRESETS[preset]
    return latest_by_key(df, spec.keys, spec.newest_by)


def latest_then_filter(df: DataFrame, keys: list[str], newest_by: list[str], condition: Column) -> DataFrame:
    """An inactive newest row hides the older active ones."""
    return latest_by_key(df, keys, newest_by).filter(condition)


def filter_then_latest(df: DataFrame, keys: list[str], newest_by: list[str], condition: Column) -> DataFrame:
    """The newest of the active rows."""
    return latest_by_key(df.filter(condition), keys, newest_by)


def dedupe(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, always the same one."""
    return latest_by_key(df, keys, [])


def newest(df: DataFrame, by: list[str], n: int = 1) -> DataFrame:
    """The ``n`` newest rows overall, e.g. a workflow's last run."""
    return df.orderBy(*[F.col(c).desc() for c in by]).limit(n)


def newest_first(df: DataFrame, column: str, values: list[str], by: str) -> DataFrame:
    """Rows of the listed values, newest first."""
    return df.filter(F.col(column).isin(values)).orderBy(F.col(by).desc())
