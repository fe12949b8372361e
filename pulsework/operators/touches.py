"""Who was last reached by which playbook, and what happened on each journey."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsework.functions import in_days, parse_second_text
from pulsework.operators.joins import skew_join
from pulsework.operators.latest import latest_by_key
from pulsework.operators.projections import channel_id, playbook_id, playbook_type
from pulsework.schemas import DELIVERY_METRICS, JOURNEY_METRICS, cast_to


def delivery_metrics(
    metrics: DataFrame, deliveries: DataFrame, first_day: str, last_day: str, hot_rows: int | None = None
) -> DataFrame:
    """Every metric event of the days with its delivery's customer, playbook and channel.

    The join is plain, and adaptive execution splits a rare hot delivery; ``hot_rows`` slices keys above that many rows.
    """
    on_days = metrics.filter(in_days(F.col("created_at"), first_day, last_day))
    facts, sides = on_days.select("event_id", "delivery_id", "metric", "created_at"), delivery_sides(deliveries)
    if hot_rows is None:
        rows = facts.join(sides, "delivery_id")
    else:
        rows = skew_join(facts, sides, ["delivery_id"], hot_rows=hot_rows)
    return rows.select(
        "internal_customer_id", "playbook_id", "type", "channel", "channel_name", "metric", "created_at"
    )


def delivery_sides(deliveries: DataFrame) -> DataFrame:
    return deliveries.select(
        "delivery_id",
        "internal_customer_id",
        playbook_id().alias("playbook_id"),
        playbook_type().alias("type"),
        channel_id().alias("channel"),
        F.col("delivery_type").alias("channel_name"),
    )


def channel_touches(
    metrics: DataFrame,
    deliveries: DataFrame,
    first_day: str,
    last_day: str,
    keys: tuple[str, ...] = ("internal_customer_id", "playbook_id"),
    kinds: list[str] | None = None,
) -> DataFrame:
    """The latest touch per metric, customer and playbook, for all metrics in one pass.

    A delivery fixes customer, playbook and channel, so the newest event per metric and
    delivery is all that can win. Taking it first is a map-side combining ``max`` and
    leaves at most one row per metric and delivery to join.
    """
    wanted = F.col("metric").isin(DELIVERY_METRICS if kinds is None else kinds)
    events = metrics.filter(wanted & in_days(F.col("created_at"), first_day, last_day))
    newest = events.groupBy("delivery_id", "metric").agg(F.max("created_at").alias("created_at"))
    rows = newest.join(delivery_sides(deliveries), "delivery_id").select(
        "metric", "internal_customer_id", "playbook_id", "type", "channel", "channel_name", "created_at"
    )
    return latest_by_key(rows, ["metric", *keys], ["created_at"])


def journey_metrics(
    outputs: DataFrame, subjects: DataFrame, first_day: str, last_day: str, hot_rows: int | None = None
) -> DataFrame:
    """Journey outputs of the days with the journey they belong to.

    The join is plain unless ``hot_rows`` asks for slices of subjects above that many rows.
    """
    on_days = outputs.filter(in_days(F.col("created_at"), first_day, last_day)).select(
        "subject_name", "action_id", "explanation", "output_type", "delay_ends_at", "created_at"
    )
    journeys = subjects.select(
        "subject_name", "internal_customer_id", "campaign_id", "campaign_type", "started_campaign_at"
    )
    if hot_rows is None:
        rows = on_days.join(journeys, "subject_name")
    else:
        rows = skew_join(on_days, journeys, ["subject_name"], hot_rows=hot_rows)

    def second_time(name: str):
        is_text = dict(rows.dtypes)[name] == "string"
        return parse_second_text(F.col(name)) if is_text else F.col(name)

    return cast_to(
        rows.select(
            "internal_customer_id",
            F.col("campaign_id").alias("playbook_id"),
            F.lit("campaign").alias("type"),
            F.col("action_id").alias("channel"),
            F.col("campaign_type").alias("playbook_type"),
            "explanation",
            F.col("output_type").alias("metric"),
            *[second_time(c).alias(c) for c in ("delay_ends_at", "started_campaign_at", "created_at")],
        ),
        JOURNEY_METRICS,
    )
