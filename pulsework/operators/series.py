"""Daily campaign and canvas payloads to variants, steps and channels.

Each input row is one entity and day, with the day's payload as JSON text or VARIANT. Text is
parsed once against a schema holding only the fields that are used, a VARIANT is only looked into; variant, step and
channel ids are map keys there, so ``explode`` gives one row for each without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsework.functions import (
    CHANNEL_METRICS,
    channel_measure,
    comma_list,
    double_or_zero,
    int_or_zero,
    is_control_name,
    message_fields,
    parse_iso,
)
from pulsework.functions.channels import Metrics
from pulsework.schemas import CANVAS_STEPS, CHANNELS_CAMPAIGN, CHANNELS_CANVAS, VARIANTS, cast_to


def _fields(series: DataFrame, payload: str, fields: str) -> Column:
    """The day's ``fields``, given as ``name TYPE, ...``; what is missing or of another type is NULL."""
    if isinstance(series.schema[payload].dataType, T.VariantType):
        return F.try_variant_get(payload, "$", f"STRUCT<{fields}>")
    return F.from_json(payload, fields)


def _messages_type(fields: list[str]) -> str:
    inner = ", ".join(f"{name}: STRING" for name in fields)
    return f"MAP<STRING, ARRAY<STRUCT<{inner}>>>"


def _total(messages: Column, field: str, whole: bool = False) -> Column:
    """Sum of one field over a list of messages; null lists, messages and counts add 0.

    With ``whole`` each count loses its fraction before it is added, else only the sum does.
    """

    def add(total: Column, message: Column) -> Column:
        value = double_or_zero(message[field])
        return total + (F.when(value < 0, F.ceil(value)).otherwise(F.floor(value)).cast("double") if whole else value)

    return F.coalesce(F.aggregate(messages, F.lit(0.0), add), F.lit(0.0))


def _measure(channel: Column, messages: Column, measure: str, metrics: Metrics, whole: bool = False) -> Column:
    return channel_measure(channel, measure, lambda field: _total(messages, field, whole), metrics)


def campaign_variants(series: DataFrame, metrics: Metrics = CHANNEL_METRICS) -> DataFrame:
    """One row per campaign, day and message variation. Unmapped channels count 0 entries."""
    extra = ["variation_name", "variation_api_id", "revenue", "unique_recipients", "conversions"]
    fields = sorted({by["sends"] for by in metrics.values() if by.get("sends")}) + extra
    day = _fields(series, "data", f"time STRING, messages {_messages_type(fields)}")
    channels = series.select("campaign_id", day.alias("d")).select(
        "campaign_id", "d.time", F.explode("d.messages").alias("channel", "messages")
    )
    rows = channels.select("campaign_id", "time", "channel", F.explode("messages").alias("m"))
    entries = channel_measure(F.col("channel"), "sends", lambda field: int_or_zero(F.col(f"m.{field}")), metrics)
    return cast_to(
        rows.filter(F.col("m").isNotNull()).select(
            F.col("campaign_id").alias("id"),
            F.lit("campaign").alias("type"),
            parse_iso(F.col("time")).alias("time"),
            F.coalesce("m.variation_name", F.lit("")).alias("variant_name"),
            F.col("m.variation_api_id").alias("variant_id"),
            entries.alias("total_entries"),
            double_or_zero(F.col("m.revenue")).alias("revenue"),
            int_or_zero(F.col("m.unique_recipients")).alias("unique_recipients"),
            int_or_zero(F.col("m.conversions")).alias("conversions"),
            is_control_name(F.col("m.variation_name")).alias("is_control_group"),
        ),
        VARIANTS,
    )


def canvas_variants(series: DataFrame) -> DataFrame:
    """One row per canvas, day and variant. Canvases do not report unique recipients: always 0."""
    stat = "STRUCT<name: STRING, entries: STRING, revenue: STRING, conversions: STRING>"
    day = _fields(series, "stats", f"time STRING, variant_stats MAP<STRING, {stat}>")
    rows = series.select("canvas_id", day.alias("d")).select(
        "canvas_id", "d.time", F.explode("d.variant_stats").alias("variant_id", "v")
    )
    return cast_to(
        rows.select(
            "variant_id",
            F.col("canvas_id").alias("id"),
            F.lit("canvas").alias("type"),
            parse_iso(F.col("time")).alias("time"),
            F.col("v.name").alias("variant_name"),
            int_or_zero(F.col("v.entries")).alias("total_entries"),
            double_or_zero(F.col("v.revenue")).alias("revenue"),
            F.lit(0).alias("unique_recipients"),
            int_or_zero(F.col("v.conversions")).alias("conversions"),
            is_control_name(F.col("v.name")).alias("is_control_group"),
        ),
        VARIANTS,
    )


def _canvas_step_days(series: DataFrame, step_type: str) -> DataFrame:
    day = _fields(series, "stats", f"time STRING, step_stats MAP<STRING, {step_type}>")
    return series.select("canvas_id", day.alias("d")).select(
        "canvas_id", "d.time", F.explode("d.step_stats").alias("step_id", "s")
    )


def canvas_steps(series: DataFrame, metrics: Metrics = CHANNEL_METRICS) -> DataFrame:
    """One row per canvas, day and step, its counts summed over all channels of the step."""
    messages = _messages_type(message_fields(metrics))
    step = (
        "STRUCT<name: STRING, revenue: STRING, conversions: STRING, unique_recipients: STRING,"
        f" messages: {messages}>"
    )
    rows = _canvas_step_days(series, step)

    def over_channels(measure: str) -> Column:
        per_channel = F.transform(
            F.map_entries("s.messages"),
            lambda entry: _measure(entry["key"], entry["value"], measure, metrics, whole=True).cast("double"),
        )
        return F.coalesce(F.aggregate(per_channel, F.lit(0.0), lambda total, n: total + n), F.lit(0.0))

    return cast_to(
        rows.select(
            parse_iso(F.col("time")).alias("time"),
            "canvas_id",
            "step_id",
            F.col("s.name").alias("step_name"),
            double_or_zero(F.col("s.revenue")).alias("revenue"),
            int_or_zero(F.col("s.conversions")).alias("conversions"),
            comma_list(F.map_keys("s.messages")).alias("channels"),
            F.col("s.unique_recipients").try_cast("double").alias("unique_recipients"),
            over_channels("sends").alias("sent"),
            over_channels("opens").alias("total_opens"),
            over_channels("clicks").alias("clicks"),
        ),
        CANVAS_STEPS,
    )


def campaign_channels(series: DataFrame, metrics: Metrics = CHANNEL_METRICS) -> DataFrame:
    """One row per campaign, day and channel. A channel that is not mapped keeps a row of zeros."""
    fields = sorted({*message_fields(metrics), "conversions", "revenue"})
    day = _fields(series, "data", f"time STRING, messages {_messages_type(fields)}")
    rows = series.select("campaign_id", day.alias("d")).select(
        "campaign_id", "d.time", F.explode("d.messages").alias("channel_name", "messages")
    )
    channel, messages = F.col("channel_name"), F.col("messages")
    mapped = channel.isin(*metrics)
    return cast_to(
        rows.select(
            parse_iso(F.col("time")).alias("time"),
            "channel_name",
            F.lit("campaign").alias("type"),
            F.col("campaign_id").alias("id"),
            *[_measure(channel, messages, m, metrics).alias(m) for m in ("sends", "opens", "clicks", "delivered")],
            F.when(mapped, _total(messages, "conversions")).otherwise(0.0).alias("conversions"),
            F.when(mapped, _total(messages, "revenue")).otherwise(0.0).alias("revenue"),
        ),
        CHANNELS_CAMPAIGN,
    )


def canvas_channels(series: DataFrame, metrics: Metrics = CHANNEL_METRICS) -> DataFrame:
    """One row per canvas, day, step and channel."""
    steps = _canvas_step_days(series, f"STRUCT<messages: {_messages_type(message_fields(metrics))}>")
    rows = steps.select("canvas_id", "time", "step_id", F.explode("s.messages").alias("channel_name", "messages"))
    channel, messages = F.col("channel_name"), F.col("messages")
    return cast_to(
        rows.select(
            parse_iso(F.col("time")).alias("time"),
            "channel_name",
            F.lit("canvas").alias("type"),
            F.col("canvas_id").alias("id"),
            "step_id",
            *[_measure(channel, messages, m, metrics).alias(m) for m in ("sends", "opens", "clicks", "delivered")],
        ),
        CHANNELS_CANVAS,
    )
