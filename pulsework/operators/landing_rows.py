"""Landing records to raw tables: nested arrays become rows, payloads stay JSON text.

Input is what :func:`pulsework.sources.accepted` returns for the matching line schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsework.functions import int_or_zero, json_path
from pulsework.schemas import METADATA
from pulsework.sources.landing import LINE, VALUE


def _param(name: str) -> Column:
    return F.col("metadata.params")[name]


def _stamp() -> list[Column]:
    return [F.to_json("metadata").alias("metadata"), F.col("metadata.timestamp").alias("created_at")]


def campaign_list(lines: DataFrame) -> DataFrame:
    return lines.select("id", "name", "tags", "last_edited", "is_api_campaign", *_stamp())


def canvas_list(lines: DataFrame) -> DataFrame:
    return lines.select("id", "name", "tags", "last_edited", *_stamp())


def campaign_series(lines: DataFrame) -> DataFrame:
    """One row per campaign and day."""
    days = lines.select(_param("campaign_id").alias("campaign_id"), F.explode("data").alias("data"), *_stamp())
    return days.select(
        "campaign_id", json_path(F.col("data"), "$.time").alias("start_date"), "data", "metadata", "created_at"
    )


def canvas_series(lines: DataFrame) -> DataFrame:
    """One row per canvas and day."""
    days = lines.select(
        _param("canvas_id").alias("canvas_id"), "name", F.explode("stats").alias("stats"), *_stamp()
    )
    return days.select(
        "canvas_id", "name", json_path(F.col("stats"), "$.time").alias("start_date"), "stats", "metadata", "created_at"
    )


def campaign_series_variants(lines: DataFrame) -> DataFrame:
    """:func:`campaign_series` of :func:`pulsework.sources.parse_variants`: ``data`` is a VARIANT, which later jobs do not parse again.

    Where a payload has a value of another type than a job reads, that value alone is NULL; in text the whole field around it is.
    """
    return _variant_days(lines, "campaign_id", [], "data")


def canvas_series_variants(lines: DataFrame) -> DataFrame:
    """:func:`canvas_series` likewise, with ``stats`` as a VARIANT."""
    return _variant_days(lines, "canvas_id", ["name"], "stats")


#: Tells payloads apart that cannot be ordered themselves, so that ties between equally new rows are broken alike in every run.
PAYLOAD_CODE = "payload_code"


def _variant_days(lines: DataFrame, entity: str, plain: list[str], payload: str) -> DataFrame:
    def field(path: str, kind: str = "string") -> Column:
        return F.try_variant_get(VALUE, f"$.{path}", kind)

    days = lines.select(
        field(f"metadata.params.{entity}").alias(entity),
        *[field(name).alias(name) for name in plain],
        F.explode(field(payload, "array<variant>")).alias(payload),
        F.to_json(field("metadata", METADATA.dataType.simpleString())).alias("metadata"),
        field("metadata.timestamp", "double").alias("created_at"),
    )
    start = F.try_variant_get(payload, "$.time", "string").alias("start_date")
    code = F.xxhash64(F.to_json(payload)).alias(PAYLOAD_CODE)
    return days.select(entity, *plain, start, payload, "metadata", "created_at", code)


def campaign_details(lines: DataFrame) -> DataFrame:
    return lines.select(_param("campaign_id").alias("campaign_id"), "data", *_stamp())


def canvas_details(lines: DataFrame) -> DataFrame:
    """Keeps the whole line as ``data``: a canvas's fields sit one level down, under ``$.data``."""
    return lines.select(_param("canvas_id").alias("canvas_id"), F.col(LINE).alias("data"), *_stamp())


def user_export(lines: DataFrame) -> DataFrame:
    """One row per exported user. Nested attributes that are absent become empty JSON."""
    users = lines.select(F.explode("data").alias("u"), *_stamp())
    # The JSON that stands for "nothing" in each nested attribute.
    nested = {
        "custom_attributes": "{}",
        "purchases": "[]",
        "devices": "[]",
        "apps": "[]",
        "campaigns_received": "[]",
        "canvases_received": "[]",
    }
    plain = [
        "dob",
        "country",
        "home_city",
        "language",
        "gender",
        "push_subscribe",
        "push_opted_in_at",
        "email_subscribe",
        "email_opted_in_at",
    ]
    return users.select(
        F.col("u.external_id").alias("user_id"),
        *[F.col(f"u.{name}").alias(name) for name in plain],
        *[F.coalesce(f"u.{name}", F.lit(empty)).alias(name) for name, empty in nested.items()],
        "metadata",
        "created_at",
    )


def events(lines: DataFrame) -> DataFrame:
    """One row per tracked event; ``time`` is whole epoch seconds."""
    fields = F.from_json("properties", "time STRING, distinct_id STRING, `$insert_id` STRING")
    rows = lines.select("event", "properties", fields.alias("p"), *_stamp())
    time = F.col("p.time")
    return rows.select(
        "event",
        F.when(time.isNotNull(), int_or_zero(time, "bigint")).alias("time"),
        F.col("p.distinct_id").alias("distinct_id"),
        F.col("p.`$insert_id`").alias("insert_id"),
        "properties",
        "metadata",
        "created_at",
    )
