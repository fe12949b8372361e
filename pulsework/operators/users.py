"""User exports to playbooks received, steps received and attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsework.functions import falsy_json_to_null, parse_iso
from pulsework.schemas import USER_DETAILS, USER_PLAYBOOK, USER_PLAYBOOK_STEPS, cast_to


def _playbooks(rows: DataFrame, kind: str, id_: str, received: str, control: str, events: str) -> DataFrame:
    return cast_to(
        rows.select(
            F.col(f"p.{id_}").alias("id"),
            F.col("p.name").alias("name"),
            F.lit(kind).alias("type"),
            "user_id",
            parse_iso(F.col(f"p.{received}")).alias("last_received"),
            F.col(f"p.{control}").try_cast("boolean").alias("in_control"),
            F.col("p.converted").try_cast("boolean").alias("converted"),
            falsy_json_to_null(F.col(f"p.{events}")).alias("conversion_events_performed"),
            falsy_json_to_null(F.col("p.engaged")).alias("message_status"),
        ),
        USER_PLAYBOOK,
    )


def _received(users: DataFrame, column: str, fields: str) -> DataFrame:
    items = F.from_json(column, f"ARRAY<STRUCT<{fields}>>")
    return users.select("user_id", F.explode(items).alias("p")).filter(F.col("p").isNotNull())


def user_campaigns(users: DataFrame) -> DataFrame:
    """One row per user and campaign received."""
    fields = (
        "name: STRING, api_campaign_id: STRING, last_received: STRING, in_control: STRING, converted: STRING,"
        " multiple_converted: STRING, engaged: STRING"
    )
    rows = _received(users, "campaigns_received", fields)
    return _playbooks(rows, "campaign", "api_campaign_id", "last_received", "in_control", "multiple_converted")


def user_canvases(users: DataFrame) -> DataFrame:
    """One row per user and canvas received."""
    fields = (
        "name: STRING, api_canvas_id: STRING, last_received_message: STRING, is_in_control: STRING,"
        " converted: STRING, conversion_events_performed: STRING, engaged: STRING"
    )
    rows = _received(users, "canvases_received", fields)
    return _playbooks(
        rows, "canvas", "api_canvas_id", "last_received_message", "is_in_control", "conversion_events_performed"
    )


def user_canvas_steps(users: DataFrame) -> DataFrame:
    """One row per user, canvas and step received."""
    step = "STRUCT<api_canvas_step_id: STRING, name: STRING, last_received: STRING>"
    canvases = _received(users, "canvases_received", f"api_canvas_id: STRING, steps_received: ARRAY<{step}>")
    rows = canvases.select("user_id", F.col("p.api_canvas_id").alias("playbook_id"), F.explode("p.steps_received").alias("s"))
    return cast_to(
        rows.filter(F.col("s").isNotNull()).select(
            F.col("s.api_canvas_step_id").alias("step_id"),
            F.col("s.name").alias("step_name"),
            "playbook_id",
            "user_id",
            parse_iso(F.col("s.last_received")).alias("last_received"),
        ),
        USER_PLAYBOOK_STEPS,
    )


def user_details(users: DataFrame) -> DataFrame:
    return cast_to(users, USER_DETAILS)
