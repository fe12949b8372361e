"""Descriptions of campaigns, canvases, newsletters, transactional messages and people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsework.functions import (
    bool_or_false,
    bool_unless_false_text,
    comma_list,
    distinct_comma_list,
    epoch_zero_to_null,
    from_epoch_seconds,
    is_control_name,
    json_path,
    json_size,
    parse_iso,
    tag_value,
)
from pulsework.operators.filters import any_on_days
from pulsework.schemas import (
    API_BROADCASTS,
    CAMPAIGN_DETAILS,
    CANVAS_DETAILS,
    CIO_CAMPAIGN_DETAILS,
    CIO_NEWSLETTER_DETAILS,
    CIO_PEOPLE,
    CIO_TRANSACTIONAL_DETAILS,
    cast_to,
)


def _text(fields: Column, name: str) -> Column:
    """A missing key reads as '', an explicit null stays NULL."""
    return F.when(F.map_contains_key(fields, name), fields[name]).otherwise("")


def _described(rows: DataFrame, key: str, first_sent: str, last_sent: str, messages: Column) -> DataFrame:
    fields = F.col("fields")
    tags = F.from_json(fields["tags"], "ARRAY<STRING>")
    return rows.select(
        key,
        _text(fields, "name").alias("name"),
        _text(fields, "description").alias("description"),
        *[bool_or_false(fields[flag]).alias(f"is_{flag}") for flag in ("archived", "enabled", "draft")],
        parse_iso(fields["created_at"]).alias("created_at"),
        parse_iso(fields["updated_at"]).alias("updated_at"),
        _text(fields, "schedule_type").alias("schedule_type"),
        comma_list(F.from_json(fields["channels"], "ARRAY<STRING>")).alias("channels"),
        parse_iso(fields[first_sent]).alias("first_sent"),
        parse_iso(fields[last_sent]).alias("last_sent"),
        messages.alias("messages"),
        tag_value(tags, "Goal").alias("goal"),
        tag_value(tags, "Stage").alias("stage"),
    )


def campaign_details(details: DataFrame) -> DataFrame:
    """``messages`` counts the messages whose name is text and not a control group's."""
    rows = details.select("campaign_id", F.from_json("data", "MAP<STRING, STRING>").alias("fields"))
    messages = F.from_json(F.col("fields")["messages"], "MAP<STRING, STRUCT<name: VARIANT>>")
    named = F.filter(
        F.map_values(messages),
        lambda m: (F.schema_of_variant(m["name"]) == "STRING") & ~is_control_name(m["name"].try_cast("string")),
    )
    count = F.coalesce(F.size(named), F.lit(0))
    return cast_to(_described(rows, "campaign_id", "first_sent", "last_sent", count), CAMPAIGN_DETAILS)


def canvas_details(details: DataFrame) -> DataFrame:
    """``messages`` counts the messages of all steps that are not a control group's."""
    body = json_path(F.col("data"), "$.data")
    rows = details.select("canvas_id", F.from_json(body, "MAP<STRING, STRING>").alias("fields"))
    steps = F.from_json(F.col("fields")["steps"], "ARRAY<STRUCT<name: STRING, messages: STRING>>")
    count = F.aggregate(
        steps,
        F.lit(0),
        lambda total, step: total + F.when(is_control_name(step["name"]), 0).otherwise(json_size(step["messages"])),
    )
    return cast_to(
        _described(rows, "canvas_id", "first_entry", "last_entry", F.coalesce(count, F.lit(0))), CANVAS_DETAILS
    )


def cio_campaign_details(campaigns: DataFrame) -> DataFrame:
    """All versions of each campaign; take the latest by ``updated_at`` before writing."""
    actions = F.from_json("actions", "ARRAY<STRUCT<type: STRING>>")
    return cast_to(
        campaigns.select(
            F.col("id").alias("campaign_id"),
            F.coalesce("name", F.lit("")).alias("name"),
            "state",
            "active",
            distinct_comma_list(F.transform(actions, lambda a: a["type"])).alias("channels"),
            "actions",
            from_epoch_seconds(F.col("created")).alias("created_at"),
            from_epoch_seconds(F.col("updated")).alias("updated_at"),
            from_epoch_seconds(F.col("first_started")).alias("first_started"),
            "deduplicate_id",
            "trigger_segment_ids",
            "tags",
        ),
        CIO_CAMPAIGN_DETAILS,
    )


def cio_newsletter_details(newsletters: DataFrame) -> DataFrame:
    return cast_to(
        newsletters.select(
            F.col("id").alias("newsletter_id"),
            F.coalesce("name", F.lit("")).alias("name"),
            "tags",
            "type",
            *[from_epoch_seconds(F.col(c)).alias(c) for c in ("created", "sent_at", "updated")],
            "content_ids",
            "deduplicate_id",
        ),
        CIO_NEWSLETTER_DETAILS,
    )


def cio_transactional_details(messages: DataFrame) -> DataFrame:
    return cast_to(
        messages.select(
            F.col("id").alias("transactional_message_id"),
            F.coalesce("name", F.lit("")).alias("name"),
            "description",
            "send_to_unsubscribed",
            "link_tracking",
            "open_tracking",
            "hide_message_body",
            "queue_drafts",
            *[from_epoch_seconds(F.col(c)).alias(c) for c in ("created_at", "updated_at")],
        ),
        CIO_TRANSACTIONAL_DETAILS,
    )


def cio_people(people: DataFrame, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """Latest people, cut to those created or updated on the days. Unknown flags count as set."""
    if first_day is not None and last_day is not None:
        people = any_on_days(people, ["updated_at", "created_at"], first_day, last_day)
    return cast_to(
        people.select(
            F.col("customer_id").alias("user_id"),
            "internal_customer_id",
            bool_unless_false_text(F.col("deleted")).alias("deleted"),
            bool_unless_false_text(F.col("suppressed")).alias("suppressed"),
            epoch_zero_to_null(F.col("created_at").cast("timestamp")).alias("created_at"),
            "updated_at",
        ),
        CIO_PEOPLE,
    )


def api_broadcasts(broadcasts: DataFrame) -> DataFrame:
    return broadcasts.withColumnRenamed("id", "api_broadcast_id").select(*API_BROADCASTS).distinct()
