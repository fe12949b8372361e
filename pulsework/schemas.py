"""Column lists and types of landing records, raw tables and results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
}


def schema(columns: str, *more: T.StructField) -> T.StructType:
    """Flat columns as ``name TYPE, ...`` plus ready-made fields; needs no running session."""
    flat = [column.split() for column in columns.split(",") if column.strip()]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in flat] + list(more))


def cast_to(df, target: T.StructType):
    """Ordered projection onto a target schema, each column cast to its type."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])


# ---- landing records: one JSON object per line -------------------------------------
# Nested values that stay JSON are declared STRING; the reader keeps their text.

METADATA = T.StructField(
    "metadata",
    schema("timestamp DOUBLE", T.StructField("params", T.MapType(T.StringType(), T.StringType())))
    .add("run_id", T.StringType()),
)


def _list_of(name: str, item: T.DataType) -> T.StructField:
    return T.StructField(name, T.ArrayType(item))


CAMPAIGN_LIST_LINE = schema(
    "id STRING, name STRING, tags STRING, last_edited STRING, is_api_campaign BOOLEAN", METADATA
)
CANVAS_LIST_LINE = schema("id STRING, name STRING, tags STRING, last_edited STRING", METADATA)
CAMPAIGN_SERIES_LINE = schema("", _list_of("data", T.StringType()), METADATA)
CANVAS_SERIES_LINE = schema("name STRING", _list_of("stats", T.StringType()), METADATA)
CAMPAIGN_DETAILS_LINE = schema("data STRING", METADATA)
CANVAS_DETAILS_LINE = schema("", METADATA)
EVENT_LINE = schema("event STRING, properties STRING", METADATA)
EXPORTED_USER = schema(
    "external_id STRING, custom_attributes STRING, purchases STRING, dob STRING, country STRING,"
    " home_city STRING, language STRING, gender STRING, push_subscribe STRING, push_opted_in_at STRING,"
    " email_subscribe STRING, email_opted_in_at STRING, devices STRING, apps STRING,"
    " campaigns_received STRING, canvases_received STRING"
)
USER_EXPORT_LINE = schema("", _list_of("data", EXPORTED_USER), METADATA)

# ---- landing Parquet files -----------------------------------------------------------

DELIVERIES = schema(
    "delivery_id STRING, internal_customer_id STRING, event_id STRING, delivery_type STRING, campaign_id INT,"
    " action_id INT, newsletter_id INT, content_id INT, trigger_id INT, transactional_message_id INT,"
    " created_at TIMESTAMP"
)
METRICS = schema("event_id STRING, delivery_id STRING, metric STRING, reason STRING, created_at TIMESTAMP")
OUTPUTS = schema(
    "subject_name STRING, output_type STRING, action_id INT, explanation STRING, delivery_id STRING,"
    " delay_ends_at TIMESTAMP, created_at TIMESTAMP"
)
SUBJECTS = schema(
    "subject_name STRING, internal_customer_id STRING, campaign_type STRING, campaign_id INT, trigger_id INT,"
    " started_campaign_at TIMESTAMP, created_at TIMESTAMP"
)
PEOPLE = schema(
    "customer_id STRING, internal_customer_id STRING, deleted BOOLEAN, suppressed BOOLEAN,"
    " created_at TIMESTAMP, updated_at TIMESTAMP"
)

# ---- dimensions ------------------------------------------------------------------------

EVENT_TYPES = schema("event_type STRING, event_type_id BIGINT, is_active BOOLEAN")
PROCESSED_FILES = schema(
    "file_name STRING, type STRING, min_timestamp TIMESTAMP, max_timestamp TIMESTAMP, inserted_at TIMESTAMP"
)

# The thirteen delivery metrics, the playbook kinds, and the columns a
# replication service adds to each table.
DELIVERY_METRICS = [
    "attempted",
    "bounced",
    "clicked",
    "converted",
    "delivered",
    "drafted",
    "dropped",
    "failed",
    "opened",
    "sent",
    "spammed",
    "undeliverable",
    "unsubscribed",
]
PLAYBOOK_TYPES = ["campaign", "canvas"]
REPLICATION_COLUMNS = ["_airbyte_raw_id", "_airbyte_extracted_at", "_airbyte_meta", "_airbyte_generation_id"]
JOURNEY_ARRAYS = ["started", "finished", "messaged", "activated", "converted", "exited_early", "never_activated"]
CHANNEL_ARRAYS = [
    "bounced",
    "clicked",
    "converted",
    "created",
    "deferred",
    "drafted",
    "failed",
    "opened",
    "sent",
    "spammed",
    "suppressed",
    "undeliverable",
    "topic_unsubscribed",
    "unsubscribed",
]

# ---- results ---------------------------------------------------------------------------

_DETAILS = (
    "name STRING, description STRING, is_archived BOOLEAN, is_enabled BOOLEAN, is_draft BOOLEAN,"
    " created_at TIMESTAMP, updated_at TIMESTAMP, schedule_type STRING, channels STRING, first_sent TIMESTAMP,"
    " last_sent TIMESTAMP, messages INT, goal STRING, stage STRING"
)
CAMPAIGN_DETAILS = schema(f"campaign_id STRING, {_DETAILS}")
CANVAS_DETAILS = schema(f"canvas_id STRING, {_DETAILS}")
VARIANTS = schema(
    "variant_id STRING, type STRING, id STRING, time TIMESTAMP, variant_name STRING, total_entries INT,"
    " revenue DOUBLE, unique_recipients INT, conversions INT, is_control_group BOOLEAN"
)
CANVAS_STEPS = schema(
    "time TIMESTAMP, canvas_id STRING, step_id STRING, step_name STRING, revenue DOUBLE, conversions INT,"
    " channels STRING, unique_recipients INT, sent INT, total_opens INT, clicks INT"
)
CHANNELS_CAMPAIGN = schema(
    "time TIMESTAMP, channel_name STRING, type STRING, id STRING, sends INT, opens INT, clicks INT,"
    " delivered INT, conversions INT, revenue DOUBLE"
)
CHANNELS_CANVAS = schema(
    "time TIMESTAMP, channel_name STRING, type STRING, id STRING, step_id STRING, sends INT, opens INT,"
    " clicks INT, delivered INT"
)
USER_PLAYBOOK = schema(
    "id STRING, name STRING, type STRING, user_id STRING, last_received TIMESTAMP, in_control BOOLEAN,"
    " converted BOOLEAN, conversion_events_performed STRING, message_status STRING"
)
USER_PLAYBOOK_STEPS = schema(
    "step_id STRING, step_name STRING, playbook_id STRING, user_id STRING, last_received TIMESTAMP"
)
USER_DETAILS = schema(
    "user_id STRING, custom_attributes STRING, purchases STRING, dob STRING, country STRING, home_city STRING,"
    " language STRING, gender STRING, push_subscribe STRING, push_opted_in_at STRING, email_subscribe STRING,"
    " email_opted_in_at STRING, devices STRING, apps STRING"
)
CIO_CAMPAIGN_DETAILS = schema(
    "campaign_id INT, name STRING, state STRING, active BOOLEAN, channels STRING, actions STRING,"
    " created_at TIMESTAMP, updated_at TIMESTAMP, first_started TIMESTAMP, deduplicate_id STRING,"
    " trigger_segment_ids STRING, tags STRING"
)
CIO_NEWSLETTER_DETAILS = schema(
    "newsletter_id INT, name STRING, tags STRING, type STRING, created TIMESTAMP, sent_at TIMESTAMP,"
    " updated TIMESTAMP, content_ids STRING, deduplicate_id STRING"
)
CIO_TRANSACTIONAL_DETAILS = schema(
    "transactional_message_id INT, name STRING, description STRING, send_to_unsubscribed BOOLEAN,"
    " link_tracking BOOLEAN, open_tracking BOOLEAN, hide_message_body BOOLEAN, queue_drafts STRING,"
    " created_at TIMESTAMP, updated_at TIMESTAMP"
)
CIO_PEOPLE = schema(
    "user_id STRING, internal_customer_id STRING, deleted BOOLEAN, suppressed BOOLEAN, created_at TIMESTAMP,"
    " updated_at TIMESTAMP"
)
CHANNEL_TOUCH = schema(
    "internal_customer_id STRING, playbook_id INT, type STRING, channel INT, channel_name STRING,"
    " created_at TIMESTAMP"
)
JOURNEY_METRICS = schema(
    "internal_customer_id STRING, playbook_id INT, type STRING, channel INT, playbook_type STRING,"
    " explanation STRING, metric STRING, delay_ends_at TIMESTAMP, started_campaign_at TIMESTAMP,"
    " created_at TIMESTAMP"
)
API_BROADCASTS = [
    "api_broadcast_id",
    "name",
    "deduplicate_id",
    "type",
    "created",
    "updated",
    "active",
    "state",
    "actions",
    "first_started",
    "tags",
]


def columns(target: T.StructType) -> list[Column]:
    return [F.col(name) for name in target.fieldNames()]
