from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, the SQL for the same result."""

    def add(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def unique_name(label: str) -> str:
    """A table name no other run uses."""
    return f"pulsework_{label}_{uuid.uuid4().hex}"


def seconds(time: str | Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


def micros(time: str | Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def with_text_times(df: DataFrame, fraction: bool = False) -> DataFrame:
    """Times and days as text, so that comparing results does not depend on a client's time zone."""
    shown = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType):
            shown.append((micros if fraction else seconds)(f.name).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            shown.append(F.date_format(f.name, "yyyy-MM-dd").alias(f.name))
        else:
            shown.append(F.col(f.name))
    return df.select(*shown)


# ---- SQL shared by the expected results --------------------------------------------------

SECONDS = "'%Y-%m-%d %H:%M:%S'"
MICROS = "'%Y-%m-%d %H:%M:%S.%f'"

# Events with whole cents, a day and the channel that the derived payloads put them on.
EVENTS = """
ev AS (
  SELECT event_id, ts, user_id, event_type, props, cast(round(value * 100) AS bigint) AS cents,
    strftime(ts, '%Y-%m-%d') AS day,
    list_extract(['ios_push', 'android_push', 'trigger_in_app_message', 'email', 'sms', 'webhook', 'whats_app',
      'content_cards', 'carrier_pigeon'],
      cast((CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 WHEN 'purchase' THEN 4 ELSE 0 END
        + user_id) % 9 + 1 AS int)) AS channel
  FROM events
)"""

# What the message fields of a group with n rows and c cents add up to per channel.
MEASURES = """
  cast(CASE WHEN channel IN ('trigger_in_app_message', 'carrier_pigeon') THEN 0 ELSE n END AS int) AS sends,
  cast(CASE channel WHEN 'ios_push' THEN c WHEN 'android_push' THEN c WHEN 'trigger_in_app_message' THEN 2 * c
    WHEN 'email' THEN 3 * c WHEN 'whats_app' THEN 4 * c + n WHEN 'content_cards' THEN 5 * c ELSE 0 END AS int) AS opens,
  cast(CASE channel WHEN 'ios_push' THEN c + n WHEN 'android_push' THEN c + n WHEN 'trigger_in_app_message'
    THEN 2 * c + n WHEN 'email' THEN 3 * c + n WHEN 'sms' THEN 2 * c + n WHEN 'content_cards' THEN 5 * c + n
    ELSE 0 END AS int) AS clicks,
  cast(CASE WHEN channel IN ('email', 'sms', 'whats_app') THEN 4 * c ELSE 0 END AS int) AS delivered"""

# Orders and order lines in the shape of deliveries and their metric events.
DELIVERIES = """
deliveries AS (
  SELECT cast(o_orderkey AS varchar) AS delivery_id, 'p-' || (o_custkey % 500) AS internal_customer_id,
    cast(o_orderkey % 7 AS int) AS playbook,
    CASE o_orderkey % 4 WHEN 0 THEN 'campaign' WHEN 1 THEN 'newsletter' WHEN 2 THEN 'transactional_message' END AS type,
    cast(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 11 ELSE o_orderkey % 13 END AS int) AS channel,
    CASE WHEN o_orderkey % 2 = 0 THEN 'email' ELSE 'push' END AS channel_name
  FROM orders
), delivery_events AS (
  SELECT cast(l_orderkey AS varchar) AS delivery_id,
    CASE l_returnflag WHEN 'A' THEN 'opened' WHEN 'R' THEN 'clicked' ELSE 'sent' END AS metric, l_shipdate AS created_at
  FROM lineitem
)"""
