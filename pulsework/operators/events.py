"""Tracked events: registry join, de-duplication and clock correction."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsework.functions import in_days, skew_corrected_time
from pulsework.operators.latest import latest
from pulsework.operators.projections import drop_replication_columns


def with_event_type(events: DataFrame, registry: DataFrame, event: str = "event_type", active_only: bool = True) -> DataFrame:
    """Events of registered types with their type id.

    The registry has one row per tracked event name. Spark broadcasts it while it is below
    ``spark.sql.autoBroadcastJoinThreshold``; beyond, adaptive execution splits the
    partitions of frequent types.
    """
    types = registry.filter("is_active") if active_only else registry
    ids = types.select(F.col("event_type").alias(event), "event_type_id").distinct()
    return events.join(ids, event)


def mixpanel_events(raw: DataFrame, registry: DataFrame) -> DataFrame:
    """The newest copy of each event, active types only; the same event can be exported twice."""
    columns = ["event", "time", "distinct_id", "insert_id", "properties", "metadata", "created_at", "event_type_id"]
    rows = with_event_type(latest(raw, "mixpanel_events"), registry, event="event")
    return rows.select(*columns).withColumn("created_at", F.col("created_at").cast("decimal(20,6)"))


def amplitude_events(
    raw: DataFrame, registry: DataFrame, first_day: str, last_day: str, active_only: bool = False
) -> DataFrame:
    """Events of known users with corrected time on the days; other columns pass through.

    Correction never moves an event back, so the client's own time bounds the scan from above.
    """
    after = (date.fromisoformat(last_day) + timedelta(days=1)).isoformat()
    corrected = skew_corrected_time(
        F.col("client_event_time"), F.col("client_upload_time"), F.col("server_received_time")
    )
    timed = (
        drop_replication_columns(raw)
        .filter(F.col("user_id").isNotNull() & (F.col("client_event_time") < F.lit(after).cast("timestamp")))
        .withColumn("event_time_calculated", corrected)
        .filter(in_days(F.col("event_time_calculated"), first_day, last_day))
    )
    joined = with_event_type(timed, registry, active_only=active_only)
    passed = [c for c in timed.columns if c != "event_time_calculated"]
    return joined.select(*passed, "event_type_id", "event_time_calculated")
