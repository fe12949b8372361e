"""Timestamps from ISO text, epoch seconds and device clocks. All times are UTC."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted shapes of an ISO 8601 time. Compact and week forms are not
# accepted and give NULL.
ISO_SHAPE = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([ T]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}:\d{2})?)?$"
)
_HOUR_ONLY = r"^(.{10})[ T](\d{2})(Z|[+-].{5})?$"
_MINUTE_ONLY = r"^(.{10})[ T](\d{2}:\d{2})(Z|[+-].{5})?$"


def parse_iso(text: Column) -> Column:
    """ISO text to timestamp; empty, malformed or impossible dates give NULL.

    The shape test comes first since a plain cast also takes ``2025`` or ``2025-1-1``.
    The cast rejects times without seconds next to an offset; only those are filled up.
    """
    filled = F.regexp_replace(text, _HOUR_ONLY, "$1 $2:00:00$3")
    filled = F.regexp_replace(filled, _MINUTE_ONLY, "$1 $2:00$3")
    return F.when(text.rlike(ISO_SHAPE), F.coalesce(text.try_cast("timestamp"), filled.try_cast("timestamp")))


def from_epoch_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds.try_cast("double").cast("bigint"))


def to_epoch_seconds(time: Column) -> Column:
    return F.unix_timestamp(time)


def days_before(day: Column, days: Column | int) -> Column:
    """``yyyy-MM-dd`` minus some days; NULL when the text is not a date."""
    text = day.cast("string")
    parsed = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, "y-M-d"))
    return F.date_sub(parsed, F.lit(days) if isinstance(days, int) else days)


def parse_second_text(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to timestamp."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))


def epoch_zero_to_null(time: Column) -> Column:
    """1970-01-01 00:00:00 stands for "not known" in people exports."""
    return F.nullif(time, F.lit("1970-01-01 00:00:00").cast("timestamp"))


def skew_corrected_time(client_event: Column, client_upload: Column, server_received: Column) -> Column:
    """Client event time, moved by the client's clock error when that is a minute or more.

    Whole seconds. A NULL input gives NULL, so that the row falls out of any date filter.
    """
    event, upload, received = (F.unix_timestamp(c) for c in (client_event, client_upload, server_received))
    drift = received - upload
    return F.timestamp_seconds(F.when(drift < 60, event).otherwise(event + drift))


def least_time(*times: Column) -> Column:
    return F.least(*times) if len(times) > 1 else times[0]


def greatest_time(*times: Column) -> Column:
    return F.greatest(*times) if len(times) > 1 else times[0]


def day_text(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd")


def in_days(time: Column, first_day: str, last_day: str) -> Column:
    """True for times on the days ``first_day`` to ``last_day``, both whole days included.

    A half-open range on the bare column, so that the scan can skip row groups. The text
    bounds take the column's own timestamp type, with or without zone.
    """
    after = (date.fromisoformat(last_day) + timedelta(days=1)).isoformat()
    return (time >= F.lit(first_day)) & (time < F.lit(after))


def not_in_days(time: Column, first_day: str, last_day: str) -> Column:
    """True for times on other days and for unknown times."""
    after = (date.fromisoformat(last_day) + timedelta(days=1)).isoformat()
    return time.isNull() | (time < F.lit(first_day)) | (time >= F.lit(after))
