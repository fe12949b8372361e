"""Which payload field counts as a send, open, click or delivery on each channel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Metrics = dict[str, dict[str, str]]

# Field names per channel and measure. A measure that a channel does not
# report is left out and counts as 0.
CHANNEL_METRICS: Metrics = {
    "ios_push": {"sends": "sent", "opens": "total_opens", "clicks": "body_clicks"},
    "android_push": {"sends": "sent", "opens": "total_opens", "clicks": "body_clicks"},
    "trigger_in_app_message": {"opens": "impressions", "clicks": "clicks"},
    "email": {"sends": "sent", "opens": "unique_opens", "clicks": "unique_clicks", "delivered": "delivered"},
    "sms": {"sends": "sent", "clicks": "clicks", "delivered": "delivered"},
    "webhook": {"sends": "sent"},
    "whats_app": {"sends": "sent", "opens": "read", "delivered": "delivered"},
    "content_cards": {"sends": "sent", "opens": "total_impressions", "clicks": "total_clicks"},
}

MEASURES = ("sends", "opens", "clicks", "delivered")


def message_fields(metrics: Metrics = CHANNEL_METRICS) -> list[str]:
    """Every payload field that some channel reads, sorted."""
    return sorted({field for by_measure in metrics.values() for field in by_measure.values()})


def _channels_by_field(measure: str, metrics: Metrics) -> dict[str, list[str]]:
    grouped: dict[str, list[str]] = {}
    for channel, by_measure in metrics.items():
        if by_measure.get(measure):
            grouped.setdefault(by_measure[measure], []).append(channel)
    return grouped


def channel_measure(channel: Column, measure: str, read, metrics: Metrics = CHANNEL_METRICS) -> Column:
    """``read(field)`` for the field that holds ``measure`` on this row's channel, else 0.

    ``read`` turns a field name into a numeric Column. Channels sharing a field share one
    branch, and only the branch taken is evaluated.
    """
    branches = _channels_by_field(measure, metrics).items()
    none_yet = F.when(F.lit(False), F.lit(0))
    chain = reduce(lambda acc, item: acc.when(channel.isin(*item[1]), read(item[0])), branches, none_yet)
    return chain.otherwise(F.lit(0))
