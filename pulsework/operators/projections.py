"""Column choices shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsework.schemas import REPLICATION_COLUMNS


def drop_replication_columns(df: DataFrame) -> DataFrame:
    return df.drop(*REPLICATION_COLUMNS)


def playbook_id() -> Column:
    """A delivery belongs to a campaign, else a newsletter, else a transactional message."""
    return F.coalesce("campaign_id", "newsletter_id", "transactional_message_id")


def playbook_type() -> Column:
    return (
        F.when(F.col("campaign_id").isNotNull(), "campaign")
        .when(F.col("newsletter_id").isNotNull(), "newsletter")
        .when(F.col("transactional_message_id").isNotNull(), "transactional_message")
    )


def channel_id() -> Column:
    return F.coalesce("action_id", "content_id")
