"""The daily series from a stored table whose payloads are VARIANT, against the SQL for the same series from text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsework.operators import landing_rows, series
from pulsework.operators.latest import dedupe, latest
from pulsework.plans import derive
from pulsework.plans.catalog import nested  # noqa: F401  (registers the SQL used here)
from pulsework.plans.catalog.registry import ORACLES, query, with_text_times
from pulsework.session import new_work_dir
from pulsework.sources import accepted, parse_variants


def stored_series(spark: SparkSession, lines: DataFrame, listed: str, rows: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Landed once as a raw table, which knows no text of the payloads."""
    landed, path = rows(accepted(parse_variants(lines, [listed]))), new_work_dir(spark, "variants")
    landed.write.parquet(path)
    return spark.read.schema(landed.schema).parquet(path)


def _campaigns(spark, sf_dir):
    lines = derive.campaign_lines(derive.events(spark, sf_dir))
    return stored_series(spark, lines, "data", landing_rows.campaign_series_variants)


def _canvases(spark, sf_dir):
    lines = derive.canvas_lines(derive.events(spark, sf_dir))
    return stored_series(spark, lines, "stats", landing_rows.canvas_series_variants)


@query("s1_n7_variants_of_variant", ORACLES["n7_campaign_variants"])
def campaign_variants(spark, sf_dir):
    return with_text_times(series.campaign_variants(_campaigns(spark, sf_dir)))


@query("s1_n8_canvas_variants_of_variant", ORACLES["n8_canvas_variants"])
def canvas_variants(spark, sf_dir):
    return with_text_times(series.canvas_variants(_canvases(spark, sf_dir)))


@query("s1_n9_canvas_steps_of_variant", ORACLES["n9_a6_canvas_steps"])
def canvas_steps(spark, sf_dir):
    return with_text_times(series.canvas_steps(_canvases(spark, sf_dir)))


@query("s1_n10_campaign_channels_of_variant", ORACLES["n10_a5_campaign_channels"])
def campaign_channels(spark, sf_dir):
    """Some lines are delivered twice; of either delivery a day has one row that counts."""
    rows = derive.events(spark, sf_dir)
    stale = rows.filter(F.pmod("user_id", F.lit(3)) == 0).withColumn("cents", F.col("cents") * 2)
    lines = derive.campaign_lines(rows).unionByName(derive.campaign_lines(stale, timestamp=1704400000.75))
    raw = stored_series(spark, lines, "data", landing_rows.campaign_series_variants)
    channels = series.campaign_channels(latest(raw, "campaign_series"))
    return with_text_times(dedupe(channels, ["time", "channel_name", "type", "id"]))


@query("s1_n11_canvas_channels_of_variant", ORACLES["n11_a5_canvas_channels"])
def canvas_channels(spark, sf_dir):
    return with_text_times(series.canvas_channels(_canvases(spark, sf_dir)))
