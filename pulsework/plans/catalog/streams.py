"""Streaming jobs over the given files, run until nothing is left and compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsework.plans import derive
from pulsework.plans.catalog.registry import EVENTS, query, unique_name, with_text_times
from pulsework.session import new_work_dir, use_utc
from pulsework.sources import list_files
from pulsework.streaming import (
    append_new_files,
    daily_sums,
    dedupe_events,
    read_state,
    stream_files,
    sums_to_days,
    upsert_latest,
)


def _event_stream(spark, sf_dir):
    use_utc(spark)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    rows = stream_files(spark, sf_dir, schema, glob="events.parquet")
    # A watermark needs a time with zone.
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "s8_st1_stream_new_files",
    "SELECT event_id, user_id, event_type, 'events.parquet' AS file FROM events",
)
def stream_new_files(spark, sf_dir):
    """Started twice; the second start finds nothing new."""
    root = new_work_dir(spark, "stream")
    for _ in range(2):
        append_new_files(_event_stream(spark, sf_dir), f"{root}/rows", f"{root}/checkpoint")
    rows = spark.read.parquet(f"{root}/rows")
    file = F.element_at(F.split("file_name", "/"), -1).alias("file")
    return rows.select("event_id", "user_id", "event_type", file)


@query(
    "st2_stream_latest_upsert",
    """SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def stream_latest_upsert(spark, sf_dir):
    """The events arrive in three parts, one micro-batch each. The job is stopped after the first and started again for the others.

    A part has as many files as tasks wrote it; a batch takes as many as a part has, so that larger tables make larger batches and not more
    of them. Folding after every second batch, so that merged state and later changes are read together.
    """
    root = new_work_dir(spark, "stream")
    rows = derive.events(spark, sf_dir).select("user_id", "event_type", "event_id", "ts")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(3)))
    known = 0
    for arriving, batches in ((F.col("part") == 0, 1), (F.col("part") > 0, 2)):
        rows.filter(arriving).write.mode("append").partitionBy("part").parquet(f"{root}/arriving")
        files = list_files(spark, f"{root}/arriving").count()
        known, new = files, files - known
        stream = stream_files(spark, f"{root}/arriving/*", rows.drop("part").schema, files_per_batch=max(1, -(-new // batches)))
        upsert_latest(
            stream.drop("file_name", "inserted_at"), f"{root}/state", f"{root}/checkpoint", ["user_id", "event_type"], ["ts"], "ts",
            fold_after=2,
        )
    return with_text_times(read_state(spark, f"{root}/state"), fraction=True)


@query("st3_stream_dedupe_events", "SELECT event_id, user_id FROM events")
def stream_dedupe_events(spark, sf_dir):
    """Every fifth event arrives twice in the stream and leaves it once."""
    root = new_work_dir(spark, "stream")
    stream = _event_stream(spark, sf_dir).select("event_id", "user_id", "ts")
    copies = F.when(F.pmod("event_id", F.lit(5)) == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    doubled = stream.withColumn("copy", F.explode(copies)).drop("copy")
    unique = dedupe_events(doubled, "ts", ["event_id"], "40 days")
    append_new_files(unique, f"{root}/rows", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/rows").select("event_id", "user_id")


@query(
    "st4_stream_daily_channel_sums",
    f"""WITH {EVENTS}
    SELECT day, channel, count(*) AS rows, cast(sum(cents) AS bigint) AS cents FROM ev GROUP BY day, channel""",
)
def stream_daily_channel_sums(spark, sf_dir):
    """Sums per day and channel, with late data awaited for thirty days."""
    root = new_work_dir(spark, "stream")
    stream = _event_stream(spark, sf_dir).select(
        "ts", derive.channel().alias("channel"), F.round(F.col("value") * 100).cast("bigint").alias("cents")
    )
    totals = daily_sums(stream, "ts", ["channel"], ["cents"], "30 days")
    table = unique_name("channel_sums")
    sums_to_days(totals, table, f"{root}/checkpoint", ["day", "channel"], location=f"{root}/sums")
    return with_text_times(spark.table(table))
