"""The incremental loads as Structured Streaming jobs.

The checkpoint takes the place of a registry of processed files. Each job runs over what is
new and stops (``availableNow``); started again it goes on where it ended.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.readwriter import DataStreamWriter

from pulsework.operators.changelog import LOAD, UpsertRule, merged
from pulsework.operators.columns import comparable
from pulsework.session import discard
from pulsework.sinks import upsert_days_table


def stream_files(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Rows of files not seen before, with their file name and its modification time."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder).select(
        "*",
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("inserted_at"),
    )


class _LateRows(StreamingQueryListener):
    """Adds up what the watermark makes one query drop."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        late = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        with self.changed:
            run = str(event.progress.runId)
            self.dropped[run] = self.dropped.get(run, 0) + late

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()


def run_available(writer: DataStreamWriter, checkpoint: str) -> int:
    """Runs over what is new; returns how many rows came too late for the watermark and were left out.

    Rows are counted where a stateful operator drops them, i.e. after partial aggregation.
    """
    streams, late = SparkSession.active().streams, _LateRows()
    streams.addListener(late)
    try:
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run = str(query.runId)
        query.awaitTermination()
        with late.changed:
            late.changed.wait_for(lambda: run in late.ended, timeout=60)
            return late.dropped.get(run, 0)
    finally:
        streams.removeListener(late)


def append_new_files(stream: DataFrame, path: str, checkpoint: str) -> int:
    """Append each new file's rows once, also across restarts; returns the rows left out as too late."""
    return run_available(stream.writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint)


# Fixed value: the state store that keeps keys on disk, not on the heap.
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _keyed_state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB; a checkpoint remembers it."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def _folders(spark: SparkSession, root: str, kind: str) -> list[int]:
    """The numbers of the finished folders ``<kind>=<number>`` below the root."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path(root)):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path(root))]
    numbers = [name.split("=", 1)[1] for name in names if name.startswith(f"{kind}=")]
    return sorted(int(n) for n in numbers if files.exists(path(f"{root}/{kind}={n}/_SUCCESS")))


def _log(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """The last folded state and the changes since, each with the number of its batch."""
    folded = [n for n in _folders(spark, root, "upto") if before is None or n < before][-1:]
    batches = [n for n in _folders(spark, root, "batch") if (not folded or n > folded[0]) and (before is None or n < before)]
    return spark.read.parquet(*[f"{root}/upto={n}" for n in folded], *[f"{root}/batch={n}" for n in batches])


def _rule(spark: SparkSession, root: str) -> UpsertRule:
    found = json.loads(spark.read.text(f"{root}/rule").first()[0])
    return UpsertRule(**{k: tuple(v) if isinstance(v, list) else v for k, v in found.items()})


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """What a job has left below its root: its changed keys, merged."""
    root = root.rstrip("/")
    return merged(_log(spark, root), _rule(spark, root))


def _fold(spark: SparkSession, root: str, batch_id: int) -> None:
    """Merges the changes before a batch. What the fold before has replaced goes; readers may still hold the rest."""
    older = _folders(spark, root, "upto")[-1:]
    state = merged(_log(spark, root, batch_id), _rule(spark, root)).withColumn(LOAD, F.lit(batch_id - 1).cast("bigint"))
    state.write.mode("overwrite").parquet(f"{root}/upto={batch_id - 1}")
    for last in older:
        for kind, most in (("batch", last), ("upto", last - 1)):
            for number in _folders(spark, root, kind):
                if number <= most:
                    discard(spark, f"{root}/{kind}={number}")


def upsert_latest(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    keys: list[str],
    newest_by: list[str],
    newer_by: str,
    update_cols: list[str] | None = None,
    fold_after: int = 16,
) -> None:
    """Keeps the newest row per key across batches, as a guarded upsert of each batch's newest rows would.

    The newest row of every key is keyed state, and a batch emits only keys that it brings. They are written as the batch's own folder,
    which a repeated batch overwrites; ``read_state`` merges them. So what a batch writes grows with the batch and not with the
    state. Every ``fold_after`` batches the folders are merged into one. ``newer_by`` must be the first of ``newest_by``. Rows
    lacking a part of their key are all kept.
    """
    if newest_by[:1] != [newer_by]:
        raise ValueError("newer_by must be the first column of newest_by")
    spark, root = stream.sparkSession, root.rstrip("/")
    rule = UpsertRule(tuple(keys), tuple(update_cols) if update_cols is not None else None, newer_by)
    rest = [c for c in stream.columns if c not in keys]
    ties = [c for c in comparable(stream) if c not in keys and c not in newest_by]
    lacking = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    alone = F.when(lacking, F.xxhash64(*comparable(stream))).otherwise(F.lit(0)).alias("_alone")
    newest = stream.groupBy(*keys, alone).agg(F.max_by(F.struct(*rest), F.struct(*newest_by, *ties)).alias("_row"))
    rows = newest.select(*keys, "_row.*").select(*stream.columns)

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if not batch_id:
            # A new checkpoint begins anew: what a lost one has left goes.
            discard(session, root)
            session.range(1).select(F.lit(json.dumps(asdict(rule)))).coalesce(1).write.mode("overwrite").text(f"{root}/rule")
        elif batch_id - max(_folders(session, root, "upto"), default=-1) > fold_after:
            _fold(session, root, batch_id)
        batch.withColumn(LOAD, F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    with _keyed_state_on_disk(spark):
        run_available(rows.writeStream.foreachBatch(write).outputMode("update"), checkpoint)


def dedupe_events(stream: DataFrame, time: str, keys: list[str], delay: str) -> DataFrame:
    """The first arrival of each key; state is kept for ``delay`` after its event time."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def daily_sums(stream: DataFrame, time: str, by: list[str], sums: list[str], delay: str) -> DataFrame:
    """Sums per UTC day and group. ``delay`` is how late data may come, i.e. the re-pull horizon."""
    day = F.window(time, "1 day")
    totals = stream.withWatermark(time, delay).groupBy(day.alias("w"), *by)
    return totals.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in sums]).select(
        F.to_date("w.start").alias("day"), *by, "rows", *sums
    )


def sums_to_days(totals: DataFrame, table: str, checkpoint: str, keys: list[str], location: str | None = None) -> int:
    """Puts changed totals into a day table as they come, days that may still change included.

    A batch rewrites the partitions of the days it brings. Repeating it gives the same
    totals. Returns the partial sums left out as too late.
    """

    def write(batch: DataFrame, _: int) -> None:
        upsert_days_table(batch, table, "day", keys, location=location)

    return run_available(totals.writeStream.foreachBatch(write).outputMode("update"), checkpoint)
