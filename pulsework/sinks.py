"""Writing results: append, overwrite, upsert, window replacement, expiry and views.

Two kinds of result table:

* a *published* table is a view on one finished copy. A rewrite makes a new copy and then
  moves the view, so readers and reruns never see half of it; the last copies are kept and
  older ones dropped;
* a *day table* is partitioned by a day column. Upserts, window replacements and expiry
  touch only the partitions of their days, whatever the size of the table.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from pulsework.operators.columns import comparable
from pulsework.operators.latest import PRESETS
from pulsework.operators.merge import expire, not_older, upsert
from pulsework.session import discard, new_work_dir


def _writer(df: DataFrame, location: str | None) -> DataFrameWriter:
    """``location`` puts a new table's files outside the warehouse."""
    return df.write.option("path", location) if location else df.write


def append(
    df: DataFrame,
    table: str,
    location: str | None = None,
    partition_by: list[str] | None = None,
    bucket_by: list[str] | None = None,
    buckets: int = 16,
) -> None:
    """Columns are matched by name, as they are in all tables Spark appends to. A load is one sorted file per bucket."""
    if bucket_by:
        df = df.repartition(buckets, *bucket_by)
    writer = _writer(df, location).mode("append")
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    (writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by) if bucket_by else writer).saveAsTable(table)


def replace_parts(
    df: DataFrame, table: str, parts: list[str], within: Column, bucket_by: list[str] | None = None, buckets: int = 16
) -> None:
    """Make the partitions that ``within`` selects equal to ``df``, so that a load can run again without doubling rows.

    ``within`` is a condition on the partition columns ``parts``. Partitions that get rows are overwritten, then those
    without rows any more are dropped: a run that fails has deleted nothing. Which get rows is observed by the write itself. With
    ``bucket_by`` each partition is written as one sorted file per bucket, and work by these keys needs no shuffle.
    """
    spark, seen = df.sparkSession, Observation("parts")
    if bucket_by:
        df = df.repartition(buckets, *bucket_by)
    texts = F.struct(*[F.col(c).cast("string").alias(c) for c in parts])
    observed = df.observe(seen, F.collect_set(texts).alias("parts"))
    if not spark.catalog.tableExists(table):
        writer = observed.write.partitionBy(*parts)
        (writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by) if bucket_by else writer).saveAsTable(table)
        return
    with _dynamic_overwrite(spark):
        observed.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    drop_parts(spark, table, parts, within, {tuple(row) for row in seen.get["parts"]})


def drop_parts(spark: SparkSession, table: str, parts: list[str], within: Column, but: set[tuple] = frozenset()) -> None:
    """Drop the partitions that ``within`` selects, ``but`` those given by their values as text."""
    kinds = dict(spark.table(table).dtypes)
    held = spark.createDataFrame([(row[0],) for row in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator()], "spec string")
    values = F.split("spec", "/")
    named = held.select(*[_partition_value(values[i], kinds[c]).alias(c) for i, c in enumerate(parts)])
    for row in named.filter(within).select(*[F.col(c).cast("string") for c in parts]).collect():
        if tuple(row) not in but:
            spec = ", ".join(f"{c} = NULL" if v is None else f"{c} = '{v}'" for c, v in zip(parts, row))
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def _partition_value(spec: Column, kind: str) -> Column:
    """The value in ``name=value`` of a partition's path, in which some characters are written as ``%`` and their code."""
    value = F.regexp_replace(spec, "^[^=]*=", "")
    plain = F.when(value != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))))
    return plain.cast(kind)


def bucket_layout(spark: SparkSession, table: str) -> tuple[list[str], int]:
    """Columns and number of the buckets of a stored table; none if it has no buckets."""
    told = {row[0]: row[1] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    columns = [c.strip(" `") for c in told.get("Bucket Columns", "").strip("[]").split(",") if c.strip()]
    return columns, int(told.get("Num Buckets", 0))


def overwrite(df: DataFrame, table: str, location: str | None = None) -> None:
    """Replace the whole table, also when it is partitioned."""
    _writer(df, location).mode("overwrite").option("partitionOverwriteMode", "static").saveAsTable(table)


def copy_table(spark: SparkSession, source: str, target: str) -> None:
    """Append one tenant's table to another's, by column name."""
    rows = spark.table(source)
    if spark.catalog.tableExists(target):
        rows = rows.select(*spark.table(target).columns)
    append(rows, target)


# ---- published tables ------------------------------------------------------------------


def publish(
    df: DataFrame,
    name: str,
    root: str | None = None,
    partition_by: list[str] | None = None,
    keep: int = 2,
) -> str:
    """Write a complete copy under a name of its own, point the view at it, drop copies before the last ``keep``.

    Copies are managed tables, or lie below ``root`` if given. Their names begin with the
    time they were made, which is the order they are dropped in. Only tables whose whole name is
    that of a copy count as copies, and the new one is never dropped.
    """
    copy = write_copy(df, name, root, partition_by)
    show_copy(df.sparkSession, name, copy, df.columns, keep)
    return copy


def show_copy(spark: SparkSession, name: str, copy: str, columns: list[str], keep: int = 2) -> None:
    """Move the view to a finished copy and drop those before the last ``keep``."""
    listed = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {listed} FROM {copy}")
    drop_old_copies(spark, name, copy, keep)


def write_copy(df: DataFrame, name: str, root: str | None = None, partition_by: list[str] | None = None) -> str:
    """A new copy of a published table, which no view reads yet; returns its name."""
    copy = f"{name}__{datetime.now(UTC):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"
    writer = _writer(df, f"{root.rstrip('/')}/{copy}" if root else None)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(copy)
    return copy


def drop_old_copies(spark: SparkSession, name: str, new: str, keep: int) -> None:
    for old in _copies(spark, name)[: -max(1, keep)]:
        if old != new:
            drop_copy(spark, old)


def _copies(spark: SparkSession, name: str) -> list[str]:
    """The copies of a published table, oldest first."""
    database, _, base = name.rpartition(".")
    within = f" IN {database}" if database else ""
    exact = re.compile(rf"{re.escape(base)}__\d{{20}}_[0-9a-f]{{8}}", re.IGNORECASE)
    found = spark.sql(f"SHOW TABLES{within} LIKE '{base}__*'").select("tableName").collect()
    return [f"{database}.{n}" if database else n for n in sorted(row[0] for row in found) if exact.fullmatch(n)]


def drop_copy(spark: SparkSession, copy: str) -> None:
    """Dropping an external table leaves its files, so they are deleted after it."""
    told = {row[0]: row[1] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {copy}").collect()}
    spark.sql(f"DROP TABLE {copy}")
    location = told.get("Location", "")
    if told.get("Type") == "EXTERNAL" and location.rstrip("/").rpartition("/")[2] == copy:
        discard(spark, location)


def upsert_published(
    source: DataFrame,
    name: str,
    keys: list[str],
    update_cols: list[str] | None = None,
    newer_by: str | None = None,
    small_source: bool = False,
    root: str | None = None,
    partition_by: list[str] | None = None,
    null_safe: bool = False,
) -> str:
    spark = source.sparkSession
    if spark.catalog.tableExists(name):
        source = upsert(spark.table(name), source, keys, update_cols, newer_by, small_source, null_safe=null_safe)
    return publish(source, name, root, partition_by)


def expire_published(
    spark: SparkSession, name: str, time: str, as_of: str, days: int = 90, root: str | None = None
) -> str:
    """Publishes what is left, laid out like the copy before."""
    copies = _copies(spark, name)
    layout = [c.name for c in spark.catalog.listColumns(copies[-1]) if c.isPartition] if copies else []
    return publish(expire(spark.table(name), time, as_of, days), name, root, layout or None)


# ---- day tables ------------------------------------------------------------------------


def _day_last(df: DataFrame, day: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c != day], F.col(day).cast("date").alias(day))


_overwriting = threading.Lock()


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrite only partitions that get rows. Inserting into a table heeds the session's mode, not a writer option.

    The lock keeps threads of one session from restoring the mode while another still inserts.
    """
    mode = "spark.sql.sources.partitionOverwriteMode"
    with _overwriting:
        before = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            yield
        finally:
            spark.conf.set(mode, before)


def into_days(df: DataFrame, table: str, day: str, location: str | None = None) -> None:
    """Overwrite exactly the days that ``df`` holds."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        _writer(df, location).partitionBy(day).saveAsTable(table)
        return
    rows = df.select(*spark.table(table).columns)
    with _dynamic_overwrite(spark):
        rows.write.insertInto(table, overwrite=True)


def drop_days(spark: SparkSession, table: str, day: str, days: list[str]) -> None:
    if days:
        parts = ", ".join(f"PARTITION ({day} = DATE'{d}')" for d in days)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")


def replace_days_table(
    df: DataFrame, table: str, day: str, first_day: str, last_day: str, location: str | None = None
) -> None:
    """Make the table's days equal to ``df``: days with rows are overwritten, the others emptied.

    Writing comes first, so a run that fails has deleted nothing. Which days got rows is
    observed by the write itself, at most one value per day of the window.
    """
    spark = df.sparkSession
    seen = Observation("days")
    within = _day_last(df, day).filter(F.col(day).between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))
    observed = within.observe(seen, F.collect_set(F.col(day).cast("string")).alias("days"))
    into_days(observed, table, day, location)
    written = set(seen.get["days"])
    first, count = date.fromisoformat(first_day), (date.fromisoformat(last_day) - date.fromisoformat(first_day)).days
    window = [(first + timedelta(days=i)).isoformat() for i in range(count + 1)]
    drop_days(spark, table, day, [d for d in window if d not in written])


def days_of(df: DataFrame, day: str) -> list[date | None]:
    """The distinct days of a load, one value each."""
    return [row[0] for row in df.select(day).distinct().collect()]


def on_days(day: str, days: list[date | None]) -> Column:
    """Rows of the listed days; a partition filter where the table is partitioned by its day."""
    hit = F.col(day).isin([d for d in days if d is not None])
    return hit | F.col(day).isNull() if None in days else hit


def upsert_days_table(
    source: DataFrame,
    table: str,
    day: str,
    keys: list[str],
    update_cols: list[str] | None = None,
    newer_by: str | None = None,
    location: str | None = None,
) -> None:
    """Upsert into a day table whose keys determine the day.

    The batch is first written to the shared work folder: it is then computed once, and the
    days it touches (one value per day) prune the target's scan. The merged days go straight into the table: new
    partitions are staged and moved in place only when all tasks have ended, so a lost executor cannot catch the
    table between reading and overwriting.

    With ``newer_by`` only days in which some row is new or newer are rewritten: a load that
    brings nothing new changes no file.
    """
    spark = source.sparkSession
    if not spark.catalog.tableExists(table):
        into_days(_day_last(source, day), table, day, location)
        return
    passing: list[str] = []

    def written(df: DataFrame, name: str) -> DataFrame:
        passing.append(new_work_dir(spark, name))
        df.write.parquet(passing[-1])
        return spark.read.schema(df.schema).parquet(passing[-1])

    batch = written(_day_last(source, day), "batch")
    keys = keys if day in keys else [*keys, day]
    days = days_of(batch, day)
    if days and newer_by is not None:
        batch = written(not_older(batch, spark.table(table).filter(on_days(day, days)), keys, newer_by), "newer")
        days = days_of(batch, day)
    if days:
        touched = spark.table(table).filter(on_days(day, days))
        into_days(upsert(touched, batch, keys, update_cols, newer_by), table, day)
    for path in passing:
        discard(spark, path)


def expire_days_table(spark: SparkSession, table: str, day: str, as_of: str, days: int = 90) -> None:
    """Drop the partitions before ``as_of`` minus ``days``; rows without a day stay."""
    cutoff = (date.fromisoformat(as_of) - timedelta(days=days)).isoformat()
    names = [row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator()]
    drop_days(spark, table, day, [d for d in names if d[:1].isdigit() and d < cutoff])


def expire_rows_table(
    spark: SparkSession, table: str, day: str, time: str, as_of: str, days: int = 90
) -> None:
    """Expire by a time other than the one that makes the day: only days holding old rows are rewritten."""
    rows = spark.table(table)
    cutoff = (date.fromisoformat(as_of) - timedelta(days=days)).isoformat()
    hit = [row[0] for row in rows.filter(F.col(time) < F.lit(cutoff)).select(day).distinct().collect()]
    if not hit:
        return
    kept_path = new_work_dir(spark, "kept")
    expire(rows.filter(on_days(day, hit)), time, as_of, days).write.parquet(kept_path)
    kept = spark.read.parquet(kept_path)
    left = {row[0] for row in kept.select(day).distinct().collect()}
    into_days(kept, table, day)
    drop_days(spark, table, day, [d.isoformat() for d in hit if d is not None and d not in left])
    if None in hit and None not in left:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({day} = NULL)")
    discard(spark, kept_path)


# ---- views and external stores -----------------------------------------------------------


def latest_view(spark: SparkSession, table: str, preset: str, view: str | None = None) -> str:
    """(Re)creates the view that shows the latest row per key of a raw table."""
    spec = PRESETS[preset]
    names = spark.table(table).columns
    ties = [c for c in comparable(spark.table(table)) if c not in spec.keys and c not in spec.newest_by]
    quoted = {c: f"`{c}`" for c in names}
    order = ", ".join(f"{quoted[c]} DESC" for c in [*spec.newest_by, *ties])
    view = view or f"{table}_view"
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(quoted.values())} FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY {', '.join(quoted[k] for k in spec.keys)} ORDER BY {order})"
        f" AS row_rank FROM {table}) WHERE row_rank = 1"
    )
    return view


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", properties: dict[str, str] | None = None,
    connections: int = 8,
) -> None:
    """Write to an external store over at most ``connections`` connections."""
    rows = df.repartition(connections)  # coalesce would run all stages before it in so few tasks
    rows.write.format("jdbc").option("url", url).option("dbtable", table).options(**(properties or {})).mode(mode).save()
