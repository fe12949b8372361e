"""Which landing files are new, what time span each covers, and which a run needs."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta
from functools import reduce
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsework.functions import greatest_time, in_days, least_time
from pulsework.operators.intervals import overlap_join
from pulsework.sources.tables import read_parquet_files, with_lineage


# Files that one plan reads; longer lists are worked through in turns.
FILES_AT_ONCE = 10_000


def list_files(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """File names and modification times below a folder; no content is read."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return listing.load(folder).select(
        F.col("path").alias("file_name"), F.col("modificationTime").alias("inserted_at")
    )


def discover_new_files(listing: DataFrame, registry: DataFrame, file_type: str) -> DataFrame:
    known = registry.filter(F.col("type") == file_type).select("file_name")
    return listing.join(known, "file_name", "left_anti")


def file_time_bounds(files: DataFrame, time_cols: list[str], file_type: str) -> DataFrame:
    """One registry row per file: earliest and latest of its time columns.

    ``files`` carries ``file_name`` and ``inserted_at`` from :func:`with_lineage`. Both
    aggregates combine on the map side, so a large file costs no more than a small one to
    shuffle.
    """
    times = [F.col(c) for c in time_cols]
    return files.groupBy("file_name").agg(
        F.lit(file_type).alias("type"),
        F.min(least_time(*times)).alias("min_timestamp"),
        F.max(greatest_time(*times)).alias("max_timestamp"),
        F.max("inserted_at").alias("inserted_at"),
    )


def file_chunks(files: DataFrame, size: int = FILES_AT_ONCE) -> Iterator[list[str]]:
    """All file names in lists of at most ``size``: the driver holds one of them and one partition's names."""
    names = (row.file_name for row in files.select("file_name").distinct().toLocalIterator())
    while chunk := list(islice(names, size)):
        yield chunk


def prune_files(registry: DataFrame, file_type: str, first_day: str, last_day: str) -> DataFrame:
    """Registered files whose time span touches the days; a file without bounds is left out."""
    after = (date.fromisoformat(last_day) + timedelta(days=1)).isoformat()
    in_time = (F.col("min_timestamp") < F.lit(after)) & (F.col("max_timestamp") >= F.lit(first_day))
    return registry.filter((F.col("type") == file_type) & in_time)


def files_of_windows(
    registry: DataFrame, windows: DataFrame, file_type: str, first_day: Column, last_day: Column, on: list[str] | None = None
) -> DataFrame:
    """The registered files that each of many windows needs: :func:`prune_files` for all of them at once.

    One row per window and file, with the window's columns, ``file_name`` and the file's bounds. ``first_day`` and ``last_day`` are the
    window's days, both inclusive. A window that needs no file has no row.
    """
    files = registry.filter(F.col("type") == file_type).select(*on or [], "file_name", "min_timestamp", "max_timestamp")
    days = (F.unix_date(first_day), F.unix_date(last_day))
    spans = (F.unix_date(F.to_date("min_timestamp")), F.unix_date(F.to_date("max_timestamp")))
    return overlap_join(windows, files, days, spans, on)


def read_pruned_files(
    spark: SparkSession,
    registry: DataFrame,
    file_type: str,
    first_day: str,
    last_day: str,
    schema: T.StructType,
    row_days: list[str],
) -> DataFrame | None:
    """Rows of the needed files whose times touch the days, with lineage; None if no file is needed."""
    chunks = list(read_pruned_chunks(spark, registry, file_type, first_day, last_day, schema, row_days))
    return reduce(DataFrame.unionAll, chunks) if chunks else None


def read_pruned_chunks(
    spark: SparkSession,
    registry: DataFrame,
    file_type: str,
    first_day: str,
    last_day: str,
    schema: T.StructType,
    row_days: list[str],
    at_once: int = FILES_AT_ONCE,
) -> Iterator[DataFrame]:
    """The same rows file list by file list, for lists that are too long for one plan."""
    times = [F.col(c) for c in row_days]
    within = in_days(times[0], first_day, last_day) if len(times) == 1 else spans_days(times, first_day, last_day)
    for names in file_chunks(prune_files(registry, file_type, first_day, last_day), at_once):
        yield with_lineage(read_parquet_files(spark, names, schema)).filter(within)


def spans_days(times: list[Column], first_day: str, last_day: str) -> Column:
    """True where the span from the earliest to the latest of the times touches the days.

    Some time before the end and some time from the start on: plain comparisons, which
    unlike ``least`` and ``greatest`` of the columns reach the scan. Unknown times do not count.
    """
    after = (date.fromisoformat(last_day) + timedelta(days=1)).isoformat()
    starts = reduce(lambda a, b: a | b, [t < F.lit(after) for t in times])
    ends = reduce(lambda a, b: a | b, [t >= F.lit(first_day) for t in times])
    return starts & ends
