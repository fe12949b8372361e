"""Parquet files, catalog tables, dimension CSVs and external stores."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet_files(spark: SparkSession, files: Iterable[str], schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*files)


def _plain_path(encoded: Column) -> Column:
    """A scan reports its files URL-encoded, a listing does not; registries hold the plain form."""
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(encoded, F.lit("%")), decoded).otherwise(encoded)


def with_lineage(files: DataFrame, file_name: str = "file_name", inserted_at: str = "inserted_at") -> DataFrame:
    """Adds each row's source file and that file's modification time; call it right on a file scan."""
    return files.select(
        "*",
        _plain_path(F.col("_metadata.file_path")).alias(file_name),
        F.col("_metadata.file_modification_time").alias(inserted_at),
    )


def read_csv_dim(spark: SparkSession, path: str) -> DataFrame:
    """Distinct event types of a CSV with header, whose name column may be called ``event_name``."""
    raw = spark.read.option("header", "true").csv(path).withColumnRenamed("event_name", "event_type")
    return raw.select("event_type").distinct()


def read_table(spark: SparkSession, name: str, columns: list[str] | dict[str, str] | None = None) -> DataFrame:
    """A table or view, cut to some columns. A dict maps source columns to new names."""
    table = spark.table(name)
    if columns is None:
        return table
    renames = columns if isinstance(columns, dict) else {c: c for c in columns}
    return table.select(*[F.col(source).alias(target) for source, target in renames.items()])


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """The table, or None where it does not exist, so that a job can end before it deletes anything."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def read_jdbc_query(
    spark: SparkSession,
    url: str,
    query: str,
    properties: dict[str, str] | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Runs ``query`` in the external store.

    ``split`` is (column, lowest, highest, parts) and reads that many ranges in parallel;
    without it the store sends all rows to one task, which suits aggregates only.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    if split is None:
        return reader.option("query", query).load()
    column, lowest, highest, parts = split
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", column)
        .option("lowerBound", lowest)
        .option("upperBound", highest)
        .option("numPartitions", parts)
        .load()
    )
