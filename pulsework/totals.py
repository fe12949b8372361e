"""Day tables with totals beside them that a load keeps up by its differences.

``<table>_deltas`` is a log of signed changes per group, partitioned by load, and ``<table>_totals`` the view that sums it.
A load reads the days it touches and writes the groups it changes; no total is ever computed again from all rows.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsework.operators.deltas import ROWS, signed_deltas
from pulsework.session import discard, new_work_dir, work_root
from pulsework.sinks import _day_last, days_of, on_days, replace_parts, upsert_days_table, write_copy

LOAD = "load"


def totals_view(table: str) -> str:
    return f"{table}_totals"


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def upsert_days_with_totals(
    source: DataFrame,
    table: str,
    day: str,
    keys: list[str],
    by: list[str],
    sums: list[str],
    run: str,
    update_cols: list[str] | None = None,
    newer_by: str | None = None,
) -> None:
    """Upsert into a day table (see ``upsert_days_table``) and add what that changes to its totals by ``by``.

    Differences are first written to the shared work folder under the name of the ``run``. If the run fails after that and is started
    again, it goes on with those, though the table may show its rows already; so each difference is added exactly once.
    """
    spark = source.sparkSession
    name = hashlib.md5(f"{table}/{run}".encode()).hexdigest()
    batch_path, staged = new_work_dir(spark, "batch"), f"{work_root(spark)}/pulsework/deltas-{name}"
    _day_last(source, day).write.parquet(batch_path)
    batch = spark.read.parquet(batch_path)
    if not _exists(spark, staged):
        if spark.catalog.tableExists(table):
            target = spark.table(table).filter(on_days(day, days_of(batch, day)))
        else:
            target = batch.limit(0)
        columns = target.columns
        found = signed_deltas(target, batch.select(*columns), [*keys, day] if day not in keys else keys, by, sums, update_cols, newer_by)
        found.withColumn(LOAD, F.lit(uuid.uuid4().hex)).write.mode("overwrite").parquet(staged)
    deltas = spark.read.parquet(staged)
    upsert_days_table(batch, table, day, keys, update_cols, newer_by)
    first = deltas.select(LOAD).first()
    log = f"{table}_deltas"
    if first is not None:
        replace_parts(deltas, log, [LOAD], F.col(LOAD) == first[0])
        _serve(spark, table, log, by, sums)
    discard(spark, staged)
    discard(spark, batch_path)


def _serve(spark: SparkSession, table: str, log: str, by: list[str], sums: list[str]) -> None:
    groups = ", ".join(f"`{c}`" for c in by)
    values = ", ".join(f"sum(`{c}`) AS `{c}`" for c in [ROWS, *sums])
    spark.sql(
        f"CREATE OR REPLACE VIEW {totals_view(table)} AS SELECT {groups}, {values} FROM {log} GROUP BY {groups} HAVING sum(`{ROWS}`) <> 0"
    )


def fold_totals(spark: SparkSession, table: str, by: list[str], sums: list[str]) -> None:
    """Make the log one load of the present totals: a new copy, then the view, then the old log is emptied into the copy's name."""
    copy = write_copy(spark.table(totals_view(table)).withColumn(LOAD, F.lit(uuid.uuid4().hex)), f"{table}_folded", None, [LOAD])
    _serve(spark, table, copy, by, sums)
    log = f"{table}_deltas"
    replace_parts(spark.table(copy), log, [LOAD], F.lit(True))
    _serve(spark, table, log, by, sums)
    spark.sql(f"DROP TABLE {copy}")
