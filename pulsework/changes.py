"""Upsert tables that are merged when they are read.

A change table is a view over a log partitioned by load. A load appends its own rows and nothing else, whatever the size of
the table; the view merges (``operators.changelog``). Folding writes the merged rows as one load into a new copy of the log and
moves the view, so readers and reruns never see half of it.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsework.operators.changelog import LOAD, UpsertRule, merged_sql
from pulsework.operators.merge import expire
from pulsework.sinks import append, drop_old_copies, write_copy

_RULE = "pulsework.upsert_rule"
#: Loads after which jobs fold a table.
FOLD_AFTER = 24


def log_of(spark: SparkSession, name: str) -> str | None:
    """The copy of the log that the view reads; None if ``name`` is no change table."""
    if not spark.catalog.tableExists(name):
        return None
    told = {row[0]: row[1] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    database, _, base = name.rpartition(".")
    copy = re.search(rf"{re.escape(base)}__\d{{20}}_[0-9a-f]{{8}}", told.get("View Text") or "", re.IGNORECASE)
    if not copy:
        return None
    log = f"{database}.{copy[0]}" if database else copy[0]
    return log if LOAD in spark.table(log).columns else None


def _spec(rule: UpsertRule) -> str:
    return json.dumps(asdict(rule), sort_keys=True)


def _stored_rule(spark: SparkSession, log: str) -> UpsertRule:
    found = dict(tuple(r) for r in spark.sql(f"SHOW TBLPROPERTIES {log}").collect())
    spec = json.loads(found[_RULE])
    lists = {k: tuple(v) if isinstance(v, list) else v for k, v in spec.items()}
    return UpsertRule(**lists)


def _loads(spark: SparkSession, log: str) -> set[int]:
    rows = spark.sql(f"SHOW PARTITIONS {log}").collect()  # as many as loads since the last folding, times the layout's values
    return {int(re.match(rf"{LOAD}=(\d+)", row[0])[1]) for row in rows}


def _serve(rows: DataFrame, name: str, rule: UpsertRule, load: int, root: str | None, layout: list[str], keep: int) -> None:
    """A new copy of the log that holds ``rows`` as one load, and the view on it."""
    spark = rows.sparkSession
    copy = write_copy(rows.withColumn(LOAD, F.lit(load).cast("bigint")), name, root, [LOAD, *layout])
    spec = _spec(rule).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {copy} SET TBLPROPERTIES ('{_RULE}' = '{spec}')")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {merged_sql(copy, rows.columns, rule)}")
    drop_old_copies(spark, name, copy, keep)


def append_changes(
    source: DataFrame,
    name: str,
    rule: UpsertRule,
    root: str | None = None,
    partition_by: list[str] | None = None,
    fold_after: int | None = None,
    keep: int = 2,
) -> int:
    """Upsert ``source``, which holds each key once, by appending it as a load; returns the load's number.

    A table published as a whole before is taken over as the first load. Loading the same rows again changes no
    result, but for rows lacking a part of their key, which every upsert adds. With ``fold_after`` the table is folded once it
    has as many loads.
    """
    spark, log = source.sparkSession, log_of(source.sparkSession, name)
    if log is None:
        if not spark.catalog.tableExists(name):
            _serve(source, name, rule, 0, root, partition_by or [], keep)
            return 0
        _serve(spark.table(name), name, rule, 0, root, partition_by or [], keep)
        log = log_of(spark, name)
    if _stored_rule(spark, log) != rule:
        raise ValueError(f"{name} is upserted by {_stored_rule(spark, log)}, not by {rule}")
    columns = [c for c in spark.table(log).columns if c != LOAD]
    layout = [c.name for c in spark.catalog.listColumns(log) if c.isPartition]
    load = max(_loads(spark, log), default=-1) + 1
    rows = source.select(*columns).withColumn(LOAD, F.lit(load).cast("bigint"))
    append(rows, log, partition_by=layout)
    if fold_after and len(_loads(spark, log)) >= fold_after:
        fold_changes(spark, name, root, keep)
    return load


def fold_changes(spark: SparkSession, name: str, root: str | None = None, keep: int = 2) -> None:
    """Make the log one load of what the view shows. Later loads count on from it."""
    _rewrite(spark, name, spark.table(name), root, keep)


def expire_changes(
    spark: SparkSession, name: str, time: str, as_of: str, days: int = 90, root: str | None = None, keep: int = 2
) -> None:
    """Fold the table without the rows before ``as_of`` minus ``days``."""
    _rewrite(spark, name, expire(spark.table(name), time, as_of, days), root, keep)


def _rewrite(spark: SparkSession, name: str, rows: DataFrame, root: str | None, keep: int) -> None:
    log = log_of(spark, name)
    if log is None:
        raise ValueError(f"{name} is not a change table")
    layout = [c.name for c in spark.catalog.listColumns(log) if c.isPartition and c.name != LOAD]
    _serve(rows, name, _stored_rule(spark, log), max(_loads(spark, log), default=0), root, layout, keep)
