"""Joins kept up run by run although either side may come late.

Facts refer to a side row, such as metric events to their delivery. A fact whose side has not landed waits in a
pending table, and is served once the side comes. A run joins its own facts and those waiting with the sides, looks at served facts only where the run
brought their side again, and rewrites only the days in which something changes. However the rows are
split over runs, and in whatever order these come, the result is that of one run over all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulsework.operators.columns import comparable
from pulsework.operators.latest import latest_by_key
from pulsework.session import new_work_dir
from pulsework.sinks import days_of, drop_days, into_days, on_days, publish


@dataclass(frozen=True)
class LateJoin:
    """``fact`` is the key of a fact, ``side`` that of its side row, ``day`` its day, ``newer_by`` tells its newest copy.

    All copies of a fact have one day, which is of type DATE; ties of ``newer_by`` go to the largest other columns.
    """

    fact: str
    side: str
    day: str
    newer_by: str


def pending_table(table: str) -> str:
    return f"{table}_pending"


def join_late(
    facts: DataFrame,
    sides: DataFrame,
    arrived: DataFrame,
    table: str,
    rule: LateJoin,
    root: str | None = None,
    from_day: str | None = None,
) -> DataFrame:
    """Serve a run's facts in the day table ``table``; returns the rows that this run has added or changed.

    ``sides`` holds all side rows known by now, each key once, and ``arrived`` the keys among them that came with this run. Served
    facts of such keys get the new values; ``from_day`` spares the days before it where no fact is older than its side.
    A run that failed is repeated as it was. Facts without a side key wait for ever; facts without a key are one fact.
    The returned rows lie in the shared work folder.
    """
    clash = (set(facts.columns) & set(sides.columns)) - {rule.side}
    if clash:
        raise ValueError(f"facts and sides share the columns {sorted(clash)}")
    spark, work = facts.sparkSession, new_work_dir(facts.sparkSession, "late")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    names = [c for c in facts.columns if c != rule.day]
    values = [c for c in sides.columns if c != rule.side]
    columns = [*names, *values, rule.day]
    served = spark.table(table) if spark.catalog.tableExists(table) else None
    waiting = pending_table(table)
    if spark.catalog.tableExists(waiting):
        facts = facts.unionByName(spark.table(waiting))
    asked = _unserved(facts, served, rule, names)
    # Found or not is told by the one join; facts without a side key are spread, as all of them would go to one task.
    spread = F.when(F.col(rule.side).isNull(), F.xxhash64(rule.fact, rule.newer_by)).otherwise(F.lit(0).cast("bigint"))
    known = sides.withColumns({"_spread": F.lit(0).cast("bigint"), "_found": F.lit(True)})
    joined = asked.withColumn("_spread", spread).join(known, [rule.side, "_spread"], "left")
    # Rows of the pending view are in the folder now, so that the copy it reads may go.
    joined = written(joined.select(*columns, "_served", "_found"), "joined")
    fresh, replaced, missed = joined.filter("_found").select(*columns), joined.filter("_served"), joined.filter("_found is null")
    if served is None:
        into_days(fresh, table, rule.day)
    else:
        current = sides.join(arrived.select(rule.side).distinct(), rule.side, "left_semi")
        refreshed = written(_refreshed(served, current, replaced, rule, names, values, from_day), "refreshed")
        fresh = fresh.unionByName(refreshed)
        out = replaced.select(rule.fact).unionByName(refreshed.select(rule.fact))
        _replace(served, fresh, out, missed.filter("_served"), table, rule, columns)
    publish(missed.select(*names, rule.day), waiting, root)
    return fresh


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _version(df: DataFrame, rule: LateJoin, names: list[str]) -> Column:
    """What copies of a fact are compared by; a missing value is the smallest, as in ``latest_by_key``."""
    rest = [c for c in comparable(df.select(*names)) if c not in (rule.fact, rule.newer_by)]
    return F.struct(rule.newer_by, *rest)


def _unserved(facts: DataFrame, served: DataFrame | None, rule: LateJoin, names: list[str]) -> DataFrame:
    """The newest copies of facts of which no copy is served, or an older one (``_served``).

    Keys in a struct are equal where both are NULL, so one shuffle by it serves the newest copies and the join.
    """
    shaped = facts.select(F.struct(rule.fact).alias("_id"), *[c for c in facts.columns if c != rule.fact])
    newest = latest_by_key(shaped, ["_id"], [rule.newer_by]).withColumn(rule.fact, F.col("_id").getField(rule.fact))
    if served is None:
        return newest.drop("_id").withColumn("_served", F.lit(False))
    held = served.filter(on_days(rule.day, days_of(facts, rule.day))).select(
        F.struct(rule.fact).alias("_id"), _version(served, rule, names).alias("_held")
    )
    # A version is never null, so a null here means that no copy is served.
    met = newest.withColumn("_version", _version(newest.drop("_id"), rule, names)).join(held, "_id", "left")
    kept = met.filter(F.col("_held").isNull() | (F.col("_version") > F.col("_held")))
    return kept.withColumn("_served", F.col("_held").isNotNull()).drop("_id", "_held", "_version")


def _refreshed(
    served: DataFrame, current: DataFrame, replaced: DataFrame, rule: LateJoin, names: list[str], values: list[str], from_day: str | None
) -> DataFrame:
    """Served facts whose side has other values by now, but for those of which a newer copy has come."""
    rows = served if from_day is None else served.filter(F.col(rule.day) >= F.lit(from_day).cast("date"))
    sides = current.select(rule.side, F.struct(*values).alias("_now"))
    changed = rows.join(sides, rule.side).filter(~F.struct(*values).eqNullSafe(F.col("_now")))
    changed = changed.join(replaced.select(F.col(rule.fact).alias("_asked")), _same(rule.fact, "_asked"), "left_anti")
    return changed.select(*names, *[F.col(f"_now.{c}").alias(c) for c in values], rule.day)


def _replace(
    served: DataFrame, fresh: DataFrame, out: DataFrame, gone: DataFrame, table: str, rule: LateJoin, columns: list[str]
) -> None:
    """Take the facts ``out`` of the table and put ``fresh`` in, in the days of ``fresh`` and of ``gone``, which are out for good.

    The table is read while it is written: new partitions are staged and moved in place only when all tasks have ended, so
    a lost executor still finds the old ones.
    """
    spark: SparkSession = served.sparkSession
    days = days_of(fresh.select(rule.day).unionByName(gone.select(rule.day)), rule.day)
    if not days:
        return
    kept = served.filter(on_days(rule.day, days)).join(out.select(F.col(rule.fact).alias("_out")), _same(rule.fact, "_out"), "left_anti")
    seen = Observation("days")
    merged = kept.select(*columns).unionByName(fresh).observe(seen, F.collect_set(F.col(rule.day).cast("string")).alias("days"),
                                                              F.count_if(F.col(rule.day).isNull()).alias("dayless"))
    into_days(merged, table, rule.day)
    left = set(seen.get["days"])
    drop_days(spark, table, rule.day, [d.isoformat() for d in days if d is not None and d.isoformat() not in left])
    if None in days and not seen.get["dayless"]:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({rule.day} = NULL)")
