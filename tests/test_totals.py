"""Totals kept up by differences, user sets per day, and numbers that grow."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pulsework import totals
from pulsework.operators import deltas, metering, numbering

ROW = "id string, g int, kind string, v int, w int, day date"
BY, SUMS = ["day", "kind"], ["v", "w"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def on(day):
    return date(2024, 1, day)


LOADS = [
    [("a", 1, "x", 1, 10, on(1)), ("b", 1, "x", 2, None, on(1)), ("c", 1, "y", 3, 1, on(2)), (None, 1, "x", 5, 5, on(1))],
    [("a", 2, "z", 4, 10, on(1)), ("b", 0, "x", 99, 99, on(1)), ("d", 1, "y", 7, 7, on(3))],
    [("c", 2, "x", -3, 1, on(2)), ("a", 2, "q", 0, 0, on(1)), (None, 1, "x", 5, 5, on(1))],
]


def test_totals_equal_the_full_recomputation(spark, unique):
    table = unique("kinds")
    for i, load in enumerate(LOADS):
        source = spark.createDataFrame(load, ROW)
        totals.upsert_days_with_totals(source, table, "day", ["id"], BY, SUMS, f"run/{i}", newer_by="g")
        want = rows(deltas.totals(spark.table(table), BY, SUMS))
        assert rows(spark.table(totals.totals_view(table))) == want
        if i == 1:
            totals.fold_totals(spark, table, BY, SUMS)
            assert rows(spark.table(totals.totals_view(table))) == want
            assert spark.table(f"{table}_deltas").select("load").distinct().count() == 1
    # A group that all its rows have left is gone, and a load again changes nothing.
    assert "y" not in {r.kind for r in spark.table(totals.totals_view(table)).filter("day = '2024-01-02'").collect()}
    log = spark.table(f"{table}_deltas").count()
    keyed = spark.createDataFrame(LOADS[1], ROW)
    totals.upsert_days_with_totals(keyed, table, "day", ["id"], BY, SUMS, "again", newer_by="g")
    assert rows(spark.table(totals.totals_view(table))) == want and spark.table(f"{table}_deltas").count() == log


def test_a_run_that_failed_adds_its_differences_once(spark, unique, monkeypatch):
    """Failing after the differences were written, before or after the table was."""
    for late in (False, True):
        table = unique("kinds")
        totals.upsert_days_with_totals(spark.createDataFrame(LOADS[0], ROW), table, "day", ["id"], BY, SUMS, "0", newer_by="g")
        load = spark.createDataFrame([r for r in LOADS[1] if r[0]], ROW)
        name = "replace_parts" if late else "upsert_days_table"

        def fail(*args, **kwargs):
            raise RuntimeError("lost")

        with monkeypatch.context() as patch, pytest.raises(RuntimeError):
            patch.setattr(totals, name, fail)
            totals.upsert_days_with_totals(load, table, "day", ["id"], BY, SUMS, "1", newer_by="g")
        totals.upsert_days_with_totals(load, table, "day", ["id"], BY, SUMS, "1", newer_by="g")
        assert rows(spark.table(totals.totals_view(table))) == rows(deltas.totals(spark.table(table), BY, SUMS))


def test_only_changed_groups_are_written(spark):
    target = spark.range(100).selectExpr("string(id) id", "1 g", "string(id % 10) kind", "1 v", "1 w", "date'2024-01-01' day")
    source = spark.createDataFrame([("3", 2, "3", 5, 1, on(1)), ("4", 2, "4", 1, 1, on(1)), ("5", 0, "9", 9, 9, on(1))], ROW)
    found = deltas.signed_deltas(target, source, ["id"], BY, SUMS, newer_by="g")
    assert rows(found) == [(on(1), "3", 0, 4, 0)]


def test_user_sets_of_days(spark):
    """Equal to counting all events anew, over bucket borders; users of several days count once."""
    seen = spark.range(120_000).selectExpr(
        "concat('u', id % 70000) user", "timestamp'2024-01-01' + make_interval(0, 0, 0, int(id % 40)) t"
    )
    seen = seen.unionByName(spark.createDataFrame([(None, datetime(2024, 1, 5)), ("nobody", None)], "user string, t timestamp"))
    known = spark.createDataFrame([("u7", 0), ("u9", 5)], "user string, index long")
    fresh = numbering.grow_index(known, seen, "user")
    assert fresh.agg(F.min("index"), F.max("index"), F.count_distinct("index")).first()[:] == (6, 70_004, 69_999)
    index = known.unionByName(fresh)
    sets = metering.daily_user_sets(seen, index, "user", F.to_date("t"))
    days = ["2024-01-04", "2024-02-05", "2024-02-20"]
    got = {str(r.as_of): r for r in metering.users_of_windows(sets, days).collect()}
    for day in days:
        want = metering.monthly_active_users(seen, "user", "t", day).first()[0]
        about = metering.monthly_active_users(seen, "user", "t", day, approximate=True).first()[0]
        assert got[day].monthly_active_users == want and abs(about - want) < 0.1 * want
        assert abs(got[day].approximate_users - want) < 0.05 * want
    assert metering.users_of_windows(sets, ["2020-01-01"]).count() == 0
    plan = metering.users_of_windows(sets, days)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bitmap_or_agg") == 1


def test_grow_index_from_nothing(spark):
    none = spark.createDataFrame([], "user string, index long")
    some = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "user string")
    assert [r["index"] for r in numbering.grow_index(none, some, "user").orderBy("index").collect()] == [0, 1]
