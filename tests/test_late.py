"""Joins with late sides: the runs' order and split do not matter, and a run rewrites only days in which something changes."""

import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from pulsework import late
from pulsework.late import LateJoin, join_late, pending_table
from pulsework.plans import jobs

RULE = LateJoin("id", "side", "day", "seen")
FACTS = "id string, side string, note string, seen int, day date"
SIDES = "side string, name string, kind int"
NO_FACTS, NO_SIDES = [], []


def day(n):
    return None if n is None else date(2024, 1, n)


def run(spark, table, facts, known, arrived, **more):
    return join_late(
        spark.createDataFrame(facts, FACTS), spark.createDataFrame(known, SIDES), spark.createDataFrame([(k,) for k in arrived], "side string"),
        table, RULE, **more,
    )


def held(spark, table):
    return sorted((tuple(r) for r in spark.table(table).select("id", "side", "note", "seen", "name", "kind", "day").collect()), key=repr)


def joined(facts, sides):
    """The newest copy of every fact with its side, in plain Python."""
    def order(f):
        return (f[3] is not None, f[3] or 0, f[1] is not None, f[1] or "", f[2] is not None, f[2] or "")

    newest = {}
    for f in facts:
        if f[0] not in newest or order(f) > order(newest[f[0]]):
            newest[f[0]] = f
    return sorted(((i, s, n, v, *sides[s], d) for i, s, n, v, d in newest.values() if s in sides), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_split_into_runs_gives_the_result_of_one_run(spark, unique, seed):
    rng, table = random.Random(seed), unique("late")
    keys = ["a", "b", "c", "d", None]
    facts = []
    for i in [*(f"f{k}" for k in range(14)), None]:
        fixed = day(rng.choice([1, 2, 3, None]))
        for _ in range(rng.randint(1, 3)):
            facts.append((i, rng.choice(keys), rng.choice(["x", "y", None]), rng.choice([None, 1, 2]), fixed))
    rng.shuffle(facts)
    # Side rows change from run to run; d never comes.
    known = {}
    runs = [facts[0:9], facts[9:18], facts[18:]]
    for part in runs:
        arrived = rng.sample(["a", "b", "c"], 2)
        known |= {k: (rng.choice(["n", "m", None]), rng.randint(0, 2)) for k in arrived}
        for _ in range(rng.randint(1, 2)):  # a run may be repeated
            run(spark, table, part, [(k, *v) for k, v in known.items()], [*arrived, *arrived])
        assert held(spark, table) == joined([f for p in runs[: runs.index(part) + 1] for f in p], known)
    waiting = {r.id for r in spark.table(pending_table(table)).collect()}
    assert waiting == {f[0] for f in facts} - {row[0] for row in held(spark, table)}


def files(spark, table):
    return {f: os.stat(f.removeprefix("file:")).st_mtime_ns for f in spark.table(table).inputFiles()}


def test_a_run_rewrites_only_days_that_change(spark, unique):
    table = unique("late")
    facts = [(f"f{i}", "a" if i < 3 else "b", "x", 1, day(i + 1)) for i in range(5)]
    fresh = run(spark, table, facts, [("a", "n", 1)], ["a"])
    assert {r.id for r in fresh.collect()} == {"f0", "f1", "f2"}
    before = files(spark, table)
    fresh = run(spark, table, NO_FACTS, [("a", "n", 1), ("b", "m", 2)], ["a", "b"])
    assert {r.id for r in fresh.collect()} == {"f3", "f4"}  # those waiting, and no one else
    after = files(spark, table)
    assert before.items() <= after.items() and len(after) > len(before)
    assert run(spark, table, facts, [("a", "n", 1), ("b", "m", 2)], ["a", "b"]).isEmpty()
    assert files(spark, table) == after


def test_a_changed_side_is_sought_from_a_day_on(spark, unique):
    table = unique("late")
    run(spark, table, [("f0", "a", "x", 1, day(1)), ("f1", "a", "x", 1, day(5))], [("a", "n", 1)], ["a"])
    fresh = run(spark, table, NO_FACTS, [("a", "m", 1)], ["a"], from_day="2024-01-03")
    assert [(r.id, r.name) for r in fresh.collect()] == [("f1", "m")]


def test_a_newer_copy_without_its_side_takes_the_served_one_out(spark, unique):
    table = unique("late")
    run(spark, table, [("f", "a", "x", 1, day(1)), ("g", "a", "x", 1, None)], [("a", "n", 1)], ["a"])
    run(spark, table, [("f", "b", "x", 2, day(1)), ("g", "b", "x", 2, None)], [("a", "n", 1)], [])
    assert held(spark, table) == []
    run(spark, table, [("f", "a", "x", 1, day(1))], [("a", "n", 1), ("b", "m", 2)], ["b"])
    assert [(r[0], r[1], r[4]) for r in held(spark, table)] == [("f", "b", "m"), ("g", "b", "m")]


def test_empty_tables_and_clashing_names(spark, unique):
    table = unique("late")
    assert run(spark, table, NO_FACTS, NO_SIDES, []).isEmpty()
    assert held(spark, table) == []
    facts = spark.createDataFrame(NO_FACTS, FACTS)
    sides = spark.createDataFrame(NO_SIDES, "side string, note string")
    with pytest.raises(ValueError, match="note"):
        join_late(facts, sides, sides, table, RULE)


def test_touches_of_deliveries_that_land_after_their_events(spark, unique, folder):
    """Equal to the touches of a run that has both."""
    name = unique("tenant")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/db'")

    def land(kind, rows, number):
        spec = jobs.FILE_LANDINGS[kind]
        shaped = rows.select(*[F.col(c).cast(t).alias(c) if c in rows.columns else F.lit(None).cast(t).alias(c)
                               for c, t in ((f.name, f.dataType) for f in spec.columns)])
        shaped.write.parquet(f"{folder}/{kind}/{number}")
        jobs.ingest_files(spark, kind, f"{folder}/{kind}", "2024-01-01", "2024-01-09", name, buckets=2)

    events = spark.createDataFrame(
        [("e1", "d1", "opened", "2024-01-02 10:00:00"), ("e2", "d2", "opened", "2024-01-03 10:00:00"), ("e3", "d2", "noise", "2024-01-03 11:00:00")],
        "event_id string, delivery_id string, metric string, created_at string",
    )
    sides = [("d1", "p1", 7, "2024-01-01 09:00:00"), ("d2", "p1", 7, "2024-01-03 09:00:00")]
    kind = "delivery_id string, internal_customer_id string, campaign_id int, created_at string"
    assert jobs.run_late_touches(spark, "2024-01-01", "2024-01-09", name) is None
    land("metrics", events, 1)
    land("deliveries", spark.createDataFrame(sides[:1], kind), 1)
    jobs.run_late_touches(spark, "2024-01-01", "2024-01-09", name)
    touched = f"{name}.customerio_channel_touches"
    assert [str(r.created_at) for r in spark.table(touched).collect()] == ["2024-01-02 10:00:00"]
    land("deliveries", spark.createDataFrame(sides[1:], kind), 2)
    jobs.run_late_touches(spark, "2024-01-03", "2024-01-03", name)
    assert [(r.metric, r.playbook_id, str(r.created_at)) for r in spark.table(touched).collect()] == [("opened", 7, "2024-01-03 10:00:00")]
    served = {r.event_id for r in spark.table(f"{name}.customerio_delivery_metrics").collect()}
    assert served == {"e1", "e2", "e3"} and spark.table(f"{name}.customerio_delivery_metrics_pending").isEmpty()


def test_a_run_shuffles_each_fact_once_per_key(spark, unique):
    """The newest copies meet the served ones where they are, and found and missing sides are told by one join."""
    facts = spark.createDataFrame([("f", "a", "x", 1, day(1))], FACTS)
    table = unique("late")
    run(spark, table, [("f", "a", "x", 0, day(1))], [("a", "n", 1)], ["a"])
    asked = late._unserved(facts, spark.table(table), RULE, [c for c in facts.columns if c != "day"])
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = asked._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") == 2  # one of the facts, one of the served table


def test_a_run_writes_each_fact_once_besides_the_tables(spark, unique, monkeypatch, folder):
    table = unique("late")
    monkeypatch.setattr(late, "new_work_dir", lambda spark, label: f"{folder}/work")
    fresh = run(spark, table, [("f", "a", "x", 1, day(1)), ("g", "b", "x", 1, day(1)), ("h", None, "x", 1, None)], [("a", "n", 1)], ["a"])
    assert [r.id for r in fresh.collect()] == ["f"]
    assert os.listdir(f"{folder}/work") == ["joined"]
