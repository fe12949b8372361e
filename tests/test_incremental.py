"""Upserts, windows, registries, plans: edge cases and properties."""

import os
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsework.operators import merge, metering, numbering, planning, quality
from pulsework.operators.latest import latest_by_key
from pulsework.sources import prune_files

KV = "k string, g int, v string, w string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_guarded_upsert(spark, small):
    target = spark.createDataFrame(
        [("older", 1, "t", "t"), ("equal", 2, "t", "t"), ("newer", 9, "t", "t"), ("no target guard", None, "t", "t"),
         ("no source guard", 1, "t", "t"), ("only target", 1, "t", "t"), (None, 1, "t", "t")],
        KV,
    )
    source = spark.createDataFrame(
        [("older", 2, "s", "s"), ("equal", 2, "s", "s"), ("newer", 2, "s", "s"), ("no target guard", 5, "s", "s"),
         ("no source guard", None, "s", "s"), ("only source", 2, "s", "s"), (None, 2, "s", "s")],
        KV,
    )
    got = rows(merge.upsert(target, source, ["k"], ["v"], "g", small_source=small))
    assert got == sorted(
        [("older", 2, "s", "t"), ("equal", 2, "t", "t"), ("newer", 9, "t", "t"), ("no target guard", None, "t", "t"),
         ("no source guard", 1, "t", "t"), ("only target", 1, "t", "t"), ("only source", 2, "s", "s"),
         (None, 1, "t", "t"), (None, 2, "s", "s")],
        key=repr,
    )


def test_plain_upsert_changes_matched_rows_always(spark):
    target = spark.createDataFrame([("a", 9, "t", "t"), ("b", 1, "t", "t")], KV)
    source = spark.createDataFrame([("a", None, "s", None)], KV)
    assert rows(merge.upsert(target, source, ["k"])) == [("a", None, "s", None), ("b", 1, "t", "t")]


pairs = st.dictionaries(
    st.sampled_from("abcdef"), st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.sampled_from("xy")), max_size=6
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=pairs, new=pairs)
def test_upsert_twice_equals_once_and_both_plans_agree(spark, old, new):
    ddl = "k string, g int, v string"
    target = spark.createDataFrame([(k, *gv) for k, gv in old.items()], ddl)
    source = spark.createDataFrame([(k, *gv) for k, gv in new.items()], ddl)
    once = merge.upsert(target, source, ["k"], newer_by="g")
    want = rows(once)
    assert rows(merge.upsert(once, source, ["k"], newer_by="g")) == want
    assert rows(merge.upsert(target, source, ["k"], newer_by="g", small_source=True)) == want
    model = dict(old)
    for k, (g, v) in new.items():
        if k not in old or (g is not None and old[k][0] is not None and g > old[k][0]):
            model[k] = (g, v)
    assert want == sorted(((k, *gv) for k, gv in model.items()), key=repr)


def test_upsert_of_rows_with_maps(spark):
    ddl = "k string, g int, m map<string,int>"
    target = spark.createDataFrame([("a", 1, {"x": 1}), (None, 1, {"x": 2})], ddl)
    source = spark.createDataFrame([("a", 2, {"y": 3})], ddl)
    got = merge.upsert(target, latest_by_key(source, ["k"], ["g"]), ["k"], newer_by="g")
    assert {r.k: r.m for r in got.collect()} == {"a": {"y": 3}, None: {"x": 2}}


def test_bucketed_target_is_not_shuffled(spark, unique):
    name = unique("bucketed")
    target = spark.range(1000).select((F.col("id") % 100).cast("string").alias("k"), F.lit(1).alias("g")).distinct()
    target.write.bucketBy(4, "k").sortBy("k").saveAsTable(name)
    source = spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit(2).alias("g"))
    merged = merge.upsert(spark.table(name), source, ["k"], null_keys=False)
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {r.g: r["count"] for r in merged.groupBy("g").count().collect()} == {1: 50, 2: 50}


def test_replace_days_keeps_rows_outside_and_without_time(spark):
    at = lambda d, h=0: datetime(2024, 1, d, h)
    target = spark.createDataFrame([(1, at(1, 23)), (2, at(2)), (3, at(3, 23)), (4, at(4)), (5, None)], "i int, t timestamp")
    source = spark.createDataFrame([(9, at(2, 5))], "i int, t timestamp")
    got = merge.replace_days(target, source, "t", "2024-01-02", "2024-01-03")
    assert sorted(r.i for r in got.collect()) == [1, 4, 5, 9]


def test_expire_keeps_the_cutoff_day_and_unknown_times(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1, 23, 59)), (2, datetime(2024, 1, 2)), (3, None)], "i int, t timestamp"
    )
    assert sorted(r.i for r in merge.expire(df, "t", "2024-04-01", 90).collect()) == [2, 3]


# ---- registry and numbering ------------------------------------------------------------------


def registry(spark, *entries):
    return spark.createDataFrame(entries, "event_type string, event_type_id bigint, is_active boolean")


def listed(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "event_type string")


def test_empty_registry_starts_at_two(spark):
    got = numbering.sync_registry(registry(spark), listed(spark, "a", "b", "a", None))
    assert sorted(r.event_type_id for r in got.collect()) == [2, 3]
    assert all(r.is_active for r in got.collect())


def test_type_that_leaves_and_returns_keeps_its_id(spark):
    first = registry(spark, ("a", 2, True), ("b", 7, True))
    gone = numbering.sync_registry(first, listed(spark, "a"))
    assert rows(gone) == [("a", 2, True), ("b", 7, False)]
    back = numbering.sync_registry(gone, listed(spark, "a", "b", "c"))
    assert rows(back) == [("a", 2, True), ("b", 7, True), ("c", 8, True)]
    assert rows(numbering.sync_registry(back, listed(spark, "a", "b", "c"))) == rows(back)
    assert rows(numbering.sync_registry(back, None)) == rows(back)


def test_dense_index_has_no_gaps(spark):
    ids = spark.range(5000).select(F.col("id").cast("string").alias("id"))
    got = numbering.dense_index(ids, "id", digits=2)
    assert sorted(r["index"] for r in got.collect()) == list(range(5000))


def test_batches_are_full_but_the_last(spark):
    ids = spark.range(0, 1030).select((F.col("id") % 515).cast("string").alias("id"))
    batches = numbering.batch_ids(ids, "id").collect()
    sizes = {b.batch: len(b.ids) for b in batches}
    assert [sizes[i] for i in sorted(sizes)] == [50] * 10 + [15]
    assert len({i for b in batches for i in b.ids}) == 515


# ---- plans -----------------------------------------------------------------------------------


@pytest.mark.parametrize("days,lengths", [(0, []), (1, [1]), (100, [100]), (101, [100, 1]), (250, [100, 100, 50])])
def test_backfill_windows_tile_the_span(spark, days, lengths):
    end = date(2025, 1, 1)
    entities = spark.createDataFrame(
        [("x", end - timedelta(days=days)), ("y", end - timedelta(days=5))], "id string, created_at date"
    )
    plan = planning.plan_backfill(entities, "id", "2025-01-01", 100).orderBy("id", F.desc("ending_at")).collect()
    mine = [r for r in plan if r.id == "x"]
    assert [r.length for r in mine] == lengths
    upper = end
    for r in mine:
        assert r.ending_at == upper
        upper = upper - timedelta(days=r.length)
    assert upper == end - timedelta(days=days)
    assert [r.length for r in plan if r.id == "y"] == [5]


def test_backfill_with_a_fixed_length(spark):
    entities = spark.createDataFrame([("x",)], "id string")
    plan = planning.plan_backfill(entities, "id", "2025-01-10", 14, start_day="2025-01-08", length=20).collect()
    assert sorted((str(r.ending_at), r.length) for r in plan) == [("2024-12-27", 8), ("2025-01-10", 14)]


def test_daily_plan_and_its_late_rerun(spark):
    runs = spark.createDataFrame([("2024-03-05", "2024-03-07")], "a string, b string")
    days = lambda **kw: sorted(str(r.day) for r in planning.plan_daily(runs, "a", "b", **kw).collect())
    assert days() == ["2024-03-04", "2024-03-05", "2024-03-06"]
    assert days(offset=30) == ["2024-02-03", "2024-02-04", "2024-02-05"]
    assert days(offset=1) == ["2024-03-03", "2024-03-04"]
    assert planning.run_window("2024-03-01", "2024-03-02") == ("2024-02-29", "2024-03-01")


def test_files_without_bounds_are_left_out(spark):
    at = lambda d: datetime(2024, 1, d, 12)
    files = spark.createDataFrame(
        [("before", "m", at(1), at(4)), ("touches", "m", at(1), at(5)), ("spans", "m", at(1), at(20)), ("inside", "m", at(6), at(6)),
         ("after", "m", at(8), at(9)), ("no lo", "m", None, at(6)), ("no hi", "m", at(6), None), ("other", "o", at(6), at(6))],
        "file_name string, type string, min_timestamp timestamp, max_timestamp timestamp",
    )
    got = prune_files(files, "m", "2024-01-05", "2024-01-07")
    assert sorted(r.file_name for r in got.collect()) == ["inside", "spans", "touches"]


# ---- checks and meters -------------------------------------------------------------------------


def test_checks(spark):
    df = spark.createDataFrame([(1, "campaign"), (1, "canvas"), (None, "mail"), (None, None)], "k int, type string")
    assert rows(quality.check_unique(df, ["k"])) == [(1, 2)]
    assert rows(quality.check_domain(df, "type", ["campaign", "canvas"])) == [("mail", 1)]
    assert rows(quality.check_not_null(df, ["k", "type"])) == [("k", 2), ("type", 1)]


def test_meter_of_an_unknown_domain_fails(spark):
    orgs = spark.createDataFrame([(1, "a", True), (2, "b", False)], "id int, domain string, active boolean")
    meters = spark.createDataFrame([], "org_id int, meter string, active boolean")
    usage = lambda d: spark.createDataFrame([(d, 3)], "domain string, active_events int")
    assert rows(metering.meter_merge(meters, orgs, usage("a"), ["active_events"])) == [(1, '{"active_events":3}', True)]
    with pytest.raises(Exception, match="no organisation for b"):
        metering.meter_merge(meters, orgs, usage("b"), ["active_events"]).collect()


def test_meter_keeps_other_keys(spark):
    orgs = spark.createDataFrame([(1, "a", True)], "id int, domain string, active boolean")
    meters = spark.createDataFrame(
        [(1, '{"plan":{"n":1.5},"active_events":9}', True), (1, '{"x":1}', False), (5, None, True)],
        "org_id int, meter string, active boolean",
    )
    usage = spark.createDataFrame([("a", 3)], "domain string, active_events int")
    got = rows(metering.meter_merge(meters, orgs, usage, ["active_events"]))
    assert got == [(1, '{"plan":{"n":1.5},"active_events":3}', True), (1, '{"x":1}', False), (5, None, True)]


def test_active_users_window_is_half_open(spark):
    at = lambda m, d: datetime(2024, m, d)
    df = spark.createDataFrame(
        [("before", at(1, 30)), ("first", at(1, 31)), ("first", at(2, 5)), ("last", at(2, 29)), ("late", at(3, 1))], "u string, t timestamp"
    )
    got = metering.monthly_active_users(df, "u", "t", "2024-03-03").first()[0]
    assert got == 2
    assert metering.monthly_active_users(df, "u", "t", "2024-03-03", approximate=True).first()[0] == 2


def test_active_types(spark):
    reg = registry(spark, ("a", 1, True), ("b", 1, True), ("c", 3, False))
    assert metering.active_types(reg).first()[0] == 2
    assert metering.active_types(reg, distinct=True).first()[0] == 1


def test_publishing_leaves_tables_of_like_names(spark, unique, folder):
    from pulsework import sinks

    name = unique("pub")
    plain = f"{name}__notes"
    spark.range(1).write.saveAsTable(plain)
    for i in range(3):
        sinks.publish(spark.range(i + 1), name, root=folder)
        sinks.publish(spark.range(10), f"{name}__y", root=folder)
    assert (spark.table(name).count(), spark.table(f"{name}__y").count(), spark.table(plain).count()) == (3, 10, 1)
    assert len([n for n in os.listdir(folder) if n.startswith(f"{name}__2")]) == 2
    assert len([n for n in os.listdir(folder) if n.startswith(f"{name}__y__2")]) == 2


def test_retention_keeps_the_layout(spark, unique, folder):
    from pulsework import sinks

    name = unique("kept")
    rows = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-06-01")], "k string, at string")
    sinks.publish(rows, name, root=folder, partition_by=["k"])
    copy = sinks.expire_published(spark, name, "at", "2024-07-01", root=folder)
    assert [c.name for c in spark.catalog.listColumns(copy) if c.isPartition] == ["k"]
    assert [r.k for r in spark.table(name).collect()] == ["b"]


def test_threads_do_not_undo_the_overwrite_mode(spark, unique):
    from concurrent.futures import ThreadPoolExecutor

    from pulsework import sinks

    tables = [unique("days") for _ in range(3)]
    days = [f"2024-01-0{i}" for i in range(1, 4)]
    whole = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, day string")
    one = spark.createDataFrame([(9, days[1])], "id int, day string")

    def load(table):
        sinks.replace_days_table(whole, table, "day", days[0], days[2])
        sinks.replace_days_table(one, table, "day", days[1], days[1])
        return sorted(r.id for r in spark.table(table).collect())

    with ThreadPoolExecutor(3) as pool:
        assert list(pool.map(load, tables)) == [[0, 2, 9]] * 3


def test_bad_lines_are_kept_aside(spark, unique, folder):
    from pulsework.plans import jobs

    os.makedirs(f"{folder}/run")
    with open(f"{folder}/run/a.jsonl", "w") as out:
        out.write('{"id": "c1", "name": "n", "metadata": {"timestamp": 1.0, "run_id": "r"}}\n{"id": "c2", "na\n')
    space = unique("ns")
    spark.sql(f"CREATE DATABASE {space}")
    jobs.ingest(spark, "campaign_list", f"{folder}/run", namespace=space)
    bad = spark.table(f"{space}.{jobs.LANDINGS['campaign_list'].table}_quarantine").collect()
    assert [r.line for r in bad] == ['{"id": "c2", "na'] and bad[0].file.endswith("a.jsonl")
    assert spark.table(f"{space}.{jobs.LANDINGS['campaign_list'].table}").count() == 1
