"""Uncovered windows, joins of overlapping intervals, VARIANT payloads, and loads that are checked before they are shown."""

import json
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pulsework import audit
from pulsework.operators import intervals, landing_rows, planning, series
from pulsework.plans import derive, jobs
from pulsework.plans.catalog import QUERIES
from pulsework.sources import accepted, files_of_windows, parse_lines, parse_variants, quarantined
from pulsework import schemas

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@pytest.fixture
def namespace(spark, unique):
    name = unique("tenant")
    spark.sql(f"CREATE DATABASE {name}")
    return name


# ---- uncovered windows -----------------------------------------------------------------------

WINDOW = "id string, ending_at date, length int"


def test_uncovered_windows_against_single_days(spark):
    pick, start = random.Random(5), date(2024, 2, 20)
    windows = lambda n: [(f"e{pick.randrange(6)}", start + timedelta(pick.randrange(60)), pick.randrange(0, 25)) for _ in range(n)]
    planned, landed = windows(30), windows(25)
    got = planning.uncovered_windows(spark.createDataFrame(planned, WINDOW), spark.createDataFrame(landed, WINDOW), "id", 5).collect()
    days_of = lambda w: {(i, end - timedelta(k)) for i, end, n in w for k in range(1, n + 1)}
    open_days = days_of(planned) - days_of(landed)
    covered = [(r.id, r.ending_at - timedelta(k)) for r in got for k in range(1, r.length + 1)]
    assert set(covered) == open_days and len(covered) == len(open_days)
    # As few windows as can be: only the earliest of an island is shorter than the limit.
    for r in got:
        assert r.length == 5 or (r.id, r.ending_at - timedelta(r.length + 1)) not in open_days


def test_uncovered_windows_of_odd_rows(spark):
    d = date(2024, 3, 1)
    planned = spark.createDataFrame([("a", d, 10), ("a", d, 10), (None, d, 3), ("b", None, 4), ("c", d, 0), ("t", d, 4)], WINDOW)
    landed = spark.createDataFrame([("a", None, 9), ("a", d, -3), (None, d, 3), ("t", d - timedelta(2), 2), ("t", d, 2)], WINDOW)
    assert rows(planning.uncovered_windows(planned, landed, "id", 14)) == [("a", d, 10), (None, d, 3)]
    assert planning.uncovered_windows(planned.limit(0), landed, "id", 14).count() == 0
    whole = planning.uncovered_windows(planned.filter("id = 't'"), landed.limit(0), "id", 14)
    assert rows(whole) == [("t", d, 4)]


def test_uncovered_windows_shuffle_once_after_the_steps(spark):
    w = spark.createDataFrame([("a", date(2024, 3, 1), 10)], WINDOW)
    plan = plan_of(planning.uncovered_windows(w, w, "id", 14))
    # One exchange for the steps of a day, one for the entity; runs are grouped where they are.
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2


# ---- overlapping intervals -------------------------------------------------------------------


@pytest.mark.parametrize("levels", [0, 3, 12])
def test_overlap_join_against_all_pairs(spark, levels):
    pick = random.Random(levels)
    spans = lambda n, name: [(f"{name}{i}", lo, lo + pick.choice([-3, -1, 0, 0, 1, 2, 5, 17, 64, 120])) for i in range(n) for lo in [pick.randrange(-70, 70)]]
    left, right = [*spans(60, "l"), ("same", 0, 7), ("lone", None, 5)], [*spans(60, "r"), ("twin", 0, 7), ("open", 3, None)]
    a = spark.createDataFrame(left, "l string, a int, b int")
    b = spark.createDataFrame(right, "r string, c int, d int")
    got = intervals.overlap_join(a, b, (F.col("a"), F.col("b")), (F.col("c"), F.col("d")), levels=levels)
    want = [(*x, *y) for x in left for y in right if None not in (*x, *y) and x[1] <= x[2] and y[1] <= y[2] and x[1] <= y[2] and y[1] <= x[2]]
    assert rows(got) == sorted(want, key=repr) and len(want) > 100


def test_overlap_join_with_equal_columns(spark):
    a = spark.createDataFrame([("x", 1, 5), ("y", 1, 5), (None, 1, 5)], "k string, a int, b int")
    b = spark.createDataFrame([("x", 5, 9), ("y", 6, 9), (None, 1, 5)], "k string, c int, d int")
    spans = (F.col("a"), F.col("b")), (F.col("c"), F.col("d"))
    assert rows(intervals.overlap_join(a, b, *spans, on=["k"])) == [("x", 1, 5, 5, 9)]
    with pytest.raises(ValueError):
        intervals.overlap_join(a, b, *spans)


def test_repeated_rows_are_never_collected_on_the_driver(spark):
    """A few rows that explode into many look small to Spark, which would broadcast them."""
    many = spark.range(3).select(F.explode(F.sequence(F.lit(0), F.lit(999))).alias("a")).withColumn("b", F.col("a") + 1)
    few = spark.range(5).selectExpr("id AS c", "id AS d")
    got = intervals.overlap_join(many, few, (F.col("a"), F.col("b")), (F.col("c"), F.col("d")))
    assert got.count() == 3 * 9
    assert "Broadcast" not in plan_of(got)


def test_query_seeks_the_files_of_equal_windows_once(spark, folder):
    """Sixty customers of one key have the same windows; only the windows' distinct days meet the files."""
    customer = spark.read.parquet(f"{SF_DIR}/customer.parquet").limit(1).drop("c_custkey").crossJoin(spark.range(60)).withColumn("c_custkey", F.col("id") * 2400)
    customer.drop("id").write.parquet(f"{folder}/customer.parquet")
    spark.read.parquet(f"{SF_DIR}/orders.parquet").write.parquet(f"{folder}/orders.parquet")
    got = QUERIES["r2_f6_files_of_all_windows"](spark, folder)
    windows = {}
    for r in got.collect():
        windows.setdefault((r.ending_at, r.length, r.files, r.first_file, r.last_file), set()).add(r.id)
    assert windows and all(len(ids) == 60 for ids in windows.values())
    joins = [line for line in plan_of(got).splitlines() if "BroadcastHashJoin" in line]
    assert joins and all("[ending_at" in line and "_block" not in line for line in joins)


def test_files_of_windows_need_no_nested_loop(spark):
    registry = spark.sql("SELECT 'f' AS file_name, 'm' AS type, timestamp'2024-01-03 12:00:00' AS min_timestamp, timestamp'2024-01-05 00:00:00' AS max_timestamp")
    windows = spark.createDataFrame([(1, date(2024, 1, 1), date(2024, 1, 2)), (2, date(2024, 1, 5), date(2024, 1, 9)), (3, date(2024, 1, 3), date(2024, 1, 3))], "w int, first date, last date")
    needed = files_of_windows(registry, windows, "m", F.col("first"), F.col("last"))
    assert sorted(r.w for r in needed.collect()) == [2, 3]
    assert files_of_windows(registry, windows, "other", F.col("first"), F.col("last")).count() == 0
    plan = plan_of(needed)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# ---- variants --------------------------------------------------------------------------------

ODD_DAYS = [
    {"time": "2024-01-01", "messages": {"email": [{"sent": 3, "opens": "4", "revenue": 1.50, "variation_name": "Control"}, None]}},
    {"time": "2024-01-02", "messages": None},
    {"time": "2024-01-03"},
    {"messages": {"sms": [{"sent": None, "clicks": 1e3, "extra": {"deep": [1]}}], "webhook": []}},
    None,
]


def test_series_from_variants_equal_those_from_text(spark):
    lines = [json.dumps({"data": ODD_DAYS, "metadata": {"timestamp": 5.25, "params": {"campaign_id": "c1"}, "run_id": "r"}}),
             json.dumps({"data": None, "metadata": {"params": {"campaign_id": "c2"}}}), json.dumps({"data": ODD_DAYS[:1]}), "{}"]
    text = spark.createDataFrame([(x,) for x in lines], "value string")
    old = landing_rows.campaign_series(accepted(parse_lines(text, schemas.CAMPAIGN_SERIES_LINE)))
    new = landing_rows.campaign_series_variants(accepted(parse_variants(text, ["data"])))
    plain = ["campaign_id", "start_date", "metadata", "created_at"]
    assert rows(old.select(*plain)) == rows(new.select(*plain)) and new.count() == 6
    for operator in (series.campaign_variants, series.campaign_channels):
        assert rows(operator(old)) == rows(operator(new)) != []


def test_a_value_of_another_type_loses_only_itself(spark):
    line = json.dumps({"data": [{"time": "2024-01-01", "messages": {"email": "none", "sms": [{"sent": 2}]}}]})
    raw = landing_rows.campaign_series_variants(accepted(parse_variants(spark.createDataFrame([(line,)], "value string"), ["data"])))
    assert sorted((r.channel_name, r.sends) for r in series.campaign_channels(raw).collect()) == [("email", 0), ("sms", 2)]


def test_bad_lines_of_variants(spark):
    lines = ["{", "", "[1]", "3", '"text"', '{"data": "x"}', '{"data": {}}', '{"a": 1, "a": 2}', '  {"data": []}', '{"data": null}', "{}", None]
    parsed = parse_variants(spark.createDataFrame([(x,) for x in lines], "value string"), ["data"])
    assert sorted(r.line for r in quarantined(parsed).collect()) == sorted([*lines[:8], ""])
    assert accepted(parsed).count() == 3
    assert landing_rows.campaign_series_variants(accepted(parsed)).count() == 0


def test_a_line_is_parsed_once(spark):
    lines = derive.campaign_lines(derive.events(spark, SF_DIR))
    landed = landing_rows.campaign_series_variants(accepted(parse_variants(lines, ["data"])))
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert plan.lower().count("parsejson") + plan.lower().count("parse_json") == 1 and "from_json" not in plan


def test_jobs_of_a_table_of_variants(spark, folder, namespace, unique):
    days = lambda n: [{"time": "2024-01-01", "messages": {"email": [{"sent": n, "opens": 1, "clicks": 2}]}}]
    line = lambda n, at: json.dumps({"data": days(n), "metadata": {"timestamp": at, "params": {"campaign_id": "c"}, "run_id": "r"}})
    for run, texts in (("1", [line(3, 1.0), "{bad"]), ("2", [line(9, 2.0)])):
        with open(f"{folder}/{run}.jsonl", "w") as f:
            f.write("\n".join(texts))
    text_tenant = unique("tenant")
    spark.sql(f"CREATE DATABASE {text_tenant}")
    results = []
    for tenant, variant in ((namespace, True), (text_tenant, False)):
        for run in ("1", "2", "1"):
            jobs.ingest(spark, "campaign_series", f"{folder}/{run}.jsonl", tenant, run, variant=variant)
            jobs.run_landed(spark, "campaign_series", run, tenant)
        results.append([rows(spark.table(f"{tenant}.{jobs.JOBS[n].table}")) for n in ("campaign_channels", "campaign_variants")])
    assert results[0] == results[1] and results[0][0]
    assert [r.line for r in spark.table(f"{namespace}.braze_campaigns_data_series_quarantine").collect()] == ["{bad"]
    assert spark.table(f"{namespace}.braze_campaigns_data_series").count() == 2
    channels = series.campaign_channels(spark.table(f"{namespace}.braze_campaigns_data_series_view"))
    plan = channels._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "get_json_object" not in plan and "parse" not in plan.lower().replace("parse_iso", "")
    with pytest.raises(ValueError):
        jobs.ingest(spark, "campaign_series", f"{folder}/1.jsonl", namespace, "1")
    with pytest.raises(ValueError):
        jobs.ingest(spark, "campaign_details", f"{folder}/1.jsonl", namespace, "1", variant=True)


# ---- write, audit, publish -------------------------------------------------------------------

RULES = audit.Rules(("k",), ("k", "v"), {"kind": ["campaign", "canvas"]})


def test_only_sound_copies_are_shown(spark, namespace):
    name, shape = f"{namespace}.checked", "k int, v int, kind string"
    sound = spark.createDataFrame([(1, 1, "campaign"), (2, 2, None)], shape)
    bad = spark.createDataFrame([(1, 1, "mail"), (1, None, "canvas"), (None, 3, "mail"), (None, 4, "campaign")], shape)
    assert rows(audit.publish_checked(bad, name, RULES)) and not spark.catalog.tableExists(name)
    assert audit.publish_checked(sound, name, RULES) is None
    for _ in range(2):
        found = audit.publish_checked(bad, name, RULES)
        assert rows(found) == [("domain", "kind", "mail", 2), ("key", "k", '{"k":1}', 2), ("required", "k", None, 2), ("required", "v", None, 1)]
    assert rows(spark.table(name)) == rows(sound)
    assert spark.sql(f"SHOW TABLES IN {namespace} LIKE 'checked__*'").count() == 1
    assert audit.publish_checked(sound.limit(0), name, RULES) is None and spark.table(name).count() == 0
    assert audit.publish_checked(bad, name, audit.Rules()) is None and spark.table(name).count() == 4


def test_checked_loads_are_handed_on_or_dropped(spark):
    loaded = []
    good = spark.createDataFrame([(1, 1, "canvas")], "k int, v int, kind string")
    assert audit.load_checked(good, RULES, lambda batch: loaded.extend(rows(batch))) is None
    assert audit.load_checked(good.unionAll(good), RULES, lambda batch: loaded.extend(rows(batch))).count() == 1
    assert loaded == [(1, 1, "canvas")]


def test_checked_jobs_load_nothing_that_breaks_their_rules(spark, folder, namespace):
    def land(run, *steps):
        stats = [{"time": "2024-01-01", "step_stats": {}, "variant_stats": {v: {"name": v, "entries": 1} for v in steps}}]
        record = {"name": "n", "stats": stats, "metadata": {"timestamp": 1.0, "params": {"canvas_id": "k" if run != "bad" else None}, "run_id": run}}
        with open(f"{folder}/{run}.jsonl", "w") as f:
            f.write(json.dumps(record))
        jobs.ingest(spark, "canvas_series", f"{folder}/{run}.jsonl", namespace, run)

    land("1", "v1")
    target = jobs.run_job(spark, "canvas_variants", namespace, checked=True)
    before = rows(spark.table(target))
    assert len(before) == 1
    land("bad", "v1", "v2")
    with pytest.raises(jobs.Rejected) as told:
        jobs.run_job(spark, "canvas_variants", namespace, checked=True)
    assert rows(told.value.violations) == [("required", "id", None, 2)]
    assert rows(spark.table(target)) == before
    jobs.run_job(spark, "canvas_variants", namespace)
    assert spark.table(target).count() == 3
