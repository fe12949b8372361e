"""Joins under skew, latest rows, touches, and what the plans look like."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulsework import schemas
from pulsework.operators import events, touches
from pulsework.operators.joins import skew_join
from pulsework.operators.latest import dedupe, filter_then_latest, latest_by_key, latest_then_filter
from pulsework.plans import derive
from pulsework.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_gives_the_plain_join(spark, how):
    """One key holds a third of the facts, another a tenth; some facts have no key or no partner."""
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1)
        .when(F.col("id") % 10 == 1, 2)
        .when(F.col("id") % 50 == 2, F.lit(None))
        .otherwise(F.col("id") % 97 + 10)
        .cast("int")
        .alias("k"),
        "id",
    )
    lookup = spark.createDataFrame([(k, f"name {k}") for k in [1, 2, *range(10, 60)]], "k int, name string")
    got = skew_join(facts, lookup, ["k"], how, hot_rows=100)
    assert rows(got.select("k", "id", "name")) == rows(facts.join(lookup, "k", how).select("k", "id", "name"))


def test_skew_join_cuts_hot_keys(spark):
    facts = spark.range(1000).select(F.lit(7).alias("k"), "id")
    lookup = spark.createDataFrame([(7, "x"), (8, "y")], "k int, name string")
    joined = skew_join(facts, lookup, ["k"], hot_rows=100)
    assert joined.count() == 1000
    assert "_slice" in plan(joined)


def test_latest_hides_or_skips_inactive_rows(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("b", 1, True)], "k string, t int, active boolean")
    assert rows(latest_then_filter(df, ["k"], ["t"], F.col("active"))) == [("b", 1, True)]
    assert rows(filter_then_latest(df, ["k"], ["t"], F.col("active"))) == [("a", 1, True), ("b", 1, True)]


def test_ties_and_unknown_times_have_one_answer(spark):
    data = [("a", None, "z"), ("a", 1, "x"), ("a", 1, "y"), (None, 2, "q"), (None, 3, "p")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k string, t int, v string").repartition(3)
        assert rows(latest_by_key(df, ["k"], ["t"])) == [("a", 1, "y"), (None, 3, "p")]
    assert rows(dedupe(spark.createDataFrame(data, "k string, t int, v string"), ["k"])) == [("a", 1, "y"), (None, 3, "p")]


def test_touch_keys_are_a_parameter(spark):
    """A campaign and a newsletter that share an id collide unless the type is part of the key."""
    at = lambda h: datetime(2024, 1, 2, h)
    deliveries = spark.createDataFrame(
        [("d1", "p", "email", 5, None, None, 1, 9), ("d2", "p", "push", None, 5, None, None, 8), ("d3", "p", "push", None, None, None, 1, 2)],
        "delivery_id string, internal_customer_id string, delivery_type string, campaign_id int, newsletter_id int,"
        " transactional_message_id int, action_id int, content_id int",
    )
    metrics = spark.createDataFrame(
        [("d1", "sent", at(1)), ("d1", "sent", at(3)), ("d2", "sent", at(2)), ("d3", "opened", at(10)), ("d1", "other", at(4)),
         ("d1", "sent", datetime(2024, 1, 3))],
        "delivery_id string, metric string, created_at timestamp",
    )
    got = touches.channel_touches(metrics, deliveries, "2024-01-02", "2024-01-02")
    assert rows(got) == [
        ("opened", "p", None, None, 1, "push", at(10)),
        ("sent", "p", 5, "campaign", 1, "email", at(3)),
    ]
    apart = touches.channel_touches(
        metrics, deliveries, "2024-01-02", "2024-01-02", ("internal_customer_id", "playbook_id", "type")
    )
    assert apart.count() == 3


def test_amplitude_keeps_inactive_types_unless_told(spark):
    at = datetime(2024, 1, 2)
    raw = spark.createDataFrame(
        [("a", "u", at, at, at, "x"), ("b", "u", at, at, at, "x"), ("a", None, at, at, at, "x"), ("c", "u", at, at, at, "x")],
        "event_type string, user_id string, client_event_time timestamp, client_upload_time timestamp,"
        f" server_received_time timestamp, {schemas.REPLICATION_COLUMNS[2]} string",
    )
    reg = spark.createDataFrame([("a", 1, True), ("b", 2, False)], schemas.EVENT_TYPES)
    both = events.amplitude_events(raw, reg, "2024-01-02", "2024-01-02")
    assert sorted(r.event_type for r in both.collect()) == ["a", "b"]
    assert not set(both.columns) & set(schemas.REPLICATION_COLUMNS)
    active = events.amplitude_events(raw, reg, "2024-01-02", "2024-01-02", active_only=True)
    assert [r.event_type for r in active.collect()] == ["a"]


# ---- plans ---------------------------------------------------------------------------------------

BATCH = sorted(n for n in QUERIES if not n.startswith(("st", "s8", "k1", "k2", "k4_upsert_p", "k4_upsert_d", "k5_replace_day_", "k6_expire_day", "k7")))


@pytest.mark.parametrize("name", BATCH)
def test_no_python_rows_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapPartitions", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_latest_row_is_limited_before_the_shuffle(spark):
    text = plan(QUERIES["w1_latest_event_per_user_and_type"](spark, SF_DIR))
    assert text.count("WindowGroupLimit") == 2


def test_day_range_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["f2_f3_f5_on_days"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in scan


@pytest.mark.parametrize(
    "name,pushed",
    [
        ("a3_monthly_active_users", ["GreaterThanOrEqual(ts,", "LessThan(ts,"]),
        ("f7_after_cursor", ["GreaterThan(o_orderdate,"]),
        ("f1_predicates", ["EqualTo(o_orderstatus,F)", "In(o_orderpriority,"]),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    text = plan(QUERIES[name](spark, SF_DIR))
    for part in pushed:
        assert part in text


def test_span_and_retention_filters_reach_the_scan(spark):
    from pulsework.operators import filters, merge

    orders = derive.table(spark, SF_DIR, "orders")
    text = plan(filters.spanning_days(orders, ["o_orderdate"], "1999-01-01", "1999-01-31"))
    assert "GreaterThanOrEqual(o_orderdate," in text and "LessThan(o_orderdate," in text
    assert "Or(IsNull(o_orderdate),GreaterThanOrEqual(o_orderdate," in plan(merge.expire(orders, "o_orderdate", "1999-01-01"))
    kept = merge.replace_days(orders, orders.limit(0), "o_orderdate", "1999-01-01", "1999-01-31")
    assert "Or(Or(IsNull(o_orderdate),LessThan(o_orderdate," in plan(kept)


def test_landing_lines_are_parsed_once(spark, folder):
    from pulsework.operators import landing_rows
    from pulsework.sources import accepted, read_jsonl

    derive.campaign_lines(derive.events(spark, SF_DIR)).write.text(f"{folder}/lines")
    parsed = read_jsonl(spark, f"{folder}/lines/*.txt", schemas.CAMPAIGN_SERIES_LINE)
    text = plan(landing_rows.campaign_series(accepted(parsed)))
    assert text.count("from_json") == 1
