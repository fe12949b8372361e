"""Payloads with missing, null and odd parts."""

import json
from datetime import datetime

import pytest

from pulsework import schemas
from pulsework.operators import daily_arrays, details, landing_rows, series, users
from pulsework.sources import accepted, line_counts, parse_lines, quarantined

META = {"timestamp": 1704500000.25, "params": {"campaign_id": "c-1", "canvas_id": "k-1"}, "run_id": "r1"}


def lines(spark, *records):
    texts = [r if isinstance(r, str) or r is None else json.dumps(r) for r in records]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def series_rows(spark, *days):
    return spark.createDataFrame([("c-1", json.dumps(d)) for d in days], "campaign_id string, data string")


def canvas_rows(spark, *days):
    return spark.createDataFrame([("k-1", json.dumps(d)) for d in days], "canvas_id string, stats string")


def dicts(df):
    return [r.asDict() for r in df.collect()]


def test_malformed_lines_are_set_aside(spark):
    parsed = parse_lines(
        lines(spark, {"data": [{"time": "2024-01-05"}], "metadata": META}, "not json", "[1]", '"x"', '{"data": {}}', "", {}),
        schemas.CAMPAIGN_SERIES_LINE,
    )
    assert accepted(parsed).count() == 2
    assert sorted(r.line for r in quarantined(parsed).collect()) == ["", '"x"', "[1]", "not json", '{"data": {}}']
    assert line_counts(parsed, ["data"]).first().asDict() == {"accepted": 2, "quarantined": 5, "missing_data": 1}


def test_series_payload_becomes_one_row_per_day(spark):
    record = {"data": [{"time": "2024-01-05", "messages": {"email": []}}, {"time": "2024-01-06"}], "metadata": META}
    rows = dicts(landing_rows.campaign_series(accepted(parse_lines(lines(spark, record), schemas.CAMPAIGN_SERIES_LINE))))
    assert [(r["campaign_id"], r["start_date"], r["created_at"]) for r in rows] == [
        ("c-1", "2024-01-05", META["timestamp"]),
        ("c-1", "2024-01-06", META["timestamp"]),
    ]
    assert json.loads(rows[0]["data"]) == record["data"][0]
    assert json.loads(rows[0]["metadata"])["params"]["campaign_id"] == "c-1"


def test_campaign_variants_of_odd_messages(spark):
    day = {
        "time": "2024-01-05",
        "messages": {
            "email": [
                {"variation_name": "Control 1", "variation_api_id": "v0", "sent": None, "revenue": 1},
                {"variation_api_id": "v1", "sent": "12", "conversions": 3.9},
                {"variation_name": None, "variation_api_id": "v2", "sent": 1000.0},
                None,
            ],
            "trigger_in_app_message": [{"variation_api_id": "v3", "sent": 9}],
            "fax": [{"variation_api_id": "v4", "sent": 9, "unique_recipients": 4}],
            "sms": None,
        },
    }
    rows = {r["variant_id"]: r for r in dicts(series.campaign_variants(series_rows(spark, day, {"time": "x", "messages": None})))}
    assert sorted(rows) == ["v0", "v1", "v2", "v3", "v4"]
    assert [rows[v]["total_entries"] for v in ("v0", "v1", "v2", "v3", "v4")] == [0, 12, 1000, 0, 0]
    assert rows["v0"]["is_control_group"] and not rows["v2"]["is_control_group"]
    assert (rows["v1"]["variant_name"], rows["v2"]["variant_name"]) == ("", "")
    assert (rows["v1"]["conversions"], rows["v4"]["unique_recipients"]) == (3, 4)
    assert rows["v0"]["time"] == datetime(2024, 1, 5)


def test_campaign_channels_sum_then_truncate(spark):
    day = {
        "time": "2024-01-05",
        "messages": {
            "email": [{"sent": 1.6, "unique_opens": None, "revenue": 0.5}, {"sent": 1.6, "delivered": 4, "conversions": 2}],
            "fax": [{"sent": 5, "conversions": 5, "revenue": 5}],
            "sms": [],
            "webhook": None,
        },
    }
    rows = {r["channel_name"]: r for r in dicts(series.campaign_channels(series_rows(spark, day)))}
    email = rows["email"]
    assert (email["sends"], email["opens"], email["clicks"], email["delivered"]) == (3, 0, 0, 4)
    assert (email["conversions"], email["revenue"]) == (2, 0.5)
    for name in ("fax", "sms", "webhook"):
        assert [rows[name][m] for m in ("sends", "opens", "clicks", "delivered", "conversions", "revenue")] == [0] * 6


def test_canvas_steps_truncate_each_count(spark):
    day = {
        "time": "2024-01-05",
        "step_stats": {
            "s1": {
                "name": "A",
                "revenue": "2.5",
                "conversions": None,
                "unique_recipients": None,
                "messages": {"email": [{"sent": 1.6}, {"sent": 1.6}], "fax": [{"sent": 7}], "ios_push": [{"sent": 2, "total_opens": 3}]},
            },
            "s2": {"name": None, "unique_recipients": 4, "messages": None},
            "s3": {},
        },
    }
    rows = {r["step_id"]: r for r in dicts(series.canvas_steps(canvas_rows(spark, day)))}
    s1 = rows["s1"]
    assert (s1["sent"], s1["total_opens"], s1["channels"]) == (4, 3, "email,fax,ios_push")
    assert (s1["revenue"], s1["conversions"], s1["unique_recipients"]) == (2.5, 0, None)
    assert (rows["s2"]["channels"], rows["s2"]["unique_recipients"], rows["s2"]["step_name"]) == ("", 4, None)
    assert rows["s3"]["sent"] == 0


def test_canvas_channels_and_variants(spark):
    day = {
        "time": "2024-01-05T00:00:00+00:00",
        "variant_stats": {"a": {"name": "Control", "entries": 3.0, "revenue": None}, "b": {}},
        "step_stats": {"s1": {"messages": {"whats_app": [{"sent": 1, "read": 2, "delivered": 3}]}}, "s2": {}},
    }
    channels = dicts(series.canvas_channels(canvas_rows(spark, day)))
    assert [(r["step_id"], r["channel_name"], r["sends"], r["opens"], r["clicks"], r["delivered"]) for r in channels] == [
        ("s1", "whats_app", 1, 2, 0, 3)
    ]
    variants = {r["variant_id"]: r for r in dicts(series.canvas_variants(canvas_rows(spark, day)))}
    assert (variants["a"]["total_entries"], variants["a"]["is_control_group"], variants["a"]["unique_recipients"]) == (3, True, 0)
    assert (variants["b"]["variant_name"], variants["b"]["is_control_group"]) == (None, False)


def test_campaign_details_of_sparse_payloads(spark):
    full = {
        "name": None,
        "archived": True,
        "tags": None,
        "channels": None,
        "messages": {"a": {"name": "Hi"}, "b": {"name": "Control"}, "c": {"name": 3}, "d": {"name": None}, "e": {}},
        "first_sent": "",
    }
    rows = spark.createDataFrame([("1", json.dumps(full)), ("2", "{}")], "campaign_id string, data string")
    first, second = sorted(dicts(details.campaign_details(rows)), key=lambda r: r["campaign_id"])
    assert (first["name"], first["description"], first["messages"], first["is_archived"]) == (None, "", 1, True)
    assert (first["channels"], first["goal"], first["first_sent"]) == ("", None, None)
    assert (second["name"], second["messages"], second["is_draft"], second["schedule_type"]) == ("", 0, False, "")


def test_canvas_details_count_messages_of_steps(spark):
    data = {
        "name": "C",
        "first_entry": "2024-01-05",
        "steps": [{"name": "Control", "messages": {"a": {}}}, {"name": None, "messages": {"a": {}, "b": {}}}, {"name": "x"}, None,
                  {"name": "y", "messages": {"c": {}}}],
    }
    record = {"data": data, "metadata": META}
    parsed = accepted(parse_lines(lines(spark, record), schemas.CANVAS_DETAILS_LINE, keep_line=True))
    (row,) = dicts(details.canvas_details(landing_rows.canvas_details(parsed)))
    assert (row["canvas_id"], row["messages"], row["first_sent"]) == ("k-1", 3, datetime(2024, 1, 5))


def test_user_playbooks(spark):
    campaigns = [
        {"name": "n", "api_campaign_id": "c", "last_received": "2024-01-05", "in_control": False, "multiple_converted": {}, "engaged": {"o": 1}},
        None,
    ]
    canvases = [
        {"api_canvas_id": "k", "is_in_control": True, "converted": True, "steps_received": None},
        {"api_canvas_id": "l", "conversion_events_performed": ["x"], "steps_received": [{"api_canvas_step_id": "s", "name": "S", "last_received": "bad"}]},
    ]
    rows = spark.createDataFrame(
        [("u", json.dumps(campaigns), json.dumps(canvases)), ("w", "[]", "null")],
        "user_id string, campaigns_received string, canvases_received string",
    )
    (campaign,) = dicts(users.user_campaigns(rows))
    assert (campaign["id"], campaign["in_control"], campaign["converted"]) == ("c", False, None)
    assert (campaign["conversion_events_performed"], json.loads(campaign["message_status"])) == (None, {"o": 1})
    by_id = {r["id"]: r for r in dicts(users.user_canvases(rows))}
    assert by_id["k"]["in_control"] and json.loads(by_id["l"]["conversion_events_performed"]) == ["x"]
    assert [(r["step_id"], r["playbook_id"], r["last_received"]) for r in dicts(users.user_canvas_steps(rows))] == [("s", "l", None)]


def test_user_export_fills_empty_json(spark):
    record = {"data": [{"external_id": "u", "devices": [{"os": "x"}], "push_subscribe": "opted_in"}], "metadata": META}
    (row,) = dicts(landing_rows.user_export(accepted(parse_lines(lines(spark, record), schemas.USER_EXPORT_LINE))))
    assert (row["custom_attributes"], row["purchases"], row["push_opted_in_at"]) == ("{}", "[]", None)
    assert json.loads(row["devices"]) == [{"os": "x"}]


def test_cio_campaigns_with_unknown_times(spark):
    rows = spark.createDataFrame(
        [(7, None, None, "t", "s", True, '[{"type":"push"},{"type":"email"},{"type":"push"}]', 1700000000, 1700000060, None, None, None)],
        "id int, name string, tags string, type string, state string, active boolean, actions string, created long,"
        " updated long, first_started long, deduplicate_id string, trigger_segment_ids string",
    )
    (row,) = dicts(details.cio_campaign_details(rows))
    assert (row["name"], row["channels"], row["first_started"]) == ("", "email,push", None)


@pytest.mark.parametrize("short", [[1], [1, 2, 3, 4]])
def test_daily_arrays_of_unequal_length(spark, short):
    counts = {a: "[1, 2, 3]" for a in schemas.JOURNEY_ARRAYS} | {"finished": json.dumps(short)}
    ddl = "playbook_id string, type string, endAt string, " + ", ".join(f"{a} string" for a in counts)
    rows = spark.createDataFrame([("5", "campaign", "2024-03-01", *counts.values())], ddl)
    got = sorted(dicts(daily_arrays.journey_days(rows)), key=lambda r: r["date"])
    assert [str(r["date"]) for r in got] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert [r["started"] for r in got] == [1, 2, 3]
    assert [r["finished"] for r in got] == (short + [None, None])[:3]
