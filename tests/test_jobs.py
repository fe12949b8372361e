"""Sinks, end-to-end jobs and streaming restarts."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pulsework import schemas, sinks
from pulsework.operators import events
from pulsework.plans import jobs
from pulsework.streaming import append_new_files, daily_sums, dedupe_events, read_state, stream_files, sums_to_days, upsert_latest


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def namespace(spark, unique):
    name = unique("tenant")
    spark.sql(f"CREATE DATABASE {name}")
    return name


def write_lines(spark, path, *records):
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    with open(path, "w") as f:
        f.write("\n".join(texts) + "\n")


def meta(timestamp, **params):
    return {"timestamp": timestamp, "params": params, "run_id": "r"}


# ---- sinks -----------------------------------------------------------------------------------


def test_published_table_moves_to_complete_copies(spark, folder, namespace):
    name = f"{namespace}.users"
    first = spark.createDataFrame([("a", 1), ("b", 1)], "k string, g int")
    sinks.upsert_published(first, name, ["k"])
    reader = spark.table(name)
    sinks.upsert_published(spark.createDataFrame([("b", 2), ("c", 2)], "k string, g int"), name, ["k"], newer_by="g")
    assert rows(spark.table(name)) == [("a", 1), ("b", 2), ("c", 2)]
    assert rows(reader) == [("a", 1), ("b", 1)]
    for _ in range(3):
        sinks.publish(first, name)
    copies = spark.sql(f"SHOW TABLES IN {namespace} LIKE 'users__*'").collect()
    assert len(copies) == 2 and rows(spark.table(name)) == [("a", 1), ("b", 1)]


def test_replace_days_twice_equals_once(spark, namespace):
    table = f"{namespace}.facts"
    d = lambda n: date(2024, 1, n)
    sinks.replace_days_table(
        spark.createDataFrame([(1, d(1)), (2, d(2)), (3, d(3)), (4, None)], "i int, day date").filter("day is not null"),
        table, "day", "2024-01-01", "2024-01-31",
    )
    window = spark.createDataFrame([(20, d(2)), (99, d(9))], "i int, day date")
    for _ in range(2):
        sinks.replace_days_table(window, table, "day", "2024-01-02", "2024-01-03")
    assert rows(spark.table(table)) == [(1, d(1)), (20, d(2))]


def test_replace_days_with_nothing_empties_the_window(spark, namespace):
    table = f"{namespace}.facts"
    full = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2))], "i int, day date")
    sinks.replace_days_table(full, table, "day", "2024-01-01", "2024-01-02")
    sinks.replace_days_table(full.filter("i > 9"), table, "day", "2024-01-02", "2024-01-02")
    assert rows(spark.table(table)) == [(1, date(2024, 1, 1))]


def test_upsert_of_a_day_table_leaves_other_days_alone(spark, namespace):
    table = f"{namespace}.events"
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    ddl = "k string, g int, day date"
    sinks.upsert_days_table(spark.createDataFrame([("a", 1, d1), ("b", 5, d2)], ddl), table, "day", ["k"], newer_by="g")
    files = {r[0] for r in spark.table(table).filter(F.col("day") == d1).select(F.input_file_name()).collect()}
    for _ in range(2):
        sinks.upsert_days_table(
            spark.createDataFrame([("b", 4, d2), ("c", 1, d2)], ddl), table, "day", ["k"], newer_by="g"
        )
    assert rows(spark.table(table)) == [("a", 1, d1), ("b", 5, d2), ("c", 1, d2)]
    assert {r[0] for r in spark.table(table).filter(F.col("day") == d1).select(F.input_file_name()).collect()} == files


def test_expire_days_keeps_rows_without_a_day(spark, namespace):
    table = f"{namespace}.events"
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, None)], "i int, day date")
    df.write.partitionBy("day").saveAsTable(table)
    sinks.expire_days_table(spark, table, "day", "2024-04-01", 90)
    assert sorted(r.i for r in spark.table(table).collect()) == [2, 3]


def test_rows_without_a_day_survive_an_upsert(spark, namespace):
    table, ddl = f"{namespace}.variants", "k string, n int, day date"
    sinks.upsert_days_table(spark.createDataFrame([("a", 1, None), ("b", 1, date(2024, 1, 1))], ddl), table, "day", ["k"])
    sinks.upsert_days_table(spark.createDataFrame([("c", 2, None)], ddl), table, "day", ["k"])
    assert rows(spark.table(table)) == [("a", 1, None), ("b", 1, date(2024, 1, 1)), ("c", 2, None)]


def test_expire_rows_by_another_time(spark, namespace):
    table = f"{namespace}.served"
    at = lambda m, d: datetime(2024, m, d)
    data = [(1, at(1, 1), date(2024, 3, 1)), (2, at(3, 1), date(2024, 3, 1)), (3, at(1, 1), date(2024, 3, 2)), (4, None, date(2024, 3, 3)),
            (5, at(1, 5), None), (6, at(3, 5), date(2024, 3, 4))]
    spark.createDataFrame(data, "i int, up timestamp, day date").write.partitionBy("day").saveAsTable(table)
    sinks.expire_rows_table(spark, table, "day", "up", "2024-05-01", 90)
    assert sorted(r.i for r in spark.table(table).collect()) == [2, 4, 6]


def test_retention_goes_over_what_there_is(spark, namespace):
    old, new = datetime(2024, 1, 1), datetime(2024, 4, 1)
    steps = spark.createDataFrame([("a", old, old.date()), ("b", new, new.date())], "step_id string, time timestamp, day date")
    sinks.upsert_days_table(steps, f"{namespace}.transformed_canvas_steps", "day", ["step_id"])
    users = spark.createDataFrame([("a", old), ("b", new), ("c", None)], "user_id string, last_received timestamp")
    sinks.publish(users, f"{namespace}.transformed_user_playbook_data")
    assert len(jobs.run_retention(spark, "2024-05-01", namespace=namespace)) == 2
    assert [r.step_id for r in spark.table(f"{namespace}.transformed_canvas_steps").collect()] == ["b"]
    assert sorted(r.user_id for r in spark.table(f"{namespace}.transformed_user_playbook_data").collect()) == ["b", "c"]


def test_expire_published(spark, folder, namespace):
    name = f"{namespace}.seen"
    sinks.publish(spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 3, 1)), (3, None)], "i int, t timestamp"), name, folder)
    sinks.expire_published(spark, name, "t", "2024-05-01", root=folder)
    assert sorted(r.i for r in spark.table(name).collect()) == [2, 3]


def test_copy_table_matches_columns_by_name(spark, namespace):
    spark.createDataFrame([(1, "a")], "i int, s string").write.saveAsTable(f"{namespace}.one")
    sinks.copy_table(spark, f"{namespace}.one", f"{namespace}.two")
    spark.createDataFrame([("b", 2)], "s string, i int").write.saveAsTable(f"{namespace}.three")
    sinks.copy_table(spark, f"{namespace}.three", f"{namespace}.two")
    assert rows(spark.table(f"{namespace}.two")) == [(1, "a"), (2, "b")]


# ---- jobs ------------------------------------------------------------------------------------


def campaign_record(timestamp, sent):
    day = {"time": "2024-01-05", "messages": {"email": [{"variation_name": "V", "variation_api_id": "v1", "sent": sent}]}}
    return {"data": [day], "metadata": meta(timestamp, campaign_id="c-1")}


def test_series_land_and_reach_the_result_table(spark, folder, namespace):
    write_lines(spark, f"{folder}/a.jsonl", campaign_record(100.5, 1), "broken", campaign_record(99.5, 7))
    assert jobs.ingest(spark, "campaign_series", folder, namespace) == f"{namespace}.braze_campaigns_data_series_view"
    jobs.run_job(spark, "campaign_channels", namespace)
    jobs.run_job(spark, "campaign_variants", namespace)
    channels = spark.table(f"{namespace}.transformed_channels_campaign")
    assert [(r.channel_name, r.sends) for r in channels.collect()] == [("email", 1)]
    assert channels.schema.fieldNames() == [*schemas.CHANNELS_CAMPAIGN.fieldNames(), jobs.DAY]
    write_lines(spark, f"{folder}/second.jsonl", campaign_record(200.5, 3))
    jobs.ingest(spark, "campaign_series", f"{folder}/second.jsonl", namespace)
    jobs.run_job(spark, "campaign_channels", namespace)
    assert [r.sends for r in spark.table(f"{namespace}.transformed_channels_campaign").collect()] == [3]
    assert spark.table(f"{namespace}.transformed_variants").count() == 1


def test_details_are_reloaded_and_guarded(spark, folder, namespace):
    def record(name, updated):
        return {"data": {"name": name, "updated_at": updated}, "metadata": meta(1.5, canvas_id="k")}

    for i, (name, updated) in enumerate([("new", "2024-01-05"), ("older", "2024-01-04")]):
        write_lines(spark, f"{folder}/{i}.jsonl", record(name, updated))
        jobs.ingest(spark, "canvas_details", f"{folder}/{i}.jsonl", namespace)
        jobs.run_job(spark, "canvas_details", namespace)
    assert spark.table(f"{namespace}.braze_canvas_details").count() == 1
    assert [r.name for r in spark.table(f"{namespace}.transformed_canvas_details").collect()] == ["new"]


def test_users_and_playbook_name_is_never_updated(spark, folder, namespace):
    def record(timestamp, name, last):
        user = {"external_id": "u", "campaigns_received": [{"name": name, "api_campaign_id": "c", "last_received": last}]}
        return {"data": [user], "metadata": meta(timestamp)}

    # Ingest times compare as numbers: 1000.5 is later than 999.5.
    for i, args in enumerate([(999.5, "first", "2024-01-01"), (1000.5, "second", "2024-01-02")]):
        write_lines(spark, f"{folder}/{i}.jsonl", record(*args))
        jobs.ingest(spark, "user_export", f"{folder}/{i}.jsonl", namespace)
        jobs.run_job(spark, "user_campaigns", namespace)
        jobs.run_job(spark, "user_details", namespace)
    (row,) = spark.table(f"{namespace}.transformed_user_playbook_data").collect()
    assert (row["name"], row["last_received"]) == ("first", datetime(2024, 1, 2))
    assert spark.table(f"{namespace}.transformed_user_details").count() == 1


def test_missing_sources_skip_the_job(spark, folder, namespace):
    assert jobs.run_job(spark, "canvas_steps", namespace) is None
    assert jobs.run_people(spark, "2024-01-01", "2024-01-02", namespace) is None
    assert jobs.run_channel_touches(spark, "2024-01-01", "2024-01-02", namespace) is None
    assert jobs.run_journey_metrics(spark, "2024-01-01", "2024-01-02", namespace) is False
    assert jobs.run_amplitude_events(spark, "2024-01-01", "2024-01-02", namespace) is False
    assert jobs.run_mixpanel_events(spark, namespace) is False


def test_mixpanel_events_reach_their_day_table_once(spark, folder, namespace):
    def record(timestamp, event, again):
        properties = {"time": 1704453000, "distinct_id": "u", "$insert_id": "i", "again": again}
        return {"event": event, "properties": properties, "metadata": meta(timestamp)}

    spark.createDataFrame([("open", 2, True), ("gone", 3, False)], schemas.EVENT_TYPES).write.saveAsTable(
        f"{namespace}.mixpanel_events_list"
    )
    write_lines(spark, f"{folder}/1.jsonl", record(10.5, "open", 1), record(11.5, "open", 2), record(10.5, "gone", 1))
    jobs.ingest(spark, "mixpanel_events", f"{folder}/1.jsonl", namespace)
    for _ in range(2):
        assert jobs.run_mixpanel_events(spark, namespace)
    (row,) = spark.table(f"{namespace}.mixpanel_events").collect()
    assert (row.event, row.event_type_id, str(row.created_at), row.event_day) == ("open", 2, "11.500000", date(2024, 1, 5))
    assert json.loads(row.properties)["again"] == 2


def test_a_mixpanel_run_rewrites_only_what_it_changes(spark, folder, namespace):
    def record(timestamp, time, again):
        properties = {"time": time, "distinct_id": "u", "$insert_id": "i", "again": again}
        return {"event": "open", "properties": properties, "metadata": meta(timestamp)}

    spark.createDataFrame([("open", 2, True)], schemas.EVENT_TYPES).write.saveAsTable(f"{namespace}.mixpanel_events_list")
    write_lines(spark, f"{folder}/1.jsonl", record(10.5, 1704453000, 1), record(10.5, 1704553000, 1))
    write_lines(spark, f"{folder}/2.jsonl", record(12.5, 1704553000, 2), record(9.5, 1704453000, 3))
    served = f"{namespace}.mixpanel_events"

    def files():
        return {r[0] for r in spark.table(served).select(F.input_file_name()).distinct().collect()}

    for run in ("1", "2"):
        jobs.ingest(spark, "mixpanel_events", f"{folder}/{run}.jsonl", namespace, run)
    jobs.run_mixpanel_events(spark, namespace, "1")
    before = files()
    jobs.run_mixpanel_events(spark, namespace, "2")
    after = files()
    assert len(before & after) == 1 and len(after) == 2
    for run in ("1", "2", None):
        jobs.run_mixpanel_events(spark, namespace, run)
    assert files() == after
    assert sorted(json.loads(r.properties)["again"] for r in spark.table(served).collect()) == [1, 2]


def test_a_series_run_touches_only_its_days(spark, folder, namespace):
    def record(timestamp, day, sent):
        one = {"time": day, "messages": {"email": [{"variation_name": "V", "variation_api_id": "v1", "sent": sent}]}}
        return {"data": [one], "metadata": meta(timestamp, campaign_id="c-1")}

    runs = {"1": [record(1.5, "2024-01-05", 1), record(1.5, "2024-01-06", 2)], "3": [record(9.5, "2024-01-06", 4)],
            "2": [record(5.5, "2024-01-06", 3)]}
    target, seen = f"{namespace}.transformed_channels_campaign", None
    for run, records in runs.items():
        write_lines(spark, f"{folder}/{run}.jsonl", *records)
        jobs.ingest(spark, "campaign_series", f"{folder}/{run}.jsonl", namespace, run)
        tables = jobs.run_landed(spark, "campaign_series", run, namespace)
        assert tables == [f"{namespace}.transformed_variants", target]
        kept = spark.table(target).filter("day = '2024-01-05'").select(F.input_file_name()).distinct().collect()
        assert seen in (None, kept)
        seen = kept
    # The run that came last is older than the one before.
    assert sorted((str(r.day), r.sends) for r in spark.table(target).collect()) == [("2024-01-05", 1), ("2024-01-06", 4)]
    whole = rows(spark.table(target))
    jobs.run_job(spark, "campaign_channels", namespace)
    assert rows(spark.table(target)) == whole
    assert jobs.missing_keys(spark, "campaign_channels", namespace).count() == 0
    parts = spark.sql(f"SHOW PARTITIONS {namespace}.braze_campaigns_data_series").collect()
    assert "day=2024-01-06/run=2" in [r[0] for r in parts]


def test_touches_without_a_playbook_do_not_grow(spark, namespace):
    name, ddl = f"{namespace}.touches", "customer string, playbook int, g int"
    for g in (1, 2, 2):
        rows_now = spark.createDataFrame([("a", None, g), ("a", 1, g), (None, None, g)], ddl)
        sinks.upsert_published(rows_now, name, ["customer", "playbook"], newer_by="g", null_safe=True)
    assert rows(spark.table(name)) == sorted([("a", None, 2), ("a", 1, 2), (None, None, 2)], key=repr)


def test_long_file_lists_are_taken_in_turns(spark, folder, namespace):
    at = datetime(2024, 1, 5)
    for i in range(7):
        data = [(f"u{i}", f"p{i}", False, None, at, at)] if i else []
        spark.createDataFrame(data, schemas.PEOPLE).coalesce(1).write.parquet(f"{folder}/in/{i}")
    window = ("2024-01-05", "2024-01-05")
    view = jobs.ingest_files(spark, "people_changes", f"{folder}/in", *window, namespace, at_once=2)
    assert spark.table(view).count() == 6
    assert spark.table(f"{namespace}.customerio_processed_files").count() == 7
    assert jobs.register_files(spark, "people_changes", f"{folder}/in", namespace) == 0


def test_amplitude_scan_is_bounded(spark, folder):
    ddl = ("user_id string, event_type string, client_event_time timestamp, client_upload_time timestamp, "
           "server_received_time timestamp")
    at = lambda d, h=0: datetime(2024, 1, d, h)
    data = [("u", "open", at(1), at(1), at(2)), ("u", "open", at(2), at(2), at(2)), ("u", "open", at(3), at(3), at(3))]
    spark.createDataFrame(data, ddl).write.parquet(f"{folder}/raw")
    types = spark.createDataFrame([("open", 2, True)], schemas.EVENT_TYPES)
    got = events.amplitude_events(spark.read.parquet(f"{folder}/raw"), types, "2024-01-02", "2024-01-02")
    assert sorted(r.client_event_time for r in got.collect()) == [at(1), at(2)]
    assert "LessThan(client_event_time" in got._jdf.queryExecution().toString()


def test_people_touch_and_journey_jobs(spark, folder, namespace):
    at = datetime(2024, 1, 2, 10)
    make = lambda data, ddl, name: spark.createDataFrame(data, ddl).write.saveAsTable(f"{namespace}.{name}")
    make([("u", "p", False, None, datetime(1970, 1, 1), at)], schemas.PEOPLE, "customerio_people_view")
    make([("d", "p", "e", "email", 5, 1, None, None, None, None, at)], schemas.DELIVERIES, "customerio_channel_deliveries_view")
    make([("e", "d", "sent", None, at)], schemas.METRICS, "customerio_channel_metrics_view")
    make([("s", "done", 1, "x", None, None, at)], schemas.OUTPUTS, "customerio_journey_outputs_view")
    make([("s", "p", "drip", 5, None, at, at)], schemas.SUBJECTS, "customerio_journey_subjects_view")
    window = ("2024-01-02", "2024-01-02")
    jobs.run_people(spark, *window, namespace, f"{folder}/out")
    (person,) = spark.table(f"{namespace}.transformed_customerio_people_details").collect()
    assert (person.deleted, person.suppressed, person.created_at) == (False, True, None)
    for _ in range(2):
        jobs.run_channel_touches(spark, *window, namespace)
        assert jobs.run_journey_metrics(spark, *window, namespace)
    assert [(r.metric, r.playbook_id, r.type) for r in spark.table(f"{namespace}.customerio_channel_touches").collect()] == [
        ("sent", 5, "campaign")
    ]
    assert spark.table(f"{namespace}.transformed_customerio_journey_metrics").count() == 1


def test_exported_files_are_registered_pruned_and_loaded(spark, folder, namespace):
    at = lambda d, h=0: datetime(2024, 1, d, h)

    def export(name, *people):
        rows = spark.createDataFrame([(f"u{i}", f"p{i}", False, None, c, u) for i, c, u in people], schemas.PEOPLE)
        rows.coalesce(1).write.parquet(f"{folder}/in put+100%/{name}")

    export("a", (1, at(1), at(2)), (2, at(1), at(9)))
    export("b", (3, at(20), at(21)))
    window = ("2024-01-05", "2024-01-06")
    assert jobs.register_files(spark, "people_changes", f"{folder}/in put+100%", namespace) == 2
    assert jobs.register_files(spark, "people_changes", f"{folder}/in put+100%", namespace) == 0
    view = jobs.ingest_files(spark, "people_changes", f"{folder}/in put+100%", *window, namespace)
    # The span of the second person reaches over the days, the others lie outside.
    assert [r.internal_customer_id for r in spark.table(view).collect()] == ["p2"]
    export("c", (2, at(1), at(10)), (4, at(5, 23), at(6)))
    for _ in range(2):
        jobs.ingest_files(spark, "people_changes", f"{folder}/in put+100%", *window, namespace)
    assert sorted((r.internal_customer_id, r.updated_at) for r in spark.table(view).collect()) == [("p2", at(10)), ("p4", at(6))]
    assert jobs.ingest_files(spark, "people_changes", f"{folder}/in put+100%", "2023-01-01", "2023-01-02", namespace) is None
    assert spark.table(f"{namespace}.customerio_processed_files").count() == 3


def test_event_types_follow_their_csv(spark, folder, namespace):
    def listing(name, *types):
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write("\n".join(["event_name,owner", *[f"{t},x" for t in types]]) + "\n")
        return f"{folder}/{name}.csv"

    read = lambda: rows(spark.table(f"{namespace}.mixpanel_events_list"))
    jobs.sync_event_types(spark, listing("1", "a", "a"), "mixpanel_events_list", namespace)
    assert read() == [("a", 2, True)]
    jobs.sync_event_types(spark, listing("2", "b"), "mixpanel_events_list", namespace)
    assert read() == [("a", 2, False), ("b", 3, True)]
    jobs.sync_event_types(spark, None, "mixpanel_events_list", namespace)
    assert read() == [("a", 2, False), ("b", 3, True)]


def test_metering_merges_into_the_stored_meter(spark, namespace):
    orgs, meters = f"{namespace}.organisation", f"{namespace}.metering"
    spark.createDataFrame([(1, "acme", True)], "id int, domain string, active boolean").write.saveAsTable(orgs)
    sinks.publish(spark.createDataFrame([(1, '{"plan":"x","active_events":9}', True)], "org_id int, meter string, active boolean"), meters)
    run = lambda: jobs.run_metering(spark, "mixpanel", "acme", "2024-03-03", orgs, meters, namespace)
    run()
    assert [json.loads(r.meter) for r in spark.table(meters).collect()] == [{"plan": "x", "active_events": 0, "monthly_active_users": 0}]
    types = [("a", 2, True), ("b", 3, True), ("c", 4, False)]
    spark.createDataFrame(types, schemas.EVENT_TYPES).write.saveAsTable(f"{namespace}.mixpanel_events_list")
    seen = [("u", date(2024, 1, 31)), ("u", date(2024, 2, 1)), ("v", date(2024, 2, 29)), ("w", date(2024, 3, 1))]
    spark.createDataFrame(seen, "distinct_id string, event_day date").write.partitionBy("event_day").saveAsTable(f"{namespace}.mixpanel_events")
    run()
    assert [json.loads(r.meter) for r in spark.table(meters).collect()] == [{"plan": "x", "active_events": 2, "monthly_active_users": 2}]


def test_replicated_descriptions_are_overwritten(spark, folder, namespace):
    ddl = "id int, name string, tags string, type string, created long, sent_at long, updated long, content_ids string, deduplicate_id string"
    make = lambda *ids: spark.createDataFrame([(i, None, None, None, 0, None, 1, None, None) for i in ids], ddl)
    make(1, 2).write.saveAsTable(f"{namespace}.customerio_newsletters")
    jobs.run_job(spark, "cio_newsletter_details", namespace)
    make(2).write.mode("overwrite").saveAsTable(f"{namespace}.customerio_newsletters")
    jobs.run_job(spark, "cio_newsletter_details", namespace)
    assert [r.newsletter_id for r in spark.table(f"{namespace}.transformed_customerio_newsletter_details").collect()] == [2]


# ---- streaming -------------------------------------------------------------------------------

EVENT = "k string, g int, t timestamp, n int"


def put(spark, folder, name, *data):
    spark.createDataFrame(data, EVENT).coalesce(1).write.parquet(f"{folder}/in/{name}")


def source(spark, folder, **kw):
    schema = spark.createDataFrame([], EVENT).schema
    return stream_files(spark, f"{folder}/in/*", schema, **kw)


def test_restarted_stream_reads_only_new_files(spark, folder):
    at = datetime(2024, 1, 1)
    put(spark, folder, "1", ("a", 1, at, 1))
    append_new_files(source(spark, folder), f"{folder}/out", f"{folder}/cp")
    put(spark, folder, "2", ("b", 1, at, 1))
    append_new_files(source(spark, folder), f"{folder}/out", f"{folder}/cp")
    got = spark.read.parquet(f"{folder}/out")
    assert sorted(r.k for r in got.collect()) == ["a", "b"]
    assert got.filter("file_name is null or inserted_at is null").count() == 0


def test_stream_keeps_the_newest_row_across_restarts(spark, folder):
    at = datetime(2024, 1, 1)

    def run():
        upsert_latest(
            source(spark, folder).drop("file_name", "inserted_at"), f"{folder}/state", f"{folder}/cp", ["k"], ["g"], "g"
        )

    put(spark, folder, "1", ("a", 5, at, 1), ("a", 4, at, 2), ("b", 1, at, 3))
    run()
    put(spark, folder, "2", ("a", 3, at, 4), ("b", 2, at, 5), ("c", 1, at, 6))
    run()
    put(spark, folder, "3", ("d", 1, at, 7))
    put(spark, folder, "4", ("a", 1, at, 8))
    run()
    state = read_state(spark, f"{folder}/state")
    assert rows(state.filter("k <> 'd'").select("k", "g", "n")) == [("a", 5, 1), ("b", 2, 5), ("c", 1, 6)]


def test_stream_dedupe_and_late_sums(spark, folder, namespace):
    d = lambda n, h=0: datetime(2024, 1, n, h)
    put(spark, folder, "1", ("a", 1, d(20), 1), ("a", 1, d(20), 1), ("b", 1, d(20, 5), 2))

    def run():
        unique = dedupe_events(source(spark, folder), "t", ["k"], "30 days")
        late = append_new_files(unique.select("k", "t", "n"), f"{folder}/unique", f"{folder}/cp1")
        totals = daily_sums(source(spark, folder), "t", ["k"], ["n"], "30 days")
        return late, sums_to_days(totals, f"{namespace}.sums", f"{folder}/cp2", ["day", "k"])

    assert run() == (0, 0)
    # A repeat of a known key, and data for a day nineteen days back.
    put(spark, folder, "2", ("a", 1, d(20), 1), ("c", 1, d(1), 4), ("b", 1, d(20, 7), 8))
    run()
    assert sorted(r.k for r in spark.read.parquet(f"{folder}/unique").collect()) == ["a", "b", "c"]
    assert rows(spark.table(f"{namespace}.sums").select("day", "k", "n")) == sorted(
        [(date(2024, 1, 1), "c", 4), (date(2024, 1, 20), "a", 3), (date(2024, 1, 20), "b", 10)], key=repr
    )
    # Too late for either: left out, and said so.
    put(spark, folder, "3", ("z", 1, datetime(2023, 6, 1), 1), ("y", 1, datetime(2023, 6, 1), 1))
    assert run() == (2, 2)


def test_a_lost_checkpoint_leaves_no_stale_state(spark, folder):
    at = datetime(2024, 1, 1)
    run = lambda cp: upsert_latest(
        source(spark, folder).drop("file_name", "inserted_at"), f"{folder}/state", f"{folder}/{cp}", ["k"], ["g"], "g"
    )
    put(spark, folder, "1", ("a", 1, at, 1))
    run("cp")
    put(spark, folder, "2", ("b", 1, at, 2))
    run("cp")
    put(spark, folder, "3", ("c", 1, at, 3))
    run("new")
    assert sorted(r.k for r in read_state(spark, f"{folder}/state").collect()) == ["a", "b", "c"]


def export(spark, path, schema, *values):
    """A Parquet export with the columns of a schema, those not named NULL."""
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in values[0]]
    rows_ = spark.createDataFrame([tuple(v.values()) for v in values], list(values[0]))
    named = [F.col(f.name).cast(f.dataType) for f in schema.fields if f.name in values[0]]
    rows_.select(*named, *missing).select(*schema.fieldNames()).coalesce(1).write.mode("append").parquet(path)


def test_landed_metrics_by_day_and_bucket(spark, folder, namespace):
    """Landing days again changes no row count; the touches read only their days, and the view needs no shuffle."""
    for day in (3, 4, 5):
        values = [
            {"event_id": f"e{day}-{i}", "delivery_id": f"d{i % 5}", "metric": "opened", "created_at": datetime(2024, 1, day, i)}
            for i in range(20)
        ]
        export(spark, f"{folder}/metrics", schemas.METRICS, *values)
    sent = [{"delivery_id": f"d{i}", "internal_customer_id": f"c{i}", "created_at": datetime(2024, 1, 1)} for i in range(5)]
    export(spark, f"{folder}/deliveries", schemas.DELIVERIES, *sent)
    table = f"{namespace}.customerio_channel_metrics"
    for at_once in (1, 1, 2):
        jobs.ingest_files(spark, "metrics", f"{folder}/metrics", "2024-01-03", "2024-01-05", namespace, at_once, buckets=4)
        assert spark.table(table).count() == 60
    jobs.ingest_files(spark, "metrics", f"{folder}/metrics", "2024-01-04", "2024-01-04", namespace)
    assert spark.table(table).count() == 60 and spark.table(f"{table}_view").count() == 60
    jobs.ingest_files(spark, "deliveries", f"{folder}/deliveries", "2024-01-01", "2024-01-01", namespace)
    plan = spark.table(f"{table}_view")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange" not in plan
    scans = jobs._latest_on_days(spark, "metrics", "2024-01-04", "2024-01-05", namespace)
    plan = scans._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "Exchange" not in plan
    target = jobs.run_channel_touches(spark, "2024-01-04", "2024-01-04", namespace)
    got = rows(spark.table(target).select("internal_customer_id", "metric", "created_at"))
    assert got == [(f"c{i}", "opened", datetime(2024, 1, 4, 15 + i)) for i in range(5)]


def test_landing_a_run_again_replaces_it(spark, folder, namespace):
    """A row without a day lies in a partition of its own; malformed lines are set aside once."""
    path, run = f"{folder}/a.jsonl", "a+b c/1%"
    undated = {"data": [{"messages": {}}], "metadata": meta(1.5, campaign_id="c-2")}
    for lines in (["not json", campaign_record(1.5, 1), undated],) * 2:
        write_lines(spark, path, *lines)
        raw = jobs.ingest(spark, "campaign_series", path, namespace, run=run).removesuffix("_view")
        assert spark.table(raw).count() == 2
    assert spark.table(f"{raw}_quarantine").count() == 1
    jobs.ingest(spark, "campaign_series", path, namespace, run="other")
    assert spark.table(raw).count() == 4
    write_lines(spark, path, undated)
    jobs.ingest(spark, "campaign_series", path, namespace, run=run)
    assert rows(spark.table(raw).select("run", "day")) == [(run, None), ("other", None), ("other", date(2024, 1, 5))]
    write_lines(spark, path, "not json")
    jobs.ingest(spark, "campaign_series", path, namespace, run=run)
    assert {r.run for r in spark.table(raw).collect()} == {"other"}


def test_day_upsert_writes_only_what_it_brings_besides_the_table(spark, unique, monkeypatch):
    """The first load goes straight into the table; later ones are compared with it once, and merged days are not written twice."""
    from pulsework import sinks
    from pulsework.session import new_work_dir

    made, table = [], unique("days")
    monkeypatch.setattr(sinks, "new_work_dir", lambda spark, label: made.append(label) or new_work_dir(spark, label))
    old = spark.createDataFrame([("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")], "k string, v int, day string")
    new = spark.createDataFrame([("a", 2, "2024-01-01"), ("b", 0, "2024-01-02"), ("c", 1, "2024-01-01")], "k string, v int, day string")
    sinks.upsert_days_table(old, table, "day", ["k"], newer_by="v")
    assert made == []
    sinks.upsert_days_table(new, table, "day", ["k"], newer_by="v")
    assert made == ["batch", "newer"]
    assert sorted((r.k, r.v, str(r.day)) for r in spark.table(table).collect()) == [("a", 2, "2024-01-01"), ("b", 1, "2024-01-02"), ("c", 1, "2024-01-01")]
