"""Latest rows, filters, projections, joins, aggregates and scalar functions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from pulsework import functions as fn
from pulsework import schemas
from pulsework.operators import events as tracked
from pulsework.operators import filters, metering, numbering, projections, touches
from pulsework.operators.joins import active_connectors
from pulsework.operators.latest import (
    dedupe,
    filter_then_latest,
    latest,
    latest_by_key,
    latest_then_filter,
    newest,
    newest_first,
)
from pulsework.operators import landing_rows, series
from pulsework.plans import derive
from pulsework.plans.catalog.nested import campaign_series, people
from pulsework.plans.catalog.registry import DELIVERIES, EVENTS, query, with_text_times
from pulsework.sources import accepted, parse_lines


def mod(column, n: int):
    return F.pmod(F.col(column) if isinstance(column, str) else column, F.lit(n))


# ---- latest rows -----------------------------------------------------------------------------


@query(
    "w1_latest_event_per_user_and_type",
    """SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts
    FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_event(spark, sf_dir):
    rows = derive.events(spark, sf_dir).select("user_id", "event_type", "event_id", "ts")
    return with_text_times(latest_by_key(rows, ["user_id", "event_type"], ["ts"]), fraction=True)


@query(
    "w1_latest_tracked_event",
    f"""WITH {EVENTS}
    SELECT event_type AS event, cast(floor(epoch(ts)) AS bigint) AS time, 'u-' || user_id AS distinct_id,
      'i-' || event_id AS insert_id, CASE WHEN event_id % 10 = 0 THEN 1706900000.5 ELSE 1706800000.25 END AS created_at
    FROM ev""",
)
def latest_tracked_event(spark, sf_dir):
    """Every tenth event is exported twice; the later copy wins."""
    lines = parse_lines(derive.event_lines(derive.events(spark, sf_dir)), schemas.EVENT_LINE)
    rows = latest(landing_rows.events(accepted(lines)), "mixpanel_events")
    return rows.select("event", "time", "distinct_id", "insert_id", "created_at")


@query(
    "w2_latest_then_active",
    """SELECT user_id, event_type, event_id FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
    WHERE r = 1 AND event_type <> 'error'""",
)
def latest_if_active(spark, sf_dir):
    rows = derive.events(spark, sf_dir).select("user_id", "event_type", "event_id", "ts")
    return latest_then_filter(rows, ["user_id"], ["ts"], F.col("event_type") != "error").drop("ts")


@query(
    "w3_active_then_latest",
    """SELECT user_id, event_type, event_id FROM events WHERE event_type <> 'error'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_active(spark, sf_dir):
    rows = derive.events(spark, sf_dir).select("user_id", "event_type", "event_id", "ts")
    return filter_then_latest(rows, ["user_id"], ["ts"], F.col("event_type") != "error").drop("ts")


@query(
    "d1_unique_variants",
    f"""WITH {EVENTS}, g AS (
      SELECT user_id, day, channel, event_id % 4 AS v, count(*) AS n, sum(cents) AS c FROM ev GROUP BY ALL
    ), rows AS (
      SELECT *, CASE WHEN channel IN ('trigger_in_app_message', 'carrier_pigeon') THEN 0 ELSE n END AS entries FROM g)
    SELECT 'v-' || v AS variant_id, 'c-' || user_id AS id, day || ' 00:00:00' AS time, cast(entries AS int) AS total_entries,
      cast(c AS double) * 0.25 AS revenue
    FROM rows QUALIFY row_number() OVER (PARTITION BY v, user_id, day ORDER BY entries DESC, c DESC, n DESC) = 1""",
)
def unique_variants(spark, sf_dir):
    """One row per variant and day; on ties the largest remaining columns win, in table order."""
    rows = dedupe(series.campaign_variants(campaign_series(spark, sf_dir)), ["variant_id", "type", "id", "time"])
    return with_text_times(rows.select("variant_id", "id", "time", "total_entries", "revenue"))


@query(
    "t1_newest_events",
    "SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 10",
)
def newest_events(spark, sf_dir):
    """A top-k report: the ten newest events."""
    return newest(derive.events(spark, sf_dir), ["ts", "event_id"], 10).select("event_id", "user_id", "event_type")


@query(
    "t2_runs_newest_first",
    """SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
    WHERE event_type IN ('purchase', 'signup') ORDER BY ts DESC""",
)
def runs_newest_first(spark, sf_dir):
    rows = newest_first(derive.events(spark, sf_dir), "event_type", ["purchase", "signup"], "ts")
    return with_text_times(rows.select("event_id", "event_type", "ts"))


# ---- projections and filters --------------------------------------------------------------------


@query(
    "p1_p2_cast_to_schema",
    """SELECT cast(c_custkey AS varchar) AS user_id, cast(c_nationkey AS varchar) AS internal_customer_id,
      c_acctbal <> 0 AS deleted, false AS suppressed, cast(NULL AS varchar) AS created_at,
      '2024-01-02 00:00:00' AS updated_at FROM customer""",
)
def cast_to_schema(spark, sf_dir):
    source = derive.table(spark, sf_dir, "customer").select(
        F.lit("2024-01-02").alias("updated_at"),
        F.lit(None).cast("string").alias("created_at"),
        F.lit("false").alias("suppressed"),
        F.col("c_acctbal").alias("deleted"),
        F.col("c_nationkey").alias("internal_customer_id"),
        F.col("c_custkey").alias("user_id"),
    )
    return with_text_times(schemas.cast_to(source, schemas.CIO_PEOPLE))


@query(
    "p3_p4_p5_replicated_columns",
    "SELECT c_custkey AS customer_id, c_name AS name, 'campaign' AS type FROM customer",
)
def replicated_columns(spark, sf_dir):
    customer = derive.table(spark, sf_dir, "customer")
    replicated = customer.select("*", *[F.lit("x").alias(c) for c in schemas.REPLICATION_COLUMNS])
    kept = projections.drop_replication_columns(replicated)
    plain = [c for c in kept.columns if c not in ("c_custkey", "c_name")]
    return kept.drop(*plain).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), F.lit("campaign").alias("type")
    )


@query(
    "p6_p7_p8_delivery_playbook",
    f"""WITH {DELIVERIES}
    SELECT delivery_id, CASE WHEN type IS NOT NULL THEN playbook END AS playbook_id, type, channel FROM deliveries""",
)
def delivery_playbook(spark, sf_dir):
    rows = derive.deliveries(derive.table(spark, sf_dir, "orders"))
    return rows.select(
        "delivery_id",
        projections.playbook_id().alias("playbook_id"),
        projections.playbook_type().alias("type"),
        projections.channel_id().alias("channel"),
    )


@query(
    "f1_predicates",
    """SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_custkey IS NOT NULL""",
)
def predicates(spark, sf_dir):
    orders = derive.table(spark, sf_dir, "orders")
    wanted = (F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return orders.filter(wanted & F.col("o_custkey").isNotNull()).select("o_orderkey", "o_custkey")


@query(
    "f2_f3_f5_on_days",
    """SELECT event_id, user_id FROM events WHERE cast(ts AS date) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
)
def on_days(spark, sf_dir):
    """The bare file column is compared, so the range reaches the scan."""
    rows = filters.on_days(derive.table(spark, sf_dir, "events"), "ts", "2024-01-10", "2024-01-12")
    return rows.select("event_id", "user_id")


@query(
    "f4_any_on_days",
    """WITH p AS (
      SELECT 'p-' || c_custkey AS internal_customer_id, c_custkey,
        CASE WHEN c_custkey % 4 > 0 THEN DATE '2024-01-01' + cast(c_custkey % 60 AS int) END AS created,
        DATE '2024-01-01' + cast(c_custkey % 90 AS int) AS updated FROM customer)
    SELECT internal_customer_id FROM p WHERE created BETWEEN DATE '2024-02-01' AND DATE '2024-02-10'
      OR updated BETWEEN DATE '2024-02-01' AND DATE '2024-02-10'""",
)
def any_on_days(spark, sf_dir):
    rows = filters.any_on_days(people(spark, sf_dir), ["created_at", "updated_at"], "2024-02-01", "2024-02-10")
    return rows.select("internal_customer_id")


@query(
    "f6_spanning_days",
    """WITH p AS (
      SELECT 'p-' || c_custkey AS internal_customer_id,
        CASE WHEN c_custkey % 4 > 0 THEN DATE '2024-01-01' + cast(c_custkey % 60 AS int)
          WHEN c_custkey % 8 = 0 THEN DATE '1970-01-01' END AS created,
        DATE '2024-01-01' + cast(c_custkey % 90 AS int) AS updated FROM customer)
    SELECT internal_customer_id FROM p WHERE least(coalesce(created, updated), updated) <= DATE '2024-02-10'
      AND greatest(coalesce(created, updated), updated) >= DATE '2024-02-01'""",
)
def spanning_days(spark, sf_dir):
    rows = filters.spanning_days(people(spark, sf_dir), ["created_at", "updated_at"], "2024-02-01", "2024-02-10")
    return rows.select("internal_customer_id")


@query("f7_after_cursor", "SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1999-01-01'")
def after_cursor(spark, sf_dir):
    orders = derive.table(spark, sf_dir, "orders")
    return filters.after_cursor(orders, "o_orderdate", "1999-01-01").select("o_orderkey")


@query(
    "f8_with_payload",
    "SELECT event_id FROM events WHERE event_id % 4 > 1",
)
def with_payload(spark, sf_dir):
    kind = mod("event_id", 4)
    rows = derive.table(spark, sf_dir, "events").select(
        "event_id", F.when(kind == 0, "[]").when(kind > 1, F.col("props")).alias("payload")
    )
    return filters.with_payload(rows, "payload").select("event_id")


# ---- joins -----------------------------------------------------------------------------------------


@query(
    "j1_j5_delivery_metrics",
    f"""WITH {DELIVERIES}
    SELECT internal_customer_id, CASE WHEN type IS NOT NULL THEN playbook END AS playbook_id, type, channel, channel_name,
      metric, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
    FROM delivery_events JOIN deliveries USING (delivery_id)
    WHERE cast(created_at AS date) BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'""",
)
def delivery_metrics(spark, sf_dir):
    metrics = derive.delivery_events(derive.table(spark, sf_dir, "lineitem"))
    deliveries = derive.deliveries(derive.table(spark, sf_dir, "orders"))
    return with_text_times(touches.delivery_metrics(metrics, deliveries, "1997-01-01", "1999-12-31"))


_JOURNEYS = """
    SELECT 'p-' || o_custkey AS internal_customer_id, cast(o_orderkey % 7 AS int) AS playbook_id, 'campaign' AS type,
      l_linenumber AS channel, o_orderpriority AS playbook_type, 'part ' || l_partkey AS explanation,
      l_linestatus AS metric,
      CASE WHEN l_partkey % 5 > 0 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS delay_ends_at,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS started_campaign_at,
      strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS created_at
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE cast(l_shipdate AS date) BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'"""


@query("j2_journey_metrics", _JOURNEYS)
def journey_metrics(spark, sf_dir):
    outputs = derive.journey_outputs(derive.table(spark, sf_dir, "lineitem"))
    subjects = derive.journey_subjects(derive.table(spark, sf_dir, "orders"))
    return with_text_times(touches.journey_metrics(outputs, subjects, "1997-01-01", "1999-12-31"))


_TYPE_IDS = """types AS (
      SELECT event_type, 9 + row_number() OVER (ORDER BY event_type) AS event_type_id FROM (SELECT DISTINCT event_type FROM events))"""


@query(
    "j3_mixpanel_events",
    f"""WITH {EVENTS}, {_TYPE_IDS}
    SELECT event_type AS event, cast(floor(epoch(ts)) AS bigint) AS time, 'u-' || user_id AS distinct_id,
      'i-' || event_id AS insert_id, event_id % 10 = 0 AS again,
      CASE WHEN event_id % 10 = 0 THEN 1706900000.5 ELSE 1706800000.25 END AS created_at, event_type_id
    FROM ev JOIN types USING (event_type) WHERE event_type <> 'error'""",
)
def mixpanel_events(spark, sf_dir):
    rows = derive.events(spark, sf_dir)
    raw = landing_rows.events(accepted(parse_lines(derive.event_lines(rows), schemas.EVENT_LINE)))
    served = tracked.mixpanel_events(raw, derive.registry(rows))
    again = F.get_json_object("properties", "$.again").cast("boolean").alias("again")
    created = F.col("created_at").cast("double").alias("created_at")
    return served.select("event", "time", "distinct_id", "insert_id", again, created, "event_type_id")


@query(
    "j4_x15_amplitude_events",
    f"""WITH {EVENTS}, {_TYPE_IDS}, timed AS (
      SELECT event_id, user_id, event_type, date_trunc('second', ts)
        + to_seconds(CASE WHEN event_id % 120 < 60 THEN 0 ELSE event_id % 120 END) AS t
      FROM ev WHERE user_id % 10 > 0 AND event_id % 11 > 0)
    SELECT event_id, user_id, event_type, event_type_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS event_time_calculated
    FROM timed JOIN types USING (event_type) WHERE cast(t AS date) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""",
)
def amplitude_events(spark, sf_dir):
    """Clock error 0 to 119 s by event id; some users and some upload times are unknown."""
    rows = derive.events(spark, sf_dir)
    drift = mod("event_id", 120)
    raw = rows.select(
        "event_id",
        F.when(mod("user_id", 10) > 0, F.col("user_id")).alias("user_id"),
        "event_type",
        F.col("ts").alias("client_event_time"),
        F.when(mod("event_id", 11) > 0, F.col("ts")).alias("client_upload_time"),
        F.timestamp_seconds(F.unix_timestamp("ts") + drift).alias("server_received_time"),
        F.lit("x").alias(schemas.REPLICATION_COLUMNS[0]),
    )
    served = tracked.amplitude_events(raw, derive.registry(rows), "2024-01-05", "2024-01-25")
    return with_text_times(
        served.select("event_id", "user_id", "event_type", "event_type_id", "event_time_calculated")
    )


@query(
    "j6_active_connectors",
    """WITH ranked AS (
      SELECT o_orderkey AS id, o_orderkey % 5 AS tool_id, o_custkey AS org_id, o_orderpriority AS config,
        o_orderstatus <> 'P' AS active,
        row_number() OVER (PARTITION BY o_custkey, o_orderkey % 5 ORDER BY o_orderdate DESC, o_orderkey DESC) AS r
      FROM orders)
    SELECT ranked.id, ranked.tool_id, ranked.org_id, ranked.config, c_name AS domain, r_name AS tool_name
    FROM ranked JOIN customer ON c_custkey = org_id JOIN region ON r_regionkey = tool_id
    WHERE r = 1 AND active AND c_nationkey % 5 > 0 AND r_regionkey <> 3""",
)
def connectors(spark, sf_dir):
    rows = derive.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        mod("o_orderkey", 5).alias("tool_id"),
        F.col("o_custkey").alias("org_id"),
        F.col("o_orderpriority").alias("config"),
        (F.col("o_orderstatus") != "P").alias("active"),
        F.col("o_orderdate").alias("updated_at"),
    )
    orgs = derive.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("domain"), (mod("c_nationkey", 5) > 0).alias("active")
    )
    tools = derive.table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"), (F.col("r_regionkey") != 3).alias("active")
    )
    return active_connectors(rows, orgs, tools)


@query(
    "j7_customers_with_orders",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)",
)
def still_present(spark, sf_dir):
    customer = derive.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    seen = derive.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return customer.join(seen, "c_custkey", "left_semi")


@query(
    "j8_customers_without_orders",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
)
def vanished(spark, sf_dir):
    customer = derive.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    seen = derive.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return customer.join(seen, "c_custkey", "left_anti")


@query(
    "u1_union_of_slices",
    """SELECT c_custkey AS id, 'new' AS slice, true AS is_active FROM customer WHERE c_nationkey < 8
    UNION ALL SELECT c_custkey, 'known', true FROM customer WHERE c_nationkey BETWEEN 8 AND 15
    UNION ALL SELECT c_custkey, 'gone', false FROM customer WHERE c_nationkey > 15""",
)
def union_of_slices(spark, sf_dir):
    customer = derive.table(spark, sf_dir, "customer")

    def slice_of(condition, name, active):
        return customer.filter(condition).select(
            F.col("c_custkey").alias("id"), F.lit(name).alias("slice"), F.lit(active).alias("is_active")
        )

    return (
        slice_of("c_nationkey < 8", "new", True)
        .unionByName(slice_of("c_nationkey between 8 and 15", "known", True))
        .unionByName(slice_of("c_nationkey > 15", "gone", False))
    )


# ---- aggregates --------------------------------------------------------------------------------------


@query(
    "a2_active_types",
    """SELECT count(DISTINCT event_type) AS active_events FROM events WHERE event_type <> 'error'""",
)
def active_types(spark, sf_dir):
    return metering.active_types(derive.registry(derive.events(spark, sf_dir)), distinct=True)


@query(
    "a3_monthly_active_users",
    """SELECT count(DISTINCT user_id) AS monthly_active_users FROM events
    WHERE ts >= DATE '2024-01-20' - INTERVAL 32 DAY AND ts < DATE '2024-01-20' - INTERVAL 2 DAY""",
)
def monthly_active_users(spark, sf_dir):
    return metering.monthly_active_users(derive.table(spark, sf_dir, "events"), "user_id", "ts", "2024-01-20")


@query(
    "a3_r1_windows_from_daily_sets",
    """WITH w AS (SELECT unnest(generate_series(DATE '2024-01-10', DATE '2024-02-08', INTERVAL 1 DAY))::date AS as_of),
    u AS (SELECT as_of, count(DISTINCT user_id) AS monthly_active_users FROM w
      JOIN events ON ts >= as_of - INTERVAL 32 DAY AND ts < as_of - INTERVAL 2 DAY GROUP BY as_of)
    SELECT strftime(as_of, '%Y-%m-%d') AS as_of, monthly_active_users, true AS close FROM u""",
)
def windows_from_daily_sets(spark, sf_dir):
    """Thirty sliding windows in one pass over the days' user sets; users are numbered as they appear, in two turns."""
    events = derive.events(spark, sf_dir).select("user_id", "ts")
    early = numbering.grow_index(
        spark.createDataFrame([], "user_id long, index long"), events.filter("ts < '2024-01-15'"), "user_id"
    )
    index = early.unionByName(numbering.grow_index(early, events, "user_id"))
    sets = metering.daily_user_sets(events, index, "user_id", F.to_date("ts"))
    as_of = [(date(2024, 1, 10) + timedelta(days=i)).isoformat() for i in range(30)]
    found, exact = metering.users_of_windows(sets, as_of), F.col("monthly_active_users")
    close = F.abs(F.col("approximate_users") - exact) <= F.greatest(exact * 0.06, F.lit(1.0))
    return found.select(F.col("as_of").cast("string").alias("as_of"), exact, close.alias("close"))


@query(
    "a4_channel_touches",
    f"""WITH {DELIVERIES}, rows AS (
      SELECT metric, internal_customer_id, CASE WHEN type IS NOT NULL THEN playbook END AS playbook_id, type, channel,
        channel_name, created_at
      FROM delivery_events JOIN deliveries USING (delivery_id)
      WHERE cast(created_at AS date) BETWEEN DATE '1997-01-01' AND DATE '1999-12-31')
    SELECT metric, internal_customer_id, playbook_id, type, channel, channel_name,
      strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
    FROM rows QUALIFY row_number() OVER (PARTITION BY metric, internal_customer_id, playbook_id
      ORDER BY created_at DESC, type DESC NULLS LAST, channel DESC NULLS LAST, channel_name DESC NULLS LAST) = 1""",
)
def channel_touches(spark, sf_dir):
    metrics = derive.delivery_events(derive.table(spark, sf_dir, "lineitem"))
    deliveries = derive.deliveries(derive.table(spark, sf_dir, "orders"))
    return with_text_times(touches.channel_touches(metrics, deliveries, "1997-01-01", "1999-12-31"))


@query(
    "a8_high_water_marks",
    """SELECT event_type, count(*) AS rows, max(event_id) AS last_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_time
    FROM events GROUP BY event_type""",
)
def high_water_marks(spark, sf_dir):
    marks = metering.high_water_marks(
        derive.events(spark, sf_dir), {"last_id": "event_id", "last_time": "ts"}, "event_type"
    )
    return with_text_times(marks, fraction=True)


@query("a9_a10_distinct_rows", "SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events")
def distinct_rows(spark, sf_dir):
    return derive.events(spark, sf_dir).select("user_id", "event_type", "day").distinct()


@query(
    "a11_meter_merge",
    """WITH u AS (SELECT o_custkey, count(*) AS a, count(DISTINCT o_orderpriority) AS m FROM orders GROUP BY 1)
    SELECT c_custkey AS org_id, CASE WHEN c_custkey % 3 = 0 THEN 'gold' END AS plan,
      coalesce(a, CASE WHEN c_custkey % 3 = 0 THEN 1 END) AS active_events, m AS monthly_active_users, true AS active
    FROM customer LEFT JOIN u ON o_custkey = c_custkey WHERE c_custkey % 3 = 0 OR a IS NOT NULL
    UNION ALL SELECT c_custkey, 'old', NULL, NULL, false FROM customer WHERE c_custkey % 4 = 0""",
)
def meter_merge(spark, sf_dir):
    """Every third organisation has an active meter, every fourth an old one that must stay as it is."""
    customer = derive.table(spark, sf_dir, "customer")
    orders = derive.table(spark, sf_dir, "orders")
    stored = (
        customer.filter(mod("c_custkey", 3) == 0)
        .select(F.col("c_custkey").alias("org_id"), F.lit('{"plan":"gold","active_events":1}').alias("meter"), F.lit(True).alias("active"))
        .unionByName(
            customer.filter(mod("c_custkey", 4) == 0).select(
                F.col("c_custkey").alias("org_id"), F.lit('{"plan":"old"}').alias("meter"), F.lit(False).alias("active")
            )
        )
    )
    orgs = customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("domain"), F.lit(True).alias("active"))
    usage = (
        orders.groupBy(F.format_string("Customer#%09d", "o_custkey").alias("domain"))
        .agg(
            F.count(F.lit(1)).alias("active_events"),
            F.count_distinct("o_orderpriority").alias("monthly_active_users"),
        )
    )
    merged = metering.meter_merge(stored, orgs, usage, ["active_events", "monthly_active_users"])
    return merged.select(
        "org_id",
        F.get_json_object("meter", "$.plan").alias("plan"),
        F.get_json_object("meter", "$.active_events").cast("bigint").alias("active_events"),
        F.get_json_object("meter", "$.monthly_active_users").cast("bigint").alias("monthly_active_users"),
        "active",
    )


# ---- scalar functions ----------------------------------------------------------------------------------


@query(
    "x1_iso_times",
    """SELECT event_id, strftime(CASE event_id % 8 WHEN 0 THEN date_trunc('second', ts)
        WHEN 1 THEN date_trunc('day', ts) WHEN 2 THEN ts WHEN 3 THEN date_trunc('minute', ts)
        WHEN 4 THEN date_trunc('hour', ts) WHEN 5 THEN date_trunc('second', ts) - INTERVAL 330 MINUTE
        END, '%Y-%m-%d %H:%M:%S.%f') AS time
    FROM events""",
)
def iso_times(spark, sf_dir):
    """Each event's time in one of eight spellings, two of them not acceptable."""
    patterns = [
        "yyyy-MM-dd HH:mm:ss",
        "yyyy-MM-dd",
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
        "yyyy-MM-dd'T'HH:mm'Z'",
        "yyyy-MM-dd HH",
        "yyyy-MM-dd'T'HH:mm:ss'+05:30'",
        "yyyyMMdd",
    ]
    kind = mod("event_id", 8)
    text = F.when(kind == 0, F.date_format("ts", patterns[0]))
    for i, pattern in enumerate(patterns[1:], start=1):
        text = text.when(kind == i, F.date_format("ts", pattern))
    rows = derive.events(spark, sf_dir).select("event_id", fn.parse_iso(text.otherwise("")).alias("time"))
    return with_text_times(rows, fraction=True)


@query(
    "x2_x3_x12_x16_times",
    """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS from_epoch,
      strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS from_text,
      strftime(cast(ts AS date) - cast(event_id % 40 AS int), '%Y-%m-%d') AS days_ago,
      cast(floor(epoch(ts)) AS bigint) AS epoch FROM events""",
)
def plain_times(spark, sf_dir):
    rows = derive.events(spark, sf_dir).select(
        "event_id",
        fn.from_epoch_seconds(F.unix_timestamp("ts")).alias("from_epoch"),
        fn.parse_second_text(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("from_text"),
        fn.days_before(F.col("day"), mod("event_id", 40).cast("int")).alias("days_ago"),
        fn.to_epoch_seconds(F.col("ts")).alias("epoch"),
    )
    return with_text_times(rows)


@query(
    "x4_x6_x7_x8_texts",
    """SELECT p_partkey, CASE WHEN p_partkey % 4 > 0 THEN p_brand END AS goal, p_partkey % 3 = 0 AS is_control,
      'b,a,b,' || p_type AS list,
      CASE WHEN p_type < 'a' THEN p_type || ',a,b' ELSE 'a,b,' || p_type END AS distinct_list
    FROM part""",
)
def texts(spark, sf_dir):
    items = F.array(F.lit("b"), F.lit("a"), F.lit("b"), F.col("p_type"))
    tags = F.array(F.lit("x"), F.concat(F.lit("Goal:\t"), F.col("p_brand"), F.lit("\n")), F.lit("Goal: later"))
    return derive.table(spark, sf_dir, "part").select(
        "p_partkey",
        fn.tag_value(F.when(mod("p_partkey", 4) > 0, tags), "Goal").alias("goal"),
        fn.is_control_name(
            F.when(mod("p_partkey", 3) == 0, "Control 1").when(mod("p_partkey", 3) == 1, "control")
        ).alias("is_control"),
        fn.comma_list(items).alias("list"),
        fn.distinct_comma_list(items).alias("distinct_list"),
    )


@query(
    "x5_x9_x10_x11_json_values",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      cast(CASE l_partkey % 4 WHEN 0 THEN l_quantity WHEN 1 THEN l_quantity WHEN 2 THEN l_quantity ELSE 0 END AS int) AS whole,
      CASE l_partkey % 4 WHEN 0 THEN l_quantity + 0.5 WHEN 1 THEN l_quantity WHEN 2 THEN l_quantity ELSE 0.0 END AS number,
      l_returnflag = 'A' AS flag
    FROM lineitem""",
)
def json_values(spark, sf_dir):
    """Counts written as 7.5, "7", 7.0 or null, read back from JSON."""
    kind = mod("l_partkey", 4)
    count = (
        F.when(kind == 0, (F.col("l_quantity") + 0.5).cast("string"))
        .when(kind == 1, F.concat(F.lit('"'), F.col("l_quantity").cast("int"), F.lit('"')))
        .when(kind == 2, F.col("l_quantity").cast("string"))
        .otherwise("null")
    )
    flag = F.when(F.col("l_returnflag") == "A", ',"on":true').when(F.col("l_returnflag") == "R", ',"on":false').otherwise("")
    payload = F.concat(F.lit('{"n":'), count, flag, F.lit("}"))
    n = fn.json_path(payload, "$.n")
    return derive.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        fn.int_or_zero(n).alias("whole"),
        fn.double_or_zero(n).alias("number"),
        fn.bool_or_false(fn.json_path(payload, "$.on")).alias("flag"),
    )


@query(
    "x13_x14_x17_flags_and_bounds",
    """WITH p AS (
      SELECT *, CASE WHEN c_custkey % 4 > 0 THEN DATE '2024-01-01' + cast(c_custkey % 60 AS int)
          WHEN c_custkey % 8 = 0 THEN DATE '1970-01-01' END AS created,
        DATE '2024-01-01' + cast(c_custkey % 90 AS int) AS updated FROM customer)
    SELECT 'p-' || c_custkey AS internal_customer_id, CASE WHEN c_custkey % 5 > 1 THEN false ELSE true END AS deleted,
      strftime(nullif(created, DATE '1970-01-01'), '%Y-%m-%d') AS created,
      strftime(least(coalesce(created, updated), updated), '%Y-%m-%d') AS first_day,
      strftime(greatest(coalesce(created, updated), updated), '%Y-%m-%d') AS last_day
    FROM p""",
)
def flags_and_bounds(spark, sf_dir):
    created, updated = F.col("created_at"), F.col("updated_at")
    return people(spark, sf_dir).select(
        "internal_customer_id",
        fn.bool_unless_false_text(F.col("deleted")).alias("deleted"),
        fn.day_text(fn.epoch_zero_to_null(created)).alias("created"),
        fn.day_text(fn.least_time(created, updated)).alias("first_day"),
        fn.day_text(fn.greatest_time(created, updated)).alias("last_day"),
    )
