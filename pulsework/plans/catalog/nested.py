"""Queries that flatten nested payloads. Input and expectation start from the same events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsework import schemas
from pulsework.functions import CHANNEL_METRICS
from pulsework.operators import daily_arrays, details, landing_rows, series, users
from pulsework.operators.latest import dedupe, latest
from pulsework.plans import derive
from pulsework.plans.catalog.registry import EVENTS, MEASURES, query, with_text_times
from pulsework.sources import accepted, parse_lines


def campaign_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = derive.campaign_lines(derive.events(spark, sf_dir))
    return landing_rows.campaign_series(accepted(parse_lines(lines, schemas.CAMPAIGN_SERIES_LINE)))


def canvas_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = derive.canvas_lines(derive.events(spark, sf_dir))
    return landing_rows.canvas_series(accepted(parse_lines(lines, schemas.CANVAS_SERIES_LINE)))


def user_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = derive.user_lines(derive.events(spark, sf_dir))
    return landing_rows.user_export(accepted(parse_lines(lines, schemas.USER_EXPORT_LINE)))


@query(
    "n1_explode_campaign_series",
    f"""WITH {EVENTS}
    SELECT 'c-' || user_id AS campaign_id, day AS start_date, cast(count(DISTINCT channel) AS int) AS channels,
      1704500000.25 AS created_at
    FROM ev GROUP BY ALL""",
)
def explode_campaign_series(spark, sf_dir):
    rows = campaign_series(spark, sf_dir)
    messages = F.json_object_keys(F.get_json_object("data", "$.messages"))
    return rows.select("campaign_id", "start_date", F.size(messages).alias("channels"), "created_at")


@query(
    "n2_explode_canvas_series",
    f"""WITH {EVENTS}
    SELECT 'k-' || user_id AS canvas_id, 'Canvas k-' || user_id AS name, day AS start_date,
      cast(count(DISTINCT event_id % 5) AS int) AS steps, 1704500000.25 AS created_at
    FROM ev GROUP BY ALL""",
)
def explode_canvas_series(spark, sf_dir):
    rows = canvas_series(spark, sf_dir)
    steps = F.json_object_keys(F.get_json_object("stats", "$.step_stats"))
    return rows.select("canvas_id", "name", "start_date", F.size(steps).alias("steps"), "created_at")


_LIST_SQL = """
    SELECT '{p}-' || c_custkey AS id, c_name AS name, '["' || c_mktsegment || '"]' AS tags,
      '2024-01-0' || (c_custkey % 9 + 1) AS last_edited{api}, 1704500000.25 AS created_at FROM customer"""


def _list_lines(spark, sf_dir, prefix, with_api):
    customer = derive.table(spark, sf_dir, "customer")
    api = [(F.pmod("c_custkey", F.lit(2)) == 1).alias("is_api_campaign")] if with_api else []
    return customer.select(
        F.to_json(
            F.struct(
                F.concat(F.lit(f"{prefix}-"), F.col("c_custkey")).alias("id"),
                F.col("c_name").alias("name"),
                F.array("c_mktsegment").alias("tags"),
                F.concat(F.lit("2024-01-0"), F.pmod("c_custkey", F.lit(9)) + 1).alias("last_edited"),
                *api,
                F.struct(F.lit(1704500000.25).alias("timestamp")).alias("metadata"),
            )
        ).alias("value")
    )


@query("n3_parse_campaign_list", _LIST_SQL.format(p="c", api=", c_custkey % 2 = 1 AS is_api_campaign"))
def parse_campaign_list(spark, sf_dir):
    lines = parse_lines(_list_lines(spark, sf_dir, "c", True), schemas.CAMPAIGN_LIST_LINE)
    return landing_rows.campaign_list(accepted(lines)).drop("metadata")


@query("n3_parse_canvas_list", _LIST_SQL.format(p="k", api=""))
def parse_canvas_list(spark, sf_dir):
    lines = parse_lines(_list_lines(spark, sf_dir, "k", False), schemas.CANVAS_LIST_LINE)
    return landing_rows.canvas_list(accepted(lines)).drop("metadata")


# ---- descriptions: customers as campaigns and canvases -------------------------------------


def _details_lines(spark, sf_dir, canvas: bool):
    key = F.col("c_custkey")
    names = ["Control A", "Welcome", "Offer", "Reminder"]
    count = F.pmod(key, F.lit(5))

    def message(i):
        return F.when(count > i, F.struct(F.lit(f"m{i}").alias("key"), F.struct(F.lit(names[i]).alias("name")).alias("value")))

    messages = F.map_from_entries(F.array_compact(F.array(*[message(i) for i in range(4)])))
    if canvas:
        # Every message is a step of its own name, holding as many messages as there are steps.
        body = F.array_compact(
            F.array(*[F.when(count > i, F.struct(F.lit(names[i]).alias("name"), messages.alias("messages"))) for i in range(4)])
        ).alias("steps")
        first, last = "first_entry", "last_entry"
    else:
        body = messages.alias("messages")
        first, last = "first_sent", "last_sent"
    data = F.struct(
        F.col("c_name").alias("name"),
        F.when(F.pmod(key, F.lit(3)) > 0, F.concat(F.lit("about "), F.col("c_name"))).alias("description"),
        (F.pmod(key, F.lit(2)) == 0).alias("archived"),
        F.when(F.pmod(key, F.lit(4)) > 0, F.pmod(key, F.lit(4)) == 1).alias("enabled"),
        F.lit("2024-01-02T03:04:05+00:00").alias("created_at"),
        F.concat(F.lit("2024-01-0"), F.pmod(key, F.lit(9)) + 1, F.lit("T10:00Z")).alias("updated_at"),
        F.lit("time_based").alias("schedule_type"),
        F.when(F.pmod(key, F.lit(3)) == 0, F.array(F.lit("email"), F.lit("sms")))
        .when(F.pmod(key, F.lit(3)) == 1, F.array(F.lit("push")))
        .alias("channels"),
        F.when(F.pmod(key, F.lit(2)) == 0, "2024-01-05").otherwise("soon").alias(first),
        F.when(F.pmod(key, F.lit(5)) > 0, "2024-02-05T00:00:00+02:00").otherwise("").alias(last),
        F.when(
            F.pmod(key, F.lit(6)) > 0,
            F.array(F.lit("other"), F.concat(F.lit("Stage: "), F.col("c_mktsegment"), F.lit(" ")), F.lit("Stage: late"), F.lit("Goal:sell")),
        ).alias("tags"),
        body,
    )
    entity = "canvas_id" if canvas else "campaign_id"
    params = F.create_map(F.lit(entity), F.concat(F.lit("d-"), key))
    metadata = F.struct(F.lit(1704500000.25).alias("timestamp"), params.alias("params")).alias("metadata")
    customer = derive.table(spark, sf_dir, "customer")
    return customer.select(F.to_json(F.struct(data.alias("data"), metadata)).alias("value"))


_DETAILS_SQL = """
    SELECT 'd-' || c_custkey AS {entity}, c_name AS name,
      CASE WHEN c_custkey % 3 > 0 THEN 'about ' || c_name ELSE '' END AS description,
      c_custkey % 2 = 0 AS is_archived, c_custkey % 4 = 1 AS is_enabled, false AS is_draft,
      '2024-01-02 03:04:05' AS created_at, '2024-01-0' || (c_custkey % 9 + 1) || ' 10:00:00' AS updated_at,
      'time_based' AS schedule_type,
      CASE c_custkey % 3 WHEN 0 THEN 'email,sms' WHEN 1 THEN 'push' ELSE '' END AS channels,
      CASE WHEN c_custkey % 2 = 0 THEN '2024-01-05 00:00:00' END AS first_sent,
      CASE WHEN c_custkey % 5 > 0 THEN '2024-02-04 22:00:00' END AS last_sent,
      cast({messages} AS int) AS messages,
      CASE WHEN c_custkey % 6 > 0 THEN 'sell' END AS goal,
      CASE WHEN c_custkey % 6 > 0 THEN c_mktsegment END AS stage
    FROM customer"""


@query(
    "n4_n12_campaign_details",
    _DETAILS_SQL.format(entity="campaign_id", messages="greatest(c_custkey % 5 - 1, 0)"),
)
def campaign_details(spark, sf_dir):
    lines = parse_lines(_details_lines(spark, sf_dir, False), schemas.CAMPAIGN_DETAILS_LINE)
    return with_text_times(details.campaign_details(landing_rows.campaign_details(accepted(lines))))


@query(
    "n4_n13_canvas_details",
    _DETAILS_SQL.format(entity="canvas_id", messages="greatest(c_custkey % 5 - 1, 0) * (c_custkey % 5)"),
)
def canvas_details(spark, sf_dir):
    lines = parse_lines(_details_lines(spark, sf_dir, True), schemas.CANVAS_DETAILS_LINE, keep_line=True)
    return with_text_times(details.canvas_details(landing_rows.canvas_details(accepted(lines))))


# ---- daily series --------------------------------------------------------------------------


@query(
    "n7_campaign_variants",
    f"""WITH {EVENTS}, g AS (
      SELECT user_id, day, channel, event_id % 4 AS v, count(*) AS n, sum(cents) AS c FROM ev GROUP BY ALL)
    SELECT 'v-' || v AS variant_id, 'campaign' AS type, 'c-' || user_id AS id, day || ' 00:00:00' AS time,
      CASE WHEN v = 0 THEN 'Control' ELSE 'Variant ' || v END AS variant_name,
      cast(CASE WHEN channel IN ('trigger_in_app_message', 'carrier_pigeon') THEN 0 ELSE n END AS int) AS total_entries,
      cast(c AS double) * 0.25 AS revenue, cast(n + 1 AS int) AS unique_recipients, cast(7 * n AS int) AS conversions,
      v = 0 AS is_control_group
    FROM g""",
)
def campaign_variants(spark, sf_dir):
    return with_text_times(series.campaign_variants(campaign_series(spark, sf_dir)))


@query(
    "n8_canvas_variants",
    f"""WITH {EVENTS}, g AS (
      SELECT user_id, day, event_id % 4 AS v, count(*) AS n, sum(cents) AS c FROM ev GROUP BY ALL)
    SELECT 'v-' || v AS variant_id, 'canvas' AS type, 'k-' || user_id AS id, day || ' 00:00:00' AS time,
      CASE WHEN v = 0 THEN 'Control' ELSE 'Variant ' || v END AS variant_name, cast(n AS int) AS total_entries,
      cast(c AS double) * 0.25 AS revenue, cast(0 AS int) AS unique_recipients, cast(7 * n AS int) AS conversions,
      v = 0 AS is_control_group
    FROM g""",
)
def canvas_variants(spark, sf_dir):
    return with_text_times(series.canvas_variants(canvas_series(spark, sf_dir)))


@query(
    "n9_a6_canvas_steps",
    f"""WITH {EVENTS}, g AS (
      SELECT user_id, day, event_id % 5 AS s, channel, count(*) AS n, sum(cents) AS c FROM ev GROUP BY ALL
    ), m AS (SELECT user_id, day, s, channel, n, c, {MEASURES} FROM g)
    SELECT day || ' 00:00:00' AS time, 'k-' || user_id AS canvas_id, 's-' || s AS step_id, 'Step ' || s AS step_name,
      cast(sum(c) AS double) * 0.25 AS revenue, cast(sum(n) * 3 AS int) AS conversions,
      string_agg(channel, ',' ORDER BY channel) AS channels, cast(sum(n) AS int) AS unique_recipients,
      cast(sum(sends) AS int) AS sent, cast(sum(opens) AS int) AS total_opens, cast(sum(clicks) AS int) AS clicks
    FROM m GROUP BY user_id, day, s""",
)
def canvas_steps(spark, sf_dir):
    return with_text_times(series.canvas_steps(canvas_series(spark, sf_dir)))


_CAMPAIGN_CHANNELS = f"""
    WITH {EVENTS}, g AS (
      SELECT user_id, day, channel, count(*) AS n, sum(cents) AS c FROM ev GROUP BY ALL
    ), channels AS (
      SELECT day || ' 00:00:00' AS time, channel AS channel_name, 'campaign' AS type, 'c-' || user_id AS id, {MEASURES},
        cast(CASE channel WHEN 'carrier_pigeon' THEN 0 ELSE 7 * n END AS int) AS conversions,
        CASE channel WHEN 'carrier_pigeon' THEN 0.0 ELSE cast(c AS double) * 0.25 END AS revenue
      FROM g
    )"""


@query("n10_a5_campaign_channels", f"{_CAMPAIGN_CHANNELS} SELECT * FROM channels")
def campaign_channels(spark, sf_dir):
    return with_text_times(series.campaign_channels(campaign_series(spark, sf_dir)))


@query(
    "n11_a5_canvas_channels",
    f"""WITH {EVENTS}, g AS (
      SELECT user_id, day, event_id % 5 AS s, channel, count(*) AS n, sum(cents) AS c FROM ev GROUP BY ALL)
    SELECT day || ' 00:00:00' AS time, channel AS channel_name, 'canvas' AS type, 'k-' || user_id AS id,
      's-' || s AS step_id, {MEASURES}
    FROM g""",
)
def canvas_channels(spark, sf_dir):
    return with_text_times(series.canvas_channels(canvas_series(spark, sf_dir)))


@query(
    "daily_channel_report",
    f"""{_CAMPAIGN_CHANNELS}
    SELECT time, channel_name, count(*) AS campaigns, cast(sum(sends) AS bigint) AS sends,
      cast(sum(opens) AS bigint) AS opens, cast(sum(clicks) AS bigint) AS clicks,
      cast(sum(delivered) AS bigint) AS delivered, sum(revenue) AS revenue
    FROM channels GROUP BY time, channel_name""",
)
def daily_channel_report(spark, sf_dir):
    """Landing lines, some delivered twice, to the daily totals per channel."""
    rows = derive.events(spark, sf_dir)
    # An older delivery holds the same days with doubled cents; the latest-row view must hide it.
    stale = rows.filter(F.pmod("user_id", F.lit(3)) == 0).withColumn("cents", F.col("cents") * 2)
    lines = derive.campaign_lines(rows).unionByName(derive.campaign_lines(stale, timestamp=1704400000.75))
    raw = landing_rows.campaign_series(accepted(parse_lines(lines, schemas.CAMPAIGN_SERIES_LINE)))
    channels = dedupe(
        series.campaign_channels(latest(raw, "campaign_series")), ["time", "channel_name", "type", "id"]
    )
    totals = channels.groupBy("time", "channel_name").agg(
        F.count(F.lit(1)).alias("campaigns"),
        *[F.sum(m).alias(m) for m in ("sends", "opens", "clicks", "delivered", "revenue")],
    )
    return with_text_times(totals)


# ---- users -----------------------------------------------------------------------------------


@query(
    "n5_explode_user_export",
    f"""WITH {EVENTS}
    SELECT 'u-' || user_id AS user_id, '{{"spent":' || sum(cents) || '}}' AS custom_attributes, '[]' AS purchases,
      CASE user_id % 3 WHEN 0 THEN 'DE' WHEN 1 THEN 'FR' END AS country, 'city ' || (user_id % 7) AS home_city,
      cast(count(DISTINCT event_id % 10) AS int) AS campaigns, cast(count(DISTINCT event_id % 6) AS int) AS canvases
    FROM ev GROUP BY ev.user_id""",
)
def explode_user_export(spark, sf_dir):
    return user_exports(spark, sf_dir).select(
        "user_id",
        "custom_attributes",
        "purchases",
        "country",
        "home_city",
        F.json_array_length("campaigns_received").alias("campaigns"),
        F.json_array_length("canvases_received").alias("canvases"),
    )


@query(
    "n6_parse_events",
    f"""WITH {EVENTS}, twice AS (
      SELECT *, false AS again FROM ev UNION ALL SELECT *, true AS again FROM ev WHERE event_id % 10 = 0)
    SELECT event_type AS event, cast(floor(epoch(ts)) AS bigint) AS time, 'u-' || user_id AS distinct_id,
      'i-' || event_id AS insert_id, cents, CASE WHEN again THEN 1706900000.5 ELSE 1706800000.25 END AS created_at
    FROM twice""",
)
def parse_events(spark, sf_dir):
    lines = parse_lines(derive.event_lines(derive.events(spark, sf_dir)), schemas.EVENT_LINE)
    cents = F.get_json_object("properties", "$.cents").cast("bigint").alias("cents")
    return landing_rows.events(accepted(lines)).select("event", "time", "distinct_id", "insert_id", cents, "created_at")


@query(
    "n14_user_campaigns",
    f"""WITH {EVENTS}, g AS (
      SELECT user_id, event_id % 10 AS k, count(*) AS n, max(ts) AS last FROM ev GROUP BY ALL)
    SELECT 'c-' || k AS id, 'Campaign ' || k AS name, 'campaign' AS type, 'u-' || user_id AS user_id,
      strftime(last, '%Y-%m-%d %H:%M:%S.%f') AS last_received, k % 2 = 0 AS in_control, n > 3 AS converted,
      CASE WHEN k % 3 > 0 THEN '{{"purchase":' || n || '}}' END AS conversion_events_performed,
      CASE WHEN k % 4 > 0 THEN '{{"opened":true}}' END AS message_status
    FROM g""",
)
def user_campaigns(spark, sf_dir):
    return with_text_times(users.user_campaigns(user_exports(spark, sf_dir)), fraction=True)


@query(
    "n15_user_canvases",
    f"""WITH {EVENTS}, g AS (
      SELECT user_id, event_id % 6 AS k, count(*) AS n, max(ts) AS last FROM ev GROUP BY ALL)
    SELECT 'k-' || k AS id, 'Canvas ' || k AS name, 'canvas' AS type, 'u-' || user_id AS user_id,
      strftime(last, '%Y-%m-%d %H:%M:%S.%f') AS last_received, k % 2 = 1 AS in_control, n > 5 AS converted,
      CASE WHEN k % 3 <> 1 THEN '["buy","goal ' || k || '"]' END AS conversion_events_performed,
      cast(NULL AS varchar) AS message_status
    FROM g""",
)
def user_canvases(spark, sf_dir):
    return with_text_times(users.user_canvases(user_exports(spark, sf_dir)), fraction=True)


@query(
    "n16_user_canvas_steps",
    f"""WITH {EVENTS}, g AS (
      SELECT user_id, event_id % 6 AS k, event_id % 5 AS s, max(ts) AS last FROM ev GROUP BY ALL)
    SELECT 's-' || s AS step_id, 'Step ' || s AS step_name, 'k-' || k AS playbook_id, 'u-' || user_id AS user_id,
      strftime(last, '%Y-%m-%d %H:%M:%S.%f') AS last_received
    FROM g""",
)
def user_canvas_steps(spark, sf_dir):
    return with_text_times(users.user_canvas_steps(user_exports(spark, sf_dir)), fraction=True)


@query(
    "n17_user_details",
    f"""WITH {EVENTS}
    SELECT 'u-' || user_id AS user_id, '{{"spent":' || sum(cents) || '}}' AS custom_attributes, '[]' AS purchases,
      CASE user_id % 3 WHEN 0 THEN 'DE' WHEN 1 THEN 'FR' END AS country, 'city ' || (user_id % 7) AS home_city,
      '[]' AS devices, '[]' AS apps
    FROM ev GROUP BY ev.user_id""",
)
def user_details(spark, sf_dir):
    rows = dedupe(users.user_details(user_exports(spark, sf_dir)), ["user_id"])
    unset = ["dob", "language", "gender", "push_subscribe", "push_opted_in_at", "email_subscribe", "email_opted_in_at"]
    return rows.drop(*unset)


# ---- replicated descriptions: parts and suppliers ---------------------------------------------


def _cio_campaigns(spark, sf_dir):
    """Parts as campaigns, each in two versions."""
    key = F.col("p_partkey")
    actions = F.when(F.pmod(key, F.lit(4)) == 0, '[{"type":"push"},{"type":"email"},{"type":"push"}]').when(
        F.pmod(key, F.lit(4)) == 1, '[{"type":"sms"}]'
    ).when(F.pmod(key, F.lit(4)) == 2, "[]")
    part = derive.table(spark, sf_dir, "part")
    versions = part.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
    return versions.select(
        key.alias("id"),
        F.when(F.pmod(key, F.lit(5)) > 0, F.concat("p_name", F.lit(" v"), "version")).alias("name"),
        F.lit("[]").alias("tags"),
        F.col("p_type").alias("type"),
        F.when(F.col("version") == 2, "running").otherwise("draft").alias("state"),
        (F.col("version") == 2).alias("active"),
        actions.alias("actions"),
        (F.lit(1700000000) + key).alias("created"),
        (F.lit(1700000000) + F.col("version") * 60).alias("updated"),
        F.when(F.pmod(key, F.lit(3)) > 0, F.lit(1700009999) + key).alias("first_started"),
        F.lit(None).cast("string").alias("deduplicate_id"),
        F.concat(F.lit("["), F.col("p_size"), F.lit("]")).alias("trigger_segment_ids"),
    )


@query(
    "n18_cio_campaign_details",
    """SELECT cast(p_partkey AS int) AS campaign_id,
      CASE WHEN p_partkey % 5 > 0 THEN p_name || ' v2' ELSE '' END AS name, 'running' AS state, true AS active,
      CASE p_partkey % 4 WHEN 0 THEN 'email,push' WHEN 1 THEN 'sms' ELSE '' END AS channels,
      CASE p_partkey % 4 WHEN 0 THEN '[{"type":"push"},{"type":"email"},{"type":"push"}]'
        WHEN 1 THEN '[{"type":"sms"}]' WHEN 2 THEN '[]' END AS actions,
      strftime(make_timestamp((1700000000 + p_partkey) * 1000000), '%Y-%m-%d %H:%M:%S') AS created_at,
      '2023-11-14 22:15:20' AS updated_at,
      CASE WHEN p_partkey % 3 > 0 THEN
        strftime(make_timestamp((1700009999 + p_partkey) * 1000000), '%Y-%m-%d %H:%M:%S') END AS first_started,
      '[' || p_size || ']' AS trigger_segment_ids, '[]' AS tags
    FROM part""",
)
def cio_campaign_details(spark, sf_dir):
    rows = latest(details.cio_campaign_details(_cio_campaigns(spark, sf_dir)), "cio_campaigns")
    return with_text_times(rows).drop("deduplicate_id")


@query(
    "n19_cio_newsletter_details",
    """SELECT cast(p_partkey AS int) AS newsletter_id, CASE WHEN p_partkey % 5 > 0 THEN p_name ELSE '' END AS name,
      '[]' AS tags, p_type AS type,
      strftime(make_timestamp((1700000000 + p_partkey) * 1000000), '%Y-%m-%d %H:%M:%S') AS created,
      CASE WHEN p_partkey % 2 = 0 THEN
        strftime(make_timestamp((1700000000 + 2 * p_partkey) * 1000000), '%Y-%m-%d %H:%M:%S') END AS sent_at,
      '2023-11-14 22:13:20' AS updated, '[' || p_size || ']' AS content_ids, p_brand AS deduplicate_id
    FROM part""",
)
def cio_newsletter_details(spark, sf_dir):
    key = F.col("p_partkey")
    source = derive.table(spark, sf_dir, "part").select(
        key.alias("id"),
        F.when(F.pmod(key, F.lit(5)) > 0, F.col("p_name")).alias("name"),
        F.lit("[]").alias("tags"),
        F.col("p_type").alias("type"),
        (F.lit(1700000000) + key).alias("created"),
        F.when(F.pmod(key, F.lit(2)) == 0, F.lit(1700000000) + key * 2).alias("sent_at"),
        F.lit(1700000000).alias("updated"),
        F.concat(F.lit("["), F.col("p_size"), F.lit("]")).alias("content_ids"),
        F.col("p_brand").alias("deduplicate_id"),
    )
    return with_text_times(details.cio_newsletter_details(source))


@query(
    "n20_cio_transactional_details",
    """SELECT cast(s_suppkey AS int) AS transactional_message_id,
      CASE WHEN s_suppkey % 5 > 0 THEN s_name ELSE '' END AS name, 'from ' || s_nationkey AS description,
      s_suppkey % 2 = 0 AS send_to_unsubscribed, s_suppkey % 3 = 0 AS link_tracking, true AS open_tracking,
      false AS hide_message_body, 'false' AS queue_drafts,
      strftime(make_timestamp((1700000000 + s_suppkey) * 1000000), '%Y-%m-%d %H:%M:%S') AS created_at,
      CASE WHEN s_suppkey % 4 > 0 THEN '2023-11-14 22:13:20' END AS updated_at
    FROM supplier""",
)
def cio_transactional_details(spark, sf_dir):
    key = F.col("s_suppkey")
    source = derive.table(spark, sf_dir, "supplier").select(
        key.alias("id"),
        F.when(F.pmod(key, F.lit(5)) > 0, F.col("s_name")).alias("name"),
        F.concat(F.lit("from "), F.col("s_nationkey")).alias("description"),
        (F.lit(1700000000) + key).alias("created_at"),
        F.when(F.pmod(key, F.lit(4)) > 0, 1700000000).alias("updated_at"),
        F.lit(False).alias("queue_drafts"),
        (F.pmod(key, F.lit(3)) == 0).alias("link_tracking"),
        F.lit(True).alias("open_tracking"),
        F.lit(False).alias("hide_message_body"),
        (F.pmod(key, F.lit(2)) == 0).alias("send_to_unsubscribed"),
    )
    return with_text_times(details.cio_transactional_details(source))


def people(spark, sf_dir):
    """Customers as people: some flags unknown, some creation times at epoch zero."""
    key = F.col("c_custkey")
    return derive.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("customer_id"),
        F.concat(F.lit("p-"), key).alias("internal_customer_id"),
        F.when(F.pmod(key, F.lit(5)) > 0, F.pmod(key, F.lit(5)) == 1).alias("deleted"),
        F.when(F.pmod(key, F.lit(7)) > 0, F.pmod(key, F.lit(7)) == 1).alias("suppressed"),
        F.when(F.pmod(key, F.lit(4)) > 0, F.timestamp_seconds(F.lit(1704067200) + F.pmod(key, F.lit(60)) * 86400))
        .when(F.pmod(key, F.lit(8)) == 0, F.timestamp_seconds(F.lit(0)))
        .alias("created_at"),
        F.timestamp_seconds(F.lit(1704067200) + F.pmod(key, F.lit(90)) * 86400 + 36000).alias("updated_at"),
    )


_PEOPLE_SQL = """
    SELECT c_name AS user_id, 'p-' || c_custkey AS internal_customer_id,
      CASE WHEN c_custkey % 5 > 1 THEN false ELSE true END AS deleted,
      CASE WHEN c_custkey % 7 > 1 THEN false ELSE true END AS suppressed,
      CASE WHEN c_custkey % 4 > 0 THEN
        strftime(make_timestamp((1704067200 + c_custkey % 60 * 86400) * 1000000), '%Y-%m-%d %H:%M:%S') END AS created_at,
      strftime(make_timestamp((1704067200 + c_custkey % 90 * 86400 + 36000) * 1000000), '%Y-%m-%d %H:%M:%S') AS updated_at
    FROM customer"""


@query("n21_cio_people", _PEOPLE_SQL)
def cio_people(spark, sf_dir):
    return with_text_times(details.cio_people(people(spark, sf_dir)))


@query(
    "n24_api_broadcasts",
    """SELECT DISTINCT cast(p_size AS int) AS api_broadcast_id, p_brand AS name, p_type AS type, 'live' AS state FROM part""",
)
def api_broadcasts(spark, sf_dir):
    unset = ["deduplicate_id", "created", "updated", "active", "actions", "first_started", "tags"]
    source = derive.table(spark, sf_dir, "part").select(
        F.col("p_size").alias("id"),
        F.col("p_brand").alias("name"),
        F.col("p_type").alias("type"),
        F.lit("live").alias("state"),
        *[F.lit("x").alias(c) for c in unset],
    )
    return details.api_broadcasts(source).drop(*unset)


# ---- arrays with one number per day --------------------------------------------------------------


def _day_arrays(spark, sf_dir, names: list[str]):
    """Per user one 31-element array per name; element i counts events of the name's kind on day i+1."""
    rows = derive.events(spark, sf_dir)
    kinds = F.pmod("event_id", F.lit(len(names)))
    per_day = rows.groupBy("user_id", F.dayofmonth("ts").alias("d")).agg(
        *[F.count_if(kinds == i).alias(name) for i, name in enumerate(names)]
    )
    entries = F.collect_list(F.struct("d", F.struct(*names)))
    users = per_day.groupBy("user_id").agg(F.map_from_entries(entries).alias("by_day"))

    def series_of(name):
        counts = f"transform(sequence(1, 31), d -> coalesce(try_element_at(by_day, d).{name}, 0L))"
        return F.to_json(F.expr(counts)).alias(name)

    return users.select(
        F.col("user_id").alias("playbook_id"),
        F.lit("campaign").alias("type"),
        F.lit("2024-01-31").alias("endAt"),
        *[series_of(name) for name in names],
        F.when(F.pmod("user_id", F.lit(2)) == 0, F.pmod("user_id", F.lit(9)).cast("string")).otherwise("").alias("channel"),
        F.when(F.pmod("user_id", F.lit(2)) == 0, "email").otherwise("").alias("channel_name"),
    )


def _day_sql(names: list[str], extra: str) -> str:
    kinds = ", ".join(
        f"cast(count(e.event_id) FILTER (WHERE e.event_id % {len(names)} = {i}) AS bigint) AS {'open' if n == 'opened' else n}"
        for i, n in enumerate(names)
    )
    return f"""
    WITH users AS (SELECT DISTINCT user_id FROM events),
    days AS (SELECT user_id, cast(unnest(generate_series(1, 31)) AS int) AS d FROM users)
    SELECT cast(days.user_id AS int) AS playbook_id, 'campaign' AS type{extra},
      strftime(make_date(2024, 1, days.d), '%Y-%m-%d') AS date, {kinds}
    FROM days LEFT JOIN events e ON e.user_id = days.user_id AND day(e.ts) = days.d
    GROUP BY days.user_id, days.d"""


@query("n22_journey_days", _day_sql(schemas.JOURNEY_ARRAYS, ""))
def journey_days(spark, sf_dir):
    return with_text_times(daily_arrays.journey_days(_day_arrays(spark, sf_dir, schemas.JOURNEY_ARRAYS)))


@query(
    "n23_channel_days",
    _day_sql(
        schemas.CHANNEL_ARRAYS,
        """, cast(CASE WHEN days.user_id % 2 = 0 THEN days.user_id % 9 END AS int) AS channel,
      CASE WHEN days.user_id % 2 = 0 THEN 'email' END AS channel_name""",
    ),
)
def channel_days(spark, sf_dir):
    return with_text_times(daily_arrays.channel_days(_day_arrays(spark, sf_dir, schemas.CHANNEL_ARRAYS)))


@query(
    "x18_channel_lookup",
    f"""WITH {EVENTS}, g AS (
      SELECT channel, event_type, event_id % 4 AS v, count(*) AS n, sum(cents) AS c FROM ev GROUP BY ALL)
    SELECT channel, event_type, v, CASE channel WHEN 'ios_push' THEN c WHEN 'android_push' THEN c
      WHEN 'trigger_in_app_message' THEN 2 * c WHEN 'email' THEN 3 * c WHEN 'whats_app' THEN 4 * c + n
      WHEN 'content_cards' THEN 5 * c ELSE 0 END AS opens FROM g""",
)
def channel_lookup(spark, sf_dir):
    from pulsework.functions import channel_measure

    rows = derive.events(spark, sf_dir)
    parts = rows.groupBy(derive.channel().alias("channel"), "event_type", F.pmod("event_id", F.lit(4)).alias("v")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("c")
    )

    def read(field):
        by_cents, by_rows = derive.FIELD_VALUES[field]
        return F.col("c") * by_cents + F.col("n") * by_rows

    opens = channel_measure(F.col("channel"), "opens", read, CHANNEL_METRICS).cast("bigint")
    return parts.select("channel", "event_type", "v", opens.alias("opens"))
