"""Engagement data in the shapes of the four sources, derived from the given tables.

The given tables hold plain rows. These functions turn whole tables into landing lines,
nested payloads and serving tables, so that the operators have realistic input whose
expected results plain SQL can compute from the same rows. Anything that collects rows into
an array first aggregates to a fixed number of groups, so a busy user adds no rows to it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsework.session import use_utc

TYPES = ["signup", "error", "click", "view", "purchase"]
CHANNELS = [
    "ios_push",
    "android_push",
    "trigger_in_app_message",
    "email",
    "sms",
    "webhook",
    "whats_app",
    "content_cards",
    "carrier_pigeon",
]
# Payload field -> (times cents, times rows): every field gets a value of its own, so that
# reading the wrong one shows.
FIELD_VALUES = {
    "sent": (0, 1),
    "total_opens": (1, 0),
    "body_clicks": (1, 1),
    "impressions": (2, 0),
    "clicks": (2, 1),
    "unique_opens": (3, 0),
    "unique_clicks": (3, 1),
    "delivered": (4, 0),
    "read": (4, 1),
    "total_impressions": (5, 0),
    "total_clicks": (5, 1),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with whole cents and a day; ``ts`` as a timestamp with zone UTC."""
    rows = table(spark, sf_dir, "events")
    return rows.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "props",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )


def _type_index() -> Column:
    return reduce(lambda acc, i: acc.when(F.col("event_type") == TYPES[i], i), range(1, 5), F.when(F.lit(False), 0)).otherwise(0)


def channel() -> Column:
    place = F.pmod(_type_index() + F.col("user_id"), F.lit(len(CHANNELS))) + 1
    return F.element_at(F.array(*[F.lit(c) for c in CHANNELS]), place.cast("int"))


def _field_values(item: Column) -> list[Column]:
    values = []
    for name, (by_cents, by_rows) in FIELD_VALUES.items():
        value = item["c"] * by_cents + item["n"] * by_rows
        # "sent" arrives as 12.0, the others as 12: both are legal JSON numbers.
        values.append((value.cast("double") if name == "sent" else value).alias(name))
    return values


def _messages(items: Column, message) -> Column:
    """Map of channel to its list of messages, built from structs that carry ``channel``."""
    names = F.array_sort(F.array_distinct(F.transform(items, lambda x: x["channel"])))
    return F.map_from_entries(
        F.transform(
            names,
            lambda name: F.struct(
                name.alias("key"), F.transform(F.filter(items, lambda x: x["channel"] == name), message).alias("value")
            ),
        )
    )


def campaign_days(rows: DataFrame) -> DataFrame:
    """One day payload per user (as campaign) and day: at most 9 channels with 4 variations."""
    parts = rows.groupBy("user_id", "day", channel().alias("channel"), F.pmod("event_id", F.lit(4)).alias("v")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("c")
    )
    days = parts.groupBy("user_id", "day").agg(
        F.array_sort(F.collect_list(F.struct("channel", "v", "n", "c"))).alias("items")
    )

    def message(x: Column) -> Column:
        return F.struct(
            F.when(x["v"] == 0, F.lit("Control")).otherwise(F.concat(F.lit("Variant "), x["v"])).alias("variation_name"),
            F.concat(F.lit("v-"), x["v"]).alias("variation_api_id"),
            *_field_values(x),
            (x["n"] * 7).alias("conversions"),
            (x["c"] * 0.25).alias("revenue"),
            (x["n"] + 1).alias("unique_recipients"),
        )

    return days.select(
        F.concat(F.lit("c-"), F.col("user_id")).alias("campaign_id"),
        F.col("day").alias("time"),
        _messages(F.col("items"), message).alias("messages"),
    )


def canvas_days(rows: DataFrame) -> DataFrame:
    """One day payload per user (as canvas) and day: 4 variants, and 5 steps with at most 9 channels."""
    parts = rows.groupBy("user_id", "day", F.pmod("event_id", F.lit(20)).alias("r"), channel().alias("channel")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("c")
    )
    days = parts.groupBy("user_id", "day").agg(
        F.array_sort(F.collect_list(F.struct("r", "channel", "n", "c"))).alias("items")
    )
    items = F.col("items")

    def total(of: Column, name: str) -> Column:
        return F.aggregate(of, F.lit(0).cast("bigint"), lambda t, x: t + x[name])

    def variant(v: int) -> Column:
        mine = F.filter(items, lambda x: x["r"] % 4 == v)
        stats = F.struct(
            F.lit("Control" if v == 0 else f"Variant {v}").alias("name"),
            total(mine, "n").alias("entries"),
            (total(mine, "c") * 0.25).alias("revenue"),
            (total(mine, "n") * 7).alias("conversions"),
        )
        return F.struct(F.lit(f"v-{v}").alias("key"), F.when(F.size(mine) > 0, stats).alias("value"))

    def step(s: int) -> Column:
        mine = F.filter(items, lambda x: x["r"] % 5 == s)
        stats = F.struct(
            F.lit(f"Step {s}").alias("name"),
            (total(mine, "c") * 0.25).alias("revenue"),
            (total(mine, "n") * 3).alias("conversions"),
            total(mine, "n").alias("unique_recipients"),
            _messages(mine, lambda x: F.struct(*_field_values(x))).alias("messages"),
        )
        return F.struct(F.lit(f"s-{s}").alias("key"), F.when(F.size(mine) > 0, stats).alias("value"))

    def present(entries: list[Column]) -> Column:
        return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))

    return days.select(
        F.concat(F.lit("k-"), F.col("user_id")).alias("canvas_id"),
        F.col("day").alias("time"),
        present([variant(v) for v in range(4)]).alias("variant_stats"),
        present([step(s) for s in range(5)]).alias("step_stats"),
    )


def _stamped(timestamp: Column, **params: Column) -> Column:
    named = [part for name, value in params.items() for part in (F.lit(name), value.cast("string"))]
    return F.struct(
        timestamp.alias("timestamp"), F.create_map(*named).alias("params"), F.lit("run-1").alias("run_id")
    ).alias("metadata")


def _hundred_days(days: DataFrame, entity: str, payload: list[str]) -> DataFrame:
    """At most 100 days to one landing record, as one export request covers."""
    block = F.floor(F.date_diff(F.to_date("time"), F.lit("2000-01-01").cast("date")) / 100)
    return days.groupBy(entity, block.alias("block")).agg(F.collect_list(F.struct("time", *payload)).alias("days"))


def campaign_lines(rows: DataFrame, timestamp: float = 1704500000.25) -> DataFrame:
    records = _hundred_days(campaign_days(rows), "campaign_id", ["messages"])
    return records.select(
        F.to_json(F.struct(F.col("days").alias("data"), _stamped(F.lit(timestamp), campaign_id=F.col("campaign_id")))).alias(
            "value"
        )
    )


def canvas_lines(rows: DataFrame, timestamp: float = 1704500000.25) -> DataFrame:
    records = _hundred_days(canvas_days(rows), "canvas_id", ["variant_stats", "step_stats"])
    return records.select(
        F.to_json(
            F.struct(
                F.concat(F.lit("Canvas "), F.col("canvas_id")).alias("name"),
                F.col("days").alias("stats"),
                _stamped(F.lit(timestamp), canvas_id=F.col("canvas_id")),
            )
        ).alias("value")
    )


def event_lines(rows: DataFrame, redelivered: bool = True) -> DataFrame:
    """One line per event; every tenth arrives again later with ``"again": true``."""

    def line(again: bool) -> Column:
        properties = F.struct(
            F.unix_timestamp("ts").alias("time"),
            F.concat(F.lit("u-"), F.col("user_id")).alias("distinct_id"),
            F.concat(F.lit("i-"), F.col("event_id")).alias("$insert_id"),
            F.col("cents").alias("cents"),
            F.lit(again).alias("again"),
        )
        stamp = _stamped(F.lit(1706900000.5 if again else 1706800000.25), project=F.lit("p-1"))
        return F.to_json(F.struct(F.col("event_type").alias("event"), properties.alias("properties"), stamp))

    first = rows.select(line(False).alias("value"))
    if not redelivered:
        return first
    return first.unionByName(rows.filter(F.pmod("event_id", F.lit(10)) == 0).select(line(True).alias("value")))


def user_lines(rows: DataFrame) -> DataFrame:
    """User exports in lines of at most 50 users; 10 campaigns, 6 canvases with 5 steps each."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    parts = rows.groupBy("user_id", F.pmod("event_id", F.lit(30)).alias("r")).agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("last"), F.sum("cents").alias("c")
    )
    users = parts.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("r", F.struct("n", "last", "c")))).alias("by_r")
    )

    # SQL text here, since building these many parts call by call takes longer than running them.
    def one(r: int) -> str:
        return f"try_element_at(by_r, {r}L)"

    def some(of: range) -> str:
        return f"array_compact(array({', '.join(one(r) for r in of)}))"

    def time(value: str) -> str:
        return f"""date_format({value}, "{iso}")"""

    def latest(of: range) -> str:
        return time(f"array_max(transform({some(of)}, x -> x.last))")

    def total(of: str, name: str) -> str:
        return f"aggregate({of}, 0L, (t, x) -> t + x.{name})"

    def campaign(k: int) -> str:
        mine = range(k, 30, 10)
        events = "cast(map() AS map<string, bigint>)" if k % 3 == 0 else f"map('purchase', {total(some(mine), 'n')})"
        engaged = "map('opened', true)" if k % 4 else "cast(NULL AS map<string, boolean>)"
        return f"""if(size({some(mine)}) > 0, named_struct('name', 'Campaign {k}', 'api_campaign_id', 'c-{k}',
            'last_received', {latest(mine)}, 'in_control', {k % 2 == 0}, 'converted', {total(some(mine), 'n')} > 3,
            'multiple_converted', {events}, 'engaged', {engaged}), NULL)"""

    def step(k: int, s: int) -> str:
        own = one(next(r for r in range(k, 30, 6) if r % 5 == s))
        return f"""if({own} IS NOT NULL, named_struct('api_canvas_step_id', 's-{s}', 'name', 'Step {s}',
            'last_received', {time(f'{own}.last')}), NULL)"""

    def canvas(k: int) -> str:
        mine = range(k, 30, 6)
        events = "cast(NULL AS array<string>)" if k % 3 == 1 else f"array('buy', 'goal {k}')"
        return f"""if(size({some(mine)}) > 0, named_struct('name', 'Canvas {k}', 'api_canvas_id', 'k-{k}',
            'last_received_message', {latest(mine)}, 'is_in_control', {k % 2 == 1},
            'converted', {total(some(mine), 'n')} > 5, 'conversion_events_performed', {events},
            'steps_received', array_compact(array({', '.join(step(k, s) for s in range(5))}))), NULL)"""

    def received(name: str, parts: list[str]) -> Column:
        return F.expr(f"array_compact(array({', '.join(parts)}))").alias(name)

    user = F.struct(
        F.concat(F.lit("u-"), F.col("user_id")).alias("external_id"),
        F.create_map(F.lit("spent"), F.expr(total("map_values(by_r)", "c"))).alias("custom_attributes"),
        F.when(F.pmod("user_id", F.lit(3)) == 0, "DE").when(F.pmod("user_id", F.lit(3)) == 1, "FR").alias("country"),
        F.concat(F.lit("city "), F.pmod("user_id", F.lit(7))).alias("home_city"),
        received("campaigns_received", [campaign(k) for k in range(10)]),
        received("canvases_received", [canvas(k) for k in range(6)]),
    )
    batches = users.select(F.floor(F.col("user_id") / 50).alias("batch"), user.alias("u"))
    return (
        batches.groupBy("batch")
        .agg(F.collect_list("u").alias("data"))
        .select(F.to_json(F.struct("data", _stamped(F.lit(1706800000.25), batch=F.col("batch")))).alias("value"))
    )


def registry(rows: DataFrame) -> DataFrame:
    """Event types of the data with ids 10, 11, … by name; "error" is inactive."""
    ids = reduce(
        lambda acc, i: acc.when(F.col("event_type") == sorted(TYPES)[i], 10 + i), range(5), F.when(F.lit(False), 0)
    )
    return (
        rows.select("event_type")
        .distinct()
        .select("event_type", ids.cast("bigint").alias("event_type_id"), (F.col("event_type") != "error").alias("is_active"))
    )


def deliveries(orders: DataFrame) -> DataFrame:
    """Orders as deliveries: customer by order, playbook kind by order key."""
    key = F.col("o_orderkey")
    return orders.select(
        key.cast("string").alias("delivery_id"),
        F.concat(F.lit("p-"), F.pmod("o_custkey", F.lit(500))).alias("internal_customer_id"),
        F.when(F.pmod(key, F.lit(2)) == 0, "email").otherwise("push").alias("delivery_type"),
        F.when(F.pmod(key, F.lit(4)) == 0, F.pmod(key, F.lit(7))).cast("int").alias("campaign_id"),
        F.when(F.pmod(key, F.lit(4)) == 1, F.pmod(key, F.lit(7))).cast("int").alias("newsletter_id"),
        F.when(F.pmod(key, F.lit(4)) == 2, F.pmod(key, F.lit(7))).cast("int").alias("transactional_message_id"),
        F.when(F.pmod(key, F.lit(3)) == 0, F.pmod(key, F.lit(11))).cast("int").alias("action_id"),
        F.pmod(key, F.lit(13)).cast("int").alias("content_id"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def delivery_events(lineitem: DataFrame) -> DataFrame:
    """Order lines as metric events: the return flag names the metric."""
    flag = F.col("l_returnflag")
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("event_id"),
        F.col("l_orderkey").cast("string").alias("delivery_id"),
        F.when(flag == "A", "opened").when(flag == "R", "clicked").otherwise("sent").alias("metric"),
        F.col("l_shipdate").cast("timestamp").alias("created_at"),
    )


def journey_outputs(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").cast("string").alias("subject_name"),
        F.col("l_linestatus").alias("output_type"),
        F.col("l_linenumber").alias("action_id"),
        F.concat(F.lit("part "), F.col("l_partkey")).alias("explanation"),
        F.when(F.pmod("l_partkey", F.lit(5)) > 0, F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("delay_ends_at"),
        F.col("l_shipdate").cast("timestamp").alias("created_at"),
    )


def journey_subjects(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").cast("string").alias("subject_name"),
        F.concat(F.lit("p-"), F.col("o_custkey")).alias("internal_customer_id"),
        F.col("o_orderpriority").alias("campaign_type"),
        F.pmod("o_orderkey", F.lit(7)).cast("int").alias("campaign_id"),
        F.col("o_orderdate").cast("timestamp").alias("started_campaign_at"),
    )
