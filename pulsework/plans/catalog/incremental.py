"""Upserts, window replacement, retention, registries, plans and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsework import audit, changes, late, sinks, totals
from pulsework.operators import changelog, merge, numbering, planning, quality, touches
from pulsework.operators.latest import latest_by_key
from pulsework.plans import derive
from pulsework.plans.catalog.registry import DELIVERIES, EVENTS, query, unique_name, with_text_times
from pulsework.plans.catalog.relational import _JOURNEYS, _TYPE_IDS
from pulsework.session import new_work_dir


def mod(column: str, n: int):
    return F.pmod(F.col(column), F.lit(n))


# ---- upserts: even events are in the target, odd events arrive ---------------------------------------


def _two_loads(spark, sf_dir):
    """The latest event per user and type of either load; every seventh event has no time.

    Signups come with the second load only, errors with the first only.
    """
    rows = derive.events(spark, sf_dir).select(
        "user_id", "event_type", "event_id", "cents", F.when(mod("event_id", 7) > 0, F.col("ts")).alias("seen_at")
    )
    keys = ["user_id", "event_type"]
    stored = (mod("event_id", 2) == 0) & (F.col("event_type") != "signup")
    arriving = (mod("event_id", 2) == 1) & (F.col("event_type") != "error") | (F.col("event_type") == "signup")
    target = latest_by_key(rows.filter(stored), keys, ["event_id"])
    source = latest_by_key(rows.filter(arriving), keys, ["event_id"])
    return target, source, keys


_TWO_LOADS = f"""{EVENTS}, seen AS (
      SELECT user_id, event_type, event_id, cents, CASE WHEN event_id % 7 > 0 THEN ts END AS seen_at FROM ev
    ), t AS (
      SELECT * FROM seen WHERE event_id % 2 = 0 AND event_type <> 'signup'
      QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1
    ), s AS (
      SELECT * FROM seen WHERE event_id % 2 = 1 AND event_type <> 'error' OR event_type = 'signup'
      QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1
    )"""

_UPSERT = f"""WITH {_TWO_LOADS}
    SELECT coalesce(t.user_id, s.user_id) AS user_id, coalesce(t.event_type, s.event_type) AS event_type,
      CASE WHEN t.user_id IS NULL THEN s.event_id ELSE t.event_id END AS event_id,
      CASE WHEN s.user_id IS NULL THEN t.cents ELSE s.cents END AS cents,
      strftime(CASE WHEN t.user_id IS NULL THEN s.seen_at ELSE t.seen_at END, '%Y-%m-%d %H:%M:%S.%f') AS seen_at
    FROM t FULL JOIN s ON t.user_id = s.user_id AND t.event_type = s.event_type"""

_UPSERT_IF_NEWER = f"""WITH {_TWO_LOADS}
    SELECT coalesce(t.user_id, s.user_id) AS user_id, coalesce(t.event_type, s.event_type) AS event_type,
      CASE WHEN t.user_id IS NULL THEN s.event_id ELSE t.event_id END AS event_id,
      CASE WHEN t.user_id IS NULL OR s.seen_at > t.seen_at THEN s.cents ELSE t.cents END AS cents,
      strftime(CASE WHEN t.user_id IS NULL OR s.seen_at > t.seen_at THEN s.seen_at ELSE t.seen_at END,
        '%Y-%m-%d %H:%M:%S.%f') AS seen_at
    FROM t FULL JOIN s ON t.user_id = s.user_id AND t.event_type = s.event_type"""


@query("k3_upsert", _UPSERT)
def upsert(spark, sf_dir):
    target, source, keys = _two_loads(spark, sf_dir)
    return with_text_times(merge.upsert(target, source, keys, ["cents"]), fraction=True)


@query("k3_upsert_probing_small_source", _UPSERT)
def upsert_small_source(spark, sf_dir):
    target, source, keys = _two_loads(spark, sf_dir)
    return with_text_times(merge.upsert(target, source, keys, ["cents"], small_source=True), fraction=True)


@query("k4_upsert_if_newer", _UPSERT_IF_NEWER)
def upsert_if_newer(spark, sf_dir):
    target, source, keys = _two_loads(spark, sf_dir)
    return with_text_times(merge.upsert(target, source, keys, ["cents"], "seen_at"), fraction=True)


@query("k4_upsert_published_twice", _UPSERT_IF_NEWER)
def upsert_published(spark, sf_dir):
    """Through the published table, the source applied twice."""
    target, source, keys = _two_loads(spark, sf_dir)
    name, root = unique_name("playbooks"), new_work_dir(spark, "published")
    sinks.upsert_published(target, name, keys, root=root)
    for _ in range(2):
        sinks.upsert_published(source, name, keys, ["cents"], "seen_at", root=root)
    return with_text_times(spark.table(name), fraction=True)


def _change_table(spark, sf_dir, update_cols, newer_by, fold):
    """The target, the source and the source again as three loads; ``fold`` says after which of them the log is folded."""
    target, source, keys = _two_loads(spark, sf_dir)
    rule = changelog.UpsertRule(tuple(keys), update_cols, newer_by)
    name, root = unique_name("changes"), new_work_dir(spark, "changes")
    for i, rows in enumerate((target, source, source)):
        changes.append_changes(rows, name, rule, root)
        if i in fold:
            changes.fold_changes(spark, name, root)
    return with_text_times(spark.table(name), fraction=True)


@query("k3_merge_on_read", _UPSERT)
def merge_on_read(spark, sf_dir):
    return _change_table(spark, sf_dir, ("cents",), None, ())


@query("k4_a4_merge_on_read_if_newer", _UPSERT_IF_NEWER)
def merge_on_read_if_newer(spark, sf_dir):
    return _change_table(spark, sf_dir, ("cents",), "seen_at", ())


@query("k4_a4_merge_on_read_folded", _UPSERT_IF_NEWER)
def merge_on_read_folded(spark, sf_dir):
    return _change_table(spark, sf_dir, ("cents",), "seen_at", (0, 1, 2))


_DAY_UPSERT = f"""WITH {EVENTS}
    SELECT event_id, user_id, CASE WHEN day(ts) > 20 AND event_type = 'purchase' THEN cents + 1 ELSE cents END AS cents,
      CASE WHEN day(ts) > 20 AND event_type IN ('purchase', 'signup') THEN 2 ELSE 1 END AS load, day AS event_day
    FROM ev"""


@query("k4_upsert_day_table", _DAY_UPSERT)
def upsert_day_table(spark, sf_dir):
    """From the 21st on signups are missing at first, purchases come again changed, clicks come again stale."""
    rows = derive.events(spark, sf_dir)
    late = F.dayofmonth("ts") > 20

    def shaped(events, load, extra):
        return events.select(
            "event_id",
            "user_id",
            (F.col("cents") + extra).alias("cents"),
            F.lit(load).alias("load"),
            F.to_date("day").alias("event_day"),
        )

    first = shaped(rows.filter(~(late & (F.col("event_type") == "signup"))), 1, 0)
    missing = shaped(rows.filter(late & (F.col("event_type") == "signup")), 2, 0)
    changed = shaped(rows.filter(late & (F.col("event_type") == "purchase")), 2, 1)
    stale = shaped(rows.filter(late & (F.col("event_type") == "click")), 0, 100)
    second = missing.unionByName(changed).unionByName(stale)
    table, path = unique_name("events"), new_work_dir(spark, "day-table")
    sinks.upsert_days_table(first, table, "event_day", ["event_id"], location=path)
    sinks.upsert_days_table(second, table, "event_day", ["event_id"], ["cents", "load"], "load")
    return with_text_times(spark.table(table))


@query(
    "j1_late_sides",
    f"""WITH {DELIVERIES}, copies AS (
      SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS event_id, l_orderkey AS key,
        cast(l_quantity AS int) % 10 AS reason, CASE l_returnflag WHEN 'A' THEN 'opened' WHEN 'R' THEN 'clicked' ELSE 'sent' END AS metric
      FROM lineitem
    ), events AS (
      SELECT *, CASE WHEN l.key % 4 = 0 THEN 1 ELSE 0 END AS version FROM copies l
      QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY reason DESC, metric DESC) = 1)
    SELECT event_id, version, reason, e.metric, CASE WHEN key % 5 = 0 THEN 'moved' ELSE internal_customer_id END AS internal_customer_id,
      CASE WHEN type IS NOT NULL THEN playbook END AS playbook_id, type, channel, channel_name
    FROM events e JOIN deliveries ON delivery_id = cast(key AS varchar) WHERE key % 17 > 0""",
)
def late_sides(spark, sf_dir):
    """Three runs: deliveries and events fall into any of them, a fourth of the events come twice, a fifth of the deliveries change.

    A seventeenth of the deliveries never comes; their events wait.
    """
    key, twice, flag = F.col("l_orderkey"), mod("l_orderkey", 4) == 0, F.col("l_returnflag")
    copies = derive.table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("event_id"),
        key.cast("string").alias("delivery_id"),
        F.pmod(F.col("l_quantity").cast("int"), F.lit(10)).alias("reason"),
        F.when(flag == "A", "opened").when(flag == "R", "clicked").otherwise("sent").alias("metric"),
        F.date_add(F.lit("2024-01-01").cast("date"), mod("l_orderkey", 30).cast("int")).alias("event_day"),
        F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("version"),
        "l_orderkey",
    )
    # Where the key is divisible by 8 the newer copy comes first.
    second = (F.col("version") + (mod("l_orderkey", 8) == 0).cast("int")) % 2
    copies = copies.withColumn("run", F.when(twice, second).otherwise(mod("l_orderkey", 3)))
    number = F.col("delivery_id").cast("long")
    sides = touches.delivery_sides(derive.deliveries(derive.table(spark, sf_dir, "orders"))).filter(number % 17 > 0)
    customer = F.when(number % 5 == 0, "moved").otherwise(F.col("internal_customer_id"))
    # The runs that bring a delivery: one in seven classes of keys, and the last if it changes.
    came = (number % 7 + 1) % 3
    rule = late.LateJoin("event_id", "delivery_id", "event_day", "version")
    table, root = unique_name("late"), new_work_dir(spark, "late")
    for run in range(3):
        known = sides.filter(came <= run)
        if run == 2:
            known = known.withColumn("internal_customer_id", customer)
        arrived = known.filter((came == run) | ((number % 5 == 0) & F.lit(run == 2)))
        facts = copies.filter(F.col("run") == run).drop("run", "l_orderkey")
        late.join_late(facts, known, arrived, table, rule, root)
    return spark.table(table).drop("event_day", "delivery_id")


# ---- window replacement and retention ------------------------------------------------------------------


@query("k5_replace_days", _JOURNEYS)
def replace_days(spark, sf_dir):
    """The window written twice over a target that holds part of it."""
    outputs = derive.journey_outputs(derive.table(spark, sf_dir, "lineitem"))
    subjects = derive.journey_subjects(derive.table(spark, sf_dir, "orders"))
    window = ("1997-01-01", "1999-12-31")
    rows = touches.journey_metrics(outputs, subjects, *window)
    once = merge.replace_days(rows.filter("channel < 4"), rows, "created_at", *window)
    return with_text_times(merge.replace_days(once, rows, "created_at", *window))


@query(
    "k5_replace_day_table",
    """SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS event_day FROM events
    WHERE NOT (day(ts) BETWEEN 10 AND 14) OR (day(ts) <> 12 AND event_type <> 'error')""",
)
def replace_day_table(spark, sf_dir):
    """Days 10 to 14 are replaced by fewer rows, and by none on the 12th."""
    events = derive.events(spark, sf_dir).select("event_id", "user_id", F.to_date("day").alias("event_day"), "event_type")
    rows = events.drop("event_type")
    table, path = unique_name("journeys"), new_work_dir(spark, "day-table")
    day = F.dayofmonth("event_day")
    sinks.upsert_days_table(rows, table, "event_day", ["event_id"], location=path)
    newer = events.filter(day.between(10, 14) & (day != 12) & (F.col("event_type") != "error")).drop("event_type")
    for _ in range(2):
        sinks.replace_days_table(newer, table, "event_day", "2024-01-10", "2024-01-14")
    return with_text_times(spark.table(table))


@query(
    "k6_expire",
    """SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderkey % 50 = 0 OR cast(o_orderdate AS date) >= DATE '1999-06-01' - 90""",
)
def expire(spark, sf_dir):
    """Orders without a date are kept."""
    orders = derive.table(spark, sf_dir, "orders").withColumn(
        "at", F.when(mod("o_orderkey", 50) > 0, F.col("o_orderdate"))
    )
    return merge.expire(orders, "at", "1999-06-01").select("o_orderkey", "o_custkey")


@query(
    "k6_expire_day_table",
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS event_day FROM events WHERE cast(ts AS date) >= DATE '2024-04-10' - 90",
)
def expire_day_table(spark, sf_dir):
    rows = derive.events(spark, sf_dir).select("event_id", F.to_date("day").alias("event_day"))
    table, path = unique_name("events"), new_work_dir(spark, "day-table")
    sinks.upsert_days_table(rows, table, "event_day", ["event_id"], location=path)
    sinks.expire_days_table(spark, table, "event_day", "2024-04-10")
    return with_text_times(spark.table(table))


# ---- tables and views ------------------------------------------------------------------------------------


@query(
    "a5_totals_by_deltas",
    f"""WITH {EVENTS}, final AS (
      SELECT day, CASE WHEN event_id % 5 = 0 THEN 'moved' ELSE event_type END AS kind,
        CASE WHEN event_id % 3 = 0 THEN cents + 7 ELSE cents END AS cents FROM ev)
    SELECT day, kind, count(*) AS rows, cast(sum(cents) AS bigint) AS cents FROM final GROUP BY day, kind""",
)
def totals_by_deltas(spark, sf_dir):
    """Daily totals after three redeliveries: new values, stale ones, and rows that move to another group; then folded."""
    rows = derive.events(spark, sf_dir)

    def load(kind, cents, seen):
        return rows.select("event_id", kind.alias("kind"), cents.alias("cents"), F.lit(seen).alias("seen"), F.to_date("ts").alias("event_day"))

    kind, cents = F.col("event_type"), F.col("cents")
    value = F.when(mod("event_id", 3) == 0, cents + 7).otherwise(cents)
    loads = [
        load(kind, cents, 1),
        load(kind, cents + 7, 2).filter(mod("event_id", 3) == 0),
        load(F.lit("stale"), cents - 1, 0),
        load(F.lit("moved"), value, 3).filter(mod("event_id", 5) == 0),
    ]
    table = unique_name("kinds")
    for i, source in enumerate(loads):
        totals.upsert_days_with_totals(
            source, table, "event_day", ["event_id"], ["event_day", "kind"], ["cents"], f"run-{i}", newer_by="seen"
        )
        if i == 1:
            totals.fold_totals(spark, table, ["event_day", "kind"], ["cents"])
    found = spark.table(totals.totals_view(table))
    return found.select(F.col("event_day").cast("string").alias("day"), "kind", "rows", "cents")


@query(
    "w1_k8_latest_of_bucketed_table",
    """SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts
    FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_of_bucketed_table(spark, sf_dir):
    """Two loads into a table bucketed by the keys: the latest rows are found within its buckets."""
    rows = derive.events(spark, sf_dir).select("user_id", "event_type", "event_id", "ts")
    table, keys, path = unique_name("bucketed"), ["user_id", "event_type"], new_work_dir(spark, "bucketed")
    for part in (0, 1):
        sinks.append(rows.filter(mod("event_id", 2) == part), table, location=path, bucket_by=keys, buckets=4)
    return with_text_times(latest_by_key(spark.table(table), keys, ["ts"]), fraction=True)


@query(
    "k1_k8_append_and_latest_view",
    """SELECT user_id, event_type, event_id AS created_at FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
)
def append_and_latest_view(spark, sf_dir):
    """Two loads appended to a raw table; the view shows the latest row per user."""
    rows = derive.events(spark, sf_dir).select("user_id", "event_type", F.col("event_id").alias("created_at"))
    table = unique_name("raw")
    path = new_work_dir(spark, "raw")
    sinks.append(rows.filter(mod("created_at", 2) == 0), table, location=path)
    sinks.append(rows.filter(mod("created_at", 2) == 1), table)
    return spark.table(sinks.latest_view(spark, table, "user_export"))


@query("k2_k9_overwrite", "SELECT DISTINCT event_type || '/' || user_id AS event_type FROM events WHERE event_type <> 'error'")
def overwrite(spark, sf_dir):
    """A dimension reloaded as a whole: the rows of the first load are gone."""
    types = derive.events(spark, sf_dir).select(
        F.concat_ws("/", "event_type", "user_id").alias("event_type"), F.col("event_type").alias("kind")
    )
    table, path = unique_name("types"), new_work_dir(spark, "types")
    sinks.overwrite(types.select("event_type").distinct(), table, location=path)
    sinks.overwrite(types.filter("kind <> 'error'").select("event_type").distinct(), table, location=path)
    return spark.table(table)


@query("k7_publish_swap", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def publish_swap(spark, sf_dir):
    orders = derive.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    name, root = unique_name("orders"), new_work_dir(spark, "published")
    sinks.publish(orders.drop("o_orderstatus"), name, root)
    # The second copy replaces the first.
    sinks.publish(orders.filter("o_orderstatus = 'F'").drop("o_orderstatus"), name, root)
    return spark.table(name)


@query(
    "k11_copy_tenant",
    f"""WITH {EVENTS}
    SELECT event_type AS event, user_id AS distinct_id, max(event_id) AS last_id, cast(max(epoch(ts)) AS double) AS created_at
    FROM ev GROUP BY 1, 2""",
)
def copy_tenant(spark, sf_dir):
    """One tenant's events into another's: epoch times, newest per key, guarded upsert."""
    rows = derive.events(spark, sf_dir).select(
        F.col("event_type").alias("event"),
        F.col("user_id").alias("distinct_id"),
        F.col("event_id").alias("last_id"),
        (F.unix_micros("ts") / 1e6).alias("created_at"),
    )
    keys = ["event", "distinct_id"]
    theirs = latest_by_key(rows.filter(mod("last_id", 3) > 0), keys, ["created_at"])
    ours = latest_by_key(rows.filter(mod("last_id", 3) == 0), keys, ["created_at"])
    return merge.upsert(theirs, ours, keys, newer_by="created_at")


@query(
    "j3_mixpanel_run_by_run",
    f"""WITH {EVENTS}, {_TYPE_IDS}
    SELECT event_type AS event, 'i-' || event_id AS insert_id, event_id % 10 = 0 AND event_id % 3 > 0 AS again,
      day AS event_day, event_type_id
    FROM ev JOIN types USING (event_type) WHERE event_type <> 'error'""",
)
def mixpanel_run_by_run(spark, sf_dir):
    """Two runs that share a third of the events, landed, then served in the wrong order, one of them twice."""
    from pulsework.plans import jobs

    rows, path, namespace = derive.events(spark, sf_dir), new_work_dir(spark, "runs"), unique_name("tenant")
    spark.sql(f"CREATE DATABASE {namespace} LOCATION '{path}/tables'")
    sinks.overwrite(derive.registry(rows), f"{namespace}.mixpanel_events_list")
    derive.event_lines(rows.filter(mod("event_id", 3) < 2), redelivered=False).write.text(f"{path}/1")
    derive.event_lines(rows.filter(mod("event_id", 3) > 0)).write.text(f"{path}/2")
    for run in ("1", "2"):
        jobs.ingest(spark, "mixpanel_events", f"{path}/{run}/*.txt", namespace, run)
    for run in ("2", "1", "2"):
        jobs.run_mixpanel_events(spark, namespace, run)
    again = F.get_json_object("properties", "$.again").cast("boolean").alias("again")
    served = spark.table(f"{namespace}.mixpanel_events")
    return with_text_times(served.select("event", "insert_id", again, "event_day", "event_type_id"))


# ---- registries and plans -----------------------------------------------------------------------------------


@query(
    "r1_sync_registry",
    f"""WITH {EVENTS}, types AS (SELECT DISTINCT event_type || '/' || user_id AS event_type, user_id,
        10 + user_id * 5 + CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3
          WHEN 'purchase' THEN 4 ELSE 0 END AS id FROM ev
    ), known AS (SELECT * FROM types WHERE event_type NOT LIKE 'signup%'
    ), listed AS (SELECT * FROM types WHERE event_type NOT LIKE 'error%')
    SELECT event_type, id AS event_type_id, event_type NOT LIKE 'error%' AS is_active FROM known
    UNION ALL
    SELECT event_type, (SELECT max(id) FROM known) + row_number() OVER (ORDER BY md5(event_type)) AS event_type_id, true
    FROM listed WHERE event_type LIKE 'signup%'""",
)
def sync_registry(spark, sf_dir):
    """A type per event type and user: signups are new, errors are gone."""
    place = F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "click", 2).when(
        F.col("event_type") == "view", 3
    ).when(F.col("event_type") == "purchase", 4).otherwise(0)
    types = derive.events(spark, sf_dir).select(
        F.concat_ws("/", "event_type", "user_id").alias("event_type"),
        (F.lit(10) + F.col("user_id") * 5 + place).alias("event_type_id"),
        F.lit(True).alias("is_active"),
        F.col("event_type").alias("kind"),
    )
    known = types.filter("kind <> 'signup'").drop("kind").distinct()
    listed = types.filter("kind <> 'error'").select("event_type")
    return numbering.sync_registry(known, listed)


@query(
    "r3_run_window",
    "SELECT event_id FROM events WHERE cast(ts AS date) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'",
)
def run_window(spark, sf_dir):
    """Runs of the 11th to the 13th work on the days before."""
    from pulsework.functions import in_days

    window = planning.run_window("2024-01-11", "2024-01-13")
    return derive.table(spark, sf_dir, "events").filter(in_days(F.col("ts"), *window)).select("event_id")


def _backfill_sql(days: int) -> str:
    return f"""WITH spans AS (
      SELECT c_custkey AS id, date_diff('day', DATE '2024-01-01' + cast(c_custkey % 400 AS int), DATE '2024-12-31') AS days
      FROM customer), steps AS (
      SELECT id, days, unnest(generate_series(0, cast(ceil(days / {days}.0) AS int) - 1)) AS step FROM spans WHERE days > 0)
    SELECT id, strftime(DATE '2024-12-31' - cast(step * {days} AS int), '%Y-%m-%d') AS ending_at,
      cast(least({days}, days - step * {days}) AS int) AS length FROM steps"""


def _entities(spark, sf_dir):
    return derive.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.date_add(F.lit("2024-01-01").cast("date"), mod("c_custkey", 400).cast("int")).alias("created_at"),
    )


@query("r4_plan_campaign_backfill", _backfill_sql(100))
def plan_campaign_backfill(spark, sf_dir):
    plan = planning.plan_backfill(_entities(spark, sf_dir), "id", "2024-12-31", planning.CAMPAIGN_WINDOW_DAYS)
    return with_text_times(plan)


@query("r4_plan_canvas_backfill", _backfill_sql(14))
def plan_canvas_backfill(spark, sf_dir):
    plan = planning.plan_backfill(_entities(spark, sf_dir), "id", "2024-12-31", planning.CANVAS_WINDOW_DAYS)
    return with_text_times(plan)


def _user_runs(spark, sf_dir):
    rows = derive.events(spark, sf_dir)
    return rows.groupBy("user_id").agg(F.min("day").alias("start_day"), F.max("day").alias("end_day"))


@query(
    "r5_plan_daily",
    """WITH runs AS (SELECT user_id, min(cast(ts AS date)) AS a, max(cast(ts AS date)) AS b FROM events GROUP BY 1)
    SELECT user_id, strftime(a + cast(unnest(generate_series(-1, cast(b - a AS int) - 1)) AS int), '%Y-%m-%d') AS day FROM runs""",
)
def plan_daily(spark, sf_dir):
    plan = planning.plan_daily(_user_runs(spark, sf_dir), "start_day", "end_day")
    return with_text_times(plan.select("user_id", "day"))


@query(
    "r5_plan_daily_late_data",
    """WITH runs AS (SELECT user_id, min(cast(ts AS date)) AS a, max(cast(ts AS date)) AS b FROM events GROUP BY 1),
    moved AS (SELECT user_id, a - 30 AS a, least(b - 30, a) AS b FROM runs)
    SELECT user_id, strftime(a + cast(unnest(generate_series(-1, cast(b - a AS int) - 1)) AS int), '%Y-%m-%d') AS day FROM moved""",
)
def plan_daily_late_data(spark, sf_dir):
    plan = planning.plan_daily(_user_runs(spark, sf_dir), "start_day", "end_day", offset=30)
    return with_text_times(plan.select("user_id", "day"))


@query(
    "r6_batch_ids",
    """WITH ids AS (SELECT DISTINCT o_custkey AS id FROM orders),
    placed AS (SELECT id, row_number() OVER (ORDER BY md5(cast(id AS varchar)), id) - 1 AS place FROM ids)
    SELECT place // 50 AS batch, string_agg(id, ',' ORDER BY place) AS ids FROM placed GROUP BY 1""",
)
def batch_ids(spark, sf_dir):
    ids = derive.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    batches = numbering.batch_ids(ids, "id", 50)
    return batches.select("batch", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


@query(
    "r7_incomplete_windows",
    """WITH runs AS (SELECT user_id, min(cast(ts AS date)) AS a, max(cast(ts AS date)) AS b FROM events GROUP BY 1),
    planned AS (SELECT user_id, strftime(a + cast(unnest(generate_series(0, cast(b - a AS int))) AS int), '%Y-%m-%d') AS day FROM runs)
    SELECT user_id, day FROM planned
    WHERE (user_id, day) NOT IN (SELECT (user_id, strftime(ts, '%Y-%m-%d')) FROM events)""",
)
def incomplete_windows(spark, sf_dir):
    planned = planning.plan_daily(_user_runs(spark, sf_dir), "start_day", "end_day", lag=0)
    planned = planned.select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"))
    landed = derive.events(spark, sf_dir).select("user_id", "day")
    return planning.incomplete_windows(planned, landed, ["user_id", "day"])


@query(
    "r7_r4_uncovered_windows",
    """WITH asked AS (SELECT c_custkey AS id, unnest(range(c_custkey % 400, 365)) AS d FROM customer),
    held AS (
      SELECT o_custkey AS id, unnest(range(o_orderkey % 366 - o_orderkey % 45, o_orderkey % 366)) AS d FROM orders
      UNION SELECT c_custkey, unnest(range(0, 365)) FROM customer WHERE c_custkey % 5 = 0),
    open AS (SELECT * FROM asked EXCEPT SELECT * FROM held),
    islands AS (SELECT *, d - row_number() OVER (PARTITION BY id ORDER BY d) AS island FROM open),
    spans AS (SELECT id, max(d) + 1 AS after, count(*) AS days FROM islands GROUP BY id, island),
    steps AS (SELECT *, unnest(range(0, cast(ceil(days / 14.0) AS bigint))) AS step FROM spans)
    SELECT id, strftime(DATE '2024-01-01' + cast(after - step * 14 AS int), '%Y-%m-%d') AS ending_at,
      cast(least(14, days - step * 14) AS int) AS length FROM steps""",
)
def uncovered_windows(spark, sf_dir):
    """Each order is a request that has landed; of every fifth entity the whole plan has, in its own windows."""
    plan = planning.plan_backfill(_entities(spark, sf_dir), "id", "2024-12-31", planning.CAMPAIGN_WINDOW_DAYS)
    key = F.col("o_orderkey")
    requests = derive.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (key % 366).cast("int")).alias("ending_at"),
        (key % 45).cast("int").alias("length"),
    )
    landed = requests.unionByName(plan.filter(mod("id", 5) == 0))
    return with_text_times(planning.uncovered_windows(plan, landed, "id", planning.CANVAS_WINDOW_DAYS))


@query(
    "r9_skip_if_absent",
    "SELECT false AS ran, count(*) AS orders FROM orders",
)
def skip_if_absent(spark, sf_dir):
    """The journey job has no source tables here, so it ends without touching anything."""
    from pulsework.plans.jobs import run_journey_metrics

    ran = run_journey_metrics(spark, "2024-01-01", "2024-01-02", namespace=unique_name("absent"))
    orders = derive.table(spark, sf_dir, "orders")
    return orders.agg(F.lit(ran).alias("ran"), F.count(F.lit(1)).alias("orders"))


@query(
    "d3_check_unique",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def check_unique(spark, sf_dir):
    return quality.check_unique(derive.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "d3_check_domain",
    "SELECT event_type, count(*) AS rows FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1",
)
def check_domain(spark, sf_dir):
    return quality.check_domain(derive.table(spark, sf_dir, "events"), "event_type", ["click", "view"])


@query(
    "d3_check_not_null",
    "SELECT 'at' AS \"column\", count(*) AS rows FROM orders WHERE o_orderkey % 50 = 0",
)
def check_not_null(spark, sf_dir):
    orders = derive.table(spark, sf_dir, "orders").withColumn(
        "at", F.when(mod("o_orderkey", 50) > 0, F.col("o_orderdate"))
    )
    return quality.check_not_null(orders, ["o_orderkey", "at"])


_ALLOWED = ["F", "O"]
_ORDER_RULES = audit.Rules(("o_orderkey",), ("o_orderkey", "o_custkey"), {"o_orderstatus": _ALLOWED})


def _bad_load(spark, sf_dir):
    """A sound load, then one in which keys repeat, customers lack and a status is unknown; returns the table and what is wrong."""
    orders = derive.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    name, root = unique_name("checked"), new_work_dir(spark, "checked")
    sound = orders.filter(F.col("o_orderstatus").isin(_ALLOWED))
    assert audit.publish_checked(sound, name, _ORDER_RULES, root) is None
    customer = F.when(mod("o_orderkey", 50) != 7, F.col("o_custkey")).alias("o_custkey")
    bad = orders.select("o_orderkey", customer, "o_orderstatus").unionByName(orders.filter(mod("o_orderkey", 100) == 3))
    return name, audit.publish_checked(bad, name, _ORDER_RULES, root)


@query(
    "d3_k7_violations_of_a_load",
    """WITH bad AS (
      SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 7 THEN o_custkey END AS o_custkey, o_orderstatus FROM orders
      UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 100 = 3)
    SELECT 'required' AS "check", 'o_custkey' AS "column", NULL AS value, count(*) AS rows FROM bad WHERE o_custkey IS NULL
    UNION ALL SELECT 'domain', 'o_orderstatus', o_orderstatus, count(*) FROM bad WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 3
    UNION ALL SELECT 'key', 'o_orderkey', '{"o_orderkey":' || o_orderkey || '}', count(*) FROM bad GROUP BY o_orderkey HAVING count(*) > 1""",
)
def violations_of_a_load(spark, sf_dir):
    return _bad_load(spark, sf_dir)[1]


@query(
    "d3_k7_served_after_a_bad_load",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O')",
)
def served_after_a_bad_load(spark, sf_dir):
    return spark.table(_bad_load(spark, sf_dir)[0])
