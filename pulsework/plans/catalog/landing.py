"""Sources: landing files, file listings and registries, written from the given tables first."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsework import schemas, sources
from pulsework.operators import landing_rows, planning
from pulsework.plans import derive
from pulsework.plans.catalog.registry import EVENTS, query, with_text_times
from pulsework.session import new_work_dir


def mod(column: str, n: int):
    return F.pmod(F.col(column), F.lit(n))


def _landed_lines(spark, sf_dir, with_bad: bool) -> str:
    """The events as JSONL files of one run; with ``with_bad`` every 25th line is cut in half or no object."""
    path = new_work_dir(spark, "landing")
    rows = derive.events(spark, sf_dir)
    lines = derive.event_lines(rows, redelivered=False)
    if with_bad:
        numbered = rows.select("event_id")
        broken = numbered.filter(mod("event_id", 25) == 0).select(
            F.when(mod("event_id", 50) == 0, '{"event":"cut", "prop').otherwise("[1, 2]").alias("value")
        )
        lines = lines.unionByName(broken)
    lines.write.text(f"{path}/run-1")
    return path


@query(
    "s1_read_jsonl",
    f"""WITH {EVENTS}
    SELECT event_type AS event, cast(floor(epoch(ts)) AS bigint) AS time, 'u-' || user_id AS distinct_id,
      'i-' || event_id AS insert_id FROM ev""",
)
def read_jsonl(spark, sf_dir):
    path = _landed_lines(spark, sf_dir, with_bad=True)
    parsed = sources.read_jsonl(spark, f"{path}/*/*.txt", schemas.EVENT_LINE)
    rows = landing_rows.events(sources.accepted(parsed))
    return rows.select("event", "time", "distinct_id", "insert_id")


@query(
    "r8_quarantine",
    """SELECT CASE WHEN event_id % 50 = 0 THEN '{"event":"cut", "prop' ELSE '[1, 2]' END AS line, count(*) AS lines
    FROM events WHERE event_id % 25 = 0 GROUP BY 1""",
)
def quarantine(spark, sf_dir):
    path = _landed_lines(spark, sf_dir, with_bad=True)
    parsed = sources.read_jsonl(spark, f"{path}/*/*.txt", schemas.EVENT_LINE)
    return sources.quarantined(parsed).groupBy("line").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "r8_line_counts",
    """SELECT count(*) AS accepted, count(*) FILTER (WHERE event_id % 25 = 0) AS quarantined,
      cast(0 AS bigint) AS missing_event FROM events""",
)
def line_counts(spark, sf_dir):
    path = _landed_lines(spark, sf_dir, with_bad=True)
    parsed = sources.read_jsonl(spark, f"{path}/*/*.txt", schemas.EVENT_LINE)
    return sources.line_counts(parsed, ["event"])


def _day_files(spark, sf_dir) -> str:
    path = new_work_dir(spark, "files")
    rows = derive.events(spark, sf_dir).select("event_id", "user_id", "ts", "day")
    rows.write.partitionBy("day").parquet(path)
    return path


def _day_of(file_name):
    return F.regexp_extract(file_name, r"day=([0-9-]+)", 1)


@query(
    "s2_read_parquet_files",
    "SELECT event_id, user_id FROM events",
)
def read_parquet_files(spark, sf_dir):
    """Reads an explicit list of files, here all that the listing finds."""
    listed = sources.list_files(spark, _day_files(spark, sf_dir))
    names = [row.file_name for row in listed.select("file_name").toLocalIterator()]
    return sources.read_parquet_files(spark, names).select("event_id", "user_id")


@query("s3_read_csv_dim", "SELECT DISTINCT event_type || '/' || user_id AS event_type FROM events")
def read_csv_dim(spark, sf_dir):
    path = new_work_dir(spark, "csv")
    names = derive.events(spark, sf_dir).select(F.concat_ws("/", "event_type", "user_id").alias("event_name"), "user_id")
    names.write.option("header", "true").csv(path)
    return sources.read_csv_dim(spark, path)


@query("s4_read_table", "SELECT c_custkey AS id, c_name AS name FROM customer")
def read_table(spark, sf_dir):
    derive.table(spark, sf_dir, "customer").createOrReplaceTempView("pulsework_customer")
    return sources.read_table(spark, "pulsework_customer", {"c_custkey": "id", "c_name": "name"})


@query(
    "s6_file_lineage",
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS file_day, true AS has_time FROM events",
)
def file_lineage(spark, sf_dir):
    rows = sources.with_lineage(spark.read.parquet(_day_files(spark, sf_dir)))
    return rows.select(
        "event_id", _day_of(F.col("file_name")).alias("file_day"), F.col("inserted_at").isNotNull().alias("has_time")
    )


@query(
    "s7_u2_discover_new_files",
    """SELECT DISTINCT strftime(ts, '%Y-%m-%d') || '/' || user_id AS file_name FROM events
    WHERE NOT (user_id % 3 = 0 AND day(ts) < 20)""",
)
def discover_new_files(spark, sf_dir):
    rows = derive.events(spark, sf_dir)
    listing = rows.select(F.concat_ws("/", "day", "user_id").alias("file_name")).distinct()
    known = rows.filter((mod("user_id", 3) == 0) & (F.dayofmonth("ts") < 20))
    other_type = rows.filter(mod("user_id", 3) == 1)
    registry = known.select(
        F.concat_ws("/", "day", "user_id").alias("file_name"), F.lit("metrics").alias("type")
    ).unionByName(
        other_type.select(F.concat_ws("/", "day", "user_id").alias("file_name"), F.lit("outputs").alias("type"))
    )
    return sources.discover_new_files(listing, registry, "metrics")


@query(
    "a1_file_time_bounds",
    """SELECT strftime(ts, '%Y-%m-%d') AS file_day, 'people' AS type,
      strftime(min(least(ts, date_trunc('second', ts) + to_seconds(user_id))), '%Y-%m-%d %H:%M:%S.%f') AS min_timestamp,
      strftime(max(greatest(ts, date_trunc('second', ts) + to_seconds(user_id))), '%Y-%m-%d %H:%M:%S.%f') AS max_timestamp
    FROM events GROUP BY 1""",
)
def file_time_bounds(spark, sf_dir):
    rows = sources.with_lineage(spark.read.parquet(_day_files(spark, sf_dir)))
    timed = rows.withColumn("later", F.timestamp_seconds(F.unix_timestamp("ts") + F.col("user_id")))
    bounds = sources.file_time_bounds(timed, ["ts", "later"], "people")
    # The writer may cut a day into several files; the expectation has one row per day.
    days = bounds.groupBy(_day_of(F.col("file_name")).alias("file_day"), "type").agg(
        F.min("min_timestamp").alias("min_timestamp"), F.max("max_timestamp").alias("max_timestamp")
    )
    return with_text_times(days, fraction=True)


_FILE_REGISTRY = """files AS (
      SELECT user_id || '/' || (day(ts) // 4) AS file_name, CASE WHEN user_id % 2 = 0 THEN 'metrics' ELSE 'outputs' END AS type,
        min(ts) AS lo, max(ts) AS hi FROM events GROUP BY 1, 2)"""


@query(
    "r2_prune_files",
    f"""WITH {_FILE_REGISTRY}
    SELECT file_name FROM files WHERE type = 'metrics' AND cast(hi AS date) >= DATE '2024-01-10'
      AND cast(lo AS date) <= DATE '2024-01-13'""",
)
def prune_files(spark, sf_dir):
    rows = derive.events(spark, sf_dir)
    named = rows.select(
        F.concat_ws("/", "user_id", F.floor(F.dayofmonth("ts") / 4)).alias("file_name"),
        F.when(mod("user_id", 2) == 0, "metrics").otherwise("outputs").alias("type"),
        "ts",
    )
    bounds = named.groupBy("file_name", "type").agg(F.min("ts").alias("min_timestamp"), F.max("ts").alias("max_timestamp"))
    return sources.prune_files(bounds, "metrics", "2024-01-10", "2024-01-13").select("file_name")


@query(
    "r2_s2_read_pruned_files",
    "SELECT event_id FROM events WHERE cast(ts AS date) BETWEEN DATE '2024-01-10' AND DATE '2024-01-13'",
)
def read_pruned_files(spark, sf_dir):
    """Registers the day files, then reads only those that the days need."""
    rows = sources.with_lineage(spark.read.parquet(_day_files(spark, sf_dir)))
    registry = sources.file_time_bounds(rows, ["ts"], "metrics")
    file_schema = schemas.schema("event_id BIGINT, user_id BIGINT, ts TIMESTAMP")
    needed = sources.read_pruned_files(spark, registry, "metrics", "2024-01-10", "2024-01-13", file_schema, ["ts"])
    return needed.select("event_id")


@query(
    "r2_f6_files_of_all_windows",
    """WITH spans AS (
      SELECT c_custkey AS id, date_diff('day', DATE '1992-01-01' + cast(c_custkey % 2400 AS int), DATE '1998-12-31') AS days FROM customer),
    steps AS (SELECT id, days, unnest(range(0, cast(ceil(days / 100.0) AS bigint))) AS step FROM spans WHERE days > 0),
    windows AS (
      SELECT id, DATE '1998-12-31' - cast(step * 100 AS int) AS after, cast(least(100, days - step * 100) AS int) AS length FROM steps),
    files AS (
      SELECT strftime(o_orderdate, '%Y-%m') || '/' || (o_custkey % 7) AS file_name, cast(min(o_orderdate) AS date) AS lo,
        cast(max(o_orderdate) AS date) AS hi FROM orders GROUP BY 1)
    SELECT id, strftime(after, '%Y-%m-%d') AS ending_at, length, count(*) AS files, min(file_name) AS first_file, max(file_name) AS last_file
    FROM windows JOIN files ON lo < after AND hi >= after - length GROUP BY ALL""",
)
def files_of_all_windows(spark, sf_dir):
    """Each backfill window of each customer with the files of orders that it needs, in one pass."""
    orders = derive.table(spark, sf_dir, "orders").select(
        F.concat_ws("/", F.date_format("o_orderdate", "yyyy-MM"), mod("o_custkey", 7)).alias("file_name"), F.col("o_orderdate").alias("at")
    )
    registry = orders.groupBy("file_name").agg(
        F.lit("orders").alias("type"), F.min("at").alias("min_timestamp"), F.max("at").alias("max_timestamp")
    )
    customers = derive.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.date_add(F.lit("1992-01-01").cast("date"), mod("c_custkey", 2400).cast("int")).alias("created_at")
    )
    windows = planning.plan_backfill(customers, "id", "1998-12-31", planning.CAMPAIGN_WINDOW_DAYS)
    # Windows of equal days need the same files, so files are sought once for each pair of days, of which there are few.
    days = ["ending_at", "length"]
    first, last = F.expr("date_sub(ending_at, length)"), F.date_sub("ending_at", 1)
    pairs = sources.files_of_windows(registry, windows.select(*days).distinct(), "orders", first, last)
    needed = pairs.groupBy(*days).agg(
        F.count(F.lit(1)).alias("files"), F.min("file_name").alias("first_file"), F.max("file_name").alias("last_file")
    )
    return with_text_times(
        windows.join(F.broadcast(needed), days).groupBy("id", *days).agg(
            F.sum("files").alias("files"), F.min("first_file").alias("first_file"), F.max("last_file").alias("last_file")
        )
    )
