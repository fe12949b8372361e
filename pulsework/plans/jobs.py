"""The jobs: which raw table feeds which result, and how the result is written."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsework import audit, changes, late, schemas, sinks
from pulsework.audit import Rejected, Rules
from pulsework.operators import details, events, landing_rows, metering, series, touches, users
from pulsework.operators.changelog import UpsertRule
from pulsework.operators.landing_rows import PAYLOAD_CODE
from pulsework.operators.latest import PRESETS, dedupe, latest, latest_by_key
from pulsework.functions import in_days, parse_iso
from pulsework.operators.numbering import sync_registry
from pulsework.operators.quality import check_not_null
from pulsework.session import discard, new_work_dir
from pulsework.sources.files import FILES_AT_ONCE
from pulsework.sources.landing import BAD_LINE
from pulsework.sources import (
    accepted,
    discover_new_files,
    file_chunks,
    file_time_bounds,
    list_files,
    quarantined,
    read_csv_dim,
    read_jsonl,
    read_parquet_files,
    read_pruned_chunks,
    read_variants,
    table_or_none,
    with_lineage,
)


DAY = "day"
RUN = "run"


@dataclass(frozen=True)
class Landing:
    """How a JSONL endpoint becomes a raw table.

    Tables that are not loaded anew each time are partitioned by run, and by the data's day where ``start``
    names the column that it comes from. So a job reads one run's rows, or all runs' rows of its days. ``variants`` makes
    the rows if the table keeps its payloads as VARIANT, where the line has its rows in the array ``listed``.
    """

    line: T.StructType
    rows: Callable[[DataFrame], DataFrame]
    table: str
    preset: str | None
    full_refresh: bool = False
    keep_line: bool = False
    start: str | None = None
    variants: Callable[[DataFrame], DataFrame] | None = None
    listed: str | None = None


# Raw tables and how their latest rows are told.
LANDINGS = {
    "campaign_list": Landing(
        schemas.CAMPAIGN_LIST_LINE, landing_rows.campaign_list, "braze_campaigns_list", "campaign_list", True
    ),
    "canvas_list": Landing(schemas.CANVAS_LIST_LINE, landing_rows.canvas_list, "braze_canvas_list", "canvas_list", True),
    "campaign_details": Landing(
        schemas.CAMPAIGN_DETAILS_LINE, landing_rows.campaign_details, "braze_campaigns_details", "campaign_details", True
    ),
    "canvas_details": Landing(
        schemas.CANVAS_DETAILS_LINE, landing_rows.canvas_details, "braze_canvas_details", "canvas_details", True, True
    ),
    "campaign_series": Landing(
        schemas.CAMPAIGN_SERIES_LINE, landing_rows.campaign_series, "braze_campaigns_data_series", "campaign_series",
        start="start_date", variants=landing_rows.campaign_series_variants, listed="data",
    ),
    "canvas_series": Landing(
        schemas.CANVAS_SERIES_LINE, landing_rows.canvas_series, "braze_canvas_data_series", "canvas_series",
        start="start_date", variants=landing_rows.canvas_series_variants, listed="stats",
    ),
    "user_export": Landing(
        schemas.USER_EXPORT_LINE, landing_rows.user_export, "braze_user_workflow_data", "user_export"
    ),
    "mixpanel_events": Landing(schemas.EVENT_LINE, landing_rows.events, "mixpanel_raw_events", "mixpanel_events"),
}


# The kinds of entities that results tell apart.
KINDS = ["campaign", "canvas"]


@dataclass(frozen=True)
class Job:
    """A result table: its source, its transformation and its upsert.

    ``time`` names the key column that gives a row's day. Such results are day tables, so a
    run rewrites only the days it brings; the others are published as a whole.
    """

    source: str
    transform: Callable[[DataFrame], DataFrame]
    table: str
    keys: list[str]
    update_cols: list[str] | None = None
    newer_by: str | None = None
    full_refresh: bool = False
    time: str | None = None

    @property
    def rules(self) -> Rules:
        """What a sound load keeps: whole keys, each once, and a known kind."""
        return Rules(tuple(self.keys), tuple(self.keys), {"type": KINDS} if "type" in self.keys else {})


_PLAYBOOK_UPDATES = ["last_received", "in_control", "converted", "conversion_events_performed", "message_status"]

# Result keys, updated columns and guards.
JOBS = {
    "campaign_details": Job(
        "braze_campaigns_details_view",
        details.campaign_details,
        "transformed_campaign_details",
        ["campaign_id"],
        newer_by="updated_at",
    ),
    "canvas_details": Job(
        "braze_canvas_details_view",
        details.canvas_details,
        "transformed_canvas_details",
        ["canvas_id"],
        newer_by="updated_at",
    ),
    "campaign_variants": Job(
        "braze_campaigns_data_series_view",
        series.campaign_variants,
        "transformed_variants",
        ["variant_id", "type", "id", "time"],
        time="time",
    ),
    "canvas_variants": Job(
        "braze_canvas_data_series_view",
        series.canvas_variants,
        "transformed_variants",
        ["variant_id", "type", "id", "time"],
        time="time",
    ),
    "canvas_steps": Job(
        "braze_canvas_data_series_view",
        series.canvas_steps,
        "transformed_canvas_steps",
        ["time", "canvas_id", "step_id"],
        time="time",
    ),
    "campaign_channels": Job(
        "braze_campaigns_data_series_view",
        series.campaign_channels,
        "transformed_channels_campaign",
        ["time", "channel_name", "type", "id"],
        time="time",
    ),
    "canvas_channels": Job(
        "braze_canvas_data_series_view",
        series.canvas_channels,
        "transformed_channels_canvas",
        ["time", "channel_name", "type", "id", "step_id"],
        time="time",
    ),
    "user_campaigns": Job(
        "braze_user_workflow_data_view",
        users.user_campaigns,
        "transformed_user_playbook_data",
        ["user_id", "id", "type"],
        _PLAYBOOK_UPDATES,
        "last_received",
    ),
    "user_canvases": Job(
        "braze_user_workflow_data_view",
        users.user_canvases,
        "transformed_user_playbook_data",
        ["user_id", "id", "type"],
        _PLAYBOOK_UPDATES,
        "last_received",
    ),
    "user_canvas_steps": Job(
        "braze_user_workflow_data_view",
        users.user_canvas_steps,
        "transformed_user_playbook_steps_data",
        ["user_id", "step_id", "playbook_id"],
        ["step_name", "last_received"],
        "last_received",
    ),
    "user_details": Job(
        "braze_user_workflow_data_view", users.user_details, "transformed_user_details", ["user_id"]
    ),
    "cio_campaign_details": Job(
        "customerio_campaigns",
        lambda table: latest(details.cio_campaign_details(table), "cio_campaigns"),
        "transformed_customerio_campaign_details",
        ["campaign_id"],
        newer_by="updated_at",
    ),
    "cio_newsletter_details": Job(
        "customerio_newsletters",
        details.cio_newsletter_details,
        "transformed_customerio_newsletter_details",
        [],
        full_refresh=True,
    ),
    "cio_transactional_details": Job(
        "customerio_transactional",
        details.cio_transactional_details,
        "transformed_customerio_transactional_message_details",
        [],
        full_refresh=True,
    ),
}


def qualified(namespace: str | None, table: str) -> str:
    return f"{namespace}.{table}" if namespace else table


def run_of(path: str) -> str:
    """The run that a landing path stands for when none is named."""
    return hashlib.md5(path.encode()).hexdigest()


def ingest(
    spark: SparkSession, kind: str, path: str, namespace: str | None = None, run: str | None = None, variant: bool = False
) -> str:
    """Land one endpoint's JSONL and refresh its latest-row view; returns the view's name.

    Lines that do not parse go to ``<table>_quarantine`` with their file and the path of the run. ``run`` names
    the raw table's partitions, by default after the path: landing a run again replaces what it has landed before.
    With ``variant`` a series table keeps its payloads as VARIANT, so that lines are parsed here and never again; its
    jobs are the same. A table keeps either text or variants.
    """
    spec = LANDINGS[kind]
    table = qualified(namespace, spec.table)
    if variant and not spec.variants:
        raise ValueError(f"{kind} has no rows of variants")
    if spec.variants and spark.catalog.tableExists(table) and variant != (PAYLOAD_CODE in spark.table(table).columns):
        raise ValueError(f"{table} keeps its payloads as {'text' if variant else 'variants'}")
    bad = Observation("bad lines")
    parsed = _parsed(spark, spec, path, variant).observe(bad, F.count_if(F.col(BAD_LINE).isNotNull()).alias("lines"))
    rows = (spec.variants if variant else spec.rows)(accepted(parsed))
    if spec.full_refresh:
        sinks.overwrite(rows, table)
    else:
        parts, name = [RUN], run or run_of(path)
        if spec.start:
            rows, parts = rows.withColumn(DAY, F.to_date(parse_iso(F.col(spec.start)))), [DAY, RUN]
        sinks.replace_parts(rows.withColumn(RUN, F.lit(name)), table, parts, F.col(RUN) == name)
    _set_aside(spark, lambda: _parsed(spark, spec, path, variant), path, f"{table}_quarantine", bad.get["lines"])
    return sinks.latest_view(spark, table, spec.preset)


def _parsed(spark: SparkSession, spec: Landing, path: str, variant: bool) -> DataFrame:
    return read_variants(spark, path, [spec.listed]) if variant else read_jsonl(spark, path, spec.line, spec.keep_line)


def _set_aside(spark: SparkSession, read: Callable[[], DataFrame], path: str, table: str, count: int) -> None:
    """Malformed lines, once each however often a path is loaded. Files are only read again if there are any."""
    if not spark.catalog.tableExists(table):
        sinks.append(spark.createDataFrame([], "line string, file string, run string"), table)
    if count:
        lines = quarantined(read()).select("line", F.input_file_name().alias("file"))
        known = spark.table(table).filter(F.col("run") == path).select("line", "file").distinct()
        sinks.append(lines.join(known, ["line", "file"], "left_anti").withColumn("run", F.lit(path)), table)


def run_job(
    spark: SparkSession, name: str, namespace: str | None = None, root: str | None = None, checked: bool = False
) -> str | None:
    """Transform and write one result table; None when its source does not exist.

    With ``checked`` rows that break the job's rules are not loaded: ``Rejected`` is raised, and what was served stays.
    """
    job = JOBS[name]
    source = table_or_none(spark, qualified(namespace, job.source))
    return None if source is None else _write_job(job, source, namespace, root, checked)


def run_landed(
    spark: SparkSession, kind: str, run: str, namespace: str | None = None, root: str | None = None, checked: bool = False
) -> list[str]:
    """All jobs of an endpoint for what one run has landed; returns the result tables.

    Series take all raw rows of the days that the run brings, whichever run they came with, and no others. Other
    endpoints take the run's own rows, so their runs are to be worked through in order. The latest rows
    are found once and written to the shared folder for all the jobs. With ``checked`` the first job whose rows break its rules
    raises ``Rejected``; jobs before it have been written.
    """
    spec = LANDINGS[kind]
    raw = table_or_none(spark, qualified(namespace, spec.table))
    if raw is None:
        return []
    rows = raw.filter(F.col(RUN) == run)
    if spec.start:
        rows = raw.filter(sinks.on_days(DAY, sinks.days_of(rows, DAY)))
    path = new_work_dir(spark, "latest")
    latest(rows, spec.preset).write.parquet(path)
    newest = spark.read.schema(raw.schema).parquet(path)
    try:
        return [_write_job(j, newest, namespace, root, checked) for j in JOBS.values() if j.source == f"{spec.table}_view"]
    finally:
        discard(spark, path)


def missing_keys(spark: SparkSession, name: str, namespace: str | None = None) -> DataFrame:
    """Rows of a job's result that lack a part of their key, counted per column; none in a sound table."""
    job = JOBS[name]
    return check_not_null(spark.table(qualified(namespace, job.table)), job.keys)


def _write_job(job: Job, source: DataFrame, namespace: str | None, root: str | None, checked: bool = False) -> str:
    target = qualified(namespace, job.table)
    rows = job.transform(source)
    if job.full_refresh:
        if not checked:
            sinks.publish(rows, target, root)
        else:
            _raise_if(target, audit.publish_checked(rows, target, job.rules, root))
        return target
    unique = dedupe(rows, job.keys)

    def load(batch: DataFrame) -> None:
        if job.time:
            dated = batch.withColumn(DAY, F.to_date(job.time))
            sinks.upsert_days_table(dated, target, DAY, job.keys, job.update_cols, job.newer_by)
        else:
            _append_changes(batch, target, job.keys, job.update_cols, job.newer_by, root)

    if checked:
        _raise_if(target, audit.load_checked(unique, job.rules, load))
    else:
        load(unique)
    return target


def _raise_if(target: str, violations: DataFrame | None) -> None:
    if violations is not None:
        raise Rejected(target, violations)


def _append_changes(
    rows: DataFrame, target: str, keys: list[str], update_cols: list[str] | None, newer_by: str | None, root: str | None, **more
) -> None:
    """A run writes only its own rows: tables whose keys fix no day are merged when they are read."""
    rule = UpsertRule(tuple(keys), tuple(update_cols) if update_cols is not None else None, newer_by, more.pop("null_safe", False))
    changes.append_changes(rows, target, rule, root, fold_after=changes.FOLD_AFTER, **more)


def run_people(
    spark: SparkSession, first_day: str, last_day: str, namespace: str | None = None, root: str | None = None
) -> str | None:
    source = table_or_none(spark, qualified(namespace, "customerio_people_view"))
    if source is None:
        return None
    target = qualified(namespace, "transformed_customerio_people_details")
    rows = details.cio_people(source, first_day, last_day)
    _append_changes(rows, target, ["internal_customer_id"], None, "updated_at", root)
    return target


def run_channel_touches(
    spark: SparkSession, first_day: str, last_day: str, namespace: str | None = None, root: str | None = None
) -> str | None:
    """All thirteen metrics from one pass over the join, as one table partitioned by metric.

    Touches without a playbook are one group per customer, which a rerun replaces like any other.
    """
    metrics = _latest_on_days(spark, "metrics", first_day, last_day, namespace)
    deliveries = table_or_none(spark, qualified(namespace, "customerio_channel_deliveries_view"))
    if metrics is None or deliveries is None:
        return None
    rows = touches.channel_touches(metrics, deliveries, first_day, last_day)
    return _append_touches(rows, namespace, root)


def _append_touches(rows: DataFrame, namespace: str | None, root: str | None) -> str:
    target = qualified(namespace, "customerio_channel_touches")
    _append_changes(
        rows,
        target,
        ["metric", "internal_customer_id", "playbook_id"],
        ["type", "channel", "channel_name"],
        "created_at",
        root,
        partition_by=["metric"],
        null_safe=True,
    )
    return target


def run_late_touches(
    spark: SparkSession, first_day: str, last_day: str, namespace: str | None = None, root: str | None = None
) -> str | None:
    """Metric events with their delivery, served by day, and the touches of those that this run could join.

    Events of a delivery that has not landed wait for it, so no touch is lost if deliveries land after their events, as in
    ``run_channel_touches``. A delivery is made before its events: one that lands again changes served events from ``first_day`` on.
    Touches of a customer from whom a delivery is taken away stay.
    """
    metrics = _latest_on_days(spark, "metrics", first_day, last_day, namespace)
    arrived = _latest_on_days(spark, "deliveries", first_day, last_day, namespace)
    deliveries = table_or_none(spark, qualified(namespace, "customerio_channel_deliveries_view"))
    if metrics is None or arrived is None or deliveries is None:
        return None
    within = in_days(F.col("created_at"), first_day, last_day)
    facts = metrics.filter(within).select("event_id", "delivery_id", "metric", "created_at", "inserted_at")
    rule = late.LateJoin("event_id", "delivery_id", "event_day", "inserted_at")
    fresh = late.join_late(
        facts.withColumn("event_day", F.to_date("created_at")), touches.delivery_sides(deliveries), arrived.filter(within),
        qualified(namespace, "customerio_delivery_metrics"), rule, root, first_day,
    )
    keys = ["metric", "internal_customer_id", "playbook_id"]
    rows = fresh.filter(F.col("metric").isin(schemas.DELIVERY_METRICS)).select(*keys, "type", "channel", "channel_name", "created_at")
    return _append_touches(latest_by_key(rows, keys, ["created_at"]), namespace, root)


def _latest_on_days(
    spark: SparkSession, kind: str, first_day: str, last_day: str, namespace: str | None
) -> DataFrame | None:
    """The latest rows of an export whose rows never change their day, from the raw partitions of these days alone.

    A filter above the latest-row view would not reach the scan, as a window lies between. A table landed without days
    is read through the view.
    """
    spec = FILE_LANDINGS[kind]
    raw = table_or_none(spark, qualified(namespace, spec.table))
    if raw is None or DAY not in raw.columns:
        return table_or_none(spark, qualified(namespace, f"{spec.table}_view"))
    return latest(raw.filter(F.col(DAY).between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))), spec.preset)


@dataclass(frozen=True)
class FileLanding:
    """How a Parquet export becomes a raw table.

    ``bounds`` are the times that a file's span is taken from, ``times`` those that decide
    whether a row belongs to a run's days. With one such time the raw table is partitioned by its day, and landing
    days again replaces them; a row that belongs to several days is appended, and the latest-row view hides the older copy.
    """

    columns: T.StructType
    bounds: list[str]
    times: list[str]
    table: str
    preset: str


# Registry types and the times of each export.
FILE_LANDINGS = {
    "deliveries": FileLanding(
        schemas.DELIVERIES, ["created_at"], ["created_at"], "customerio_channel_deliveries", "deliveries"
    ),
    "metrics": FileLanding(schemas.METRICS, ["created_at"], ["created_at"], "customerio_channel_metrics", "metrics"),
    "outputs": FileLanding(
        schemas.OUTPUTS, ["created_at", "delay_ends_at"], ["created_at"], "customerio_journey_outputs", "outputs"
    ),
    "subjects": FileLanding(
        schemas.SUBJECTS,
        ["created_at", "started_campaign_at"],
        ["created_at", "started_campaign_at"],
        "customerio_journey_subjects",
        "subjects",
    ),
    "people_changes": FileLanding(
        schemas.PEOPLE, ["created_at", "updated_at"], ["created_at", "updated_at"], "customerio_people", "people"
    ),
}
FILE_REGISTRY = "customerio_processed_files"
#: The chunk of the file list that a row came with, the second partition column of day tables.
CHUNK = "chunk"


def register_files(
    spark: SparkSession, kind: str, folder: str, namespace: str | None = None, at_once: int = FILES_AT_ONCE
) -> int:
    """Add the files of a folder that the registry does not know yet; returns how many there were.

    A file without rows is registered without bounds.
    """
    spec = FILE_LANDINGS[kind]
    registry = qualified(namespace, FILE_REGISTRY)
    if not spark.catalog.tableExists(registry):
        sinks.append(spark.createDataFrame([], schemas.PROCESSED_FILES), registry)
    listing, columns = list_files(spark, folder), schemas.PROCESSED_FILES
    count = 0
    for names in file_chunks(discover_new_files(listing, spark.table(registry), kind), at_once):
        rows = with_lineage(read_parquet_files(spark, names, spec.columns))
        sinks.append(file_time_bounds(rows, spec.bounds, kind).select(*columns.fieldNames()), registry)
        count += len(names)
    if count:
        unknown = {c: F.lit(None).cast("timestamp") for c in ("min_timestamp", "max_timestamp")}
        empty = discover_new_files(listing, spark.table(registry), kind).withColumns({"type": F.lit(kind), **unknown})
        sinks.append(empty.select(*columns.fieldNames()), registry)
    sinks.latest_view(spark, registry, "processed_files")
    return count


def ingest_files(
    spark: SparkSession, kind: str, folder: str, first_day: str, last_day: str, namespace: str | None = None,
    at_once: int = FILES_AT_ONCE, buckets: int = 16,
) -> str | None:
    """Land the days' rows of an export in its raw table and refresh the view.

    Only files whose registered span touches the days are read. Tables are bucketed by the keys of their latest
    rows, so that the view needs no shuffle; ``buckets`` counts for a new table, one bucket of all days being the work of a task. None when
    no file is needed.
    """
    spec = FILE_LANDINGS[kind]
    register_files(spark, kind, folder, namespace, at_once)
    registry = spark.table(qualified(namespace, f"{FILE_REGISTRY}_view"))
    table, chunks = qualified(namespace, spec.table), 0
    keys, count = PRESETS[spec.preset].keys, buckets
    by_day = len(spec.times) == 1
    if spark.catalog.tableExists(table):
        (keys, count), by_day = sinks.bucket_layout(spark, table), DAY in spark.table(table).columns
    span = F.col(DAY).between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    for rows in read_pruned_chunks(spark, registry, kind, first_day, last_day, spec.columns, spec.times, at_once):
        rows = rows.select(*spec.columns.fieldNames(), "inserted_at")
        if by_day:
            placed = rows.withColumns({DAY: F.to_date(spec.times[0]), CHUNK: F.lit(chunks)})
            sinks.replace_parts(placed, table, [DAY, CHUNK], span & (F.col(CHUNK) == chunks), keys, count)
        else:
            sinks.append(rows, table, bucket_by=keys, buckets=count)
        chunks += 1
    if by_day and chunks:
        sinks.drop_parts(spark, table, [DAY, CHUNK], span & (F.col(CHUNK) >= chunks))
    return sinks.latest_view(spark, table, spec.preset) if chunks else None


def run_journey_metrics(spark: SparkSession, first_day: str, last_day: str, namespace: str | None = None) -> bool:
    """Sources are checked before anything is replaced."""
    outputs = table_or_none(spark, qualified(namespace, "customerio_journey_outputs_view"))
    subjects = table_or_none(spark, qualified(namespace, "customerio_journey_subjects_view"))
    if outputs is None or subjects is None:
        return False
    # The outputs view holds each subject once, so no subject can be hot.
    rows = touches.journey_metrics(outputs, subjects, first_day, last_day)
    table = qualified(namespace, "transformed_customerio_journey_metrics")
    sinks.replace_days_table(
        rows.withColumn("created_day", rows["created_at"].cast("date")), table, "created_day", first_day, last_day
    )
    return True


def sync_event_types(
    spark: SparkSession, csv: str | None, table: str, namespace: str | None = None, root: str | None = None
) -> str:
    """Bring an event type registry up to date with its CSV; without a CSV it stays as it is."""
    name = qualified(namespace, table)
    known = table_or_none(spark, name)
    if known is None:
        known = spark.createDataFrame([], schemas.EVENT_TYPES)
    listed = read_csv_dim(spark, csv) if csv else None
    sinks.publish(sync_registry(known, listed), name, root)
    return name


def run_amplitude_events(spark: SparkSession, first_day: str, last_day: str, namespace: str | None = None) -> bool:
    raw = table_or_none(spark, qualified(namespace, "amplitude_events"))
    registry = table_or_none(spark, qualified(namespace, "amplitude_events_list"))
    if raw is None or registry is None:
        return False
    rows = events.amplitude_events(raw, registry, first_day, last_day)
    table = qualified(namespace, "served_amplitude_events")
    sinks.replace_days_table(
        rows.withColumn("event_day", rows["event_time_calculated"].cast("date")), table, "event_day", first_day, last_day
    )
    return True


def run_mixpanel_events(spark: SparkSession, namespace: str | None = None, run: str | None = None) -> bool:
    """Raw events, of one run or of all, to the served day table; an event's key holds its time, hence its day.

    The order of runs does not matter, as a newer copy of an event is never replaced by an older one.
    """
    raw = table_or_none(spark, qualified(namespace, "mixpanel_raw_events"))
    registry = table_or_none(spark, qualified(namespace, "mixpanel_events_list"))
    if raw is None or registry is None:
        return False
    if run is not None:
        raw = raw.filter(F.col(RUN) == run)
    rows = events.mixpanel_events(raw, registry).withColumn("event_day", F.to_date(F.timestamp_seconds("time")))
    keys = ["event", "time", "distinct_id", "insert_id"]
    sinks.upsert_days_table(
        rows, qualified(namespace, "mixpanel_events"), "event_day", keys,
        ["properties", "metadata", "created_at", "event_type_id"], "created_at",
    )
    return True


@dataclass(frozen=True)
class Meter:
    """Where a source's usage is counted: its type registry, its events, who and when."""

    registry: str
    events: str
    user: str
    time: str
    distinct_types: bool


# The Mixpanel table is partitioned by its events' days, which prunes the month's partitions.
METERS = {
    "amplitude": Meter("amplitude_events_list", "served_amplitude_events", "user_id", "event_time_calculated", False),
    "mixpanel": Meter("mixpanel_events_list", "mixpanel_events", "distinct_id", "event_day", True),
}
USAGE = ["active_events", "monthly_active_users"]


def run_metering(
    spark: SparkSession,
    kind: str,
    domain: str,
    as_of: str,
    organisations: str,
    meters: str,
    namespace: str | None = None,
    root: str | None = None,
) -> str:
    """Count a tenant's usage and merge it into its meter; counts are 0 while a source table is missing."""
    spec = METERS[kind]
    registry = table_or_none(spark, qualified(namespace, spec.registry))
    rows = table_or_none(spark, qualified(namespace, spec.events))
    counts = [F.lit(0).cast("bigint"), F.lit(0).cast("bigint")]
    if registry is not None and rows is not None:
        types = metering.active_types(registry, spec.distinct_types)
        users = metering.monthly_active_users(rows, spec.user, spec.time, as_of)
        counts = [types.scalar(), users.scalar()]
    usage = spark.range(1).select(
        F.lit(domain).alias("domain"), *[c.alias(name) for c, name in zip(counts, USAGE)]
    )
    merged = metering.meter_merge(spark.table(meters), spark.table(organisations), usage, USAGE)
    sinks.publish(merged, meters, root)
    return meters


# Result tables that lose rows after the retention period, their day column
# if they are day tables, and the time that counts where it is not the one of the day.
RETENTION = {
    "mixpanel_events": ("event_day", None),
    "transformed_canvas_steps": (DAY, None),
    "transformed_channels_campaign": (DAY, None),
    "transformed_channels_canvas": (DAY, None),
    "transformed_variants": (DAY, None),
    "transformed_user_playbook_data": (None, "last_received"),
    "transformed_user_playbook_steps_data": (None, "last_received"),
    "customerio_channel_touches": (None, "created_at"),
    "customerio_delivery_metrics": ("event_day", None),
    "customerio_delivery_metrics_pending": (None, "created_at"),
    "transformed_customerio_journey_metrics": ("created_day", None),
    "served_amplitude_events": ("event_day", "server_upload_time"),
}


def run_retention(
    spark: SparkSession, as_of: str, days: int = 90, namespace: str | None = None, root: str | None = None
) -> list[str]:
    """Expire every result table there is; returns the tables it went over."""
    done = []
    for table, (day, time) in RETENTION.items():
        name = qualified(namespace, table)
        if not spark.catalog.tableExists(name):
            continue
        if day and time:
            sinks.expire_rows_table(spark, name, day, time, as_of, days)
        elif day:
            sinks.expire_days_table(spark, name, day, as_of, days)
        elif changes.log_of(spark, name):
            changes.expire_changes(spark, name, time, as_of, days, root)
        else:
            sinks.expire_published(spark, name, time, as_of, days, root)
        done.append(name)
    return done
