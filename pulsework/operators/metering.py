"""Usage counts per organisation."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def active_types(registry: DataFrame, distinct: bool = False) -> DataFrame:
    ids = F.col("event_type_id")
    count = F.count_distinct(ids) if distinct else F.count(ids)
    return registry.filter("is_active").agg(count.alias("active_events"))


def monthly_active_users(
    events: DataFrame, user: str, time: str, as_of: str, approximate: bool = False
) -> DataFrame:
    """Distinct users from 32 days before ``as_of`` up to, not including, 2 days before it.

    Spark first reduces to distinct users within each task. ``approximate`` trades the
    exact count for a sketch of fixed size.
    """
    day = date.fromisoformat(as_of)
    first, after = ((day - timedelta(days=n)).isoformat() for n in (32, 2))
    window = (F.col(time) >= F.lit(first)) & (F.col(time) < F.lit(after))
    users = F.approx_count_distinct(user) if approximate else F.count_distinct(user)
    return events.filter(window).agg(users.alias("monthly_active_users"))


def daily_user_sets(events: DataFrame, index: DataFrame, user: str, day: Column) -> DataFrame:
    """The users of each day as sets that can be united: ``day``, ``bucket``, ``users`` (a bitmap) and ``sketch`` (HLL).

    ``index`` numbers the users (``user``, ``index``; see ``numbering.grow_index``). A bucket holds 32,768 numbers in 4 KB, so a
    day has as many rows as it has buckets in use. Users are first reduced to one row per day. The sketches of a day's buckets
    unite to the day's.
    """
    seen = events.select(day.alias("day"), F.col(user)).filter(F.col(user).isNotNull() & F.col("day").isNotNull()).distinct()
    # Numbers count from 0, bitmap positions from 1.
    numbered = seen.join(index.select(F.col(user), (F.col("index") + 1).alias("_number")), user)
    return numbered.groupBy("day", F.bitmap_bucket_number("_number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("users"), F.hll_sketch_agg(user).alias("sketch")
    )


def users_of_windows(sets: DataFrame, as_of: list[str]) -> DataFrame:
    """``as_of``, ``monthly_active_users`` (exact) and ``approximate_users`` for each date, from one pass over the days' sets.

    The window is that of ``monthly_active_users``: from 32 days before the date up to, not including, 2 days before it. A day is
    united into all windows that it lies in; windows without users have no row.
    """
    first, last = min(as_of), max(as_of)
    dates = F.array(*[F.lit(d).cast("date") for d in as_of])
    inside = F.filter(dates, lambda d: (F.col("day") >= F.date_sub(d, 32)) & (F.col("day") < F.date_sub(d, 2)))
    needed = sets.filter(
        (F.col("day") >= F.lit((date.fromisoformat(first) - timedelta(days=32)).isoformat()).cast("date"))
        & (F.col("day") < F.lit((date.fromisoformat(last) - timedelta(days=2)).isoformat()).cast("date"))
    )
    united = needed.select(F.explode(inside).alias("as_of"), "bucket", "users", "sketch").groupBy("as_of", "bucket").agg(
        F.bitmap_or_agg("users").alias("users"), F.hll_union_agg("sketch").alias("sketch")
    )
    return united.groupBy("as_of").agg(
        F.sum(F.bitmap_count("users")).alias("monthly_active_users"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approximate_users"),
    )


def high_water_marks(df: DataFrame, marks: dict[str, str], kind: str | None = None) -> DataFrame:
    """Largest value per cursor column and the row count, per kind if given."""
    groups = [kind] if kind else []
    aggregates = [F.max(c).alias(name) for name, c in marks.items()]
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("rows"), *aggregates)


def meter_merge(
    metering: DataFrame, organisations: DataFrame, usage: DataFrame, counts: list[str]
) -> DataFrame:
    """The metering table with each organisation's new counts merged into its active meter.

    ``usage`` has one row per ``domain`` with the count columns. Other keys of the stored
    JSON stay, organisations without an active meter get one, and a domain without an
    active organisation fails the job.
    """
    orgs = organisations.filter("active").select(F.col("id").alias("org_id"), "domain")
    unknown = F.raise_error(F.concat(F.lit("no organisation for "), F.col("domain")))
    known = usage.join(orgs, "domain", "left").select(
        F.coalesce(F.col("org_id"), unknown.cast(orgs.schema["org_id"].dataType)).alias("org_id"),
        F.create_map(*_pairs(counts)).alias("_counts"),
    )
    stored = metering.select("org_id", "meter", "active", F.coalesce("active", F.lit(False)).alias("_live"))
    joined = stored.join(known.withColumn("_live", F.lit(True)), ["org_id", "_live"], "full_outer")
    old = F.coalesce(F.from_json("meter", "MAP<STRING, VARIANT>"), _no_counts())
    kept = F.map_filter(old, lambda k, _: ~k.isin(*counts))
    fresh = F.col("_counts")
    return joined.select(
        "org_id",
        F.when(fresh.isNotNull(), F.to_json(F.map_concat(kept, fresh))).otherwise(F.col("meter")).alias("meter"),
        F.when(fresh.isNotNull(), F.lit(True)).otherwise(F.col("active")).alias("active"),
    )


def _pairs(counts: list[str]) -> list[Column]:
    return [part for name in counts for part in (F.lit(name), F.col(name).cast("bigint").cast("variant"))]


def _no_counts() -> Column:
    return F.create_map().cast("map<string,variant>")
