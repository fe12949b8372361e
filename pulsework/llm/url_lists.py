"""Temporal list join for URL filters, in DataFrame functions only.

Dated entries (``add`` and ``remove`` of a key on a list) become validity intervals. Every capture
is evaluated against the entries active when it was fetched: its keys are its host, the host's
parent domains and the URL itself, without scheme, fragment and trailing slash.

Defined results: a null URL or fetch time matches nothing and is not blocked; of entries for one
key and list at one time, ``add`` wins; repeated entries count once; repeated captures are kept.
An allowed key outranks a blocked one of equal or lesser length. An IP address stands for itself alone. Columns of the
input that have the name of a result are not kept; all others may have any name. No captures or no entries: no matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESULTS = ("host", "n_active", "matched_key", "verdict", "blocked")


def host_of(url: Column) -> Column:
    """Host in lower case, without user and port; null if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", ""))
    return F.when(host != "", host)


def page_of(url: Column) -> Column:
    """The URL without scheme, fragment and trailing slash, its host in lower case."""
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    return F.concat(host_of(url), F.regexp_replace(rest, r"/$", ""))


def keys_of(url: Column) -> Column:
    """The page, the host and its parent domains of two labels or more; an IP address has no parents."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    is_address = F.regexp_like(host, F.lit(r"^([0-9]+(\.[0-9]+){3}|\[.*\])$"))
    domains = F.transform(
        F.sequence(F.lit(1), F.when(is_address, 1).otherwise(F.greatest(F.lit(1), F.size(labels) - 1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    return F.array_distinct(F.concat(F.array(page_of(url)), domains))


def intervals(entries: DataFrame, end: str = "9999-12-31") -> DataFrame:
    """``list``, ``key``, ``valid_from``, ``valid_to`` (exclusive) from ``list``, ``key``, ``action``, ``at``.

    Entries of one key at one time are first combined, so what a window sees per key are its
    distinct times only. Intervals of one key and list never overlap.
    """
    changes = (
        entries.filter(F.col("key").isNotNull() & F.col("at").isNotNull())
        .groupBy("list", "key", "at")
        .agg(F.max((F.col("action") == "add").cast("int")).alias("on"))
    )
    per_key = Window.partitionBy("list", "key").orderBy("at")
    return (
        changes.withColumn("before", F.coalesce(F.lag("on").over(per_key), F.lit(0)))
        .filter(F.col("on") != F.col("before"))
        .withColumn("valid_to", F.coalesce(F.lead("at").over(per_key), F.lit(end).cast("timestamp")))
        .filter(F.col("on") == 1)
        .select("list", "key", F.col("at").alias("valid_from"), "valid_to")
    )


def _months(start: Column, end: Column) -> Column:
    return F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))


def evaluate(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """``captures`` with ``host``, ``n_active``, ``matched_key``, ``verdict`` and ``blocked``.

    Distinct pairs of URL and time are judged once. An as-of join by key alone would meet all intervals of
    an often changed key with all its captures; so both sides are dealt by key and month, and the interval decides within
    the month. Intervals are spread only over months in which there are captures.
    """
    kept = [F.col(f"`{c}`") for c in captures.columns if c not in RESULTS]
    # Input columns stay in a struct, so their names meet none of those used here.
    rows = captures.select(
        F.struct(*kept).alias("_row"), F.col(url_col).alias("_asked"), F.col(time_col).cast("timestamp").alias("_when")
    )
    asked = rows.select(F.col("_asked").alias("_url"), F.col("_when").alias("_at")).dropna().distinct()
    keyed = asked.select("_url", "_at", F.explode(keys_of(F.col("_url"))).alias("key")).withColumn(
        "_month", F.trunc("_at", "month")
    )
    span = asked.agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    # One row: its size is proven.
    active = (
        intervals(entries)
        .crossJoin(F.broadcast(span))
        .filter((F.col("valid_from") <= F.col("_last")) & (F.col("valid_to") > F.col("_first")))
        .select(
            "list",
            "key",
            "valid_from",
            "valid_to",
            F.explode(
                _months(F.greatest("valid_from", "_first"), F.least("valid_to", "_last"))
            ).alias("_month"),
        )
    )
    hit = keyed.join(active, ["key", "_month"]).filter(
        (F.col("valid_from") <= F.col("_at")) & (F.col("_at") < F.col("valid_to"))
    )
    rank = F.struct(F.length("key").alias("size"), (F.col("list") == "allow").alias("allow"), F.col("key"))
    judged = hit.groupBy("_url", "_at").agg(F.count(F.lit(1)).alias("n_active"), F.max(rank).alias("_best"))
    joined = rows.join(judged, (F.col("_asked") == F.col("_url")) & (F.col("_when") == F.col("_at")), "left")
    verdict = F.when(F.col("_best").isNull(), "none").when(F.col("_best.allow"), "allow").otherwise("block")
    return joined.select(
        "_row.*",
        host_of(F.col("_asked")).alias("host"),
        F.coalesce(F.col("n_active"), F.lit(0).cast("long")).alias("n_active"),
        F.col("_best.key").alias("matched_key"),
        verdict.alias("verdict"),
        (verdict == "block").alias("blocked"),
    )
