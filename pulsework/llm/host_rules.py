"""Host-level quality rules in DataFrame functions only.

Each document is measured within its own row. Rule failures are then counted per host, the rates
are shrunk with a beta prior fitted to all hosts, and hosts with a bad shrunk rate are rejected
with all their documents.

Defined results: a null or empty text has no words and fails; a null host has no verdict, so its
documents stand on their own; repeated rows give repeated results and count as often. Columns of
the input that have the name of a result are not kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsework.session import new_work_dir

_SPACE = r"[\x20\x09-\x0D]+"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rules:
    """Limits per document and per host."""

    least_words: int = 50
    most_repeat_percent: int = 50
    most_symbol_percent: int = 20
    most_dup_lines: int = 30
    host_rate: float = 0.75
    host_documents: int = 10


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE), lambda w: w != F.lit(""))


def _covered(words: Column) -> Column:
    """Words within three-word windows that occur at least twice.

    Windows are sorted by hash, so equal ones are neighbours. Repeated windows in order of
    place then cover three words each, less what the window before has covered.
    """
    windows = F.when(
        F.size(words) >= 3,
        F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size(words) - 3),
                lambda i: F.struct(F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("h"), i.alias("i")),
            )
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))

    def repeated(w: Column) -> Column:
        # F.get gives null outside the array, and a comparison with null keeps nothing.
        alike = lambda x, k: F.coalesce(x["h"] == F.get(w, k - 1)["h"], F.lit(False)) | F.coalesce(
            x["h"] == F.get(w, k + 1)["h"], F.lit(False)
        )
        return F.sort_array(F.transform(F.filter(w, alike), lambda x: x["i"]))

    def lengths(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
            F.lit(0).cast("bigint"),
            lambda total, x: total + x,
        )

    # Each step is the variable of a one-element transform, so that it is computed once per row.
    return F.transform(F.transform(F.array(windows), repeated), lengths)[0]


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the five measures of each whole text; no shuffle."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
            _covered(words).alias("n_repeat_words"),
        )

    found = F.transform(F.array(_words(text)), counts)[0]
    doubled = F.transform(F.array(lines), lambda all_: F.size(all_) - F.size(F.array_distinct(all_)))[0]
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in MEASURES]
    # Input columns stay in a struct, so their names meet none of those used here.
    return docs.select(
        F.struct(*kept).alias("_row"),
        found.alias("_found"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        doubled.cast("long").alias("n_dup_lines"),
    ).select("_row.*", "_found.n_words", "_found.word_chars", "n_symbols", "n_dup_lines", "_found.n_repeat_words")


def base_failed(rules: Rules) -> Column:
    return (F.col("n_words") < rules.least_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.most_repeat_percent
    )


def any_failed(rules: Rules) -> Column:
    """All rules of a document, as the host is judged by them."""
    return (
        base_failed(rules)
        | (F.col("n_symbols") * 100 > F.col("word_chars") * rules.most_symbol_percent)
        | (F.col("n_dup_lines") > rules.most_dup_lines)
    )


def host_verdicts(rows: DataFrame, host_col: str, failed: Column, rules: Rules) -> DataFrame:
    """``host``, its documents and those that ``failed``, the shrunk ``rate`` and ``host_bad``.

    The prior's mean is the mean of the hosts' rates and its weight comes from their spread (method of moments,
    kept between 1 and 1000 documents). Counting combines before the shuffle, so a host with a
    third of all rows costs no more than another.
    """
    hosts = (
        rows.filter(F.col(host_col).isNotNull())
        .groupBy(F.col(host_col).alias("host"))
        .agg(F.count(F.lit(1)).alias("documents"), F.sum(failed.cast("long")).alias("failures"))
    )
    rate = F.col("failures") / F.col("documents")
    prior = hosts.agg(F.avg(rate).alias("mean"), F.coalesce(F.var_samp(rate), F.lit(0.0)).alias("spread")).select(
        "mean",
        F.least(
            F.lit(1000.0),
            F.greatest(
                F.lit(1.0),
                F.when(F.col("spread") > 0, F.col("mean") * (1 - F.col("mean")) / F.col("spread") - 1).otherwise(1000.0),
            ),
        ).alias("weight"),
    )
    # One row beside each host: its size is proven.
    shrunk = (F.col("failures") + F.col("mean") * F.col("weight")) / (F.col("documents") + F.col("weight"))
    return hosts.crossJoin(F.broadcast(prior)).select(
        "host",
        "documents",
        "failures",
        shrunk.alias("rate"),
        ((shrunk > rules.host_rate) & (F.col("documents") >= rules.host_documents)).alias("host_bad"),
    )


def judge(measured: DataFrame, host_col: str = "source", rules: Rules = Rules()) -> DataFrame:
    """Measured documents with ``base_failed``, ``host_rate`` and ``kept``.

    The verdicts on hosts are a written table: Spark then knows their size when it decides whether to
    broadcast them.
    """
    path = new_work_dir(measured.sparkSession, "hosts")
    host_verdicts(measured, host_col, any_failed(rules), rules).write.parquet(path)
    verdicts = measured.sparkSession.read.parquet(path).select(
        F.col("host").alias("_host"), F.col("rate").alias("_rate"), F.col("host_bad").alias("_bad")
    )
    own = ("base_failed", "host_rate", "kept")
    kept = [F.col(f"`{c}`") for c in measured.columns if c not in own]
    rows = measured.select(F.struct(*kept).alias("_row"), F.col(host_col).alias("_source"), base_failed(rules).alias("_base"))
    return rows.join(verdicts, F.col("_source") == F.col("_host"), "left").select(
        "_row.*",
        F.col("_base").alias("base_failed"),
        F.col("_rate").alias("host_rate"),
        (~F.col("_base") & ~F.coalesce(F.col("_bad"), F.lit(False))).alias("kept"),
    )


def judge_documents(
    docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", rules: Rules = Rules()
) -> DataFrame:
    """Id, host, measures and verdict of each document. The measures are written once, the texts are not moved."""
    slim = docs.select(F.col(id_col), F.col(host_col), F.col(text_col))
    path = new_work_dir(docs.sparkSession, "measures")
    measure(slim, text_col).drop(text_col).write.parquet(path)
    return judge(docs.sparkSession.read.parquet(path), host_col, rules)


def keep_good(docs: DataFrame, host_col: str = "source", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The documents that are kept, all columns unchanged.

    They are measured once: each row is written with its two flags for the hosts' verdicts, without the document
    where that fails by itself.
    """
    held = docs.select(F.struct("*").alias("_row"), F.col(host_col).alias("_source"), F.col(text_col).alias("_text"))
    path = new_work_dir(docs.sparkSession, "judged")
    measure(held, "_text").select(
        "_source",
        base_failed(rules).alias("_base"),
        any_failed(rules).alias("_any"),
        F.when(~base_failed(rules), F.col("_row")).alias("_row"),
    ).write.parquet(path)
    judged = docs.sparkSession.read.parquet(path)
    hosts = new_work_dir(docs.sparkSession, "hosts")
    host_verdicts(judged, "_source", F.col("_any"), rules).filter("host_bad").select("host").write.parquet(hosts)
    bad = docs.sparkSession.read.parquet(hosts)
    return judged.filter(~F.col("_base")).join(bad, F.col("_source") == F.col("host"), "left_anti").select("_row.*")
