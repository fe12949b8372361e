"""Write, audit, publish: loads are checked where they are written and shown only if they hold.

Required values and allowed values are counted by the write itself. Repeated keys are then looked for among the written rows, of which only the
key columns are read. A load that breaks a rule leaves everything as it was served, and its violations are returned.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pulsework import sinks
from pulsework.operators.quality import check_domain, check_unique
from pulsework.session import discard, new_work_dir

VIOLATIONS = "check STRING, column STRING, value STRING, rows BIGINT"


@dataclass(frozen=True)
class Rules:
    """``key`` tells rows apart, ``required`` columns are never NULL, ``domains`` names the values that a column may have.

    As in SQL, a key with a NULL part repeats no other, and NULL lies in every domain.
    """

    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    domains: Mapping[str, list] = field(default_factory=dict)


class Rejected(ValueError):
    """A load broke its rules; ``violations`` says how, in rows of ``VIOLATIONS``."""

    def __init__(self, target: str, violations: DataFrame):
        super().__init__(f"the rows for {target} break their rules, nothing was changed")
        self.violations = violations


def _watched(df: DataFrame, rules: Rules) -> tuple[DataFrame, Observation]:
    """Rows that count, as they are written, what they lack and what is outside its domain."""
    seen = Observation("rules")
    lacking = [F.count_if(F.col(c).isNull()).alias(f"required {c}") for c in rules.required]
    outside = [F.count_if(~F.col(c).isin(allowed)).alias(f"domain {c}") for c, allowed in rules.domains.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *lacking, *outside), seen


def _violations(written: DataFrame, rules: Rules, counts: Mapping[str, int]) -> DataFrame | None:
    """One row per column that lacks values, per value outside its domain and per repeated key; None if there are none."""
    spark = written.sparkSession
    lacking = [("required", c, None, counts[f"required {c}"]) for c in rules.required if counts[f"required {c}"]]
    found = [spark.createDataFrame(lacking, VIOLATIONS)] if lacking else []
    for column, allowed in rules.domains.items():
        if counts[f"domain {column}"]:
            values = check_domain(written, column, allowed)
            found.append(values.select(F.lit("domain"), F.lit(column), F.col(column).cast("string"), "rows"))
    if rules.key:
        repeated = check_unique(written.select(*rules.key), list(rules.key))
        found.append(repeated.select(F.lit("key"), F.lit(",".join(rules.key)), F.to_json(F.struct(*rules.key)), "rows"))
    if not found:
        return None
    path, kept = new_work_dir(spark, "violations"), Observation("violations")
    rows = reduce(DataFrame.unionAll, found).toDF("check", "column", "value", "rows")
    rows.observe(kept, F.count(F.lit(1)).alias("n")).write.parquet(path)
    if kept.get["n"]:
        return spark.read.schema(rows.schema).parquet(path)
    discard(spark, path)
    return None


def publish_checked(
    df: DataFrame, name: str, rules: Rules, root: str | None = None, partition_by: list[str] | None = None, keep: int = 2
) -> DataFrame | None:
    """``sinks.publish``, but the view moves only if the new copy keeps the rules; else that copy goes and its violations are returned.

    Nobody sees the copy while it is checked. None says that the view has moved.
    """
    watched, seen = _watched(df, rules)
    copy = sinks.write_copy(watched, name, root, partition_by)
    violations = _violations(df.sparkSession.table(copy), rules, seen.get)
    if violations is None:
        sinks.show_copy(df.sparkSession, name, copy, df.columns, keep)
    else:
        sinks.drop_copy(df.sparkSession, copy)
    return violations


def load_checked(df: DataFrame, rules: Rules, load: Callable[[DataFrame], object]) -> DataFrame | None:
    """Hand the rows to ``load`` if they keep the rules; else nothing is loaded and the violations are returned.

    For loads that are merged into a table: they are computed once, into the shared work folder, and checked there. ``load`` has
    to use them up, since the folder goes afterwards.
    """
    spark, path = df.sparkSession, new_work_dir(df.sparkSession, "staged")
    watched, seen = _watched(df, rules)
    watched.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    violations = _violations(rows, rules, seen.get)
    if violations is None:
        load(rows)
    discard(spark, path)
    return violations
