"""An upsert as an aggregate over a log of loads.

A log holds the rows of all loads with the load's number. What a chain of upserts would have left of a key is an
associative aggregate of its rows, so Spark combines before the shuffle, and any prefix of the log can be folded
into one load of its result:

* the earliest row gives the columns that a match does not change;
* without a guard, the latest row gives the others;
* with a guard, they come from the row with the greatest guard, the earliest among equals. A NULL guard never wins, and if the
  earliest row has one, nothing changes that row any more, as no value is greater than NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOAD = "load"


@dataclass(frozen=True)
class UpsertRule:
    """``update_cols`` are changed on a match (default: all but the keys), ``newer_by`` is the guard.

    Keys compare as in SQL: a row lacking a part of its key matches nothing, unless ``null_safe`` makes NULL equal to NULL.
    """

    keys: tuple[str, ...]
    update_cols: tuple[str, ...] | None = None
    newer_by: str | None = None
    null_safe: bool = False

    def changed(self, columns: list[str]) -> list[str]:
        named = {*(self.update_cols if self.update_cols is not None else columns), self.newer_by}
        return [c for c in columns if c in named and c not in self.keys]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _struct(columns: list[str]) -> str:
    return f"named_struct({', '.join(f'{_literal(c)}, {_q(c)}' for c in columns)})"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _aggregates(rule: UpsertRule, columns: list[str]) -> dict[str, str]:
    rest, changed = [c for c in columns if c not in rule.keys], rule.changed(columns)
    found = {"first_row": f"min_by({_struct(rest)}, {LOAD})"} if rest else {}
    if changed and rule.newer_by:
        guard = _q(rule.newer_by)
        found["last_row"] = f"max_by({_struct(changed)}, struct({guard}, -{LOAD})) FILTER (WHERE {guard} IS NOT NULL)"
    elif changed:
        found["last_row"] = f"max_by({_struct(changed)}, {LOAD})"
    return found


def _results(rule: UpsertRule, columns: list[str]) -> list[str]:
    changed = set(rule.changed(columns))

    def value(column: str) -> str:
        name = _q(column)
        if column in rule.keys:
            return name
        if column not in changed:
            return f"first_row.{name} AS {name}"
        if not rule.newer_by:
            return f"last_row.{name} AS {name}"
        return f"CASE WHEN first_row.{_q(rule.newer_by)} IS NULL THEN first_row.{name} ELSE last_row.{name} END AS {name}"

    return [value(c) for c in columns]


def _whole(rule: UpsertRule) -> str:
    return "true" if rule.null_safe else " AND ".join(f"{_q(k)} IS NOT NULL" for k in rule.keys)


def merged(log: DataFrame, rule: UpsertRule) -> DataFrame:
    """The table that the loads of a log make, upserted one after the other; ``log`` has the column ``load``.

    Within a load every key stands once.
    """
    columns = [c for c in log.columns if c != LOAD]
    found = [F.expr(e).alias(n) for n, e in _aggregates(rule, columns).items()]
    keys = [F.col(_q(k)) for k in rule.keys]
    whole = log.filter(_whole(rule))
    rows = (whole.groupBy(*keys).agg(*found) if found else whole.select(*keys).distinct()).selectExpr(*_results(rule, columns))
    if rule.null_safe:
        return rows
    return rows.unionByName(log.filter(f"NOT ({_whole(rule)})").select(*[F.col(_q(c)) for c in columns]))


def merged_sql(table: str, columns: list[str], rule: UpsertRule) -> str:
    """The same as a query on a stored log, for a view."""
    keys, found = ", ".join(map(_q, rule.keys)), _aggregates(rule, columns)
    inner = ", ".join([keys, *(f"{e} AS {n}" for n, e in found.items())])
    grouped = (
        f"SELECT {', '.join(_results(rule, columns))} FROM (SELECT {inner} FROM {table} WHERE {_whole(rule)} GROUP BY {keys})"
    )
    if rule.null_safe:
        return grouped
    return f"{grouped} UNION ALL SELECT {', '.join(map(_q, columns))} FROM {table} WHERE NOT ({_whole(rule)})"
