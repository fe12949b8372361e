"""Names, tags and comma lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What marks a control group, and the white space a tag is stripped of.
CONTROL_PREFIX = "Control"
_BLANKS = " \t\n\r\x0b\x0c"


def is_control_name(name: Column) -> Column:
    return F.coalesce(F.startswith(name, F.lit(CONTROL_PREFIX)), F.lit(False))


def tag_value(tags: Column, label: str) -> Column:
    """Text after ``label:`` in the first tag that has it, e.g. ``tag_value(tags, "Goal")``."""
    prefix = f"{label}:"
    hits = F.filter(tags, lambda tag: F.startswith(tag, F.lit(prefix)))
    first = F.try_element_at(hits, F.lit(1))
    return F.trim(F.substring(first, len(prefix) + 1, 2**31 - 1), F.lit(_BLANKS))


def comma_list(items: Column) -> Column:
    return F.coalesce(F.array_join(items, ","), F.lit(""))


def distinct_comma_list(items: Column) -> Column:
    return comma_list(F.array_sort(F.array_distinct(F.array_compact(items))))
