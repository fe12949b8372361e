"""Null-safe coercions of values that arrive as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def double_or_zero(value: Column) -> Column:
    """Missing, null and non-numeric become 0.0."""
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def int_or_zero(value: Column, to: str = "int") -> Column:
    """Missing, null and non-numeric become 0; a fraction is cut off, not rounded.

    The step through DOUBLE is needed because ``1000.0`` is a legal JSON count and does
    not cast to INT directly. A count beyond the target type raises under ANSI mode
    instead of turning into a silent zero.
    """
    return F.nanvl(double_or_zero(value), F.lit(0.0)).cast(to)


def bool_or_false(value: Column) -> Column:
    return F.coalesce(value.try_cast("boolean"), F.lit(False))


def bool_unless_false_text(value: Column) -> Column:
    """Only the value false is false: NULL and any other text count as true."""
    return F.when(value.cast("string") == "false", F.lit(False)).otherwise(F.lit(True))


def falsy_json_to_null(value: Column) -> Column:
    """JSON text whose value is empty, zero or false carries no information; drop it."""
    # The JSON spellings of an empty or false value.
    return F.when(~value.isin("", "{}", "[]", "0", "0.0", "false", "null"), value)


def json_path(value: Column, path: str) -> Column:
    return F.get_json_object(value, path)


def json_size(value: Column) -> Column:
    """Number of entries of a JSON object or array given as text, 0 for anything else."""
    return F.coalesce(F.json_array_length(value), F.size(F.json_object_keys(value)), F.lit(0))
