"""Edge values of the scalar functions."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulsework import functions as fn


def values(spark, column, inputs, ddl="v string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, {ddl}")
    return [r.o for r in rows.select("i", column.alias("o")).orderBy("i").collect()]


def test_parse_iso_accepts_and_rejects_the_listed_shapes(spark):
    shapes = {
        "2024-01-05": datetime(2024, 1, 5),
        "2024-01-05T10": datetime(2024, 1, 5, 10),
        "2024-01-05T10Z": datetime(2024, 1, 5, 10),
        "2024-01-05 10:11": datetime(2024, 1, 5, 10, 11),
        "2024-01-05T10:11Z": datetime(2024, 1, 5, 10, 11),
        "2024-01-05T10:11+02:00": datetime(2024, 1, 5, 8, 11),
        "2024-01-05T10:11:12": datetime(2024, 1, 5, 10, 11, 12),
        "2024-01-05T10:11:12.5Z": datetime(2024, 1, 5, 10, 11, 12, 500000),
        "2024-01-05T10:11:12-05:30": datetime(2024, 1, 5, 15, 41, 12),
        "": None,
        None: None,
        "soon": None,
        "2025": None,
        "2025-01": None,
        "2025-1-1": None,
        " 2025-01-01": None,
        "2025-01-01 UTC": None,
        "20250111": None,
        "2025-W02-1": None,
        "2024-02-30": None,
        "2024-01-05T25:00:00": None,
    }
    assert values(spark, fn.parse_iso(F.col("v")), list(shapes)) == list(shapes.values())


def test_counts_from_json_text(spark):
    texts = ["12", "1000.0", "7.9", "-7.9", None, "abc", "", "1e3", "NaN"]
    assert values(spark, fn.int_or_zero(F.col("v")), texts) == [12, 1000, 7, -7, 0, 0, 0, 1000, 0]
    assert values(spark, fn.double_or_zero(F.col("v")), ["12.5", None, "x"]) == [12.5, 0.0, 0.0]


def test_a_count_beyond_int_fails_instead_of_vanishing(spark):
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        values(spark, fn.int_or_zero(F.col("v")), ["3000000000"])


def test_flags(spark):
    assert values(spark, fn.bool_or_false(F.col("v")), ["true", "false", "1", "0", None, "maybe"]) == [
        True, False, True, False, False, False,
    ]
    assert values(spark, fn.bool_unless_false_text(F.col("v")), ["false", "true", None, "False"]) == [
        False, True, True, True,
    ]


def test_falsy_json(spark):
    falsy = ["", "{}", "[]", "0", "0.0", "false", "null", None]
    assert values(spark, fn.falsy_json_to_null(F.col("v")), falsy) == [None] * 8
    assert values(spark, fn.falsy_json_to_null(F.col("v")), ['{"a":0}', "1"]) == ['{"a":0}', "1"]


def test_tags(spark):
    tags = [["a", "Goal:  x ", "Goal:y"], ["Stage:z"], [], None, ["Goal:Goal:x"], [None, "Goal:q"], ["my Goal:x"]]
    got = values(spark, fn.tag_value(F.col("v"), "Goal"), tags, "v array<string>")
    assert got == ["x", None, None, None, "Goal:x", "q", None]


def test_comma_lists(spark):
    lists = [["b", "a", "b"], [], None, ["b", None]]
    assert values(spark, fn.comma_list(F.col("v")), lists, "v array<string>") == ["b,a,b", "", "", "b"]
    assert values(spark, fn.distinct_comma_list(F.col("v")), lists, "v array<string>") == ["a,b", "", "", "b"]


def test_clock_correction_starts_at_a_minute(spark):
    at = lambda s: datetime(2024, 1, 1, 0, s // 60, s % 60)
    rows = [(at(0), at(10), at(69)), (at(0), at(10), at(70)), (None, at(10), at(70)), (at(0), None, at(70)), (at(0), at(10), None)]
    df = spark.createDataFrame(rows, "e timestamp, u timestamp, r timestamp")
    got = [r.t for r in df.select(fn.skew_corrected_time(F.col("e"), F.col("u"), F.col("r")).alias("t")).collect()]
    assert got == [at(0), at(60), None, None, None]


def test_epochs_and_days(spark):
    assert values(spark, fn.from_epoch_seconds(F.col("v")), ["1700000000", "1700000000.9", None, "x"]) == [
        datetime(2023, 11, 14, 22, 13, 20), datetime(2023, 11, 14, 22, 13, 20), None, None,
    ]
    days = values(spark, fn.days_before(F.col("v"), 3).cast("string"), ["2024-03-01", "2024-3-1", "2024-02-30", "", None, "x"])
    assert days == ["2024-02-27", "2024-02-27", None, None, None, None]


def test_day_range_keeps_the_whole_last_day(spark):
    times = [datetime(2024, 1, 1, 23, 59, 59), datetime(2024, 1, 2), datetime(2024, 1, 3, 10), datetime(2024, 1, 4), None]
    got = values(spark, fn.in_days(F.col("v"), "2024-01-02", "2024-01-03"), times, "v timestamp")
    assert got == [False, True, True, False, None]


def test_epoch_zero_is_unknown(spark):
    times = [datetime(1970, 1, 1), datetime(1970, 1, 1, 0, 0, 1), None]
    assert values(spark, fn.epoch_zero_to_null(F.col("v")), times, "v timestamp") == [None, times[1], None]


def test_least_and_greatest_skip_unknown_times(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2), None), (None, None)], "a timestamp, b timestamp")
    rows = df.select(fn.least_time(F.col("a"), F.col("b")), fn.greatest_time(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in rows] == [(datetime(2024, 1, 2), datetime(2024, 1, 2)), (None, None)]


def test_json_size_counts_objects_and_arrays(spark):
    assert values(spark, fn.json_size(F.col("v")), ['{"a":1,"b":2}', "[1,2,3]", "x", None, "{}"]) == [2, 3, 0, 0, 0]
