"""JSONL landing files: one pass parses, and sets malformed lines aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD_LINE = "_bad_line"
LINE = "_line"
VALUE = "_value"


def parse_lines(lines: DataFrame, record: T.StructType, keep_line: bool = False, text: str = "value") -> DataFrame:
    """Parse a text column into the record's columns plus ``_bad_line``.

    ``_bad_line`` holds the text of a line that is not a JSON object of this shape, NULL
    otherwise. A key that is merely missing gives NULL in its column.
    """
    wide = T.StructType(record.fields + [T.StructField(BAD_LINE, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    # The one-element explode keeps later filters from repeating the parse below themselves.
    parsed = lines.select(F.col(text).alias(LINE), F.explode(F.array(F.from_json(text, wide, options))).alias("r"))
    kept = [F.col(LINE)] if keep_line else []
    bad = F.when(F.col("r").isNull(), F.col(LINE)).otherwise(F.col(f"r.{BAD_LINE}"))
    return parsed.select(*[F.col(f"r.{f.name}") for f in record.fields], *kept, bad.alias(BAD_LINE))


def read_jsonl(spark: SparkSession, path: str, record: T.StructType, keep_line: bool = False) -> DataFrame:
    """All ``*.jsonl`` files below a run's folder, or one file or glob."""
    return parse_lines(_text_lines(spark, path), record, keep_line)


def _text_lines(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read
    if "*" not in path and not path.endswith(".jsonl"):
        reader = reader.option("pathGlobFilter", "*.jsonl").option("recursiveFileLookup", "true")
    return reader.text(path)


def parse_variants(lines: DataFrame, lists: list[str], text: str = "value") -> DataFrame:
    """Parse a text column into one VARIANT, ``_value``, plus ``_bad_line``: the only parse that the line ever gets.

    A line is bad if it is not one JSON object, names a key of an object twice, is larger than a VARIANT may be, or has something else than an
    array or null in one of ``lists``.
    """
    parsed = lines.select(F.col(text).alias(LINE), F.explode(F.array(F.try_parse_json(text))).alias(VALUE))
    sound = F.col(VALUE).isNotNull() & F.col(LINE).rlike(r"^[ \t\r\n]*\{")
    for name in lists:
        item = F.try_variant_get(VALUE, f"$.{name}", "variant")
        array = F.try_variant_get(VALUE, f"$.{name}", "array<variant>").isNotNull()
        sound = sound & (array | item.isNull() | F.is_variant_null(item))
    return parsed.select(VALUE, F.when(~sound, F.coalesce(LINE, F.lit(""))).alias(BAD_LINE))


def read_variants(spark: SparkSession, path: str, lists: list[str]) -> DataFrame:
    """The files of :func:`read_jsonl` as variants."""
    return parse_variants(_text_lines(spark, path), lists)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE)


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(BAD_LINE).isNotNull()).select(F.col(BAD_LINE).alias("line"))


def line_counts(parsed: DataFrame, required: list[str] | None = None) -> DataFrame:
    """One row: lines accepted, lines set aside, and good lines lacking each required value."""
    good = F.col(BAD_LINE).isNull()
    missing = [
        F.count_if(good & F.col(name).isNull()).alias(f"missing_{name.replace('.', '_')}") for name in required or []
    ]
    return parsed.agg(F.count_if(good).alias("accepted"), F.count_if(~good).alias("quarantined"), *missing)
