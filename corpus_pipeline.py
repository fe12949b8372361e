"""The corpus pipeline: quality, near duplicates, decontamination, secrets, tokens.

Each stage works on all that the stage before kept, and takes ``(spark, docs, sf_dir)``. Its result is
written as Parquet and read again as the next one's input. All but the last return the columns of
documents.

Defined results: rows with null or empty texts go in the first stage (fewer than 50 words); rows
with a null id stay in the second; other columns pass unchanged; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsework.llm import bpe, decontaminate, host_rules, probminhash, secret_scan
from pulsework.llm.catalog import VOCABULARY
from pulsework.llm.shipping import ship
from pulsework.session import new_work_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return host_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return probminhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return secret_scan.redact_secrets(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe.round_trip(docs, VOCABULARY)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

# Sketches, edit distances and merges are beyond SQL: the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_work_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
