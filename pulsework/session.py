"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_fallback_root: str | None = None


def build_session(
    app_name: str = "pulsework",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Data dates are UTC dates; a session with another zone would move rows across midnight."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def work_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only where the setting is absent in a local session does this fall back to a folder of its own;
    on a cluster such a folder would be another one on each machine.
    """
    global _fallback_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if _fallback_root is None:
        _fallback_root = tempfile.mkdtemp(prefix="pulsework-")
    return _fallback_root


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, so a retried job never reads half of an older run."""
    return f"{work_root(spark)}/pulsework/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
