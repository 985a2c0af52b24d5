"""Session settings and the shared folder used for staged data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Instants are compared in UTC everywhere; the rest lets AQE size partitions at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Log lines may be up to a megabyte each: bound Arrow batches by bytes, not only by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def build_session(app_name: str = "proofline", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; ``master`` is only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_settings(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings results depend on to a session built elsewhere."""
    for key in ("spark.sql.session.timeZone", "spark.sql.execution.arrow.maxBytesPerBatch"):
        spark.conf.set(key, SETTINGS[key])
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``."""
    return named_folder(spark, f"{purpose}-{uuid.uuid4().hex}")


def named_folder(spark: SparkSession, name: str) -> str:
    """A path below the folder the cluster names in ``spark.checkpoint.dir``.

    Every executor can read that folder, so tables staged there survive the loss of an executor.
    Only a local session without the setting falls back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="proofline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/proofline/{name}"
