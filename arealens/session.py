"""Session defaults the operators are written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str = "arealens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the pinned settings; cluster sizing is left to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Where none is set, a local session gets a scratch folder; a cluster gets a folder on its default
    file system, and none at all if that is machine-local.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        return tempfile.mkdtemp(prefix="arealens-")
    default = spark._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    if default.startswith("file:"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{default.rstrip('/')}/tmp/arealens"
