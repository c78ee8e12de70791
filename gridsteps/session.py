"""Session helpers: shared work folder and the settings the library expects."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_base: str | None = None


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path below the shared folder of the cluster.

    The base is ``spark.checkpoint.dir`` of the session. Only a local session
    without that setting falls back to a temporary folder; on a cluster a
    machine-local folder would be lost with its executor, so that is an error.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _local_base = _local_base or tempfile.mkdtemp(prefix="gridsteps-")
        base = _local_base
    # A full URI: what Spark's default file system means by a bare path, everybody must mean.
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return f"{whole.rstrip('/')}/gridsteps/{label}-{uuid.uuid4().hex}"


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings that results or plans depend on; sizes stay with the cluster."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
