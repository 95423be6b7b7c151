"""Session settings shared by the jobs, the tests and the bench."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "palmares", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on and a UTC clock.

    ``conf`` overrides or adds Spark settings (underscores stand for dots are not
    interpreted: pass real names through ``**{"spark.x": v}``).
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Plans of a hundred steps: do not look up the Python call site of every expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediates, on storage every executor can reach.

    The parent is the cluster's ``spark.checkpoint.dir``, else its warehouse folder, which on a cluster must
    not be a folder of one machine. The folder is removed when the session's JVM ends: results may be read until then.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        scheme = spark._jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()
        if scheme == "file" and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()
