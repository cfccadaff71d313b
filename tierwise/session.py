"""Session helpers: a scale-aware session builder and the shared folder.

The shared folder is the one the cluster names in ``spark.checkpoint.dir``.
We only create one of our own when the session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; all are plain Spark SQL configs.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark 4 default is ANSI on; we keep it and use try_cast where the
    # reference expects null-on-failure.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Hive-style partition values stay text ("04"), never re-typed to int.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tierwise",
          extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "8g"))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). When
    neither is set, a session on a local master gets one of our own; on a
    cluster that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:       # e.g. a Spark Connect session: no driver-side context
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.conf.get("spark.master", "").startswith("local"):
            # a machine-local folder is no shared one: executors couldn't read each other's files
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tierwise-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:   # core confs may be read-only at runtime; the context setter below suffices
            pass
    if sc is None:
        return d.rstrip("/")
    sc.setCheckpointDir(d)
    return (sc.getCheckpointDir() or d).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    base = shared_dir(spark)
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith("file:"):
        os.makedirs(path[len("file:"):], exist_ok=True)
    elif "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its path class: whatever store the cluster uses."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at
