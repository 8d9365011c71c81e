"""Spark session for the suite.

On a cluster the session comes from ``spark-submit`` and its configuration
is left alone (shuffle partitions, memory and broadcast threshold belong to
the deployment).  For ``local[...]`` runs (tests, the benchmark) a few
settings are fixed so results and timings are reproducible.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# settings for local runs only
LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # dimension sides below this estimated size are broadcast; Spark checks
    # each side's size (and AQE re-checks at run time) before choosing it
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # PySpark records the Python call site of every API call for error
    # messages (a stack walk and JVM round trips per call); building the
    # wide query plans then costs seconds on the driver
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "starloom") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    local = bool(master and master.startswith("local"))
    if master:
        builder = builder.master(master)
    if local:
        for k, v in LOCAL_DEFAULTS.items():
            builder = builder.config(k, v)
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        builder = builder.config("spark.driver.memory", os.environ.get("STARLOOM_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """One JVM: local, local[n], local[*]; local-cluster has executors of its own."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as is; only when
    it is unset on a local master (tests) a fresh scratch folder is set.  On a
    cluster a machine-local folder would be lost or unseen, so that is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        # set at startup: SparkContext already uses it for checkpoint()
        return current
    if not is_local(spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="starloom-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
