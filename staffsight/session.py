"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators assume. Session time zone UTC keeps date arithmetic on
# timestamps stable; AQE coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "staffsight", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above; used by tests and bench."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("STAFFSIGHT_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant folder and is
    used as is. Where it is unset a local master (tests) gets a scratch folder, and any
    other master is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="staffsight-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def let_go(spark: SparkSession) -> None:
    """Free the plans, broadcasts and shuffle files that nothing refers to any more; the driver's JVM
    else collects its garbage, on which their removal waits, only when its heap is full."""
    gc.collect()
    spark._jvm.System.gc()
