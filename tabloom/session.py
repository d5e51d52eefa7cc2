"""Session defaults shared by tests, bench and the query registry."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every query relies on: ANSI arithmetic, UTC wall clock, AQE.
_SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(master: str | None = None, partitions: int = 8, app: str = "tabloom",
                driver_memory: str = "8g") -> SparkSession:
    """Local session for tests and the bench; on a cluster use the provided session."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", driver_memory)
         .config("spark.sql.shuffle.partitions", str(partitions))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in _SQL_DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Pin the SQL settings the operators assume on a session we did not build."""
    for k, v in _SQL_DEFAULTS.items():
        if k == "spark.sql.session.timeZone" or spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is set by the deployment and only read here; a
    missing setting is an error there.  A local folder is created only under a
    local master when nothing is configured (tests, bench).
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d and not (spark.sparkContext.master + "[").startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="tabloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d
