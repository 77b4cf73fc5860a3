"""Session settings and the shared folder used for checkpoints and written state."""

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library is tuned for. AQE sizes the reducers, turns joins into broadcasts from the
# measured size of a side, and splits skewed join partitions even where that costs one more shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app_name: str = "crossfade", cpus: str | int = "*", **extra: str) -> SparkSession:
    """Single-machine session for tests and the bench; on a cluster pass your own session instead."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
    partitions = os.cpu_count() if cpus == "*" else int(cpus)
    settings = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": "12g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, or the checkpoint folder the
    context was given.

    Only a local master may run without either; it then gets a fresh temporary folder. On a cluster
    a missing setting is an error, since a machine-local folder dies with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="crossfade-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")
