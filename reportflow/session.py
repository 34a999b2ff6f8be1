"""Spark session defaults for report runs.

UTC everywhere (stored checkpoints are instants), AQE on so the runtime can
coalesce small shuffles and split skewed join partitions, and no web UI.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.caseSensitive": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of DataFrames no longer referenced are removed by the context cleaner.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app_name: str = "reportflow",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    settings.setdefault("spark.driver.memory", os.environ.get("REPORTFLOW_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared lineage-cut folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name shared storage; it is read, never
    overridden. Only in local mode with the setting unset (tests) is a
    scratch folder made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    path = fallback or tempfile.mkdtemp(prefix="reportflow-ckpt-")
    sc.setCheckpointDir(path)
    return path
