"""What every run leaves, scheduled or streamed: outbox, rejects, dead letters and run events, in one layout.

Folders are partitioned by (report_id, run_id); a run that is started again overwrites its own and nothing else. Run
events are appended by attempt, so none is ever lost or mistaken for an earlier one.
"""

from __future__ import annotations

import os
import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportflow import schemas
from reportflow.operators import delivery as dl
from reportflow.sources import state_store as store


def write_run(df: DataFrame, root: str, name: str, run_id: str) -> None:
    """Rows (with report_id) of one run; a repeated run overwrites its own folders."""
    (df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("report_id", "run_id").parquet(os.path.join(root, name)))


def append_events(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    """Run events of one attempt, as an append of their own."""
    if rows:
        store.append_run_events(spark.createDataFrame(rows, schemas.RUN_EVENTS).coalesce(1), root)


def next_seq() -> int:
    """Orders the events of attempts with the same event time: later attempts count."""
    return time.time_ns()


def chain_text(spark: SparkSession, error: BaseException) -> str:
    """The failure text with all causes."""
    rows, e = [], error
    while e is not None:
        rows.append((1, len(rows), str(e)))
        e = e.__cause__
    causes = spark.createDataFrame(rows, "failure_id int, depth int, message string")
    return dl.error_chain(causes).first()["chain"]


def write_dead_letters(spark: SparkSession, root: str, run_id: str, bodies: DataFrame, at: datetime) -> None:
    """bodies: report_id, json."""
    letters = dl.dead_letters(bodies, F.col("json"), F.col("report_id"), failed_at=F.lit(at))
    write_run(letters, root, "dead_letters", run_id)
