"""The sync state as a stateful stream over run events.

Spark keeps the fold of every report in its state store: a streaming aggregation in update mode, whose changed rows go
into a published table after each batch. What a batch writes is merged, not appended, so a replayed batch changes nothing,
and a restart goes on from the checkpoint. Counts of runs per report and day are a second, windowed aggregation in append mode:
a day is written once, when the watermark has passed its end, and its state is dropped.

Both queries' checkpoints and tables lie under ``root``, which must be on shared storage.
"""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reportflow.operators.state import combine_partial, finalize_state, fold_partial
from reportflow.session import checkpoint_dir
from reportflow.sources import files
from reportflow.sources.tables import DEFAULT_SYNC_START
from reportflow.streaming.stream import run_stream


def _state(root: str) -> str:
    return os.path.join(root, "streamed_state")


def _published(spark: SparkSession, root: str) -> tuple[int, str | None]:
    number, content = files.read_pointer(spark, _state(root))
    return number, content.get("partial")


def _publish(changed: DataFrame, root: str) -> None:
    """Merge the reports that a batch changed into the published partial folds."""
    spark = changed.sparkSession
    checkpoint_dir(spark)
    number, before = _published(spark, root)
    if before is not None:
        changed = combine_partial(spark.read.parquet(os.path.join(_state(root), before)), changed)
    name = f"v-{files.fresh_name()}"
    changed.write.parquet(os.path.join(_state(root), name))
    files.write_pointer(spark, _state(root), number, {"partial": name})
    for old in files.names(spark, _state(root)):   # the version before stays for those who read it
        if old.startswith("v-") and old not in (name, before):
            files.delete(spark, os.path.join(_state(root), old))


def stream_state(events: DataFrame, root: str, default_start: datetime = DEFAULT_SYNC_START, available_now: bool = True,
                 interval: str = "2 minutes") -> StreamingQuery:
    """Fold a stream of run events (``schemas.RUN_EVENTS``) into the state per report."""
    def write(changed: DataFrame, batch_id: int) -> None:
        _publish(changed, root)

    return run_stream(fold_partial(events, default_start), write, os.path.join(root, "_checkpoint", "state"),
                      available_now, interval, mode="update")


def read_streamed_state(spark: SparkSession, root: str) -> DataFrame:
    """The state table as of the last batch."""
    _, name = _published(spark, root)
    if name is None:
        raise ValueError(f"no streamed state under {root}")
    return finalize_state(spark.read.parquet(os.path.join(_state(root), name)))


def run_days(events: DataFrame, late: str = "0 seconds") -> DataFrame:
    """Per report and day: runs that ended, their failures and records. On a stream, a day closes (and is given once)
    when an event later than its end by more than ``late`` has come; events of closed days are dropped."""
    ended = F.col("event").isin("SUCCESS", "FAILED")
    rows = events.withWatermark("event_ts", late) if events.isStreaming else events
    return (rows.groupBy("report_id", F.window("event_ts", "1 day").alias("w"))
            .agg(F.sum(ended.cast("long")).alias("runs"), F.sum((F.col("event") == "FAILED").cast("long")).alias("failed"),
                 F.sum(F.when(F.col("event") == "SUCCESS", F.col("records")).otherwise(0)).alias("records"))
            .select("report_id", F.col("w.start").alias("day"), "runs", "failed", "records"))


def stream_run_days(events: DataFrame, root: str, late: str = "0 seconds", available_now: bool = True,
                    interval: str = "2 minutes") -> StreamingQuery:
    """Write the closed days of ``run_days`` under ``root``; a replayed batch overwrites its own folder."""
    def write(closed: DataFrame, batch_id: int) -> None:
        if not closed.isEmpty():
            closed.write.mode("overwrite").parquet(os.path.join(root, "run_days", f"batch={batch_id}"))

    return run_stream(run_days(events, late), write, os.path.join(root, "_checkpoint", "run_days"), available_now, interval)
