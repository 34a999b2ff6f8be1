"""Many reports, one scan (section 7.3 of the survey).

The shipped facility reports differ only in the facility literal. Run one by
one, N facilities cost N scans of the fact tables. Here the facility literal
becomes a join with a ``report_watermarks`` view (facility, report_id,
checkpoint): one scan serves every report, each row is tagged with its report
and filtered by that report's own checkpoint. The smallest checkpoint is also
bound as a literal, so the scan still prunes by time.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportflow.sources.tables import DEFAULT_SYNC_START, run_report_sql

WATERMARK_VIEW = "report_watermarks"
# Above this many reports the watermark table is left to the planner (no broadcast hint).
MAX_BROADCAST_WATERMARKS = 100_000


def register_watermarks(spark: SparkSession, watermarks: DataFrame) -> datetime:
    """Register ``watermarks`` (facility, report_id, checkpoint) and return the smallest checkpoint."""
    stats = watermarks.agg(F.min("checkpoint").alias("lo"), F.count(F.lit(1)).alias("n")).first()
    view = F.broadcast(watermarks) if stats["n"] <= MAX_BROADCAST_WATERMARKS else watermarks
    view.createOrReplaceTempView(WATERMARK_VIEW)
    lo = stats["lo"]
    if lo is None:
        return DEFAULT_SYNC_START
    return lo if lo.tzinfo is not None else lo.replace(tzinfo=timezone.utc)


def run_shared_report(spark: SparkSession, sql: str, watermarks: DataFrame,
                      params: dict | None = None) -> DataFrame:
    """Run a template SQL that joins ``report_watermarks``; ``:lastSyncTimestamp`` is the lowest bound."""
    lo = register_watermarks(spark, watermarks)
    args = {"lastSyncTimestamp": lo}
    args.update(params or {})
    return run_report_sql(spark, sql, args)
