"""Scheduled report runs as a Structured Streaming query.

The original polled on a timer and re-read everything after its checkpoint.
Here new source files arrive as micro-batches and ``foreachBatch`` runs the
report. Three scopes:

* ``batch``: the report's SQL runs over the micro-batch's rows (right for
  row-level reports).
* ``recompute``: for aggregating reports a micro-batch holds only part of a
  period (T13). The batch only says which periods changed: the SQL re-aggregates
  exactly those months from the full source table (their time ranges are pushed
  into its scan). A late file of an old month re-reads that month only.
* ``merge``: the same without reading anything again, for reports whose measures can be merged: the SQL runs over the batch's
  rows, and its share is merged with the kept ones of the same periods (``operators.partials``).

A batch does all that a scheduled run does, in the same layout under the same root, so streams and scheduled runs, and
several streams, share one store: the values sent go to ``sent_values`` and the sets to ``outbox``, rejects to ``rejects``,
all by (report, run) with the batch as the run; cells are upserted; the run event tells sets (T15) and the checkpoint, which
never moves back except by a reset. A replay after a lost executor or driver overwrites its own folders and upserts the same
cells. A batch that fails leaves a FAILED event and its rows' sets (or the definition) as dead letters, and the stream stops.

Progress lives in the stream's checkpoint folder, which must be on shared storage.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reportflow.operators import partials
from reportflow.operators.delivery import dvs_json, run_counts
from reportflow.operators.dvs import nest_dvs, rejected_rows, report_values_long
from reportflow.operators.state import finalize_state, run_event
from reportflow.plans import outputs
from reportflow.plans.report_run import month_rows, restricted_view, touched_months
from reportflow.session import checkpoint_dir
from reportflow.sources import state_store
from reportflow.sources.reports import Report
from reportflow.sources.tables import DEFAULT_SYNC_START, report_params, run_report_sql

#: A bound that no event time is before.
BEFORE_ALL = datetime(1, 1, 2, tzinfo=timezone.utc)


def stream_root(spark: SparkSession, name: str = "stream") -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "reportflow", f"{name}-{uuid.uuid4().hex[:12]}")


def _as_utc(ts):
    if isinstance(ts, datetime) and ts.tzinfo is None:
        return ts.replace(tzinfo=timezone.utc)
    return ts


def _checkpoint(spark: SparkSession, sink: str, report_id: str) -> datetime | None:
    """The report's checkpoint as the log has it now (a reset puts it back)."""
    state = finalize_state(state_store.current_partial(spark, sink, DEFAULT_SYNC_START)[0])
    found = state.filter(F.col("report_id") == report_id).select("last_sync_timestamp").first()
    return _as_utc(found[0]) if found else None


def report_batch_writer(report: Report, view: str, sink: str, time_col: str,
                        order_by: Sequence[str] | None = None, scope: str = "batch", folds: Mapping[str, str] | None = None,
                        period_col: str | None = None, max_shares: int = partials.MAX_SHARES):
    """``foreachBatch`` function for ``report``; see the module notes for ``scope``.

    With ``scope="merge"``, ``folds`` says how each measure column of the report's result is merged, and ``period_col`` is the
    result column that holds the period (default: that of the report's grouping).
    """
    if scope not in ("batch", "recompute", "merge"):
        raise ValueError(f"scope must be 'batch', 'recompute' or 'merge', got {scope!r}")
    if scope == "merge" and not folds:
        raise ValueError("scope 'merge' needs the folds of the report's measures")
    period_col = period_col or (report.groupBy.period if report.groupBy else "period")

    def over_batch(spark: SparkSession, batch: DataFrame) -> DataFrame:
        # All rows of the batch count, however old: the bound is before any time.
        with restricted_view(spark, view, F.lit(True)):
            batch.createOrReplaceTempView(view)
            return run_report_sql(spark, report.sql, report_params(BEFORE_ALL, report.parameters))

    def result(spark: SparkSession, batch: DataFrame, batch_id: int) -> DataFrame:
        if scope == "batch":
            return over_batch(spark, batch)
        if scope == "recompute":
            return month_rows(spark, report, view, time_col, touched_months(batch, time_col), BEFORE_ALL)
        shares = partials.Shares(spark, os.path.join(sink, "partials", report.id), folds, period_col, max_shares)
        shares.put(batch_id, over_batch(spark, batch))
        return shares.rows(touched_by=batch_id)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        checkpoint_dir(spark)
        run_id, now, seq = f"batch-{batch_id:012d}", datetime.now(timezone.utc), outputs.next_seq()
        sets, long = None, None
        # Every action on a batch reads its source again, so its rows are kept: emptiness, newest time and SQL share one read.
        batch = batch.persist()
        try:
            if not batch.count():
                return
            # Times before the checkpoint come with late files; they do not move it back.
            times = [_as_utc(batch.agg(F.max(time_col)).first()[0]), _checkpoint(spark, sink, report.id)]
            newest = max([t for t in times if t is not None], default=None)
            rows = result(spark, batch, batch_id).checkpoint()
            # Sent values, sets, cells and counts all read the leaves.
            long = report_values_long(rows, report, order_by=order_by).persist()
            sets = dvs_json(nest_dvs(long))
            outputs.write_run(long, sink, "sent_values", run_id)
            outputs.write_run(sets, sink, "outbox", run_id)
            outputs.write_run(rejected_rows(rows, report.groupBy, report_id=report.id), sink, "rejects", run_id)
            state_store.upsert_values(spark, long.withColumn("load_ts", F.lit(now)), sink)
            counts = run_counts(rows.withColumn("report_id", F.lit(report.id)), long).first()
            state_store.append_run_events(spark.range(1).select(*run_event(
                F.lit(report.id), F.lit(seq), F.lit(now), "SUCCESS",
                report_name=F.lit(report.name), records=F.lit(counts["records_synced"] if counts else 0),
                checkpoint=F.lit(newest).cast("timestamp"))), sink, name=f"batch-{report.id}-{batch_id:020d}")
        except Exception as e:
            text = outputs.chain_text(spark, e)
            body = spark.createDataFrame([(report.id, report.to_json())], "report_id string, json string")
            outputs.write_dead_letters(spark, sink, run_id, body if sets is None else sets.select("report_id", "json"), now)
            outputs.append_events(spark, sink, [(report.id, seq, now, "FAILED", report.name, None, text, None)])
            raise
        finally:
            batch.unpersist()
            if long is not None:
                long.unpersist()
        if scope == "merge":
            partials.Shares(spark, os.path.join(sink, "partials", report.id), folds, period_col, max_shares).compact(batch_id)
    return write


def run_stream(source: DataFrame, writer, checkpoint: str, available_now: bool = True, interval: str = "2 minutes",
               mode: str = "append") -> StreamingQuery:
    """Start a ``foreachBatch`` query. ``available_now`` processes what is there and stops; else it runs every ``interval``
    (the original's two-minute poll)."""
    w = source.writeStream.outputMode(mode).foreachBatch(writer).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def finish(query: StreamingQuery) -> None:
    """Wait until the query has stopped; raises what stopped it."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def stream_report(spark: SparkSession, source_dir: str, schema: T.StructType, report: Report,
                  view: str, sink: str, time_col: str, glob: str | None = None,
                  order_by: Sequence[str] | None = None, available_now: bool = True,
                  interval: str = "2 minutes", max_files_per_trigger: int | None = None,
                  scope: str = "batch", folds: Mapping[str, str] | None = None,
                  max_shares: int = partials.MAX_SHARES) -> StreamingQuery:
    """Start the stream over new files. With ``scope="recompute"`` the report's SQL reads the full source table registered
    as a view by the caller. Each report has a checkpoint of its own under ``sink``."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = report_batch_writer(report, view, sink, time_col, order_by, scope, folds, max_shares=max_shares)
    return run_stream(reader.parquet(source_dir), writer, report_checkpoint(sink, report), available_now, interval)


def report_checkpoint(sink: str, report: Report) -> str:
    return os.path.join(sink, "_checkpoint", report.id)
