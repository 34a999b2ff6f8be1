"""Sync state as a fold over an append-only run log.

The original kept one mutable JSON map per process and rewrote it on every
transition, with locks around single reads and writes only (T16). Here every
transition is an appended ``run_events`` row and the current state is a
``groupBy(report_id)`` fold. All folds are ``max_by``/``min``/``max``
aggregates, which Spark combines map-side, so a report with a huge event
history costs one small partial row per task before the shuffle.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportflow.sources.tables import DEFAULT_SYNC_START

# Status shown after each run event.
STATUS_AFTER = {"IN_PROGRESS": "IN_PROGRESS", "SUCCESS": "SUCCESS", "FAILED": "FAILED",
                "RESET": "PENDING"}


def _last(value: Column, sets: Column, order: Column) -> Column:
    """``struct(o, v)`` from the latest event that sets the field (null struct: never set).

    The order goes along with the value, so that folds of any parts of the log
    merge to the same result; the wrapping also keeps a null *set* by an event
    apart from "not set".
    """
    return F.max(F.when(sets, F.struct(order.alias("o"), value.alias("v"))))


# Partial fold columns: ``*_s`` are struct<o, v> "last set" values, the rest combine by min or max.
SET_FIELDS = {"name_s": "report_name", "ckpt_s": "last_sync_timestamp", "status_s": "sync_status",
              "records_s": "records_synced", "error_s": "error_message"}


def fold_partial(events: DataFrame, default_start: datetime | Column = DEFAULT_SYNC_START) -> DataFrame:
    """Per report, the fold of ``events`` in a form that later events can be merged into.

    ``events``: report_id, seq, event_ts, event, report_name, records, error,
    checkpoint. Rules (which event sets which field): status from every event;
    name from IN_PROGRESS/SUCCESS; checkpoint from SUCCESS (its ``checkpoint``,
    the max event time read, else the event time) and RESET (default start);
    records from SUCCESS/RESET (0); error from FAILED (text), SUCCESS/RESET
    (null), IN_PROGRESS keeps it; created_at = first SUCCESS/FAILED/RESET.
    """
    ev = F.col("event")
    order = F.struct(F.col("event_ts"), F.col("seq"))
    dflt = default_start if isinstance(default_start, Column) else F.lit(default_start)
    status = F.create_map(*[x for k, v in STATUS_AFTER.items() for x in (F.lit(k), F.lit(v))])[ev]
    sets_name = ev.isin("IN_PROGRESS", "SUCCESS")
    sets_ckpt = ev.isin("SUCCESS", "RESET")
    sets_err = ev.isin("SUCCESS", "FAILED", "RESET")
    ckpt_val = F.when(ev == "SUCCESS", F.coalesce(F.col("checkpoint"), F.col("event_ts"))) \
        .otherwise(dflt.cast(events.schema["event_ts"].dataType))
    return events.groupBy("report_id").agg(
        _last(F.col("report_name"), sets_name, order).alias("name_s"),
        _last(ckpt_val, sets_ckpt, order).alias("ckpt_s"),
        _last(status, F.lit(True), order).alias("status_s"),
        _last(F.when(ev == "SUCCESS", F.col("records")).otherwise(F.lit(0).cast("long")),
              sets_ckpt, order).alias("records_s"),
        _last(F.when(ev == "FAILED", F.col("error")), sets_err, order).alias("error_s"),
        F.min(F.when(sets_err, F.col("event_ts"))).alias("created_at"),
        F.max("event_ts").alias("updated_at"))


def combine_partial(old: DataFrame, new: DataFrame) -> DataFrame:
    """Merge two partial folds; which events each side holds, and how often, makes no difference.

    Both sides hold one row per report, so this join is report-count sized.
    """
    o, n = old.alias("o"), new.alias("n")
    pick = lambda c, f: f(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c)  # noqa: E731 - null means "not set"
    return o.join(n, "report_id", "full").select(
        "report_id", *[pick(c, F.greatest) for c in SET_FIELDS],
        pick("created_at", F.least), pick("updated_at", F.greatest))


def finalize_state(partial: DataFrame) -> DataFrame:
    """The sync state table from a partial fold."""
    return partial.select(
        "report_id", *[F.col(f"{c}.v").alias(name) for c, name in SET_FIELDS.items()],
        "created_at", "updated_at")


def fold_sync_state(events: DataFrame, default_start: datetime | Column = DEFAULT_SYNC_START) -> DataFrame:
    """Current state per report from its run events (a grouped, map-side combined fold)."""
    return finalize_state(fold_partial(events, default_start))


# The shape of an ISO-8601 instant (date, 'T', time, 'Z' or an offset).
ISO_INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})$"


def parse_instant(text: Column) -> Column:
    """ISO instant text to timestamp; other shapes, unparsable or empty text give null.

    Only instants count, as in the original: a bare date or a zone-less time is
    not a stored checkpoint, so the report falls back to its default start.
    """
    return F.when(text.rlike(ISO_INSTANT), F.try_to_timestamp(text))


def sync_watermarks(reports: DataFrame, state: DataFrame,
                    default_start: datetime = DEFAULT_SYNC_START,
                    state_ts_col: str = "last_sync_timestamp") -> DataFrame:
    """Effective start per report (I1, I5, J3): stored checkpoint, else the default start.

    ``state`` may hold the checkpoint as text (as stored by the original) or as
    a timestamp. A report without state is PENDING.
    """
    st = state.select(F.col("report_id").alias("_rid"), F.col(state_ts_col).alias("_ckpt"),
                      F.col("sync_status").alias("_status"))
    ckpt = F.col("_ckpt")
    if dict(st.dtypes)["_ckpt"] == "string":
        ckpt = parse_instant(ckpt)
    return (reports.join(st, reports["id"] == st["_rid"], "left")
            .select(F.col("id").alias("report_id"),
                    F.coalesce(F.col("_status"), F.lit("PENDING")).alias("sync_status"),
                    F.coalesce(ckpt.cast("timestamp"), F.lit(default_start)).alias("effective_start")))


def run_event(report_id: Column, seq: Column, event_ts: Column, event: str | Column,
              report_name: Column | None = None, records: Column | None = None,
              error: Column | None = None, checkpoint: Column | None = None) -> list[Column]:
    """Columns of one ``run_events`` row, for ``select``."""
    null_s = F.lit(None).cast("string")
    return [report_id.cast("string").alias("report_id"), seq.cast("long").alias("seq"),
            event_ts.alias("event_ts"),
            (event if isinstance(event, Column) else F.lit(event)).alias("event"),
            (report_name if report_name is not None else null_s).alias("report_name"),
            (records if records is not None else F.lit(None)).cast("long").alias("records"),
            (error if error is not None else null_s).alias("error"),
            (checkpoint if checkpoint is not None else F.when(F.lit(False), event_ts))
            .alias("checkpoint")]
