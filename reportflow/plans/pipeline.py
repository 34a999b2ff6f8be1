"""A full scheduled run over a list of reports (the original's main route, L1-L3).

Definitions are resolved first: placeholders, validation, SQL files. The log
then gets one append that marks all runnable reports IN_PROGRESS. Each report
reads its checkpoint, runs its SQL once (recompute or delta), applies its
transform, upserts the values, keeps the rejects and writes the sets as JSON.
A report that fails leaves its sets (or, before there are any, its definition)
as dead letters with the chain of causes, and the others go on. All outputs
carry the run id and overwrite their own (report, run) folder, so a run that is
started again repeats nothing. The outcomes are appended at the end, every
attempt as an append of its own, and the state is a fold of the log: a run that
failed, was mended and is started again at the same ``as_of`` ends in SUCCESS.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportflow.functions.expr import bound_above
from reportflow.operators import delivery as dl
from reportflow.operators.dvs import nest_dvs, rejected_rows, report_values_long, values_long
from reportflow.operators.reshape import Transform, custom_transform, ensure_complete_date
from reportflow.operators.state import finalize_state
from reportflow.plans.outputs import append_events, chain_text, next_seq, write_dead_letters, write_run
from reportflow.plans.report_run import Arrivals, arrived_since, changed_rows, keep_digests, recompute_start, report_rows
from reportflow.plans.shared import run_shared_report
from reportflow.session import checkpoint_dir
from reportflow.sources import state_store as store
from reportflow.sources.reports import Report, reports_frame, resolve_report_placeholders, to_reports, validate_reports
from reportflow.sources.tables import DEFAULT_SYNC_START

log = logging.getLogger(__name__)


def resolve_reports(spark: SparkSession, reports: Sequence[Report] | DataFrame,
                    variables: Mapping[str, str] | None = None) -> list[Report]:
    """Definitions ready to run, from objects or a ``reports`` table: ids checked, placeholders filled in."""
    frame = reports if isinstance(reports, DataFrame) else reports_frame(spark, list(reports))
    return to_reports(resolve_report_placeholders(validate_reports(frame), dict(variables or {})))


def _checkpoints(spark: SparkSession, root: str, reports: Sequence[Report],
                 default_start: datetime) -> dict[str, datetime]:
    """Stored checkpoint per report (one row per configured report, so it is small)."""
    ids = [r.id for r in reports]
    state = finalize_state(store.current_partial(spark, root, default_start)[0]).filter(F.col("report_id").isin(ids))
    out = {r.id: default_start for r in reports}
    for row in state.select("report_id", "last_sync_timestamp").collect():
        ts = row["last_sync_timestamp"]
        if ts is not None:
            out[row["report_id"]] = ts if ts.tzinfo else ts.replace(tzinfo=timezone.utc)
    return out


def _run_id(as_of: datetime) -> str:
    """Names a run's output folders: a run started again at the same snapshot time overwrites them."""
    return f"{as_of.astimezone(timezone.utc):%Y%m%dT%H%M%S%f}"


def _set_documents(long: DataFrame, max_values_per_set: int | None, complete_date: str | None) -> DataFrame:
    """The sets as JSON, with a completeDate where one is asked for."""
    nested = nest_dvs(long, max_values_per_set)
    if complete_date is None:
        return dl.dvs_json(nested)
    nested = ensure_complete_date(nested.withColumn("completeDate", F.lit(None).cast("string")), complete_date)
    return dl.dvs_json(nested, F.col("completeDate"))


def run_reports(spark: SparkSession, reports: Sequence[Report] | DataFrame, root: str, as_of: datetime,
                mode: str = "recompute", default_start: datetime = DEFAULT_SYNC_START,
                order_by: dict[str, list[str]] | None = None, max_values_per_set: int | None = None,
                variables: Mapping[str, str] | None = None, base_dir: str | None = None,
                transforms: Mapping[str, Transform] | None = None, complete_date: str | None = None,
                arrivals: Mapping[str, Arrivals] | None = None) -> DataFrame:
    """Run every report once; ``as_of`` is the source snapshot time, stored as the new checkpoint.

    ``transforms`` maps a report id to its reshaping step (D3); ``complete_date`` is set on sets that have none
    (D1); ``arrivals`` names a report's fact view, with its arrival column for exact recomputes of late rows, or without one
    to have the view's months compared with their kept digests: then late, changed and deleted rows are found, too.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    # Reports without SQL are skipped before any state change.
    runnable = [r for r in resolve_reports(spark, reports, variables) if ((r.sql or "").strip() or r.sqlFile)]
    ckpt = _checkpoints(spark, root, runnable, default_start)
    run_id, seq = _run_id(as_of), next_seq()
    append_events(spark, root, [(r.id, seq, as_of, "IN_PROGRESS", r.name, None, None, None) for r in runnable])
    ended = []
    for r in runnable:
        sets, long, replaced, digests = None, None, None, None
        facts = (arrivals or {}).get(r.id)
        try:
            # Values, rejects, sets and counts all read the result: run the SQL once, cut lineage.
            if mode == "recompute" and facts is not None and facts.arrived_col is None:
                rows, replaced, digests = changed_rows(spark, r, facts, root, default_start, base_dir)
            else:
                rows = report_rows(spark, r, ckpt[r.id], mode, base_dir, facts, default_start, as_of)
            if transforms and r.id in transforms:
                rows = custom_transform(rows, transforms[r.id])
            rows = rows.checkpoint(eager=True)
            # Sets, cells and counts all read the leaves.
            long = report_values_long(rows, r, order_by=(order_by or {}).get(r.id)).persist()
            sets = _set_documents(long, max_values_per_set, complete_date)
            write_run(sets, root, "outbox", run_id)
            store.upsert_values(spark, long.withColumn("load_ts", F.lit(as_of)), root,
                                None if replaced is None else (r.id, replaced))
            write_run(rejected_rows(rows, r.groupBy, report_id=r.id), root, "rejects", run_id)
            if digests is not None:
                keep_digests(spark, r, root, digests, facts)
            counts = dl.run_counts(rows.withColumn("report_id", F.lit(r.id)), long).first()
            ended.append((r.id, seq + 1, as_of, "SUCCESS", r.name, counts["records_synced"] if counts else 0, None, as_of))
        except Exception as e:  # noqa: BLE001 - a failed report is data, the others go on
            text = chain_text(spark, e)
            log.error("report %s failed: %s", r.id, text)
            body = spark.createDataFrame([(r.id, r.to_json())], "report_id string, json string")
            write_dead_letters(spark, root, run_id, body if sets is None else sets.select("report_id", "json"), as_of)
            ended.append((r.id, seq + 1, as_of, "FAILED", r.name, None, text, None))
        finally:
            if long is not None:
                long.unpersist()
    append_events(spark, root, ended)
    return store.snapshot_state(spark, root, default_start)


def run_report_group(spark: SparkSession, template: Report, facilities: Sequence[tuple[str, str]],
                     root: str, as_of: datetime, mode: str = "recompute",
                     default_start: datetime = DEFAULT_SYNC_START, order_by: list[str] | None = None,
                     max_values_per_set: int | None = None, variables: Mapping[str, str] | None = None,
                     transform: Transform | None = None, complete_date: str | None = None,
                     arrivals: Arrivals | None = None) -> DataFrame:
    """Run many reports that share one SQL shape as one plan (survey 7.3).

    ``facilities`` lists (facility value, report id). The template SQL joins the
    ``report_watermarks`` view (facility, report_id, checkpoint) and filters on
    each report's own checkpoint, so all reports share one scan. Each report
    still gets its own run events, values and sets; if the plan
    fails, all of them fail with its causes. ``arrivals`` names the fact view's arrival column: then the months of the rows
    that arrived since the members' smallest checkpoint are read whole, for every member.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    if arrivals is not None and arrivals.arrived_col is None:
        raise ValueError("a group needs the arrival column of its fact view")
    template = resolve_reports(spark, [template], variables)[0]
    members = [Report(id=rid, name=f"{template.name} ({fac})") for fac, rid in facilities]
    ckpt = _checkpoints(spark, root, members, default_start)
    run_id, seq = _run_id(as_of), next_seq()
    append_events(spark, root, [(m.id, seq, as_of, "IN_PROGRESS", m.name, None, None, None) for m in members])
    try:
        with arrived_since(spark, arrivals, min(ckpt.values(), default=default_start)):
            if arrivals is not None:   # the view is cut to the touched months, which count whole
                bound = dict.fromkeys(ckpt, default_start)
            else:
                bound = {rid: (ckpt[rid] if mode == "delta" else recompute_start(ckpt[rid])) for _, rid in facilities}
            wm = spark.createDataFrame([(fac, rid, bound[rid]) for fac, rid in facilities],
                                       "facility string, report_id string, checkpoint timestamp")
            sql = template.resolved_sql()
            rows = run_shared_report(spark, bound_above(sql) if mode == "delta" else sql, wm, {"asOf": as_of, **(template.parameters or {})})
        if transform is not None:
            rows = custom_transform(rows, transform)
        rows = rows.checkpoint(eager=True)
        long = values_long(rows, template.groupBy, template.dataValueMappings, order_by=order_by, report_id=F.col("report_id"))
        write_run(_set_documents(long, max_values_per_set, complete_date), root, "outbox", run_id)
        store.upsert_values(spark, long.withColumn("load_ts", F.lit(as_of)), root)
        write_run(rejected_rows(rows, template.groupBy, report_id=F.col("report_id")), root, "rejects", run_id)
        # One row per report: config-sized.
        sets = {r["report_id"]: r["records_synced"] for r in dl.run_counts(rows, long).collect()}
        ended = [(m.id, seq + 1, as_of, "SUCCESS", m.name, sets.get(m.id, 0), None, as_of) for m in members]
    except Exception as e:  # noqa: BLE001 - the failure is recorded for every member
        text = chain_text(spark, e)
        log.error("report group %s failed: %s", template.id, text)
        bodies = spark.createDataFrame([(m.id, template.to_json()) for m in members], "report_id string, json string")
        write_dead_letters(spark, root, run_id, bodies, as_of)
        ended = [(m.id, seq + 1, as_of, "FAILED", m.name, None, text, None) for m in members]
    append_events(spark, root, ended)
    return store.snapshot_state(spark, root, default_start)
