"""Queries: run log fold, watermarks, incremental runs and the keyed upsert."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportflow.operators.delivery import upsert_latest
from reportflow.operators.dvs import report_values_long, values_long
from reportflow.operators.state import fold_sync_state, run_event, sync_watermarks
from reportflow.plans import testdata as td
from reportflow.plans.q_reports import DUCK_ROLLUP
from reportflow.plans.registry import query
from reportflow.plans.report_run import Arrivals, report_rows
from reportflow.plans.pipeline import run_reports
from reportflow.plans.q_reports import DUCK_EVENT_LEAVES
from reportflow.plans.shared import run_shared_report
from reportflow.sources.reports import Report
from reportflow.sources import state_store as store
from reportflow.sources.state_store import read_values
from reportflow.streaming.stream import stream_root
from reportflow.sources.tables import table

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DUCK_TS_FMT = "%Y-%m-%d %H:%M:%S.%f"

# How test events stand for run events.
EVENT_KIND = {"signup": "RESET", "view": "IN_PROGRESS", "click": "IN_PROGRESS",
              "purchase": "SUCCESS", "error": "FAILED"}


def run_log(spark: SparkSession, sf_dir: str, prefix: str = "user-") -> DataFrame:
    """``events`` as a run log: one report per user, event type as the transition."""
    ev = table(spark, sf_dir, "events")
    kind = F.create_map(*[x for k, v in EVENT_KIND.items() for x in (F.lit(k), F.lit(v))])
    return ev.select(*run_event(
        F.concat(F.lit(prefix), F.col("user_id").cast("string")), F.col("event_id"), F.col("ts"),
        kind[F.col("event_type")],
        report_name=F.concat(F.lit("user "), F.col("user_id").cast("string")),
        records=F.floor("value"),
        error=F.concat(F.lit("failed event "), F.col("event_id").cast("string")),
        checkpoint=F.col("ts")))


def duck_fold(prefix: str = "user-") -> str:
    return f"""
WITH e AS (
  SELECT '{prefix}' || user_id AS report_id, event_id AS seq, ts AS event_ts,
         CASE event_type WHEN 'signup' THEN 'RESET' WHEN 'purchase' THEN 'SUCCESS'
              WHEN 'error' THEN 'FAILED' ELSE 'IN_PROGRESS' END AS event,
         'user ' || user_id AS report_name, CAST(floor(value) AS BIGINT) AS records,
         'failed event ' || event_id AS error, ts AS checkpoint
  FROM events),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY event_ts DESC, seq DESC) AS rn_all,
         row_number() OVER (PARTITION BY report_id, event IN ('IN_PROGRESS', 'SUCCESS')
                            ORDER BY event_ts DESC, seq DESC) AS rn_name,
         row_number() OVER (PARTITION BY report_id, event IN ('SUCCESS', 'RESET')
                            ORDER BY event_ts DESC, seq DESC) AS rn_ck,
         row_number() OVER (PARTITION BY report_id, event IN ('SUCCESS', 'FAILED', 'RESET')
                            ORDER BY event_ts DESC, seq DESC) AS rn_err
  FROM e),
agg AS (
  SELECT report_id,
         max(CASE WHEN rn_all = 1 THEN CASE event WHEN 'RESET' THEN 'PENDING' ELSE event END END) AS sync_status,
         max(CASE WHEN rn_name = 1 AND event IN ('IN_PROGRESS', 'SUCCESS') THEN report_name END) AS report_name,
         max(CASE WHEN rn_ck = 1 AND event IN ('SUCCESS', 'RESET')
                  THEN CASE WHEN event = 'SUCCESS' THEN checkpoint ELSE TIMESTAMP '2020-01-01 00:00:00' END END)
           AS last_sync_timestamp,
         max(CASE WHEN rn_ck = 1 AND event IN ('SUCCESS', 'RESET')
                  THEN CASE WHEN event = 'SUCCESS' THEN records ELSE 0 END END) AS records_synced,
         max(CASE WHEN rn_err = 1 AND event = 'FAILED' THEN error END) AS error_message,
         min(CASE WHEN event IN ('SUCCESS', 'FAILED', 'RESET') THEN event_ts END) AS created_at,
         max(event_ts) AS updated_at
  FROM ranked GROUP BY report_id)
"""


@query("sync_state_fold", oracle=duck_fold() + f"""
SELECT report_id, report_name, strftime(last_sync_timestamp, '{DUCK_TS_FMT}') AS last_sync_timestamp,
       sync_status, records_synced, error_message,
       strftime(created_at, '{DUCK_TS_FMT}') AS created_at, strftime(updated_at, '{DUCK_TS_FMT}') AS updated_at
FROM agg
""")
def sync_state_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4-I8: current sync state per report folded from the append-only run log."""
    st = fold_sync_state(run_log(spark, sf_dir))
    return st.select("report_id", "report_name",
                     F.date_format("last_sync_timestamp", TS_FMT).alias("last_sync_timestamp"),
                     "sync_status", "records_synced", "error_message",
                     F.date_format("created_at", TS_FMT).alias("created_at"),
                     F.date_format("updated_at", TS_FMT).alias("updated_at"))


@query("sync_watermarks", oracle=duck_fold("rpt-") + f"""
SELECT 'rpt-' || c.c_custkey AS report_id, coalesce(a.sync_status, 'PENDING') AS sync_status,
       strftime(CASE WHEN a.sync_status = 'FAILED' OR a.last_sync_timestamp IS NULL
                     THEN TIMESTAMP '2020-01-01 00:00:00' ELSE a.last_sync_timestamp END,
                '{DUCK_TS_FMT}') AS effective_start
FROM customer c LEFT JOIN agg a ON a.report_id = 'rpt-' || c.c_custkey
""")
def sync_watermarks_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored checkpoint text parsed per report, bad or missing -> default start."""
    st = fold_sync_state(run_log(spark, sf_dir, prefix="rpt-"))
    stored = st.select(
        "report_id", "sync_status",
        F.when(F.col("sync_status") == "FAILED", F.lit("not a timestamp"))
         .otherwise(F.date_format("last_sync_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
         .alias("last_sync_timestamp"))
    wm = sync_watermarks(td.customer_reports(spark, sf_dir), stored)
    return wm.select("report_id", "sync_status",
                     F.date_format("effective_start", TS_FMT).alias("effective_start"))


PIPE_START = td.ROLLUP_START
MID_MONTH = datetime(1996, 1, 15, 12, 0, tzinfo=timezone.utc)


def duck_rollup_values(bound_sql: str, op: str = ">") -> str:
    base = DUCK_ROLLUP.replace("l.l_shipdate > TIMESTAMP '1996-01-01 00:00:00'", f"l.l_shipdate {op} {bound_sql}")
    return f"""
WITH r AS ({base})
SELECT 'line-returns' AS report_id, data_set AS dataSet, period, org_unit AS orgUnit,
       'ElReturned' AS dataElement, CAST(performed AS VARCHAR) AS value, 'CocLine' AS categoryOptionCombo,
       0 AS mapping_idx FROM r
UNION ALL
SELECT 'line-returns', data_set, period, org_unit, 'ElReturnedLarge', CAST(positive AS VARCHAR), 'CocLine', 1
FROM r
"""


def _rollup_values(spark: SparkSession, sf_dir: str, checkpoint: datetime, mode: str) -> DataFrame:
    td.sources(spark, sf_dir)
    rows = report_rows(spark, td.ROLLUP_REPORT, checkpoint, mode)
    return report_values_long(rows, td.ROLLUP_REPORT)


@query("incremental_delta", oracle=duck_rollup_values("TIMESTAMP '1996-01-15 12:00:00'"))
def incremental_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I2, I3 delta mode: rows strictly after the checkpoint only (the original's way, T13)."""
    return _rollup_values(spark, sf_dir, MID_MONTH, "delta")


@query("incremental_recompute", oracle=duck_rollup_values("TIMESTAMP '1996-01-01 00:00:00'", ">="))
def incremental_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3 recompute mode: every period touched since the checkpoint is re-aggregated whole."""
    return _rollup_values(spark, sf_dir, MID_MONTH, "recompute")


@query("upsert_latest", oracle=f"""
WITH existing AS (
  SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS load_ts
  FROM ({duck_rollup_values("TIMESTAMP '1990-01-01 00:00:00'")})),
incoming AS (
  SELECT *, TIMESTAMP '2024-03-01 00:00:00' AS load_ts
  FROM ({duck_rollup_values("TIMESTAMP '1996-01-15 12:00:00'")})),
both_ AS (SELECT * FROM existing UNION ALL SELECT * FROM incoming)
SELECT dataSet, period, orgUnit, dataElement, categoryOptionCombo, report_id, value, mapping_idx,
       strftime(load_ts, '%Y-%m-%d') AS load_day
FROM both_
QUALIFY row_number() OVER (PARTITION BY dataSet, period, orgUnit, dataElement, categoryOptionCombo
                           ORDER BY load_ts DESC, mapping_idx DESC, value DESC) = 1
""")
def upsert_latest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full load, then a delta load; the newest value per cell wins (shows T13's shrink)."""
    full = _rollup_values(spark, sf_dir, datetime(1990, 1, 1, tzinfo=timezone.utc), "delta") \
        .withColumn("load_ts", F.lit(datetime(2024, 2, 1, tzinfo=timezone.utc)))
    delta = _rollup_values(spark, sf_dir, MID_MONTH, "delta") \
        .withColumn("load_ts", F.lit(datetime(2024, 3, 1, tzinfo=timezone.utc)))
    out = upsert_latest(full, delta)
    return out.select("dataSet", "period", "orgUnit", "dataElement", "categoryOptionCombo", "report_id",
                      "value", "mapping_idx", F.date_format("load_ts", "yyyy-MM-dd").alias("load_day"))


@query("shared_rollup", oracle="""
WITH w AS (SELECT n_name AS facility, 'rpt-' || n_name AS report_id,
                  TIMESTAMP '1996-01-01 00:00:00' + to_months(n_nationkey) AS checkpoint FROM nation),
r AS (
  SELECT w.report_id, 'DsLineReturns' AS data_set, strftime(l.l_shipdate, '%Y%m') AS period, n.n_name AS org_unit,
         COUNT(*) AS performed, COUNT(CASE WHEN l.l_quantity > 25.0 THEN 1 END) AS positive
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN w ON n.n_name = w.facility
  WHERE l.l_shipdate > w.checkpoint AND l.l_returnflag = 'R'
  GROUP BY 1, 3, 4)
SELECT report_id, data_set AS dataSet, period, org_unit AS orgUnit, 'ElReturned' AS dataElement,
       CAST(performed AS VARCHAR) AS value, 'CocLine' AS categoryOptionCombo, 0 AS mapping_idx FROM r
UNION ALL
SELECT report_id, data_set, period, org_unit, 'ElReturnedLarge', CAST(positive AS VARCHAR), 'CocLine', 1 FROM r
""")
def shared_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """7.3: every nation's report from one scan, each with its own checkpoint."""
    td.sources(spark, sf_dir)
    rows = run_shared_report(spark, td.SHARED_ROLLUP_SQL, spark.sql(td.NATION_WATERMARKS_SQL))
    r = td.ROLLUP_REPORT
    return values_long(rows, r.groupBy, r.dataValueMappings, report_id=F.col("report_id"))


ARRIVED_SQL = "SELECT *, l_shipdate + make_dt_interval(CAST(l_orderkey % 75 AS INT)) AS arrived_at FROM lineitem"


@query("incremental_late_rows", oracle=f"""
WITH touched AS (
  SELECT DISTINCT date_trunc('month', l_shipdate) AS m FROM lineitem
  WHERE l_shipdate + to_days(CAST(l_orderkey % 75 AS INTEGER)) > TIMESTAMP '2001-08-20 00:00:00')
SELECT v.* FROM ({duck_rollup_values("TIMESTAMP '1990-01-01 00:00:00'")}) v
WHERE period IN (SELECT strftime(m, '%Y%m') FROM touched)
""")
def incremental_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly the periods of the rows that arrived since the checkpoint, re-aggregated whole."""
    td.sources(spark, sf_dir)
    spark.sql(ARRIVED_SQL).createOrReplaceTempView("lineitem")
    try:
        rows = report_rows(spark, td.ROLLUP_REPORT, datetime(2001, 8, 20, tzinfo=timezone.utc),
                           arrivals=Arrivals("lineitem", "l_shipdate", "arrived_at"), default_start=PIPE_START)
        return report_values_long(rows, td.ROLLUP_REPORT)
    finally:
        td.sources(spark, sf_dir)


@query("state_snapshot", oracle=duck_fold() + f"""
SELECT report_id, report_name, strftime(last_sync_timestamp, '{DUCK_TS_FMT}') AS last_sync_timestamp,
       sync_status, records_synced, error_message,
       strftime(created_at, '{DUCK_TS_FMT}') AS created_at, strftime(updated_at, '{DUCK_TS_FMT}') AS updated_at
FROM agg
""")
def state_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log appended out of order, with a snapshot in between, gives the state of the whole log."""
    root = stream_root(spark, "state")
    events, late = run_log(spark, sf_dir), F.col("seq") % 3 == 0
    store.append_run_events(events.filter(~late & (F.col("event_ts") >= F.lit("2024-01-15"))), root)
    store.snapshot_state(spark, root, td.DEFAULT_START)
    store.append_run_events(events.filter(~late & (F.col("event_ts") < F.lit("2024-01-15"))), root)
    store.snapshot_state(spark, root, td.DEFAULT_START)
    store.append_run_events(events.filter(late), root)
    st = store.snapshot_state(spark, root, td.DEFAULT_START)
    return st.select("report_id", "report_name",
                     F.date_format("last_sync_timestamp", TS_FMT).alias("last_sync_timestamp"),
                     "sync_status", "records_synced", "error_message",
                     F.date_format("created_at", TS_FMT).alias("created_at"),
                     F.date_format("updated_at", TS_FMT).alias("updated_at"))


DUCK_PIPELINE_VALUES = f"""
WITH v AS (
  SELECT *, 0 AS event_id, TIMESTAMP '1990-01-01 00:00:00' AS ts FROM ({duck_rollup_values("TIMESTAMP '1990-01-01 00:00:00'")})
  UNION ALL
  SELECT report_id, dataSet, period, orgUnit, dataElement, value, categoryOptionCombo, mapping_idx, event_id, ts
  FROM ({DUCK_EVENT_LEAVES}))
SELECT report_id, dataSet, period, orgUnit, dataElement, categoryOptionCombo, value, mapping_idx
FROM v
QUALIFY row_number() OVER (PARTITION BY report_id, dataSet, period, orgUnit, dataElement, categoryOptionCombo
                           ORDER BY mapping_idx DESC, ts DESC, event_id DESC) = 1
"""
BLANK_REPORT = Report(id="no-sql", name="blank", sql="  ")


def _pipeline_values(spark: SparkSession, sf_dir: str, runs: list[datetime]) -> DataFrame:
    td.sources(spark, sf_dir)
    root = stream_root(spark, "pipeline")
    for as_of in runs:
        run_reports(spark, [td.ROLLUP_REPORT, td.EVENTS_REPORT, BLANK_REPORT], root, as_of, default_start=PIPE_START,
                    order_by={td.EVENTS_REPORT.id: td.EVENTS_ORDER}, variables={"START_DATE": "1990-01-01"})
    return read_values(spark, root).select("report_id", "dataSet", "period", "orgUnit", "dataElement",
                                           "categoryOptionCombo", "value", "mapping_idx")


@query("pipeline_run", oracle=DUCK_PIPELINE_VALUES)
def pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 end to end, twice: state, recompute run, upsert (the last row sent wins), rejects, JSON outbox, run log."""
    return _pipeline_values(spark, sf_dir, [datetime(1998, 6, 15, tzinfo=timezone.utc),
                                            datetime(2002, 1, 1, tzinfo=timezone.utc)])


@query("pipeline_first_run", oracle=DUCK_PIPELINE_VALUES)
def pipeline_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load merges too: one value for each cell."""
    return _pipeline_values(spark, sf_dir, [datetime(2002, 1, 1, tzinfo=timezone.utc)])


@query("pipeline_failure", oracle=f"""
WITH l AS ({DUCK_EVENT_LEAVES})
SELECT 'user-events' AS report_id, 'SUCCESS' AS sync_status,
       (SELECT COUNT(*) FROM (SELECT DISTINCT dataSet, period, orgUnit FROM l)) AS records_synced,
       false AS has_error, 0 AS dead_letters
UNION ALL SELECT 'broken', 'FAILED', NULL, true, 1
""")
def pipeline_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: a report that fails over the data leaves a dead letter and FAILED; the other report succeeds."""
    td.sources(spark, sf_dir)
    root = stream_root(spark, "pipeline")
    broken = Report(id="broken", name="broken", groupBy=td.EVENTS_REPORT.groupBy,
                    dataValueMappings=td.EVENTS_REPORT.dataValueMappings,
                    sql=td.EVENTS_SQL.replace("event_id, ts,", "CAST(event_type AS INT) AS event_id, ts,"))
    st = run_reports(spark, [broken, td.EVENTS_REPORT], root, datetime(2024, 2, 1, tzinfo=timezone.utc),
                     order_by={td.EVENTS_REPORT.id: td.EVENTS_ORDER})
    letters = spark.read.parquet(f"{root}/dead_letters").groupBy("report_id").agg(F.count("*").cast("int").alias("n"))
    return st.join(letters, "report_id", "left").select(
        "report_id", "sync_status", "records_synced", F.col("error_message").isNotNull().alias("has_error"),
        F.coalesce("n", F.lit(0)).alias("dead_letters"))
