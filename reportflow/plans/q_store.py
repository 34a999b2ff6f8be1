"""Queries: what the store keeps between runs: attempts, publications, digests, shares, streamed state, polling."""

from __future__ import annotations

import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportflow import schemas
from reportflow.operators import delivery as dl
from reportflow.operators.dvs import report_values_long
from reportflow.plans import testdata as td
from reportflow.plans.pipeline import run_reports
from reportflow.plans.q_reports import DUCK_EVENT_LEAVES, rollup_rows
from reportflow.plans.q_state import DUCK_TS_FMT, TS_FMT, duck_fold, duck_rollup_values, run_log
from reportflow.plans.registry import query
from reportflow.plans.report_run import Arrivals, report_rows
from reportflow.sources import state_store as store
from reportflow.sources.polled import PolledTable
from reportflow.sources.reports import Report
from reportflow.sources.tables import table, streamed_path
from reportflow.streaming import state_stream as ss
from reportflow.streaming.stream import finish, report_batch_writer, report_checkpoint, run_stream, stream_report, stream_root

VALUE_COLUMNS = ["report_id", "dataSet", "period", "orgUnit", "dataElement", "value", "categoryOptionCombo", "mapping_idx"]
ALL_TIME = "TIMESTAMP '1990-01-01 00:00:00'"
POLLED_FILE_ROWS = 100_000
AS_OF = datetime(2002, 1, 1, tzinfo=timezone.utc)


def state_columns(state: DataFrame) -> DataFrame:
    return state.select("report_id", "report_name", F.date_format("last_sync_timestamp", TS_FMT).alias("last_sync_timestamp"),
                        "sync_status", "records_synced", "error_message", F.date_format("created_at", TS_FMT).alias("created_at"),
                        F.date_format("updated_at", TS_FMT).alias("updated_at"))


DUCK_STATE = duck_fold() + f"""
SELECT report_id, report_name, strftime(last_sync_timestamp, '{DUCK_TS_FMT}') AS last_sync_timestamp,
       sync_status, records_synced, error_message,
       strftime(created_at, '{DUCK_TS_FMT}') AS created_at, strftime(updated_at, '{DUCK_TS_FMT}') AS updated_at
FROM agg
"""


def broken_events_report() -> Report:
    """Fails over the data: event types are not numbers."""
    r = td.EVENTS_REPORT
    return Report(id=r.id, name=r.name, groupBy=r.groupBy, dataValueMappings=r.dataValueMappings,
                  sql=td.EVENTS_SQL.replace("event_id, ts,", "CAST(event_type AS INT) AS event_id, ts,"))


@query("pipeline_rerun", oracle=f"""
WITH l AS ({DUCK_EVENT_LEAVES}), r AS ({duck_rollup_values(ALL_TIME)})
SELECT 'user-events' AS report_id, 'SUCCESS' AS sync_status, false AS has_error, '2024-02-01' AS checkpoint,
       (SELECT COUNT(*) FROM (SELECT DISTINCT dataSet, period, orgUnit FROM l)) AS records_synced,
       3 AS events, 1 AS failures
UNION ALL
SELECT 'line-returns', 'SUCCESS', false, '2024-02-01', (SELECT COUNT(*) FROM (SELECT DISTINCT dataSet, period, orgUnit FROM r)), 2, 0
""")
def pipeline_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report fails, is mended and run again at the same snapshot time, at which a second call runs another
    report: both end in SUCCESS with the checkpoint moved, and the log keeps every attempt."""
    td.sources(spark, sf_dir)
    root, as_of = stream_root(spark, "rerun"), datetime(2024, 2, 1, tzinfo=timezone.utc)
    options = {"default_start": td.ROLLUP_START, "order_by": {td.EVENTS_REPORT.id: td.EVENTS_ORDER}}
    run_reports(spark, [broken_events_report()], root, as_of, **options)
    run_reports(spark, [td.ROLLUP_REPORT], root, as_of, variables={"START_DATE": "1990-01-01"}, **options)
    state = run_reports(spark, [td.EVENTS_REPORT], root, as_of, **options)
    counts = store.read_run_events(spark, root).filter("event != 'IN_PROGRESS'").groupBy("report_id").agg(
        F.count(F.lit(1)).alias("ended"), F.sum((F.col("event") == "FAILED").cast("int")).alias("failures"))
    return state.join(counts, "report_id").select(
        "report_id", "sync_status", F.col("error_message").isNotNull().alias("has_error"),
        F.date_format("last_sync_timestamp", "yyyy-MM-dd").alias("checkpoint"), "records_synced",
        (F.col("ended") + 1).cast("int").alias("events"), F.col("failures").cast("int").alias("failures"))


CHANGED = "l_shipdate >= TIMESTAMP '1996-03-01 00:00:00' AND l_shipdate < TIMESTAMP '1996-05-01 00:00:00'"


@query("incremental_changed_periods", oracle=f"""
SELECT report_id, dataSet, period, orgUnit, dataElement, value, categoryOptionCombo, mapping_idx,
       (SELECT string_agg(DISTINCT strftime(l_shipdate, '%Y%m'), ',' ORDER BY strftime(l_shipdate, '%Y%m')) FROM lineitem WHERE {CHANGED}) AS months_read
FROM ({duck_rollup_values(ALL_TIME)})
""")
def incremental_changed_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two old months are added, changed and deleted without a trace in any column. The kept digests name
    these months, only they are read again, and the values equal a full recompute."""
    td.sources(spark, sf_dir)
    root = stream_root(spark, "changed")
    # As it was before: some rows of the two months not there yet, some with another flag, and some that will be deleted.
    now, inside, kind = table(spark, sf_dir, "lineitem"), F.expr(CHANGED), F.col("l_orderkey") % 5
    before = (now.filter(~inside | (kind != 0))
              .withColumn("l_returnflag", F.when(inside & (kind == 1), "R").otherwise(F.col("l_returnflag")))
              .unionByName(now.filter(inside & (kind == 2))))
    facts = {td.ROLLUP_REPORT.id: Arrivals("lineitem", "l_shipdate", columns=("l_orderkey", "l_quantity", "l_returnflag", "l_shipdate"))}
    run = lambda at: run_reports(spark, [td.ROLLUP_REPORT], root, at, default_start=td.ROLLUP_START, arrivals=facts,
                                 variables={"START_DATE": "1990-01-01"})
    try:
        before.createOrReplaceTempView("lineitem")
        run(AS_OF)
        td.sources(spark, sf_dir)
        run(datetime(2002, 2, 1, tzinfo=timezone.utc))
    finally:
        td.sources(spark, sf_dir)
    # The second run's outbox holds sets of just the months that it read.
    sets = spark.read.parquet(f"{root}/outbox").filter("CAST(run_id AS STRING) LIKE '20020201%'")
    months = sets.agg(F.array_join(F.array_sort(F.collect_set("period")), ",").alias("months_read"))
    return store.read_values(spark, root).select(*VALUE_COLUMNS, F.lit(months.first()[0]).alias("months_read"))


@query("incremental_merge", oracle=duck_rollup_values(ALL_TIME))
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A2 under I3: several files, late ones of old months too, each read once; its share of the counts is merged with the
    kept ones, one batch is replayed, and the values equal the full recompute."""
    td.sources(spark, sf_dir)
    whole = table(spark, sf_dir, "lineitem")
    sink, report = stream_root(spark, "merge"), td.ROLLUP_REPORT
    files, cut = os.path.join(sink, "incoming"), F.lit("1998-01-01").cast("timestamp_ntz")
    late = (F.col("l_shipdate") < cut) & (F.col("l_orderkey") % 7 == 0)
    folds = {"performed": "sum", "positive": "sum"}
    parts = [(F.col("l_shipdate") < cut) & ~late, F.col("l_shipdate") >= cut, late & (F.col("l_orderkey") % 2 == 0), late & (F.col("l_orderkey") % 2 == 1)]
    for n, part in enumerate(parts):
        whole.filter(part).write.parquet(os.path.join(files, f"part{n}"))
        finish(stream_report(spark, f"{files}/*", whole.schema, report, view="lineitem", sink=sink, time_col="l_shipdate",
                             glob="part-*.parquet", scope="merge", folds=folds, max_shares=2))
    replay = report_batch_writer(report, "lineitem", sink, "l_shipdate", scope="merge", folds=folds, max_shares=2)
    replay(spark.read.parquet(os.path.join(files, "part3")), len(parts) - 1)
    return store.read_values(spark, sink).select(*VALUE_COLUMNS)


@query("publish_interrupted", oracle=f"""
SELECT 'before' AS seen, v.* FROM ({duck_rollup_values("TIMESTAMP '1998-01-01 00:00:00'")}) v
UNION ALL SELECT 'after', v.* FROM ({duck_rollup_values(ALL_TIME)}) v
""")
def publish_interrupted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that is lost after writing its folders and before its pointer leaves the old values; run again, it completes."""
    td.sources(spark, sf_dir)
    root = stream_root(spark, "publish")
    values = lambda start: report_values_long(
        report_rows(spark, td.ROLLUP_REPORT, start, "delta"), td.ROLLUP_REPORT).withColumn("load_ts", F.lit(AS_OF))
    store.upsert_values(spark, values(datetime(1998, 1, 1, tzinfo=timezone.utc)), root)
    store.stage_values(spark, values(td.ROLLUP_START), root)   # the driver is lost here
    before = store.read_values(spark, root).select(F.lit("before").alias("seen"), *VALUE_COLUMNS).checkpoint()
    store.upsert_values(spark, values(td.ROLLUP_START), root)
    return before.unionByName(store.read_values(spark, root).select(F.lit("after").alias("seen"), *VALUE_COLUMNS))


@query("state_log_compacted", oracle=DUCK_STATE.replace("FROM agg", """, (SELECT COUNT(*) FROM events) AS logged, true AS few_folders FROM agg"""))
def state_log_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in many appends, merged into segments and these into larger ones: the state and the log stay whole,
    and few folders are left."""
    root, events = stream_root(spark, "compact"), run_log(spark, sf_dir)
    for n in range(16):
        store.append_run_events(events.filter(F.pmod(F.hash("seq"), F.lit(16)) == n).coalesce(1), root)
        if n % 2:
            state = store.snapshot_state(spark, root, td.DEFAULT_START, max_live_appends=1)
    folders = len(store.run_appends(spark, root)) + len(store.files.read_pointer(spark, f"{root}/run_events")[1]["segments"])
    return state_columns(state).select("*", F.lit(store.read_run_events(spark, root).count()).alias("logged"),
                                       F.lit(folders <= 2 * store.SEGMENTS_PER_TIER).alias("few_folders"))


def _in_files(events: DataFrame, folder: str, part: F.Column, name: str) -> None:
    events.filter(part).coalesce(2).write.parquet(os.path.join(folder, name))


@query("stream_state", oracle=DUCK_STATE)
def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state as a streaming aggregation in update mode, stopped and started again from its checkpoint."""
    root, events = stream_root(spark, "state-stream"), run_log(spark, sf_dir)
    feed = os.path.join(root, "feed")
    for n in range(2):
        _in_files(events, feed, F.pmod(F.hash("seq"), F.lit(2)) == n, f"n{n}")
        source = spark.readStream.schema(schemas.RUN_EVENTS).option("pathGlobFilter", "part-*.parquet").option("maxFilesPerTrigger", 1).parquet(f"{feed}/*")
        finish(ss.stream_state(source, root, td.DEFAULT_START))
    return state_columns(ss.read_streamed_state(spark, root))


@query("stream_run_days", oracle=f"""
WITH e AS (SELECT 'user-' || user_id AS report_id, date_trunc('day', ts) AS day, event_type, CAST(floor(value) AS BIGINT) AS records FROM events)
SELECT report_id, strftime(day, '%Y-%m-%d') AS day, CAST(SUM(CASE WHEN event_type IN ('purchase', 'error') THEN 1 ELSE 0 END) AS BIGINT) AS runs,
       CAST(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
       CAST(SUM(CASE WHEN event_type = 'purchase' THEN records ELSE 0 END) AS BIGINT) AS records
FROM e WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) GROUP BY report_id, day
""")
def stream_run_days_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs per report and day, each day written once, when the watermark has passed its end."""
    root, events = stream_root(spark, "run-days"), run_log(spark, sf_dir)
    middle = F.lit("2024-01-15").cast("timestamp")
    for name, part in (("a", F.col("event_ts") < middle), ("b", F.col("event_ts") >= middle)):
        _in_files(events, os.path.join(root, "feed"), part, name)
        source = spark.readStream.schema(schemas.RUN_EVENTS).option("pathGlobFilter", "part-*.parquet").parquet(f"{root}/feed/*")
        finish(ss.stream_run_days(source, root))
    return spark.read.parquet(f"{root}/run_days").select("report_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "runs", "failed", "records")


@query("stream_polled", oracle=f"""
SELECT report_id, dataSet, period, orgUnit, dataElement, value, categoryOptionCombo, mapping_idx, event_id FROM ({DUCK_EVENT_LEAVES})
""")
def stream_polled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A growing table polled by time; the poll is stopped, the table grows, and it goes on from its offset."""
    td.sources(spark, sf_dir)
    spark.dataSource.register(PolledTable)
    sink, events = stream_root(spark, "polled"), table(spark, sf_dir, "events")
    grown, middle = os.path.join(sink, "table"), F.lit("2024-01-15").cast("timestamp_ntz")
    for part in (F.col("ts") <= middle, F.col("ts") > middle):
        # A poll reads a file's row groups in parallel, so files are bounded by rows.
        events.filter(part).write.mode("append").option("maxRecordsPerFile", POLLED_FILE_ROWS).parquet(grown)
        source = spark.readStream.format("polled_table").option("path", grown).option("time_col", "ts").load()
        finish(run_stream(source, report_batch_writer(td.EVENTS_REPORT, "events", sink, "ts", td.EVENTS_ORDER), report_checkpoint(sink, td.EVENTS_REPORT)))
    vals = spark.read.parquet(os.path.join(sink, "sent_values"))
    return vals.select(*VALUE_COLUMNS, F.col("row_order.event_id").alias("event_id"))


@query("stream_failure", oracle=f"""
WITH l AS ({DUCK_EVENT_LEAVES})
SELECT 'failed' AS phase, 'FAILED' AS sync_status, true AS has_error, true AS raised, 1 AS dead_letters, false AS checkpoint_moved
UNION ALL SELECT 'mended', 'SUCCESS', false, false, 1, true
""")
def stream_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that fails leaves FAILED and a dead letter and stops the stream; mended, the stream takes the same batch again."""
    td.sources(spark, sf_dir)
    schema, sink, seen = table(spark, sf_dir, "events").schema, stream_root(spark, "stream-failure"), []
    for phase, report in (("failed", broken_events_report()), ("mended", td.EVENTS_REPORT)):
        q = stream_report(spark, streamed_path(sf_dir, "events"), schema, report, view="events", sink=sink, time_col="ts", order_by=td.EVENTS_ORDER)
        try:
            finish(q)
            raised = False
        except Exception:  # noqa: BLE001 - the stream is meant to stop
            raised = True
        letters = spark.read.parquet(f"{sink}/dead_letters").count()
        state = store.snapshot_state(spark, sink, td.DEFAULT_START)
        seen.append(state.select(F.lit(phase).alias("phase"), "sync_status", F.col("error_message").isNotNull().alias("has_error"),
                                 F.lit(raised).alias("raised"), F.lit(letters).alias("dead_letters"),
                                 (F.coalesce("last_sync_timestamp", F.lit(td.DEFAULT_START)) > F.lit(td.DEFAULT_START)).alias("checkpoint_moved")))
    return seen[0].unionByName(seen[1])


DUCK_SENT = f"SELECT * FROM ({duck_rollup_values(ALL_TIME)})"


@query("verify_differences", oracle=f"""
WITH s AS ({DUCK_SENT}),
t AS (SELECT * FROM s WHERE NOT (orgUnit = 'NATION_3' AND period = '199602' AND dataElement = 'ElReturned')),
u AS (SELECT dataSet, period, orgUnit, dataElement, categoryOptionCombo,
             CASE WHEN orgUnit = 'NATION_7' AND period LIKE '1997%' THEN value || '0' ELSE value END AS value FROM t
      UNION ALL SELECT dataSet, period, orgUnit, 'ElNew', NULL, value FROM s WHERE orgUnit = 'NATION_5' AND period = '199607' AND mapping_idx = 0)
SELECT coalesce(s.dataSet, u.dataSet) AS dataSet, coalesce(s.period, u.period) AS period, coalesce(s.orgUnit, u.orgUnit) AS orgUnit,
       coalesce(s.dataElement, u.dataElement) AS dataElement,
       CASE WHEN s.dataSet IS NULL THEN u.categoryOptionCombo ELSE s.categoryOptionCombo END AS categoryOptionCombo,
       CASE WHEN u.dataSet IS NULL THEN 'lost' WHEN s.dataSet IS NULL THEN 'added' ELSE 'changed' END AS difference, s.value AS sent, u.value AS stored
FROM s FULL JOIN u ON s.dataSet = u.dataSet AND s.period = u.period AND s.orgUnit = u.orgUnit AND s.dataElement = u.dataElement
     AND s.categoryOptionCombo IS NOT DISTINCT FROM u.categoryOptionCombo
WHERE s.value IS DISTINCT FROM u.value
""")
def verify_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that a receiver holds otherwise than sent, found through digests of the sets."""
    sent = report_values_long(rollup_rows(spark, sf_dir), td.ROLLUP_REPORT)
    lost = (F.col("orgUnit") == "NATION_3") & (F.col("period") == "199602") & (F.col("dataElement") == "ElReturned")
    changed = (F.col("orgUnit") == "NATION_7") & F.col("period").startswith("1997")
    stored = sent.filter(~lost).withColumn("value", F.when(changed, F.concat("value", F.lit("0"))).otherwise(F.col("value")))
    new = (F.col("orgUnit") == "NATION_5") & (F.col("period") == "199607") & (F.col("mapping_idx") == 0)
    added = sent.filter(new).withColumn("dataElement", F.lit("ElNew")).withColumn("categoryOptionCombo", F.lit(None).cast("string"))
    return dl.verify_differences(sent, stored.unionByName(added))


MAX_ATTEMPTS = 4


@query("redelivery", oracle=f"""
WITH l AS (SELECT event_id, user_id, ts, event_id % 6 + 1 AS works FROM events WHERE event_type = 'error')
SELECT 'letter-' || event_id AS report_id, CASE WHEN works <= {MAX_ATTEMPTS} THEN 'SUCCESS' ELSE 'FAILED' END AS sync_status,
       CAST(least(works, {MAX_ATTEMPTS}) AS INTEGER) AS attempts,
       CASE WHEN works > {MAX_ATTEMPTS} THEN 'DLQ - Failed to process message after {MAX_ATTEMPTS - 1} redeliveries. Body: ' || user_id END AS error_message,
       false AS still_due
FROM l
""")
def redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters tried again in rounds until they get through or were tried often enough; the state folds every attempt."""
    td.sources(spark, sf_dir)
    store.checkpoint_dir(spark)
    letters = spark.sql("""SELECT event_id AS letter_id, concat('letter-', event_id) AS report_id, CAST(user_id AS STRING) AS body, ts,
                           event_id % 6 + 1 AS works FROM events WHERE event_type = 'error'""")
    ledger = spark.createDataFrame([], "letter_id long, attempt int, ok boolean, at timestamp")
    for n in range(1, MAX_ATTEMPTS + 2):
        due = dl.due_letters(letters, ledger, MAX_ATTEMPTS)
        # The receiver of this test takes a letter from its attempt ``works`` on.
        tried = due.select("letter_id", "attempt", (F.col("attempt") >= F.col("works")).alias("ok"),
                           F.lit(datetime(2024, 3, n, tzinfo=timezone.utc)).alias("at"))
        ledger = ledger.unionByName(tried).checkpoint()
    state = store.finalize_state(store.fold_partial(dl.redelivery_events(letters, ledger, F.col("ts").cast("timestamp"))))
    tries = ledger.join(letters, "letter_id").groupBy("report_id").agg(F.max("attempt").alias("attempts"))
    left = dl.due_letters(letters, ledger, MAX_ATTEMPTS).select("report_id", F.lit(True).alias("due"))
    return state.join(tries, "report_id").join(left, "report_id", "left").select(
        "report_id", "sync_status", "attempts", "error_message", F.coalesce("due", F.lit(False)).alias("still_due"))
