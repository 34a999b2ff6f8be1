"""Queries: JSON sink, dead letters, failure texts, run counts and delivery checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportflow.operators import delivery as dl
from reportflow.operators.dvs import nest_dvs, report_values_long
from reportflow.plans import testdata as td
from reportflow.plans.q_reports import DUCK_EVENT_LEAVES, DUCK_EVENTS, DUCK_ROLLUP_ALL, events_rows, rollup_rows
from reportflow.plans.registry import query
from reportflow.session import checkpoint_dir
from reportflow.sources.tables import table

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DUCK_TS_FMT = "%Y-%m-%d %H:%M:%S.%f"
DUCK_JTRIM = "regexp_replace({0}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def rollup_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_values_long(rollup_rows(spark, sf_dir), td.ROLLUP_REPORT)


def rollup_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nest_dvs(rollup_long(spark, sf_dir))


def _leaf_json(el: str, v: str, coc: str) -> str:
    return (f"'{{\"dataElement\":' || CAST(to_json({el}) AS VARCHAR) || ',\"value\":' || CAST(to_json({v}) AS VARCHAR)"
            f" || coalesce(',\"categoryOptionCombo\":' || CAST(to_json({coc}) AS VARCHAR), '') || '}}'")


@query("dvs_json", oracle=f"""
WITH r AS ({DUCK_ROLLUP_ALL}),
leaves AS (
  SELECT data_set, period, org_unit, 0 AS mapping_idx, 'ElReturned' AS el, CAST(performed AS VARCHAR) AS v,
         'CocLine' AS coc FROM r
  UNION ALL
  SELECT data_set, period, org_unit, 1, 'ElReturnedLarge', CAST(positive AS VARCHAR), 'CocLine' FROM r)
SELECT 'line-returns' AS report_id, data_set AS dataSet, period, org_unit AS orgUnit,
       '{{"dataSet":' || CAST(to_json(data_set) AS VARCHAR) || ',"period":' || CAST(to_json(period) AS VARCHAR)
       || ',"orgUnit":' || CAST(to_json(org_unit) AS VARCHAR) || ',"dataValues":['
       || string_agg({_leaf_json('el', 'v', 'coc')}, ',' ORDER BY mapping_idx, el, v, coc) || ']}}' AS json
FROM leaves GROUP BY data_set, period, org_unit
""")
def dvs_json_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per set, null combos left out."""
    return dl.dvs_json(rollup_sets(spark, sf_dir)).drop("chunk")


SPARK_FAILED = """
SELECT event_id, user_id, ts, value,
       to_json(named_struct('event_id', event_id, 'user_id', user_id)) AS body,
       CASE WHEN value < 100 THEN NULL ELSE 'user-' || CAST(user_id AS STRING) END AS header_id,
       CASE WHEN value < 50 THEN NULL ELSE 'prop-' || CAST(user_id AS STRING) END AS property_id,
       CASE WHEN value < 20 THEN NULL ELSE CAST(floor(value / 100) AS INT) END AS redeliveries
FROM events WHERE event_type = 'error'
"""


@query("dead_letters", oracle=f"""
SELECT coalesce(CASE WHEN value < 100 THEN NULL ELSE 'user-' || user_id END,
                CASE WHEN value < 50 THEN NULL ELSE 'prop-' || user_id END, 'unknown') AS report_id,
       '{{"event_id":' || event_id || ',"user_id":' || user_id || '}}' AS body,
       'DLQ - Failed to process message after '
         || coalesce(CASE WHEN value < 20 THEN NULL ELSE CAST(floor(value / 100) AS INT) END, 0)
         || ' redeliveries. Body: {{"event_id":' || event_id || ',"user_id":' || user_id || '}}' AS error_message,
       coalesce(CASE WHEN value < 20 THEN NULL ELSE CAST(floor(value / 100) AS INT) END, 0) AS redeliveries,
       strftime(ts, '{DUCK_TS_FMT}') AS failed_at
FROM events WHERE event_type = 'error'
""")
def dead_letters_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed sets as dead letters; report from header, else property, else unknown."""
    td.sources(spark, sf_dir)
    failed = spark.sql(SPARK_FAILED)
    out = dl.dead_letters(failed, F.col("body"), F.col("header_id"), F.col("property_id"),
                          F.col("redeliveries"), failed_at=F.col("ts"))
    return out.withColumn("failed_at", F.date_format("failed_at", TS_FMT))


CAUSE_MESSAGE = """CASE WHEN depth = 0 THEN 'POST failed code=' || CAST(400 + CAST(floor(value) AS BIGINT) % 110 AS STRING)
                    || ', url=https://recv.example/api/' || CAST(user_id AS STRING)
          WHEN depth = 1 THEN CASE WHEN value < 100 THEN NULL ELSE 'Connection reset' END
          ELSE 'cause ' || CAST(depth AS STRING) || ' of ' || CAST(event_id AS STRING) END"""

CAUSE_CLASS = "CASE WHEN depth = 0 THEN 'org.example.HttpFailure' ELSE 'java.io.IOException' END"

SPARK_CAUSES = f"""
SELECT event_id AS failure_id, depth, {CAUSE_MESSAGE} AS message, {CAUSE_CLASS} AS class_name
FROM (SELECT event_id, user_id, value,
             explode(sequence(0, CAST(floor(value / 100) AS INT) + 1)) AS depth
      FROM events WHERE event_type = 'error')
"""
DUCK_CAUSES = f"""
SELECT event_id AS failure_id, depth, {CAUSE_MESSAGE.replace('STRING', 'VARCHAR')} AS message,
       {CAUSE_CLASS} AS class_name
FROM (SELECT event_id, user_id, value,
             CAST(unnest(range(0, CAST(floor(value / 100) AS INT) + 2)) AS INTEGER) AS depth
      FROM events WHERE event_type = 'error')
"""


def causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    td.sources(spark, sf_dir)
    return spark.sql(SPARK_CAUSES)


@query("error_chain", oracle=f"""
SELECT failure_id,
       '{dl.SEND_FAILED} -> ' || string_agg(coalesce(message, 'null'), ' -> ' ORDER BY depth) AS chain
FROM ({DUCK_CAUSES}) GROUP BY failure_id
""")
def error_chain_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cause chain text per failure, null messages printed as ``null``."""
    return dl.error_chain(causes(spark, sf_dir))


@query("error_details", oracle=f"""
SELECT failure_id, depth,
       'Caused by (' || CAST(depth + 1 AS VARCHAR) || '): ' || class_name || ' - ' || coalesce(message, 'null') AS line
FROM ({DUCK_CAUSES}) WHERE depth < 5
""")
def error_details_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``Caused by (n): class - message`` lines, depth limited to 5."""
    return dl.error_details(causes(spark, sf_dir))


MESSAGE_SQL = """CASE event_type
  WHEN 'purchase' THEN 'status code=409, url=https://recv.example/api/' || CAST(user_id AS STRING) || ', conflict'
  WHEN 'error' THEN 'Server said code=500 url=https://recv.example/api'
  WHEN 'view' THEN 'code= 20x , url=  https://recv.example/v  '
  WHEN 'click' THEN NULL
  ELSE 'no code here, code=' || CAST(event_id AS STRING) END"""


@query("parse_delivery_errors", oracle=f"""
WITH m AS (SELECT event_id, {MESSAGE_SQL.replace('STRING', 'VARCHAR')} AS message FROM events)
SELECT event_id,
       coalesce(TRY_CAST({DUCK_JTRIM.format("regexp_extract(message, 'code=([^,]*),', 1)")} AS INTEGER), 0)
         AS status_code,
       CASE WHEN strpos(message, 'url=') > 0
            THEN {DUCK_JTRIM.format("regexp_extract(message, 'url=([^,]*)', 1)")} END AS url,
       coalesce(TRY_CAST({DUCK_JTRIM.format("regexp_extract(message, 'code=([^,]*),', 1)")} AS INTEGER), 0) = 409
         AS is_conflict
FROM m
""")
def parse_delivery_errors_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status code up to the next comma (else 0), URL, conflict flag."""
    td.sources(spark, sf_dir)
    msgs = spark.sql(f"SELECT event_id, {MESSAGE_SQL} AS message FROM events")
    return dl.parse_delivery_errors(msgs).drop("message")


@query("classify_status", oracle="""
SELECT event_id,
       CASE WHEN code >= 200 AND code < 300 THEN 'ok' WHEN code = 409 THEN 'ok_conflict' ELSE 'error' END
         AS outcome,
       regexp_matches(body, 'error|Error') AS mentions_error
FROM (SELECT event_id, CAST(floor(value) AS INTEGER) + 100 AS code,
             event_type || ' ' || props AS body FROM events)
""")
def classify_status_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response class from the status code; body flagged when it mentions an error."""
    ev = table(spark, sf_dir, "events")
    code = (F.floor("value") + 100).cast("int")
    body = F.concat_ws(" ", "event_type", "props")
    return ev.select("event_id", *dl.classify_status(code, body))


BODY_SQL = """CASE event_type
  WHEN 'click' THEN '{"status":"x","total":}'
  ELSE '{"response":{"responseType":"ImportReport","status":"'
       || CASE event_type WHEN 'purchase' THEN 'OK' WHEN 'view' THEN 'WARNING' WHEN 'error' THEN 'ERROR' ELSE '' END
       || '","stats":{"total":' || CAST(event_id % 7 AS STRING) || ',"created":1,"updated":2}},'
       || '"typeReports":[{"stats":{"total":' || CAST(user_id % 3 AS STRING) || ',"created":'
       || CAST(event_id AS STRING) || '}}]}' END"""


@query("import_summary", oracle=f"""
WITH b AS (SELECT event_id, {BODY_SQL.replace('STRING', 'VARCHAR')} AS body FROM events)
SELECT event_id, status, total, created, updated,
       CASE WHEN status IN ('OK', 'WARNING') THEN 'imported'
            WHEN coalesce(total, 0) > 0 THEN 'processed' ELSE 'failed' END AS outcome
FROM (SELECT event_id,
        CASE WHEN regexp_matches(body, '"response":\\{{"responseType":"ImportReport","status":"([^"]*)"')
             THEN regexp_extract(body, '"response":\\{{"responseType":"ImportReport","status":"([^"]*)"', 1) END
          AS status,
        TRY_CAST(regexp_extract_all(body, '"total":([0-9]*)', 1)[-1] AS BIGINT) AS total,
        TRY_CAST(regexp_extract_all(body, '"created":([0-9]*)', 1)[-1] AS BIGINT) AS created,
        TRY_CAST(regexp_extract_all(body, '"updated":([0-9]*)', 1)[-1] AS BIGINT) AS updated
      FROM b)
""")
def import_summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Import status and the last total/created/updated counters of a response body."""
    td.sources(spark, sf_dir)
    bodies = spark.sql(f"SELECT event_id, {BODY_SQL} AS body FROM events")
    return bodies.select("event_id", *dl.import_summary(F.col("body")))


@query("run_counts", oracle=f"""
WITH r AS ({DUCK_ROLLUP_ALL}), e AS ({DUCK_EVENTS}), l AS ({DUCK_EVENT_LEAVES})
SELECT 'line-returns' AS report_id, (SELECT COUNT(*) FROM r) AS result_rows,
       (SELECT 2 * COUNT(*) FROM r) AS data_values, (SELECT COUNT(*) FROM r) AS data_value_sets,
       (SELECT COUNT(*) FROM r) AS records_synced
UNION ALL
SELECT 'user-events', (SELECT COUNT(*) FROM e), (SELECT COUNT(*) FROM l),
       (SELECT COUNT(*) FROM (SELECT DISTINCT dataSet, period, orgUnit FROM l)),
       (SELECT COUNT(*) FROM (SELECT DISTINCT dataSet, period, orgUnit FROM l))
""")
def run_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows, data values and sets per report run; records = sets."""
    parts = []
    checkpoint_dir(spark)
    for report, rows, order in ((td.ROLLUP_REPORT, rollup_rows(spark, sf_dir), None),
                                (td.EVENTS_REPORT, events_rows(spark, sf_dir), td.EVENTS_ORDER)):
        rows = rows.checkpoint(eager=True)   # rows and values are counted from one run
        parts.append((rows.select(F.lit(report.id).alias("report_id")),
                      report_values_long(rows, report, order_by=order).select("report_id", *dl.KEYS)))
    (rows, long), (rows_2, long_2) = parts
    return dl.run_counts(rows.unionByName(rows_2), long.unionByName(long_2))


@query("verify_by_orgunit", oracle=f"""
SELECT org_unit AS orgUnit, CAST(2 * COUNT(*) AS BIGINT) AS data_values, COUNT(*) AS data_value_sets
FROM ({DUCK_ROLLUP_ALL}) GROUP BY org_unit
""")
def verify_by_orgunit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered values and sets per org unit."""
    return dl.verify_counts(rollup_long(spark, sf_dir), "orgUnit")


@query("verify_by_period", oracle=f"""
SELECT period, CAST(2 * COUNT(*) AS BIGINT) AS data_values, COUNT(*) AS data_value_sets
FROM ({DUCK_ROLLUP_ALL}) GROUP BY period
""")
def verify_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered values and sets per period."""
    return dl.verify_counts(rollup_long(spark, sf_dir), "period")


CHECK_UNITS = ["NATION_3", "NATION_7"]
CHECK_PERIODS = ["199601", "199602", "199603"]


@query("verify_total", oracle=f"""
WITH v AS (
  SELECT org_unit AS orgUnit, period, 'ElReturned' AS dataElement, 'CocLine' AS coc, CAST(performed AS VARCHAR) AS value
  FROM ({DUCK_ROLLUP_ALL})
  UNION ALL
  SELECT org_unit, period, 'ElReturnedLarge', 'CocLine', CAST(positive AS VARCHAR) FROM ({DUCK_ROLLUP_ALL})),
f AS (SELECT * FROM v WHERE orgUnit IN ('NATION_3', 'NATION_7') AND period IN ('199601', '199602', '199603'))
SELECT (SELECT COUNT(*) FROM f) AS total_values,
       (SELECT '{{"dataElement":"' || dataElement || '","period":"' || period || '","orgUnit":"' || orgUnit
               || '","value":"' || value || '","categoryOptionCombo":"' || coc || '"}}'
        FROM f ORDER BY orgUnit, period, dataElement, coc, value LIMIT 1) AS sample
""")
def verify_total_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total stored values for asked org units and periods, plus a sample value."""
    long = report_values_long(rollup_rows(spark, sf_dir), td.ROLLUP_REPORT)
    return dl.verify_total(long, "DsLineReturns", CHECK_UNITS, CHECK_PERIODS)


FAILURE_BODY = "CASE WHEN value < 250 THEN NULL ELSE 'request ' || event_id END"


@query("error_detail_text", oracle=f"""
WITH c AS ({DUCK_CAUSES}),
l AS (SELECT failure_id, string_agg('Caused by (' || CAST(depth + 1 AS VARCHAR) || '): ' || class_name || ' - '
             || coalesce(message, 'null') || chr(10), '' ORDER BY depth) AS lines FROM c WHERE depth < 5 GROUP BY 1),
f AS (SELECT event_id AS failure_id, 'org.example.SendFailure' AS class_name,
             CASE WHEN value < 30 THEN NULL WHEN value < 60 THEN 'no status here'
                  ELSE 'POST failed code=' || CASE WHEN value < 200 THEN '409' ELSE '500' END
                       || ', url= https://recv.example/api/' || user_id || ' , end' END AS message,
             {FAILURE_BODY} AS request_body
      FROM events WHERE event_type = 'error')
SELECT f.failure_id,
       '{dl.DETAIL_HEAD}' || '{dl.DETAIL_TYPE}' || class_name || chr(10) || '{dl.DETAIL_MESSAGE}' || coalesce(message, 'null') || chr(10)
       || CASE WHEN message LIKE '%code=%' THEN '{dl.DETAIL_STATUS}' || regexp_extract(message, 'code=([^,]*),', 1) || chr(10) ELSE '' END
       || CASE WHEN message LIKE '%url=%' THEN '{dl.DETAIL_URL}' || trim(regexp_extract(message, 'url=([^,]*)', 1)) || chr(10) ELSE '' END
       || coalesce(lines, '') || '{dl.DETAIL_REQUEST}' || coalesce(request_body, 'null') || chr(10)
       || '{dl.DETAIL_RESPONSE}' || 'null' || chr(10)
       || CASE WHEN message LIKE '%code=409,%' THEN '{dl.DETAIL_CONFLICT}' ELSE '' END || '{dl.DETAIL_END}' AS detail
FROM f LEFT JOIN l USING (failure_id)
""")
def error_detail_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole detail text of a failure, parts in order."""
    c = causes(spark, sf_dir)
    failures = spark.sql(f"""
SELECT event_id AS failure_id, 'org.example.SendFailure' AS class_name,
       CASE WHEN value < 30 THEN NULL WHEN value < 60 THEN 'no status here'
            ELSE 'POST failed code=' || CASE WHEN value < 200 THEN '409' ELSE '500' END
                 || ', url= https://recv.example/api/' || user_id || ' , end' END AS message,
       {FAILURE_BODY} AS request_body, CAST(NULL AS STRING) AS response_body
FROM events WHERE event_type = 'error'""")
    return dl.error_detail_text(failures, c)
