"""Queries: report SQL, definitions, unpivot and DataValueSet construction."""

from __future__ import annotations

import os
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportflow.functions.expr import coc_expr, column_or_const, filter_flag, jtrim, with_filter_flags
from reportflow.operators.delivery import write_documents
from reportflow.operators.dvs import (aggregate_dvs, merge_duplicate_leaves, nest_dvs, rejected_rows, report_values_long,
                                      values_text)
from reportflow.operators.paging import paged_extract
from reportflow.plans import testdata as td
from reportflow.plans.registry import query
from reportflow.session import checkpoint_dir
from reportflow.sources.reports import DataValueMapping, GroupBySpec, Report, explode_mappings, report_by_id, runnable_reports
from reportflow.sources.tables import register_period_function, report_params, run_report_sql, table

# DuckDB twins of the test-data report SQL (same rows; strftime for date_format).
DUCK_ROLLUP = """
SELECT 'DsLineReturns' AS data_set, strftime(l.l_shipdate, '%Y%m') AS period, n.n_name AS org_unit,
       COUNT(*) AS performed, COUNT(CASE WHEN l.l_quantity > 25.0 THEN 1 END) AS positive
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE l.l_shipdate > TIMESTAMP '1996-01-01 00:00:00' AND l.l_returnflag = 'R'
GROUP BY 2, 3
"""
DUCK_ROLLUP_ALL = DUCK_ROLLUP.replace("l.l_shipdate > TIMESTAMP '1996-01-01 00:00:00' AND ", "")

DUCK_EVENTS = """
SELECT 'DsEvents' AS data_set, strftime(ts, '%Y%m') AS period, CAST(user_id AS VARCHAR) AS org_unit,
       event_id, ts, event_type, value,
       CASE event_type WHEN 'view' THEN 'default' WHEN 'click' THEN NULL ELSE upper(event_type) END AS combo
FROM events
"""

DUCK_EVENT_LEAVES = f"""
WITH r AS ({DUCK_EVENTS})
SELECT 'user-events' AS report_id, data_set AS dataSet, period, org_unit AS orgUnit,
       'ElPurchase' AS dataElement, CAST(value AS VARCHAR) AS value,
       CASE WHEN combo <> '' AND lower(combo) <> 'default' THEN combo END AS categoryOptionCombo,
       0 AS mapping_idx, event_id, ts
FROM r WHERE event_type = 'purchase' AND value IS NOT NULL
UNION ALL
SELECT 'user-events', data_set, period, org_unit, 'ElLarge', CAST(value AS VARCHAR), NULL, 1, event_id, ts
FROM r WHERE value > 400
UNION ALL
SELECT 'user-events', data_set, period, org_unit, 'ElKind', event_type, 'CocKind', 2, event_id, ts
FROM r WHERE event_type IS NOT NULL AND event_type <> ''
"""

PAGE_KEYS = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

LEAF_TEXT_SQL = "dataElement || '=' || value || coalesce('/' || categoryOptionCombo, '')"


def rollup_rows(spark: SparkSession, sf_dir: str, checkpoint=td.ROLLUP_START) -> DataFrame:
    td.sources(spark, sf_dir)
    return run_report_sql(spark, td.ROLLUP_SQL, report_params(checkpoint, td.ROLLUP_REPORT.parameters))


def events_rows(spark: SparkSession, sf_dir: str, checkpoint=td.DEFAULT_START) -> DataFrame:
    td.sources(spark, sf_dir)
    return run_report_sql(spark, td.EVENTS_SQL, report_params(checkpoint))


def flat_sets(sets: DataFrame) -> DataFrame:
    """Nested sets as one comparable line each: keys, leaf count, ordered leaf text."""
    return sets.select("report_id", "dataSet", "period", "orgUnit",
                       F.size("dataValues").cast("long").alias("n_values"),
                       values_text(F.col("dataValues")).alias("values_text"))


@query("report_rollup", oracle=DUCK_ROLLUP)
def report_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1+S2+J1+A1+A2+X1+F1-F3+O1: the shipped report's shape, three joins and a monthly rollup."""
    return rollup_rows(spark, sf_dir, td.ROLLUP_CHECKPOINT)


@query("report_dvs", oracle=f"""
WITH r AS ({DUCK_ROLLUP_ALL}),
leaves AS (
  SELECT data_set, period, org_unit, 0 AS mapping_idx, 'ElReturned' AS dataElement,
         CAST(performed AS VARCHAR) AS value, 'CocLine' AS categoryOptionCombo FROM r
  UNION ALL
  SELECT data_set, period, org_unit, 1, 'ElReturnedLarge', CAST(positive AS VARCHAR), 'CocLine' FROM r)
SELECT 'line-returns' AS report_id, data_set AS dataSet, period, org_unit AS orgUnit,
       COUNT(*) AS n_values,
       string_agg({LEAF_TEXT_SQL}, ';' ORDER BY mapping_idx, dataElement, value, categoryOptionCombo)
         AS values_text
FROM leaves GROUP BY data_set, period, org_unit
""")
def report_dvs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: rollup report -> mapped unpivot -> DataValueSets (A3)."""
    rows = rollup_rows(spark, sf_dir)
    return flat_sets(nest_dvs(report_values_long(rows, td.ROLLUP_REPORT)))


@query("config_values_long", oracle=f"""
SELECT report_id, dataSet, period, orgUnit, dataElement, value, categoryOptionCombo, mapping_idx, event_id
FROM ({DUCK_EVENT_LEAVES})
""")
def config_values_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2+F6+F7+X7+X9: mapped unpivot of raw rows, per-mapping filters, long form."""
    long = report_values_long(events_rows(spark, sf_dir), td.EVENTS_REPORT, order_by=td.EVENTS_ORDER)
    return long.select("report_id", "dataSet", "period", "orgUnit", "dataElement", "value",
                       "categoryOptionCombo", "mapping_idx", F.col("row_order.event_id").alias("event_id"))


@query("dvs_config", oracle=f"""
SELECT report_id, dataSet, period, orgUnit, COUNT(*) AS n_values,
       string_agg({LEAF_TEXT_SQL}, ';'
                  ORDER BY mapping_idx, ts, event_id, dataElement, value, categoryOptionCombo) AS values_text
FROM ({DUCK_EVENT_LEAVES}) GROUP BY report_id, dataSet, period, orgUnit
""")
def dvs_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3+A5+O3: mapped path nested into sets, leaves by mapping then row order."""
    long = report_values_long(events_rows(spark, sf_dir), td.EVENTS_REPORT, order_by=td.EVENTS_ORDER)
    return flat_sets(nest_dvs(long))


@query("dvs_default", oracle=f"""
WITH r AS (
  SELECT 'DsEvents' AS dataSet, strftime(ts, '%Y%m') AS period,
         CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS orgUnit,
         event_type AS dataElement,
         CASE WHEN event_type = 'signup' THEN '' ELSE CAST(value AS VARCHAR) END AS value,
         CASE event_type WHEN 'purchase' THEN 'CocPaid' END AS categoryOptionCombo,
         event_id, ts
  FROM events)
SELECT CAST(NULL AS VARCHAR) AS report_id, dataSet, period, orgUnit, COUNT(*) AS n_values,
       string_agg({LEAF_TEXT_SQL}, ';'
                  ORDER BY ts, event_id, dataElement, value, categoryOptionCombo) AS values_text
FROM r WHERE orgUnit IS NOT NULL AND dataElement IS NOT NULL AND value IS NOT NULL
GROUP BY dataSet, period, orgUnit
""")
def dvs_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4+X10+F9: default path, keys and leaf from alias columns, empty values kept."""
    td.sources(spark, sf_dir)
    rows = run_report_sql(spark, td.EVENTS_DEFAULT_SQL, report_params(td.DEFAULT_START))
    return flat_sets(aggregate_dvs(rows, None, order_by=td.EVENTS_ORDER))


@query("mapping_filter", oracle="""
SELECT event_id, coalesce(event_type = 'purchase', false) AS f_purchase,
       coalesce(value > 400, false) AS f_row, false AS f_broken, false AS f_not_boolean,
       false AS f_null, false AS f_cast, coalesce(user_id % 3 <> 0 AND 1000 / (user_id % 3) > 600, false) AS f_division
FROM events
""")
def mapping_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter text as a Spark SQL boolean; errors (also of a single row), nulls and non-booleans drop."""
    filters = {"f_purchase": "event_type = 'purchase'", "f_row": "row.value > 400", "f_broken": "no_such_column > 1",
               "f_not_boolean": "value + 1", "f_null": "value > CAST(NULL AS DOUBLE)",
               "f_cast": "CAST(event_type AS INT) > 0", "f_division": "1000 / (user_id % 3) > 600"}
    ev = with_filter_flags(table(spark, sf_dir, "events"), list(filters.values()))
    return ev.select("event_id", *[F.col(filter_flag(i)).alias(name) for i, name in enumerate(filters)])


@query("coc_resolution", oracle=f"""
WITH r AS ({DUCK_EVENTS})
SELECT event_id,
       CASE WHEN combo <> '' AND lower(combo) <> 'default' THEN combo END AS coc_column,
       CASE WHEN combo <> '' AND lower(combo) <> 'default' THEN combo ELSE 'COMBO' END AS coc_legacy,
       'CocX' AS coc_const, CAST(NULL AS VARCHAR) AS coc_default, CAST(NULL AS VARCHAR) AS coc_blank
FROM r
""")
def coc_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combo from a column or a constant; ``default`` and blanks mean none."""
    rows = events_rows(spark, sf_dir, checkpoint=td.DEFAULT_START)
    return rows.select(
        "event_id",
        coc_expr(rows, "combo").alias("coc_column"),
        coc_expr(rows, "COMBO", legacy_fallback=True).alias("coc_legacy"),
        coc_expr(rows, " CocX\t").alias("coc_const"),
        coc_expr(rows, "Default").alias("coc_default"),
        coc_expr(rows, "  ").alias("coc_blank"))


DUCK_REJECT_ROWS = """
SELECT 'DsEvents' AS data_set, strftime(ts, '%Y%m') AS period,
       CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN ' ' || chr(9)
            ELSE CAST(user_id AS VARCHAR) END AS org_unit,
       event_id, event_type
FROM events
"""
DUCK_JTRIM = "regexp_replace({0}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


@query("group_key_resolution", oracle=f"""
SELECT event_id, {DUCK_JTRIM.format('org_unit')} AS k_reject,
       coalesce({DUCK_JTRIM.format('org_unit')}, 'org_unit') AS k_name,
       'Facility-1' AS k_const, {DUCK_JTRIM.format('org_unit')} AS k_case
FROM ({DUCK_REJECT_ROWS})
""")
def group_key_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouping key from a column (any case) or a constant."""
    td.sources(spark, sf_dir)
    rows = spark.sql(td.EVENTS_REJECT_SQL)
    return rows.select(
        "event_id",
        column_or_const(rows, "org_unit").alias("k_reject"),
        column_or_const(rows, "org_unit", null_key="name").alias("k_name"),
        column_or_const(rows, "  Facility-1 ").alias("k_const"),
        column_or_const(rows, "ORG_UNIT").alias("k_case"))


@query("rejected_rows", oracle=f"""
SELECT 'user-events' AS report_id, 'missing_grouping_key' AS reason,
       '{{"data_set":' || to_json(data_set) || ',"period":' || to_json(period)
       || CASE WHEN org_unit IS NULL THEN '' ELSE ',"org_unit":' || to_json(org_unit) END
       || ',"event_id":' || event_id || ',"event_type":' || to_json(event_type) || '}}' AS body
FROM ({DUCK_REJECT_ROWS})
WHERE org_unit IS NULL OR {DUCK_JTRIM.format('org_unit')} = ''
""")
def rejected_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: rows with a null or blank grouping key go to a rejects output with the reason."""
    td.sources(spark, sf_dir)
    rows = spark.sql(td.EVENTS_REJECT_SQL)
    return rejected_rows(rows, td.REJECT_GROUP_BY, report_id="user-events")


@query("mappings_exploded", oracle="""
SELECT 'rpt-' || c_custkey AS report_id, 0 AS mapping_idx, 'ElOrders ' || c_name AS mapping_name,
       'ElOrders' AS dataElement, 'n_orders' AS valueColumn, c_mktsegment AS categoryOptionCombo,
       CAST(NULL AS VARCHAR) AS filter
FROM customer WHERE c_nationkey <> 0
UNION ALL
SELECT 'rpt-' || c_custkey, 1, 'ElValue ' || c_name, 'ElValue', 'total_price', 'default', 'n_orders > 0'
FROM customer WHERE c_nationkey <> 0
UNION ALL
SELECT 'rpt-' || c_custkey, NULL, NULL, NULL, NULL, NULL, NULL FROM customer WHERE c_nationkey = 0
""")
def mappings_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: report definitions as a table, one row per mapping with its position."""
    return explode_mappings(td.customer_reports(spark, sf_dir)).select(
        "report_id", "mapping_idx", "mapping_name", "dataElement", "valueColumn",
        "categoryOptionCombo", "filter")


@query("runnable_reports", oracle="""
SELECT 'rpt-' || c_custkey AS id, c_name AS name, c_mktsegment AS dataSet
FROM customer WHERE c_acctbal >= 500
""")
def runnable_reports_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports with null or blank SQL are skipped before any state change."""
    return runnable_reports(td.customer_reports(spark, sf_dir)).select("id", "name", "dataSet")


@query("period_udf", oracle="""
SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS period FROM orders
""")
def period_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``calculate_period`` as a SQL function (inlined, no Python)."""
    td.sources(spark, sf_dir)
    register_period_function(spark)
    return spark.sql("SELECT o_orderkey, calculate_period(o_orderdate) AS period FROM orders")


@query("jtrim", oracle=f"""
SELECT doc_id, {DUCK_JTRIM.format("chr(9) || chr(1) || ' ' || text || ' ' || chr(160) || chr(10) || chr(31)")}
         AS trimmed,
       trim(chr(9) || ' ' || text || ' ') AS sql_trimmed
FROM documents
""")
def jtrim_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Java trim over whole texts; U+00A0 stays, control chars go."""
    d = table(spark, sf_dir, "documents")
    padded = F.concat(F.lit("\t\x01 "), F.col("text"), F.lit("  \n\x1f"))
    return d.select("doc_id", jtrim(padded).alias("trimmed"),
                    F.trim(F.concat(F.lit("\t "), F.col("text"), F.lit(" "))).alias("sql_trimmed"))


@query("param_range_filter", oracle="""
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m') AS period
FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-12-31 00:00:00'
  AND o_totalprice >= 1000
""")
def param_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report parameters bound as named SQL parameters (strings cast in SQL)."""
    td.sources(spark, sf_dir)
    sql = ("SELECT o_orderkey, o_custkey, date_format(o_orderdate, 'yyyyMM') AS period FROM orders "
           "WHERE o_orderdate BETWEEN CAST(:#startDate AS TIMESTAMP_NTZ) AND CAST(:#endDate AS TIMESTAMP_NTZ) "
           "AND o_totalprice >= CAST(:#minPrice AS DOUBLE)")
    params = {"startDate": "1996-01-01", "endDate": "1996-12-31", "minPrice": "1000",
              "unused": "${NOT_SET}"}
    return run_report_sql(spark, sql, report_params(td.DEFAULT_START, params))


@query("paged_extract", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipdate
FROM lineitem WHERE l_shipdate > TIMESTAMP '1996-01-01 00:00:00'
ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 1000
""")
def paged_extract_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One top-k page after the checkpoint, keyed by a unique tie-break."""
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") > F.lit("1996-01-01").cast("timestamp_ntz"))
    page = paged_extract(li, PAGE_KEYS, 1000)
    return page.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipdate"))


@query("duplicate_leaves", oracle=f"""
SELECT report_id, dataSet, period, orgUnit, dataElement, categoryOptionCombo, value, mapping_idx
FROM ({DUCK_EVENT_LEAVES})
QUALIFY row_number() OVER (PARTITION BY report_id, dataSet, period, orgUnit, dataElement, categoryOptionCombo
                           ORDER BY mapping_idx DESC, ts DESC, event_id DESC, value DESC) = 1
""")
def duplicate_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 option: repeated (element, combo) in a set merged to the last by mapping and row order."""
    long = report_values_long(events_rows(spark, sf_dir), td.EVENTS_REPORT, order_by=td.EVENTS_ORDER)
    return merge_duplicate_leaves(long, "last").select(
        "report_id", "dataSet", "period", "orgUnit", "dataElement", "categoryOptionCombo", "value", "mapping_idx")


@query("paged_extract_next", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipdate
FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 1000 OFFSET 2000
""")
def paged_extract_next_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: the third page, each page continuing after the last key of the one before."""
    li, keys, after = table(spark, sf_dir, "lineitem"), PAGE_KEYS, None
    for _ in range(2):
        last = paged_extract(li, keys, 1000, after).select(*keys).tail(1)   # one row
        after = [F.lit(last[0][0]).cast("timestamp_ntz"), *last[0][1:]]
    return paged_extract(li, keys, 1000, after).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipdate"))


@query("duplicate_leaves_sum", oracle="""
SELECT l_returnflag AS orgUnit, CAST(sum(CAST(l_quantity AS DECIMAL(38, 0))) AS VARCHAR) AS quantity,
       count(*) AS leaves
FROM lineitem GROUP BY l_returnflag
""")
def duplicate_leaves_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 option: repeated leaves of a set added up exactly, as plain decimal text."""
    long = hot_long(spark, sf_dir)
    total = merge_duplicate_leaves(long, "sum").select("orgUnit", F.col("value").alias("quantity"))
    return total.join(long.groupBy("orgUnit").agg(F.count("*").alias("leaves")), "orgUnit")


def hot_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``lineitem`` in three sets with very many equal leaves."""
    li = table(spark, sf_dir, "lineitem").select(
        F.lit("DsHot").alias("data_set"), F.lit("all").alias("period"), "l_returnflag", "l_orderkey", "l_linenumber",
        "l_partkey", F.col("l_quantity").cast("decimal(18,0)").cast("string").alias("quantity"))
    report = Report(id="hot", groupBy=GroupBySpec("data_set", "period", "l_returnflag"),
                    dataValueMappings=[DataValueMapping("ElQuantity", "quantity")])
    return report_values_long(li, report, order_by=["l_orderkey", "l_linenumber", "l_partkey"])


HOT_PART = 1000


@query("dvs_hot_set", oracle=f"""
WITH leaves AS (
  SELECT l_returnflag AS orgUnit, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS value,
         row_number() OVER (PARTITION BY l_returnflag
                            ORDER BY l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)) - 1 AS n
  FROM lineitem)
SELECT orgUnit, CAST(floor(n / {HOT_PART}) AS INTEGER) AS chunk, COUNT(*) AS n_values,
       md5(string_agg('ElQuantity=' || value, ';' ORDER BY n)) AS values_md5
FROM leaves GROUP BY ALL
""")
def dvs_hot_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, O3: sets of any size, here asked for in parts: exact bound, leaf order kept, equal leaves spread."""
    sets = nest_dvs(hot_long(spark, sf_dir), HOT_PART)
    return sets.select("orgUnit", "chunk", F.size("dataValues").cast("long").alias("n_values"),
                       F.md5(values_text(F.col("dataValues"))).alias("values_md5"))


@query("dvs_streamed_document", oracle="""
WITH l AS (
  SELECT l_returnflag AS orgUnit, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS value,
         row_number() OVER (PARTITION BY l_returnflag
                            ORDER BY l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)) AS n,
         count(*) OVER (PARTITION BY l_returnflag) AS all_n
  FROM lineitem)
SELECT orgUnit, CASE WHEN n = 1 THEN '{"dataSet":"DsHot","period":"all","orgUnit":"' || orgUnit || '","dataValues":[' ELSE ',' END
       || '{"dataElement":"ElQuantity","value":"' || value || '"}' || CASE WHEN n = all_n THEN ']}' ELSE '' END AS text
FROM l
""")
def dvs_streamed_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets larger than memory as one document each, written piece by piece in leaf order; no set is collected."""
    path = os.path.join(checkpoint_dir(spark), "documents-" + uuid.uuid4().hex)
    write_documents(hot_long(spark, sf_dir), path)
    return spark.read.text(path).select("orgUnit", F.col("value").alias("text"))


@query("report_lookup", oracle="""
WITH r AS (SELECT 'rpt-' || c_custkey AS id, c_name AS name, c_custkey FROM customer),
asked AS (SELECT 'rpt-7' AS asked UNION ALL SELECT 'none such' UNION ALL SELECT NULL)
SELECT asked, id, name FROM asked JOIN r ON id = asked
UNION ALL SELECT NULL, id, name FROM (SELECT * FROM r ORDER BY c_custkey LIMIT 1)
""")
def report_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A definition by id; an unknown id gives none, no id the first one."""
    reports = td.customer_reports(spark, sf_dir)
    found = None
    for asked in ("rpt-7", "none such", None):
        one = report_by_id(reports, asked).select(F.lit(asked).cast("string").alias("asked"), "id", "name")
        found = one if found is None else found.unionByName(one)
    return found


@query("empty_result", oracle="""
SELECT 'values' AS kind, 0 AS n UNION ALL SELECT 'sets', 0 UNION ALL SELECT 'rejects', 0
UNION ALL SELECT 'default_values', 0 UNION ALL SELECT 'rows_read', COUNT(*) FROM lineitem
""")
def empty_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL that gives no row gives no value, set or reject, with and without a mapping."""
    rows = rollup_rows(spark, sf_dir, datetime(2999, 1, 1, tzinfo=timezone.utc))
    long = report_values_long(rows, td.ROLLUP_REPORT)
    parts = {"values": long, "sets": nest_dvs(long), "rejects": rejected_rows(rows, td.ROLLUP_REPORT.groupBy, report_id="r"),
             "default_values": nest_dvs(report_values_long(rows, Report(id="plain"))), "rows_read": table(spark, sf_dir, "lineitem")}
    out = None
    for kind, df in parts.items():
        one = df.agg(F.count(F.lit(1)).cast("int").alias("n")).select(F.lit(kind).alias("kind"), "n")
        out = one if out is None else out.unionByName(one)
    return out
