"""Report definitions over the driver's test tables.

The shipped reports count tests per facility and month from clinical tables.
The test data has no such tables, so the same report shapes are laid over
``lineitem``/``orders``/``customer``/``nation`` (a three-join rollup) and over
``events`` (raw rows, mapped and default paths). These are configuration; all
data comes from the given tables.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportflow import schemas
from reportflow.sources.reports import DataValueMapping, GroupBySpec, Report
from reportflow.sources.tables import DEFAULT_SYNC_START as DEFAULT_START
from reportflow.sources.tables import register_sources, table

# A checkpoint inside the test data (lineitem 1995-2001) for the incremental queries.
ROLLUP_CHECKPOINT = datetime(1996, 1, 1, tzinfo=timezone.utc)
# A start before all data: every other query runs over whole tables.
ROLLUP_START = datetime(1990, 1, 1, tzinfo=timezone.utc)

ROLLUP_SQL = """
SELECT
  'DsLineReturns' AS data_set,
  TO_CHAR(CAST(l.l_shipdate AS TIMESTAMP), 'YYYYMM') AS period, -- TO_CHAR as the reports' database has it
  n.n_name AS org_unit,
  COUNT(*) AS performed,
  COUNT(CASE WHEN l.l_quantity > 25.0 THEN 1 END) AS positive
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE l.l_shipdate > :#lastSyncTimestamp
  AND l.l_returnflag = 'R'
GROUP BY TO_CHAR(CAST(l.l_shipdate AS TIMESTAMP), 'YYYYMM'), n.n_name
ORDER BY period
"""

ROLLUP_REPORT = Report(
    id="line-returns", name="Returned line items per nation", dataSet="DsLineReturns",
    sql=ROLLUP_SQL,
    parameters={"startDate": "${START_DATE}", "minQty": "25"},
    groupBy=GroupBySpec(dataSet="data_set", period="period", orgUnit="org_unit"),
    dataValueMappings=[
        DataValueMapping(name="returned lines", dataElement="ElReturned", valueColumn="performed",
                         categoryOptionCombo="CocLine"),
        DataValueMapping(name="returned large lines", dataElement="ElReturnedLarge",
                         valueColumn="positive", categoryOptionCombo="CocLine"),
    ])

EVENTS_SQL = """
SELECT
  'DsEvents' AS data_set,
  date_format(ts, 'yyyyMM') AS period,
  CAST(user_id AS STRING) AS org_unit,
  event_id, ts, event_type, value,
  CASE event_type WHEN 'view' THEN 'default' WHEN 'click' THEN NULL
       ELSE upper(event_type) END AS combo
FROM events
WHERE ts > :#lastSyncTimestamp
"""

EVENTS_REPORT = Report(
    id="user-events", name="User events", dataSet="DsEvents", sql=EVENTS_SQL,
    groupBy=GroupBySpec(dataSet="data_set", period="period", orgUnit="org_unit"),
    dataValueMappings=[
        DataValueMapping(name="purchase value", dataElement="ElPurchase", valueColumn="value",
                         categoryOptionCombo="combo", filter="event_type = 'purchase'"),
        DataValueMapping(name="large values", dataElement="ElLarge", valueColumn="VALUE",
                         categoryOptionCombo="default", filter="row.value > 400"),
        DataValueMapping(name="event kind", dataElement="ElKind", valueColumn="event_type",
                         categoryOptionCombo="CocKind", filter=None),
        DataValueMapping(name="broken filter", dataElement="ElBroken", valueColumn="value",
                         filter="no_such_column > 1"),
        DataValueMapping(name="failing filter", dataElement="ElFails", valueColumn="value",
                         filter="CAST(event_type AS INT) > 0"),
        DataValueMapping(name="not boolean", dataElement="ElNotBool", valueColumn="value",
                         filter="value + 1"),
    ])
EVENTS_ORDER = ["ts", "event_id"]

# Default (unmapped) path: the SQL already names keys, element and value.
EVENTS_DEFAULT_SQL = """
SELECT
  'DsEvents' AS dataSet,
  date_format(ts, 'yyyyMM') AS period,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS STRING) END AS orgunit,
  event_type AS data_element,
  CASE WHEN event_type = 'signup' THEN '' ELSE CAST(value AS STRING) END AS value,
  CASE event_type WHEN 'view' THEN 'DEFAULT' WHEN 'purchase' THEN 'CocPaid' END
    AS category_option_combo,
  event_id, ts
FROM events
WHERE ts > :#lastSyncTimestamp
"""

# Rows with broken keys for the rejects output: null and blank org units.
EVENTS_REJECT_SQL = """
SELECT
  'DsEvents' AS data_set,
  date_format(ts, 'yyyyMM') AS period,
  CASE WHEN event_type = 'error' THEN NULL
       WHEN event_type = 'signup' THEN ' \t'
       ELSE CAST(user_id AS STRING) END AS org_unit,
  event_id, event_type
FROM events
"""
REJECT_GROUP_BY = GroupBySpec(dataSet="data_set", period="period", orgUnit="org_unit")


def sources(spark: SparkSession, sf_dir: str) -> None:
    # Checkpoints are instants compared with zone-less columns: runs are defined in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    register_sources(spark, sf_dir)


def customer_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report per customer (facility), as a ``reports`` table derived from ``customer``.

    All share one SQL shape that differs only in the facility literal, as the
    shipped facility A/B reports do. Edge rows: no SQL (negative balance),
    blank SQL (balance under 500), no mappings (nation 0).
    """
    c = table(spark, sf_dir, "customer")
    sql = F.concat(F.lit("SELECT * FROM orders WHERE o_custkey = "), F.col("c_custkey").cast("string"))
    mapping = lambda el, vc, coc, flt: F.struct(
        F.concat(F.lit(el + " "), F.col("c_name")).alias("name"), F.lit(el).alias("dataElement"),
        F.lit(vc).alias("valueColumn"), coc.alias("categoryOptionCombo"),
        F.lit(flt).cast("string").alias("filter"))
    maps = F.when(F.col("c_nationkey") == 0, F.array().cast(schemas.REPORTS["dataValueMappings"].dataType)) \
        .otherwise(F.array(
            mapping("ElOrders", "n_orders", F.col("c_mktsegment"), None),
            mapping("ElValue", "total_price", F.lit("default"), "n_orders > 0")))
    return c.select(
        F.concat(F.lit("rpt-"), F.col("c_custkey").cast("string")).alias("id"),
        F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("description"),
        F.col("c_mktsegment").alias("dataSet"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
         .when(F.col("c_acctbal") < 500, F.lit(" \t "))
         .otherwise(sql).alias("sql"),
        F.lit(None).cast("string").alias("sqlFile"),
        F.create_map(F.lit("nation"), F.col("c_nationkey").cast("string")).alias("parameters"),
        F.struct(F.lit("data_set").alias("dataSet"), F.lit("period").alias("period"),
                 F.concat(F.lit("OU"), F.col("c_custkey").cast("string")).alias("orgUnit")).alias("groupBy"),
        maps.alias("dataValueMappings"),
        F.col("c_custkey").cast("int").alias("pos"))

# One template for every nation's report: the facility literal became a join.
SHARED_ROLLUP_SQL = """
SELECT
  w.report_id,
  'DsLineReturns' AS data_set,
  date_format(l.l_shipdate, 'yyyyMM') AS period,
  n.n_name AS org_unit,
  COUNT(*) AS performed,
  COUNT(CASE WHEN l.l_quantity > 25.0 THEN 1 END) AS positive
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN report_watermarks w ON n.n_name = w.facility
WHERE l.l_shipdate > :lastSyncTimestamp
  AND l.l_shipdate > w.checkpoint
  AND l.l_returnflag = 'R'
GROUP BY w.report_id, date_format(l.l_shipdate, 'yyyyMM'), n.n_name
"""

# Per-nation checkpoints: 1996-01 plus the nation key in months.
NATION_WATERMARKS_SQL = """
SELECT n_name AS facility, concat('rpt-', n_name) AS report_id,
       TIMESTAMP_NTZ'1996-01-01 00:00:00' + make_ym_interval(0, n_nationkey) AS checkpoint
FROM nation
"""
