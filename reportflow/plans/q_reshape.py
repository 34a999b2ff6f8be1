"""Queries: set and row reshaping, defaults and placeholder substitution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportflow.functions.expr import elvis, resolve_placeholders, string_value_of
from reportflow.operators.reshape import (ElementPair, custom_transform, default_transform, element_leaves,
                                          ensure_complete_date, example_script, multi_element_unpivot)
from reportflow.plans import testdata as td
from reportflow.plans.q_delivery import rollup_long
from reportflow.plans.q_reports import DUCK_ROLLUP_ALL
from reportflow.plans.registry import query
from reportflow.sources.tables import table

AS_OF = "2026-02-15"


@query("complete_date", oracle=f"""
SELECT 'line-returns' AS report_id, data_set AS dataSet, period, org_unit AS orgUnit,
       CASE WHEN period < '199701' THEN strftime(last_day(strptime(period, '%Y%m')), '%Y-%m-%d')
            ELSE '{AS_OF}' END AS completeDate
FROM ({DUCK_ROLLUP_ALL})
""")
def complete_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets keep their completeDate; a missing one is set to the run date."""
    sets = rollup_long(spark, sf_dir).select("report_id", "dataSet", "period", "orgUnit").distinct()
    sets = sets.withColumn("completeDate", F.when(
        F.col("period") < "199701",
        F.date_format(F.last_day(F.to_date("period", "yyyyMM")), "yyyy-MM-dd")))
    return ensure_complete_date(sets, AS_OF).select("report_id", "dataSet", "period", "orgUnit",
                                                     "completeDate")


EVENT_FLAT = """
SELECT event_id, date_format(ts, 'yyyyMM') AS period, CAST(user_id AS STRING) AS orgUnit,
       event_type AS dataElement, value,
       CASE event_type WHEN 'view' THEN 'Default' WHEN 'click' THEN ' \t' WHEN 'error' THEN NULL
            ELSE 'Coc' || upper(event_type) END AS categoryOptionCombo
FROM events
"""


@query("default_transform", oracle=f"""
SELECT event_id, 'default' AS dataSet, '{AS_OF}' AS completeDate, strftime(ts, '%Y%m') AS period,
       CAST(user_id AS VARCHAR) AS orgUnit, event_type AS dataElement, value,
       CASE WHEN event_type IN ('view', 'click', 'error') THEN NULL ELSE 'Coc' || upper(event_type) END
         AS categoryOptionCombo
FROM events
""")
def default_transform_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat row to one set; defaults only for absent columns; default/blank combos dropped."""
    td.sources(spark, sf_dir)
    out = default_transform(spark.sql(EVENT_FLAT), as_of=AS_OF)
    leaf = F.get(F.col("dataValues"), 0)
    return out.select("event_id", "dataSet", "completeDate", "period", "orgUnit",
                      leaf["dataElement"].alias("dataElement"), leaf["value"].alias("value"),
                      leaf["categoryOptionCombo"].alias("categoryOptionCombo"))


SCRIPT_ROWS = """
SELECT event_id,
       CASE event_type WHEN 'signup' THEN '' WHEN 'error' THEN NULL ELSE 'DsEvents' END AS dataSet,
       date_format(ts, 'yyyyMM') AS period, CAST(user_id AS STRING) AS orgUnit, event_type AS dataElement,
       CASE event_type WHEN 'view' THEN '' ELSE upper(event_type) END AS categoryOptionCombo,
       CASE WHEN event_type = 'click' THEN NULL ELSE value END AS value
FROM events
"""


@query("custom_transform", oracle=f"""
SELECT event_id,
       CASE WHEN event_type IN ('signup', 'error') THEN 'default' ELSE 'DsEvents' END AS dataSet,
       strftime(ts, '%Y%m') AS period, CAST(user_id AS VARCHAR) AS orgUnit, '{AS_OF}' AS completeDate,
       event_type AS dataElement,
       CASE WHEN event_type = 'view' THEN 'default' ELSE upper(event_type) END AS categoryOptionCombo,
       CASE WHEN event_type = 'click' THEN 'null' ELSE CAST(value AS VARCHAR) END AS value
FROM events
""")
def custom_transform_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample column-to-field script as a projection."""
    td.sources(spark, sf_dir)
    out = example_script(spark.sql(SCRIPT_ROWS), as_of=AS_OF, keep=["event_id"])
    leaf = F.get(F.col("dataValues"), 0)
    return out.select("event_id", "dataSet", "period", "orgUnit", "completeDate",
                      leaf["dataElement"].alias("dataElement"),
                      leaf["categoryOptionCombo"].alias("categoryOptionCombo"), leaf["value"].alias("value"))


@query("elvis_default", oracle="""
SELECT event_id,
       CASE WHEN event_type IN ('view', 'click') THEN 'default' ELSE event_type END AS s_elvis,
       CASE WHEN CAST(floor(value) AS BIGINT) - 100 <> 0 THEN CAST(floor(value) AS BIGINT) - 100 ELSE -1 END
         AS n_elvis,
       CASE WHEN event_type = 'error' THEN 'null' ELSE CAST(value AS VARCHAR) END AS s_value_of
FROM events
""")
def elvis_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``x ?: default`` with Groovy truth; ``String.valueOf`` prints null as text."""
    ev = table(spark, sf_dir, "events")
    s = F.when(F.col("event_type") == "view", F.lit("")).when(F.col("event_type") == "click", F.lit(None)) \
        .otherwise(F.col("event_type"))
    n = F.floor("value") - 100
    v = F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value"))
    return ev.select("event_id", elvis(s, T.StringType(), "default").alias("s_elvis"),
                     elvis(n, T.LongType(), F.lit(-1).cast("long")).alias("n_elvis"),
                     string_value_of(v).alias("s_value_of"))


LINE_ROWS = """
SELECT l_orderkey, l_linenumber, 'ElQty' AS el1, l_quantity AS v1, l_returnflag AS c1,
       CASE WHEN l_returnflag = 'N' THEN '' ELSE 'ElDisc' END AS el2, l_discount AS v2,
       CAST(NULL AS STRING) AS c2,
       'ElTax' AS el3, CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_tax END AS v3, 'CocTax' AS c3,
       l_linenumber AS n
FROM lineitem
"""
PAIRS = [ElementPair("el1", "v1", "c1"), ElementPair("el2", "v2", "c2"), ElementPair("el3", "v3", "c3")]


def leaves_text(c):
    return F.array_join(F.transform(c, lambda x: F.concat(
        x["dataElement"], F.lit("="), x["value"], F.lit("/"),
        F.coalesce(x["categoryOptionCombo"], F.lit("-")))), ";")


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    td.sources(spark, sf_dir)
    return spark.sql(LINE_ROWS)


DUCK_LINE = """
SELECT l_orderkey, l_linenumber, l_quantity AS v1, l_returnflag AS c1,
       CASE WHEN l_returnflag = 'N' THEN '' ELSE 'ElDisc' END AS el2, l_discount AS v2,
       CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_tax END AS v3, l_linenumber AS n
FROM lineitem
"""


@query("multi_element_unpivot", oracle=f"""
SELECT l_orderkey, l_linenumber,
  concat_ws(';',
    CASE WHEN v1 <> 0 THEN 'ElQty=' || CAST(v1 AS VARCHAR) || '/' || coalesce(c1, '-') END,
    CASE WHEN v2 <> 0 THEN el2 || '=' || CAST(v2 AS VARCHAR) || '/-' END,
    CASE WHEN v3 IS NOT NULL AND v3 <> 0 THEN 'ElTax=' || CAST(v3 AS VARCHAR) || '/CocTax' END) AS readme_form,
  concat_ws(';',
    CASE WHEN v1 IS NOT NULL THEN 'ElQty=' || CAST(v1 AS VARCHAR) || '/'
         || CASE WHEN c1 IS NOT NULL AND c1 <> '' THEN c1 ELSE 'default' END END,
    CASE WHEN el2 <> '' AND v2 IS NOT NULL THEN el2 || '=' || CAST(v2 AS VARCHAR) || '/default' END,
    CASE WHEN v3 IS NOT NULL THEN 'ElTax=' || CAST(v3 AS VARCHAR) || '/CocTax' END) AS strict_form
FROM ({DUCK_LINE})
""")
def multi_element_unpivot_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row to several leaves; README rule skips falsy values, strict rule keeps 0."""
    rows = line_rows(spark, sf_dir)
    readme = element_leaves(rows, PAIRS, rule="value_truthy")
    strict = element_leaves(rows, PAIRS, rule="element_and_value", combo_default="default")
    return rows.select("l_orderkey", "l_linenumber", leaves_text(readme).alias("readme_form"),
                       leaves_text(strict).alias("strict_form"))


@query("derived_element", oracle=f"""
SELECT l_orderkey, l_linenumber,
  concat_ws(';',
    CASE WHEN v1 IS NOT NULL THEN 'ElQty=' || CAST(v1 AS VARCHAR) || '/'
         || CASE WHEN c1 IS NOT NULL AND c1 <> '' THEN c1 ELSE 'default' END END,
    CASE WHEN el2 <> '' AND v2 IS NOT NULL THEN el2 || '=' || CAST(v2 AS VARCHAR) || '/default' END,
    CASE WHEN v3 IS NOT NULL THEN 'ElTax=' || CAST(v3 AS VARCHAR) || '/CocTax' END,
    CASE WHEN v1 IS NOT NULL AND n IS NOT NULL THEN 'ElDerived=' || CAST(v1 + n AS VARCHAR) || '/default' END)
    AS leaves
FROM ({DUCK_LINE})
""")
def derived_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A derived leaf ``a + b`` appended only when both inputs are present."""
    rows = line_rows(spark, sf_dir)
    out = multi_element_unpivot(rows, PAIRS, rule="element_and_value", combo_default="default",
                                keep=["l_orderkey", "l_linenumber"], derived=("ElDerived", "v1", "n"))
    return out.select("l_orderkey", "l_linenumber", leaves_text(F.col("dataValues")).alias("leaves"))


PLACEHOLDER_VARS = {"purchase": "P${view}", "view": "V", "HOME": "/home/reports"}


@query("resolve_placeholders", oracle="""
SELECT event_id,
  CASE event_type WHEN 'purchase' THEN 'P${view}' WHEN 'view' THEN 'V' ELSE '${' || event_type || '}' END
    || '/home/reports/' || props || '/${' || upper(event_type) || ':fallback}' AS resolved,
  CASE event_type WHEN 'purchase' THEN 'P${view}' WHEN 'view' THEN 'V' ELSE '${' || event_type || '}' END
    || '/home/reports/' || props || '/fallback' AS resolved_with_default
FROM events
""")
def resolve_placeholders_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``${KEY}`` from variables, unknown kept verbatim, values not re-scanned."""
    ev = table(spark, sf_dir, "events")
    tpl = F.concat(F.lit("${"), F.col("event_type"), F.lit("}${HOME}/"), F.col("props"),
                   F.lit("/${"), F.upper("event_type"), F.lit(":fallback}"))
    return ev.select("event_id", resolve_placeholders(tpl, PLACEHOLDER_VARS).alias("resolved"),
                     resolve_placeholders(tpl, PLACEHOLDER_VARS, allow_default=True)
                     .alias("resolved_with_default"))


@query("custom_transform_fields", oracle="""
SELECT event_id, 'DsEvents' AS dataSet, strftime(ts, '%Y%m') AS period,
       CASE WHEN value > 400 THEN 'large' ELSE 'small' END AS size_class, value * 2 AS twice
FROM events
""")
def custom_transform_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: a user transform given as output fields with SQL expressions."""
    return custom_transform(table(spark, sf_dir, "events"), {
        "dataSet": "'DsEvents'", "period": "date_format(ts, 'yyyyMM')",
        "size_class": "CASE WHEN value > 400 THEN 'large' ELSE 'small' END", "twice": F.col("value") * 2},
        keep=["event_id"])
