"""DataValueSet construction: golden fixture, mapped and default paths, rejects, chunking."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from reportflow.operators import dvs
from reportflow.operators import delivery as dl
from reportflow.operators.dvs import (aggregate_dvs, nest_dvs, rejected_rows, report_values_long,
                                      values_long, values_text)
from reportflow.sources.reports import DataValueMapping, GroupBySpec, Report
from reportflow.sources.tables import report_params, run_report_sql

A, B = "ImspTQPwCqd", "DiszpKrYNg8"

# The shipped report's SQL as it is (facility A; facility B's differs in the org unit alone).
FACILITY_SQL = """SELECT
  'GqKaojXhPdg' AS data_set,
  TO_CHAR(CAST(obs.obs_date AS TIMESTAMP), 'YYYYMM') AS period,
  COUNT(*) AS tests_performed,
  COUNT(CASE WHEN obs.val_quantity > 18.0 THEN 1 END) AS tests_positive
FROM diagnostic_report_flat dr
JOIN observation_flat obs ON dr.result_obs_id = obs.id
JOIN patient_flat p ON dr.patient_id = p.id
WHERE obs.obs_date > :#lastSyncTimestamp
  AND dr.code_code = '718-7'
  AND p.org_unit = 'ImspTQPwCqd'
GROUP BY TO_CHAR(CAST(obs.obs_date AS TIMESTAMP), 'YYYYMM')
ORDER BY period
"""


def facility_report(ou):
    return Report(
        id=f"hiv-{ou}", name="HIV", dataSet="GqKaojXhPdg", sql=FACILITY_SQL.replace(A, ou),
        parameters={"startDate": "${HIV_REPORT_START_DATE:2024-01-01}"},
        groupBy=GroupBySpec("data_set", "period", ou),
        dataValueMappings=[
            DataValueMapping("Aog9SRWtjvv", "tests_performed", "HllvX50cXC0"),
            DataValueMapping("o4RQy5hlIXa", "tests_positive", "HllvX50cXC0")])


# The seed rows of the shipped fixture.
def golden_tables(spark):
    ts = lambda s: datetime.fromisoformat(s)
    spark.createDataFrame([("p0", "M", A), ("p1", "F", B), ("p2", "M", B)],
                          "id string, gender string, org_unit string").createOrReplaceTempView("patient_flat")
    spark.createDataFrame([("r1", "p0", "o1", "718-7"), ("r2", "p1", "o5", "718-7"), ("r3", "p2", "oX", "718-7")],
                          "id string, patient_id string, result_obs_id string, code_code string") \
        .createOrReplaceTempView("diagnostic_report_flat")
    obs = [("o1", "p0", "2026-02-01 08:00:00", 19.5), ("o2", "p0", "2026-02-02 09:30:00", 17.2),
           ("o3", "p0", "2026-02-03 10:15:00", 20.1), ("o4", "p0", "2026-02-05 11:45:00", 16.8),
           ("o5", "p1", "2026-02-01 14:20:00", 21.3), ("o6", "p1", "2026-02-04 15:00:00", 18.9),
           ("o7", "p2", "2026-02-05 16:30:00", 15.4)]
    spark.createDataFrame([(i, p, ts(d), v, "718-7") for i, p, d, v in obs],
                          "id string, patient_id string, obs_date timestamp_ntz, val_quantity double, code_code string") \
        .createOrReplaceTempView("observation_flat")


def test_golden_fixture_one_and_one(spark):
    """The seed gives 1/1 for both facilities (not the 4/2 and 3/2 its comment promises)."""
    golden_tables(spark)
    got = {}
    for ou in (A, B):
        r = facility_report(ou)
        rows = run_report_sql(spark, r.sql, report_params(datetime(2020, 1, 1), r.parameters))
        got[ou] = [tuple(x) for x in rows.collect()]
    assert got[A] == [("GqKaojXhPdg", "202602", 1, 1)]
    assert got[B] == [("GqKaojXhPdg", "202602", 1, 1)]
    r = facility_report(A)
    rows = run_report_sql(spark, r.sql, report_params(datetime(2020, 1, 1), r.parameters))
    doc = json.loads(dl.dvs_json(nest_dvs(report_values_long(rows, r))).first()["json"])
    assert doc == {"dataSet": "GqKaojXhPdg", "period": "202602", "orgUnit": A, "dataValues": [
        {"dataElement": "Aog9SRWtjvv", "value": "1", "categoryOptionCombo": "HllvX50cXC0"},
        {"dataElement": "o4RQy5hlIXa", "value": "1", "categoryOptionCombo": "HllvX50cXC0"}]}


def rows_df(spark):
    return spark.createDataFrame([
        (1, "DS", "202401", "OU|1", " 5 ", "real", 1),
        (2, "DS", "202401", "OU|1", "\t", "default", 2),      # blank value: no leaf on the mapped path
        (3, "DS", "202401", "OU|1", "7", None, 3),
        (4, "DS", None, "OU2", "9", "x", 4),                   # null key: rejected
        (5, "DS", "202401", "", "9", "x", 5),                  # blank key: rejected
        (6, "DS", "202401", "OU|1", "5", "real", 6),           # same element twice in a set: kept (T8)
    ], "id int, Data_Set string, period string, ou string, val string, combo string, n int")


GB = GroupBySpec("data_set", "PERIOD", "ou")
MAPS = [DataValueMapping("E1", "val", "combo"),
        DataValueMapping("E2", "n", "C2", filter="n >= 3 AND row.id <> 6"),
        DataValueMapping("E3", "missing_column", "C3")]


def test_mapped_path_leaves_order_and_keys(spark):
    df = rows_df(spark)
    sets = nest_dvs(values_long(df, GB, MAPS, order_by=["id"], report_id="r"))
    out = [(r["dataSet"], r["period"], r["orgUnit"], r["txt"])
           for r in sets.select("*", values_text(F.col("dataValues")).alias("txt")).collect()]
    # '|' inside a key no longer shifts fields (T7); leaves by mapping, then row order
    assert out == [("DS", "202401", "OU|1", "E1=5/real;E1=7;E1=5/real;E2=3/C2")]


def test_rejects_name_the_reason(spark):
    rej = rejected_rows(rows_df(spark), GB, report_id="r").orderBy("body").collect()
    assert [r["reason"] for r in rej] == ["missing_grouping_key"] * 2
    assert {json.loads(r["body"])["id"] for r in rej} == {4, 5}


def test_default_path_aliases_and_empty_values(spark):
    df = spark.createDataFrame([
        ("DS", "202401", "OU1", "E1", "", "default"),
        ("DS", "202401", "OU1", "E2", "3", "CC"),
        ("DS", "202401", None, "E3", "4", None),
        ("DS", "202401", "OU1", None, "5", None),
    ], "dataset string, period string, org_unit string, data_element string, value string, category_option_combo string")
    sets = aggregate_dvs(df, None, order_by=["data_element"]).collect()
    assert len(sets) == 1
    vals = [tuple(v) for v in sets[0]["dataValues"]]
    assert vals == [("E1", "", None), ("E2", "3", "CC")]
    rej = rejected_rows(df, None).collect()
    assert sorted(r["reason"] for r in rej) == ["missing_element_or_value", "missing_grouping_key"]


def test_empty_result_gives_no_sets(spark):
    df = rows_df(spark).limit(0)
    assert nest_dvs(values_long(df, GB, MAPS)).count() == 0


def hot_rows(spark, n=2500, hot=2400):
    return spark.range(n).select(F.lit("DS").alias("data_set"), F.lit("202401").alias("period"),
                                 F.when(F.col("id") < hot, F.lit("HOT")).otherwise(F.concat(F.lit("OU"), F.col("id") % 7))
                                 .alias("ou"), (F.col("id") % 3).cast("string").alias("val"), F.col("id"))


def test_a_set_is_one_document_whatever_its_size(spark):
    long = values_long(hot_rows(spark, 25_000, 24_000), GB, [DataValueMapping("E", "val")], report_id="r")
    sets = nest_dvs(long).select("orgUnit", "chunk", F.size("dataValues").alias("n")).collect()
    assert len(sets) == 8 and {r["chunk"] for r in sets} == {0}
    assert {r["orgUnit"]: r["n"] for r in sets}["HOT"] == 24_000
    rows = hot_rows(spark, 25_000, 24_000).withColumn("report_id", F.lit("r"))
    assert dl.run_counts(rows, long).first().asDict() == {
        "report_id": "r", "result_rows": 25_000, "data_values": 25_000, "data_value_sets": 8, "records_synced": 8}


def test_parts_on_request_are_exact_and_ordered(spark):
    """Very many equal leaves: no part above the bound, all but the last full, order kept across parts."""
    long = values_long(hot_rows(spark), GB, [DataValueMapping("E", "val")], order_by=["id"])
    sets = nest_dvs(long, max_values_per_set=500)
    sizes = {(r["orgUnit"], r["chunk"]): r["n"] for r in
             sets.select("orgUnit", "chunk", F.size("dataValues").alias("n")).collect()}
    assert [sizes["HOT", k] for k in range(5)] == [500, 500, 500, 500, 400] and sum(sizes.values()) == 2500
    hot = sets.filter("orgUnit = 'HOT'").orderBy("chunk").select(values_text(F.col("dataValues"))).collect()
    assert ";".join(r[0] for r in hot) == ";".join(f"E={i % 3}" for i in range(2400))
    unordered = nest_dvs(values_long(hot_rows(spark), GB, [DataValueMapping("E", "val")]), 1000)
    assert unordered.agg(F.max(F.size("dataValues"))).first()[0] == 1000


def test_sets_carry_first_appearance(spark):
    df = spark.createDataFrame([(3, "DS", "p", "B", "1"), (1, "DS", "p", "A", "2"), (2, "DS", "p", "B", "3")],
                               "id int, data_set string, period string, ou string, val string")
    sets = nest_dvs(values_long(df, GroupBySpec("data_set", "period", "ou"), [DataValueMapping("E", "val")],
                                order_by=["id"]), None)
    order = [r["orgUnit"] for r in sets.orderBy("first_row").collect()]
    assert order == ["A", "B"]


def test_duplicate_leaves_keep_last_sum(spark):
    from reportflow.operators.dvs import merge_duplicate_leaves
    df = spark.createDataFrame([(1, "DS", "p", "A", "2"), (2, "DS", "p", "A", "5"), (3, "DS", "p", "B", "1")],
                               "id int, data_set string, period string, ou string, val string")
    long = values_long(df, GroupBySpec("data_set", "period", "ou"), [DataValueMapping("E", "val")], order_by=["id"])
    assert merge_duplicate_leaves(long, "keep").count() == 3
    last = {r["orgUnit"]: r["value"] for r in merge_duplicate_leaves(long, "last").collect()}
    summed = {r["orgUnit"]: r["value"] for r in merge_duplicate_leaves(long, "sum").collect()}
    assert last == {"A": "5", "B": "1"} and summed == {"A": "7", "B": "1"}


def test_sum_is_exact_and_keeps_other_values_apart(spark):
    from reportflow.operators.dvs import merge_duplicate_leaves, unsummed_leaves
    df = spark.createDataFrame([("DS", "p", "A", "6000000"), ("DS", "p", "A", "5000000"), ("DS", "p", "B", "9007199254740993"),
                                ("DS", "p", "C", "0.10"), ("DS", "p", "C", "0.2"), ("DS", "p", "C", "n/a")],
                               "data_set string, period string, ou string, val string")
    long = values_long(df, GB, [DataValueMapping("E", "val")], report_id="r")
    got = {r["orgUnit"]: r["value"] for r in merge_duplicate_leaves(long, "sum").collect()}
    assert got == {"A": "11000000", "B": "9007199254740993", "C": "0.3"}
    rej = unsummed_leaves(long).collect()
    assert [r["reason"] for r in rej] == ["value_not_a_number"] and json.loads(rej[0]["body"])["value"] == "n/a"


def test_failing_filter_is_false_for_its_row_only(spark):
    df = spark.createDataFrame([("DS", "p", "A", "7"), ("DS", "p", "A", "x"), ("DS", "p", "A", "0")],
                               "data_set string, period string, ou string, val string")
    maps = [DataValueMapping("E", "val", filter="CAST(val AS INT) > 5"), DataValueMapping("D", "val", filter="10 / CAST(val AS INT) < 2")]
    got = sorted((r["dataElement"], r["value"]) for r in values_long(df, GB, maps).collect())
    assert got == [("D", "7"), ("E", "7")]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_to_char_is_translated_outside_quotes_and_comments():
    from reportflow.functions.expr import translate_to_char
    sql = """SELECT to_char(f(a, (b)), 'YYYY-MM-DD HH24:MI:SS') x, 'TO_CHAR(a, ''YYYY'')' y -- it's TO_CHAR(c, 'YYYY')
/* TO_CHAR(d, 'MM') */ , "TO_CHAR(e, 'MM')" """
    out = translate_to_char(sql)
    assert "date_format(f(a, (b)), 'yyyy-MM-dd HH:mm:ss') x" in out
    assert "'TO_CHAR(a, ''YYYY'')'" in out and "TO_CHAR(c, 'YYYY')" in out and "TO_CHAR(d, 'MM')" in out and "TO_CHAR(e, 'MM')" in out


def test_positions_without_a_task_that_gathers_parts(spark, monkeypatch):
    """One large set in many sorted parts: no window over leaves, no leaf shuffled by its part; positions are those of the order."""
    monkeypatch.setattr(dvs, "LEAVES_PER_SORT", 100, raising=False)
    long = spark.range(5000).select(
        F.lit("r").alias("report_id"), F.lit("ds").alias("dataSet"), F.when(F.col("id") < 4500, "p").alias("period"), F.lit("ou").alias("orgUnit"),
        F.lit("e").alias("dataElement"), F.lpad(F.pmod(F.col("id") * 7919, F.lit(1000)).cast("string"), 4, "0").alias("value"),
        F.lit(None).cast("string").alias("categoryOptionCombo"), F.lit(0).alias("mapping_idx"))
    placed = dvs.with_positions(long, ["report_id", *dvs.KEYS])
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Window" in line and "row_number" in line]
    for period, n in (("p", 4500), (None, 500)):
        rows = placed.filter(F.col("period").eqNullSafe(F.lit(period))).orderBy("position").collect()
        assert [r["position"] for r in rows] == list(range(n)) and {r["set_size"] for r in rows} == {n}
        assert [r["value"] for r in rows] == sorted(r["value"] for r in rows)
