"""Report definitions as a table: JSON source, explode, lookup, validation, runnable filter."""

import json

import pytest

from reportflow.sources.reports import (Report, explode_mappings, read_reports_json, report_by_id,
                                        reports_frame, runnable_reports, validate_reports)
from reportflow.sources.tables import register_period_function, run_report_sql

DOC = {"reports": [
    {"id": "a", "name": "A", "dataSet": "DS", "sql": "SELECT 1", "parameters": {"minAge": "15"},
     "groupBy": {"dataSet": "data_set", "period": "period", "orgUnit": "OU1"},
     "dataValueMappings": [{"name": "m0", "dataElement": "E0", "valueColumn": "v0"},
                           {"name": "m1", "dataElement": "E1", "valueColumn": "v1",
                            "categoryOptionCombo": "C", "filter": "v1 > 0"}]},
    {"id": "b", "name": "B", "sql": "  \t"},
    {"id": "c", "name": "C", "sqlFile": "queries/c.sql"},
]}


def test_read_json_explode_and_lookup(spark, tmp_out):
    path = tmp_out + "/reports.json"
    with open(path, "w") as fh:
        json.dump(DOC, fh, indent=2)
    reports = validate_reports(read_reports_json(spark, path))
    assert [r["id"] for r in reports.orderBy("pos").collect()] == ["a", "b", "c"]
    ex = explode_mappings(reports).orderBy("report_id", "mapping_idx").collect()
    assert [(r["report_id"], r["mapping_idx"], r["dataElement"]) for r in ex] == \
        [("a", 0, "E0"), ("a", 1, "E1"), ("b", None, None), ("c", None, None)]
    assert report_by_id(reports, None).first()["id"] == "a"
    assert report_by_id(reports, "c").first()["sqlFile"] == "queries/c.sql"
    assert sorted(r["id"] for r in runnable_reports(reports).collect()) == ["a", "c"]


def test_duplicate_ids_rejected(spark):
    df = reports_frame(spark, [Report(id="x"), Report(id="x")])
    with pytest.raises(ValueError):
        validate_reports(df)


def test_report_from_dict_and_sql_file(tmp_path):
    r = Report.from_dict(DOC["reports"][0])
    assert r.groupBy.orgUnit == "OU1" and r.dataValueMappings[1].filter == "v1 > 0"
    (tmp_path / "q.sql").write_text("SELECT 2")
    f = Report(id="f", sql="SELECT 1", sqlFile="q.sql")
    assert f.resolved_sql(str(tmp_path)) == "SELECT 2"
    assert Report(id="g", sql="SELECT 1", sqlFile="missing.sql").resolved_sql(str(tmp_path)) == "SELECT 1"


def test_period_function_and_params(spark):
    register_period_function(spark)
    got = spark.sql("SELECT calculate_period(TIMESTAMP_NTZ'2026-02-03 04:05:06') AS p").first()["p"]
    assert got == "202602"
    df = run_report_sql(spark, "SELECT :#x AS x, ':#x' AS lit", {"x": 5, "unused": "${NOPE}"})
    assert tuple(df.first()) == (5, ":#x")


def test_placeholders_in_definitions(spark):
    r = Report(id="x", name="${SITE} report", sql="SELECT '${SITE}'", parameters={"start": "${START:2024-01-01}"},
               groupBy=__import__("reportflow.sources.reports", fromlist=["GroupBySpec"]).GroupBySpec("ds", "p", "${OU}"),
               dataValueMappings=[__import__("reportflow.sources.reports", fromlist=["DataValueMapping"])
                                  .DataValueMapping("${EL}", "v")])
    from reportflow.sources.reports import resolve_report_placeholders
    out = resolve_report_placeholders(reports_frame(spark, [r]), {"SITE": "A", "OU": "ou1", "EL": "e1"}).first()
    assert out["name"] == "A report" and out["sql"] == "SELECT 'A'"
    assert out["parameters"]["start"] == "${START:2024-01-01}"          # T3: no default syntax
    assert out["groupBy"]["orgUnit"] == "ou1" and out["dataValueMappings"][0]["dataElement"] == "e1"
    assert out["pos"] == 0
