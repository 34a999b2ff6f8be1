"""The YAML definitions file, and documents written in pieces."""

import glob
import json
import os
from datetime import datetime, timezone

import pytest

from reportflow.operators import delivery as dl
from reportflow.operators.dvs import nest_dvs, report_values_long
from reportflow.plans import q_reports
from reportflow.plans.pipeline import run_reports
from reportflow.sources.definitions import parse_definitions, parse_reports, read_reports_yaml
from reportflow.sources.state_store import read_values
from test_dvs import A, B, FACILITY_SQL, golden_tables

# The first report of the shipped definitions file as it is.
SHIPPED = """reports:
  - id: hiv-testing-facility-a
    name: HIV Testing Results - Facility A
    description: HIV testing indicators aggregated from patient-level events for Facility A
    dataSet: GqKaojXhPdg
    sqlFile: queries/hiv-testing-facility-a.sql

    # Extra parameters injected as SQL bind variables (:#paramName syntax).
    # Values support ${ENV_VAR} and ${system.property} placeholders.
    parameters:
      startDate: ${HIV_REPORT_START_DATE:2024-01-01}
      endDate: ${HIV_REPORT_END_DATE:2024-12-31}
      minAge: ${HIV_REPORT_MIN_AGE:15}
      maxAge: ${HIV_REPORT_MAX_AGE:49}

    groupBy:
      dataSet: data_set
      period: period
      orgUnit: ImspTQPwCqd

    dataValueMappings:
      - name: HIV - HTS - HIV test performed
        dataElement: Aog9SRWtjvv
        valueColumn: tests_performed
        categoryOptionCombo: HllvX50cXC0

      - name: HIV - HTS - HIV positive test result
        dataElement: o4RQy5hlIXa
        valueColumn: tests_positive
        categoryOptionCombo: HllvX50cXC0
"""


def test_the_shipped_definitions_run_the_golden_case(spark, tmp_out):
    golden_tables(spark)
    os.makedirs(f"{tmp_out}/config/queries")
    second = SHIPPED.removeprefix("reports:\n").replace("facility-a", "facility-b").replace(A, B)
    for name, text in (("mappings.yml", SHIPPED + second), ("queries/hiv-testing-facility-a.sql", FACILITY_SQL),
                       ("queries/hiv-testing-facility-b.sql", FACILITY_SQL.replace(A, B))):
        with open(f"{tmp_out}/config/{name}", "w") as f:
            f.write(text)
    reports = read_reports_yaml(spark, f"{tmp_out}/config/mappings.yml")
    assert [r["pos"] for r in reports.collect()] == [0, 1]
    state = run_reports(spark, reports, f"{tmp_out}/root", datetime(2026, 3, 1, tzinfo=timezone.utc), base_dir=f"{tmp_out}/config")
    assert {(r["report_id"], r["sync_status"], r["records_synced"]) for r in state.collect()} == {
        ("hiv-testing-facility-a", "SUCCESS", 1), ("hiv-testing-facility-b", "SUCCESS", 1)}
    got = {(r["orgUnit"], r["dataElement"], r["value"]) for r in read_values(spark, f"{tmp_out}/root").collect()}
    assert got == {(ou, el, "1") for ou in (A, B) for el in ("Aog9SRWtjvv", "o4RQy5hlIXa")}


def test_the_subset_of_yaml():
    got = parse_definitions("""---
a: 'it''s # x' # c
b: "q\\n # d"
list:
- x
- y: 1
  z:
    - deep: 2024-01-01
sql: |
  SELECT 1
    -- # not a comment

  FROM t
f: >-
  one
  two
n: ~
url: http://x/#y
""")
    assert got == {"a": "it's # x", "b": "q\n # d", "list": ["x", {"y": "1", "z": [{"deep": "2024-01-01"}]}],
                   "sql": "SELECT 1\n  -- # not a comment\n\nFROM t\n", "f": "one two", "n": None, "url": "http://x/#y"}
    assert parse_definitions("# nothing\n") is None


@pytest.mark.parametrize("text, line", [("a: [1]", 1), ("a: 1\n  b: 2", 2), ("a: 1\na: 2", 2), ("\ta: 1", 1), ("x: 1\na: 'x", 2), ("- a\nb: 1", 2),
                                        ("a: &x 1", 1), ("a:\n  - b: 1\n   c: 2", 3), ("just text", 1)])
def test_errors_name_their_line(text, line):
    with pytest.raises(ValueError, match=f"line {line}:"):
        parse_definitions(text)


@pytest.mark.parametrize("text", ["", "reports: x", "other:\n  - id: a", "reports:\n  - id: a\n    groupBy: x", "reports:\n  - id: a\n    dataElement: x"])
def test_what_is_no_list_of_definitions_raises(text):
    with pytest.raises(ValueError):
        parse_reports(text)


def test_pieces_joined_by_name_are_the_document(spark, tmp_out):
    long = q_reports.hot_long(spark, "/root/testdata/sf0.001")
    path = os.path.join(tmp_out, "docs")
    dl.write_documents(long, path)
    want = {r["orgUnit"]: json.loads(r["json"]) for r in dl.dvs_json(nest_dvs(long)).collect()}
    for unit, doc in want.items():
        files = sorted(glob.glob(f"{path}/report_id=hot/dataSet=DsHot/period=all/orgUnit={unit}/part-*"))
        assert json.loads("".join(open(f).read() for f in files)) == doc
    assert len(want) == 3


def test_a_set_of_one_leaf_and_odd_keys(spark):
    long = spark.createDataFrame([("r", "D\"]}", "p", "[]}", 0, "E", "v]}", None)], "report_id string, dataSet string, period string, orgUnit string, "
                                 "mapping_idx int, dataElement string, value string, categoryOptionCombo string")
    assert json.loads(dl.document_pieces(long).first()["text"]) == json.loads(dl.dvs_json(nest_dvs(long)).first()["json"])
