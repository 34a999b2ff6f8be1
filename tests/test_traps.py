"""Traps not covered elsewhere: T5 (parameter overrides checkpoint), T12 (text forms), T23 (blank SQL)."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from reportflow.functions.expr import as_text
from reportflow.plans import testdata as td
from reportflow.plans.pipeline import run_reports
from reportflow.sources.reports import Report
from reportflow.sources.state_store import read_run_events, read_state
from reportflow.sources.tables import report_params, run_report_sql

SF = "/root/testdata/sf0.001"


def test_report_parameter_named_checkpoint_wins(spark):
    p = report_params(datetime(2020, 1, 1, tzinfo=timezone.utc), {"lastSyncTimestamp": "1999-01-01"})
    assert p["lastSyncTimestamp"] == "1999-01-01"
    df = run_report_sql(spark, "SELECT CAST(:#lastSyncTimestamp AS STRING) AS c", p)
    assert df.first()["c"] == "1999-01-01"


def test_text_forms_are_sparks(spark):
    df = spark.createDataFrame([(1e7, 2.5, datetime(2026, 2, 1, 8, 0))], "a double, b double, t timestamp_ntz")
    got = df.select(as_text(F.col("a")), as_text(F.col("b")), as_text(F.col("t"))).first()
    assert tuple(got) == ("1.0E7", "2.5", "2026-02-01 08:00:00")


def test_blank_sql_report_never_marked_in_progress(spark, tmp_out):
    td.sources(spark, SF)
    blank = Report(id="blank", name="blank", sql=" \t ")
    state = run_reports(spark, [td.EVENTS_REPORT, blank], tmp_out, datetime(2024, 2, 1, tzinfo=timezone.utc),
                        default_start=datetime(2023, 1, 1, tzinfo=timezone.utc))
    ids = {r["report_id"]: r for r in state.collect()}
    assert "blank" not in ids
    assert ids["user-events"]["sync_status"] == "SUCCESS" and ids["user-events"]["records_synced"] > 0
    assert read_run_events(spark, tmp_out).filter("report_id = 'blank'").count() == 0
    assert read_state(spark, tmp_out).count() == 1


def test_report_group_equals_single_reports(spark, tmp_out):
    """Many facility reports in one scan give each report what its own run would give."""
    from reportflow.operators.dvs import report_values_long
    from reportflow.plans.pipeline import run_report_group
    from reportflow.sources.state_store import read_values
    td.sources(spark, SF)
    names = [r["n_name"] for r in spark.sql("SELECT n_name FROM nation").collect()]   # 25 config rows
    template = Report(id="tpl", name="returns", sql=td.SHARED_ROLLUP_SQL, groupBy=td.ROLLUP_REPORT.groupBy,
                      dataValueMappings=td.ROLLUP_REPORT.dataValueMappings)
    start = datetime(1990, 1, 1, tzinfo=timezone.utc)
    state = run_report_group(spark, template, [(n, f"rpt-{n}") for n in names], tmp_out,
                             datetime(2002, 1, 1, tzinfo=timezone.utc), default_start=start)
    got = {(r["report_id"], r["period"], r["dataElement"], r["value"]) for r in read_values(spark, tmp_out).collect()}
    rows = run_report_sql(spark, td.ROLLUP_SQL, report_params(start))
    want = {("rpt-" + r["orgUnit"], r["period"], r["dataElement"], r["value"])
            for r in report_values_long(rows, td.ROLLUP_REPORT).collect()}
    assert got == want and len(got) > 0
    st = state.collect()
    assert len(st) == len(names) and all(r["sync_status"] == "SUCCESS" for r in st)
