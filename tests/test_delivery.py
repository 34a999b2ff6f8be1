"""Failure texts, dead letters, import summaries, JSON sink."""

import json

from pyspark.sql import functions as F

from reportflow.operators import delivery as dl


def col_values(spark, exprs, rows, schema):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*exprs).collect()]


def test_status_code_and_url(spark):
    rows = [("HTTP code=409, url=http://h/api/dataValueSets, x",), ("code=409",), ("code=abc, x",),
            (None,), ("a url= http://x/y ",), ("code= 201 ,url=u,v",)]
    got = col_values(spark, [dl.status_code(F.col("m")), dl.request_url(F.col("m"))], rows, "m string")
    assert got == [(409, "http://h/api/dataValueSets"), (0, None), (0, None), (0, None),
                   (0, "http://x/y"), (201, "u")]


def test_error_chain_and_details(spark):
    c = spark.createDataFrame([(1, 1, None), (1, 0, "top"), (2, 0, "only")] +
                              [(3, d, f"m{d}") for d in range(7)], "failure_id int, depth int, message string")
    chains = {r[0]: r[1] for r in dl.error_chain(c).collect()}
    assert chains[1] == f"{dl.SEND_FAILED} -> top -> null" and chains[2] == f"{dl.SEND_FAILED} -> only"
    details = dl.error_details(c).filter("failure_id = 3").orderBy("depth").collect()
    assert [r["line"] for r in details] == [f"Caused by ({d + 1}): java.lang.Exception - m{d}" for d in range(5)]


def test_dead_letter_text(spark):
    df = spark.createDataFrame([("{}", None, "p", None), ("{\"a\":1}", "h", "p", 3)],
                               "body string, h string, p string, n int")
    got = dl.dead_letters(df, F.col("body"), F.col("h"), F.col("p"), F.col("n")).collect()
    assert got[0]["report_id"] == "p" and got[1]["report_id"] == "h"
    assert got[0]["error_message"] == "DLQ - Failed to process message after 0 redeliveries. Body: {}"
    assert got[1]["redeliveries"] == 3
    none = dl.dead_letters(df, F.col("body")).first()
    assert none["report_id"] == "unknown"


def test_import_summary(spark):
    ok = '{"response":{"responseType":"ImportReport","status":"OK","stats":{"total":3}},"x":{"total":5,"created":2}}'
    warn = '{"response":{"responseType":"ImportReport","status":"ERROR"},"stats":{"total":4}}'
    bad = '{"status":"ERROR","total":}'
    got = col_values(spark, dl.import_summary(F.col("b")), [(ok,), (warn,), (bad,)], "b string")
    assert got[0] == ("OK", 5, 2, None, "imported")
    assert got[1] == ("ERROR", 4, None, None, "processed")
    assert got[2] == (None, None, None, None, "failed")


def test_classify(spark):
    got = col_values(spark, dl.classify_status(F.col("c"), F.col("b")),
                     [(200, "fine"), (409, "Error: exists"), (500, None)], "c int, b string")
    assert got == [("ok", False), ("ok_conflict", True), ("error", False)]


def test_json_drops_null_combo(spark):
    sets = spark.createDataFrame(
        [("r", "DS", "202401", "OU", 0, [("E1", "1", None), ("E2", "2", "C")])],
        "report_id string, dataSet string, period string, orgUnit string, chunk int, "
        "dataValues array<struct<dataElement:string,value:string,categoryOptionCombo:string>>")
    doc = json.loads(dl.dvs_json(sets).first()["json"])
    assert doc["dataValues"] == [{"dataElement": "E1", "value": "1"},
                                 {"dataElement": "E2", "value": "2", "categoryOptionCombo": "C"}]


def test_write_dvs_partitions_by_report(spark, tmp_out):
    sets = spark.createDataFrame([("r1", "DS", "p", "o", 0, [("E", "1", None)])],
                                 "report_id string, dataSet string, period string, orgUnit string, chunk int, "
                                 "dataValues array<struct<dataElement:string,value:string,categoryOptionCombo:string>>")
    dl.write_dvs(sets, tmp_out + "/dvs")
    back = spark.read.text(tmp_out + "/dvs").collect()
    assert len(back) == 1 and json.loads(back[0]["value"])["orgUnit"] == "o"


def test_dead_letters_fold_to_failed_state(spark):
    from datetime import datetime
    from reportflow.operators.state import fold_sync_state
    df = spark.createDataFrame([("{}", "r1", 2, datetime(2026, 1, 2))], "body string, h string, n int, at timestamp")
    letters = dl.dead_letters(df, F.col("body"), F.col("h"), None, F.col("n"), failed_at=F.col("at"))
    st = fold_sync_state(dl.failure_events(letters)).first()
    assert st["report_id"] == "r1" and st["sync_status"] == "FAILED"
    assert st["error_message"].startswith("DLQ - Failed to process message after 2 redeliveries")
