"""Run-log fold, watermarks, recompute bound, keyed upsert."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from reportflow.operators.delivery import upsert_latest
from reportflow.operators.state import finalize_state, fold_sync_state, sync_watermarks
from reportflow.plans.report_run import recompute_start
from reportflow.schemas import RUN_EVENTS

T0 = datetime(2026, 1, 1, tzinfo=timezone.utc)


def ts(h):
    return datetime(2026, 1, 1, h, tzinfo=timezone.utc)


def events(spark, rows):
    return spark.createDataFrame(rows, RUN_EVENTS)


def test_fold_follows_transition_rules(spark):
    ev = events(spark, [
        ("r1", 1, ts(1), "IN_PROGRESS", "Report one", None, None, None),
        ("r1", 2, ts(2), "FAILED", None, None, "boom", None),
        ("r1", 3, ts(3), "IN_PROGRESS", "Report one v2", None, None, None),   # error kept
        ("r2", 1, ts(1), "IN_PROGRESS", "Two", None, None, None),              # never settled
        ("r3", 1, ts(1), "SUCCESS", "Three", 45, None, ts(0)),
        ("r3", 2, ts(2), "FAILED", None, None, "late", None),
        ("r3", 3, ts(3), "SUCCESS", "Three", 7, None, ts(2)),                  # error cleared
        ("r4", 1, ts(1), "SUCCESS", "Four", 3, None, None),
        ("r4", 2, ts(5), "RESET", None, None, None, None),
    ])
    st = {r["report_id"]: r.asDict() for r in fold_sync_state(ev, T0).collect()}
    assert st["r1"]["sync_status"] == "IN_PROGRESS" and st["r1"]["error_message"] == "boom"
    assert st["r1"]["report_name"] == "Report one v2" and st["r1"]["created_at"].hour == 2
    assert st["r2"]["created_at"] is None and st["r2"]["last_sync_timestamp"] is None
    assert st["r3"]["sync_status"] == "SUCCESS" and st["r3"]["error_message"] is None
    assert st["r3"]["records_synced"] == 7 and st["r3"]["last_sync_timestamp"].hour == 2
    assert st["r4"]["sync_status"] == "PENDING" and st["r4"]["records_synced"] == 0
    assert st["r4"]["last_sync_timestamp"].year == 2026 and st["r4"]["last_sync_timestamp"].hour == 0


def test_fold_ignores_partitioning(spark):
    rows = [(f"r{i % 3}", i, ts(i % 20), ["IN_PROGRESS", "SUCCESS", "FAILED", "RESET"][i % 4],
             f"n{i}", i, f"e{i}", ts(i % 20)) for i in range(200)]
    a = fold_sync_state(events(spark, rows).repartition(1), T0).orderBy("report_id").collect()
    b = fold_sync_state(events(spark, rows).repartition(7, "seq"), T0).orderBy("report_id").collect()
    assert a == b


def test_watermarks_parse_text_and_default(spark):
    reports = spark.createDataFrame([("a",), ("b",), ("c",), ("c2",), ("d",)], "id string")
    state = spark.createDataFrame([("a", "2026-02-01T10:00:00.5Z", "SUCCESS"), ("b", "garbage", "FAILED"),
                                   ("c2", "2026-02-01", "SUCCESS"), ("d", "2026-02-01T12:00:00+02:00", "SUCCESS")],
                                  "report_id string, last_sync_timestamp string, sync_status string")
    got = {r["report_id"]: r for r in sync_watermarks(reports, state).collect()}
    assert got["a"]["effective_start"].isoformat().startswith("2026-02-01T10:00:00.5")
    assert got["b"]["effective_start"].year == 2020
    assert got["c"]["sync_status"] == "PENDING" and got["c"]["effective_start"].year == 2020
    assert got["c2"]["effective_start"].year == 2020            # a bare date is not an instant
    assert got["d"]["effective_start"].hour == 10                # offset honoured


def test_recompute_start_reads_whole_month():
    b = recompute_start(datetime(1996, 1, 15, 12, tzinfo=timezone.utc))
    assert b == datetime(1995, 12, 31, 23, 59, 59, 999999, tzinfo=timezone.utc)


def values(spark, rows):
    return spark.createDataFrame(rows, "report_id string, dataSet string, period string, orgUnit string, "
                                       "dataElement string, categoryOptionCombo string, value string, "
                                       "mapping_idx int, load_ts timestamp")


def test_upsert_newest_wins_and_is_idempotent(spark):
    old = values(spark, [("r", "DS", "202401", "OU", "E", None, "5", 0, ts(1)),
                         ("r", "DS", "202402", "OU", "E", "C", "6", 0, ts(1))])
    new = values(spark, [("r", "DS", "202401", "OU", "E", None, "9", 0, ts(2))])
    once = upsert_latest(old, new)
    twice = upsert_latest(once, new)
    key = lambda df: sorted(repr(tuple(r)) for r in df.select(sorted(df.columns)).collect())
    assert key(once) == key(twice)
    got = {r["period"]: r["value"] for r in once.collect()}
    assert got == {"202401": "9", "202402": "6"}   # null combo is one cell


def test_state_store_missing_is_empty_and_versions(spark, tmp_out):
    from reportflow.sources import state_store as store
    assert store.read_state(spark, tmp_out).count() == 0
    assert store.read_run_events(spark, tmp_out).count() == 0
    ev = events(spark, [("r", 1, ts(1), "SUCCESS", "R", 3, None, ts(1))])
    store.append_run_events(ev, tmp_out)
    store.snapshot_state(spark, tmp_out, T0)
    store.append_run_events(events(spark, [("r", 2, ts(2), "FAILED", None, None, "x", None)]), tmp_out)
    store.snapshot_state(spark, tmp_out, T0)
    st = store.read_state(spark, tmp_out).collect()
    assert len(st) == 1 and st[0]["sync_status"] == "FAILED" and st[0]["records_synced"] == 3


def test_upsert_values_rewrites_only_touched_periods(spark, tmp_out):
    from reportflow.sources import state_store as store
    first = values(spark, [("r", "DS", "202401", "OU", "E", None, "1", 0, ts(1)),
                           ("r", "DS", "202402", "OU", "E", None, "2", 0, ts(1))])
    store.upsert_values(spark, first, tmp_out)
    store.upsert_values(spark, values(spark, [("r", "DS", "202402", "OU", "E", None, "7", 0, ts(2))]), tmp_out)
    store.upsert_values(spark, values(spark, [("r", "DS", "202402", "OU", "E", None, "7", 0, ts(2))]), tmp_out)
    got = sorted((r["period"], r["value"]) for r in store.read_values(spark, tmp_out).collect())
    assert got == [("202401", "1"), ("202402", "7")]


def test_incremental_fold_equals_full_fold(spark, tmp_out):
    """Snapshot after part of the log, then fold only newer events: same state as folding it all."""
    from reportflow.sources import state_store as store
    kinds = ["IN_PROGRESS", "SUCCESS", "FAILED", "RESET"]
    rows = [(f"r{i % 4}", i, ts(i // 10), kinds[(i * 7) % 4], f"n{i}", i, f"e{i}", ts(i // 10))
            for i in range(120)]
    first, second = [r for r in rows if r[2] < ts(6)], [r for r in rows if r[2] >= ts(6)]
    store.append_run_events(events(spark, first), tmp_out)
    store.snapshot_state(spark, tmp_out, T0)
    store.append_run_events(events(spark, second), tmp_out)
    inc = finalize_state(store.current_partial(spark, tmp_out, T0)[0])
    full = fold_sync_state(events(spark, rows), T0)
    key = lambda df: sorted(repr(tuple(r)) for r in df.select(sorted(df.columns)).collect())
    assert key(inc) == key(full)


def test_runs_out_of_time_order_lose_no_event(spark, tmp_out):
    """A report run later with an earlier time is folded too, and a reset puts a report back."""
    from reportflow.sources import state_store as store
    store.append_run_events(events(spark, [("r", 1, ts(10), "SUCCESS", "R", 3, None, ts(10))]), tmp_out)
    store.snapshot_state(spark, tmp_out, T0)
    store.append_run_events(events(spark, [("r2", 1, ts(9), "FAILED", None, None, "x", None),
                                           ("r", 0, ts(9), "FAILED", None, None, "older", None)]), tmp_out)
    st = {r["report_id"]: r for r in store.snapshot_state(spark, tmp_out, T0).collect()}
    assert st["r2"]["sync_status"] == "FAILED" and st["r"]["sync_status"] == "SUCCESS" and st["r"]["error_message"] is None
    assert st["r"]["created_at"].hour == 9
    store.reset_report(spark, tmp_out, "r", ts(11))
    st = {r["report_id"]: r for r in store.snapshot_state(spark, tmp_out, T0).collect()}
    assert st["r"]["sync_status"] == "PENDING" and st["r"]["records_synced"] == 0
    assert len(store.files.finished_folders(spark, tmp_out + "/sync_state", "v=", "appends/_SUCCESS")) == 2   # old versions go


def test_first_load_merges_and_the_last_row_sent_wins(spark, tmp_out):
    from reportflow.sources import state_store as store
    rows = [("r", "DS", "202401", "OU", "E", None, v, 0, ts(1), i) for i, v in enumerate(["10", "9", "100"])]
    df = spark.createDataFrame(rows, "report_id string, dataSet string, period string, orgUnit string, dataElement string, "
                                     "categoryOptionCombo string, value string, mapping_idx int, load_ts timestamp, row_order int")
    for _ in range(2):
        store.upsert_values(spark, df, tmp_out)
        assert [r["value"] for r in store.read_values(spark, tmp_out).collect()] == ["100"]


def test_late_rows_are_recomputed_exactly(spark):
    """A row of an old month that lands late: its month is read whole, and no month besides the touched ones."""
    from reportflow.plans.report_run import Arrivals, report_rows
    from reportflow.sources.reports import Report
    day = lambda s: datetime.fromisoformat(s)
    spark.createDataFrame([(day("2026-01-03"), day("2026-01-04")), (day("2026-01-20"), day("2026-02-25")),
                           (day("2026-02-05"), day("2026-02-06")), (day("2026-03-01"), day("2026-03-02"))],
                          "ts timestamp_ntz, landed timestamp_ntz").createOrReplaceTempView("facts")
    report = Report(id="r", sql="SELECT TO_CHAR(ts, 'YYYYMM') AS p, COUNT(*) AS n FROM facts WHERE ts > :#lastSyncTimestamp GROUP BY 1")
    rows = report_rows(spark, report, datetime(2026, 2, 10, tzinfo=timezone.utc), arrivals=Arrivals("facts", "ts", "landed"))
    assert {(r["p"], r["n"]) for r in rows.collect()} == {("202601", 2), ("202603", 1)}
    assert spark.table("facts").count() == 4
