"""What runs leave behind: attempts, publications, segments, digests, shares; and streams on the same store."""

import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from reportflow.operators import delivery as dl
from reportflow.operators import digests as dg
from reportflow.operators import partials
from reportflow.operators.state import fold_sync_state
from reportflow.plans import q_store
from reportflow.plans.pipeline import run_report_group, run_reports
from reportflow.plans.report_run import Arrivals, report_rows
from reportflow.schemas import RUN_EVENTS
from reportflow.sources import files
from reportflow.sources import state_store as store
from reportflow.sources.reports import DataValueMapping, GroupBySpec, Report
from reportflow.sources.tables import table
from reportflow.streaming import state_stream as ss
from reportflow.streaming.stream import finish, report_batch_writer, stream_report

SF = "/root/testdata/sf0.001"
START = datetime(2020, 1, 1, tzinfo=timezone.utc)


def at(day, month=1):
    return datetime(2026, month, day, tzinfo=timezone.utc)


def report(rid, where="ts > :#lastSyncTimestamp", element="E", extra=""):
    return Report(id=rid, name=rid, sql=f"SELECT 'DS' AS ds, TO_CHAR(ts, 'YYYYMM') AS p, place AS ou, COUNT(*) AS n{extra} "
                  f"FROM facts WHERE {where} GROUP BY 1, 2, 3", groupBy=GroupBySpec(dataSet="ds", period="p", orgUnit="ou"),
                  dataValueMappings=[DataValueMapping(name="n", dataElement=element, valueColumn="n")])


def facts(spark, rows):
    spark.createDataFrame([(datetime.fromisoformat(t), place) for t, place in rows], "ts timestamp_ntz, place string").createOrReplaceTempView("facts")


def stored(spark, root):
    return sorted((r["period"], r["orgUnit"], r["dataElement"], r["value"]) for r in store.read_values(spark, root).collect())


def states(df):
    return {r["report_id"]: r for r in df.collect()}


def test_a_rerun_at_one_snapshot_time_counts(spark, tmp_out):
    facts(spark, [("2026-01-03", "a"), ("2026-01-04", "a")])
    bad = report("r", extra=", CAST('x' AS INT) AS bad")
    st = states(run_reports(spark, [bad], tmp_out, at(5), default_start=START))
    assert st["r"]["sync_status"] == "FAILED" and st["r"]["last_sync_timestamp"] is None
    st = states(run_reports(spark, [report("r2")], tmp_out, at(5), default_start=START))
    assert st["r"]["sync_status"] == "FAILED" and st["r2"]["sync_status"] == "SUCCESS"
    st = states(run_reports(spark, [report("r")], tmp_out, at(5), default_start=START))
    assert st["r"]["sync_status"] == "SUCCESS" and st["r"]["last_sync_timestamp"].day == 5 and st["r"]["error_message"] is None
    events = store.read_run_events(spark, tmp_out)
    assert events.filter("report_id = 'r'").count() == 4 and events.count() == 6
    assert stored(spark, tmp_out) == [("202601", "a", "E", "2")]


def test_two_reports_on_one_cell_leave_the_last(spark, tmp_out):
    facts(spark, [("2026-01-03", "a"), ("2026-01-04", "a")])
    run_reports(spark, [report("r1"), report("r2", "ts > TIMESTAMP '2026-01-03 12:00:00'")], tmp_out, at(5), default_start=START)
    got = store.read_values(spark, tmp_out).collect()
    assert [(r["report_id"], r["value"]) for r in got] == [("r2", "1")]


def test_delta_sends_no_row_twice(spark, tmp_out):
    facts(spark, [("2026-01-03", "a"), ("2026-01-09", "b")])
    sent = []
    for day in (5, 10):
        run_reports(spark, [report("r")], tmp_out, at(day), mode="delta", default_start=START)
        sent.append(sorted(r["orgUnit"] for r in spark.read.parquet(f"{tmp_out}/outbox").filter(f"run_id LIKE '202601{day:02d}%'").collect()))
    assert sent == [["a"], ["b"]]
    odd = report("r", "date_trunc('day', ts) > :#lastSyncTimestamp")
    rows = report_rows(spark, odd, START, "delta", arrivals=Arrivals("facts", "ts"), as_of=at(5))
    assert [r["ou"] for r in rows.collect()] == ["a"] and spark.table("facts").count() == 2


def test_group_reads_late_rows_by_arrival(spark, tmp_out):
    def landed(rows):
        spark.createDataFrame([(datetime.fromisoformat(t), p, datetime.fromisoformat(a)) for t, p, a in rows],
                              "ts timestamp_ntz, place string, landed timestamp_ntz").createOrReplaceTempView("facts")
    template = Report(id="t", name="t", groupBy=GroupBySpec(dataSet="ds", period="p", orgUnit="ou"),
                      dataValueMappings=[DataValueMapping(name="n", dataElement="E", valueColumn="n")],
                      sql="SELECT w.report_id, 'DS' AS ds, TO_CHAR(f.ts, 'YYYYMM') AS p, f.place AS ou, COUNT(*) AS n FROM facts f "
                          "JOIN report_watermarks w ON f.place = w.facility WHERE f.ts > w.checkpoint GROUP BY 1, 2, 3, 4")
    rows = [("2026-01-03", "a", "2026-01-03"), ("2026-02-03", "a", "2026-02-03")]
    run = lambda day: run_report_group(spark, template, [("a", "ra")], tmp_out, day, default_start=START, arrivals=Arrivals("facts", "ts", "landed"))
    landed(rows)
    run(at(10, 2))
    landed(rows + [("2026-01-04", "a", "2026-02-11")])
    run(at(20, 2))
    assert stored(spark, tmp_out) == [("202601", "a", "E", "2"), ("202602", "a", "E", "1")]


def test_changed_months_are_found_without_arrival_times(spark, tmp_out):
    """Added, changed and deleted rows of old months; a month whose rows all went loses its cells; another report's stay."""
    run = lambda day: run_reports(spark, [report("r")], tmp_out, at(day), default_start=START, arrivals={"r": Arrivals("facts", "ts")})
    facts(spark, [("2025-11-01", "a"), ("2025-12-01", "a"), ("2025-12-02", "b"), ("2026-01-03", "a"), ("2026-01-04", "c")])
    run_reports(spark, [report("other", element="E2")], tmp_out, at(1), default_start=START)
    run(5)
    facts(spark, [("2025-12-01", "a"), ("2025-12-02", "a"), ("2026-01-04", "c"), ("2026-01-03", "a")])
    run(6)
    mine = [v for v in stored(spark, tmp_out) if v[2] == "E"]
    assert mine == [("202512", "a", "E", "2"), ("202601", "a", "E", "1"), ("202601", "c", "E", "1")]
    assert len(stored(spark, tmp_out)) == len(mine) + 5
    sets = spark.read.parquet(f"{tmp_out}/outbox").filter("report_id = 'r' AND run_id LIKE '20260106%'")
    assert {r["period"] for r in sets.collect()} == {"202512"}   # November is empty, January is as it was


def test_digests_tell_nulls_and_repeats_apart(spark):
    rows = [("2026-01-01", None, 1), ("2026-01-02", 1, None)]
    df = spark.createDataFrame([(datetime.fromisoformat(t), a, b) for t, a, b in rows], "ts timestamp_ntz, a int, b int")
    digest = lambda d: dg.period_digests(d, "ts", ["a", "b"])
    assert dg.changed_periods(digest(df), digest(df.orderBy(F.desc("ts")))).count() == 0
    swapped = df.select("ts", F.col("b").alias("a"), F.col("a").alias("b")).limit(1)
    assert dg.changed_periods(digest(df.limit(1)), digest(swapped)).count() == 1
    assert dg.changed_periods(digest(df), digest(df.unionAll(df))).count() == 1
    assert dg.changed_periods(digest(df.limit(0)), digest(df)).count() == 1


def long(spark, rows):
    return spark.createDataFrame([("r", "DS", p, "OU", e, None, v, 0, at(1)) for p, e, v in rows],
                                 "report_id string, dataSet string, period string, orgUnit string, dataElement string, "
                                 "categoryOptionCombo string, value string, mapping_idx int, load_ts timestamp")


def test_staged_values_are_unseen_and_a_lost_race_is_told(spark, tmp_out):
    store.upsert_values(spark, long(spark, [("202601", "E", "1"), ("2026 / 02", "E", "1")]), tmp_out)
    staged = store.stage_values(spark, long(spark, [("202601", "E", "2")]), tmp_out)
    assert [v[3] for v in stored(spark, tmp_out)] == ["1", "1"]
    store.upsert_values(spark, long(spark, [("202601", "E", "3")]), tmp_out)
    with pytest.raises(files.Conflict):
        store.publish(spark, staged)
    for value in ("4", "5", "6"):
        store.upsert_values(spark, long(spark, [("202601", "E", value)]), tmp_out)
    assert stored(spark, tmp_out) == [("2026 / 02", "OU", "E", "1"), ("202601", "OU", "E", "6")]
    # Folders that no recent version names are gone, the lost run's aside.
    kept = [r for v in files.names(spark, f"{tmp_out}/data_values") if v.startswith("v=")
            for r in files.names(spark, f"{tmp_out}/data_values/{v}/dataSet=DS") if r == "period=202601"]
    assert len(kept) == 3


def test_a_half_written_pointer_is_not_read(spark, tmp_out):
    store.upsert_values(spark, long(spark, [("202601", "E", "1")]), tmp_out)
    with open(f"{tmp_out}/data_values/_pointers/000000000002", "w") as f:
        f.write('{"manif')
    assert [v[3] for v in stored(spark, tmp_out)] == ["1"]
    store.upsert_values(spark, long(spark, [("202601", "E", "2")]), tmp_out)
    assert [v[3] for v in stored(spark, tmp_out)] == ["2"]


def test_very_many_pairs_are_read_by_a_join(spark, tmp_out, monkeypatch):
    monkeypatch.setattr(store, "MAX_PRUNED_PARTITIONS", 1)
    for value in ("1", "2"):
        store.upsert_values(spark, long(spark, [(f"20260{k}", "E", value) for k in range(1, 4)]), tmp_out)
    store.upsert_values(spark, long(spark, [("202603", "E", "3")]), tmp_out)
    assert [v[3] for v in stored(spark, tmp_out)] == ["2", "2", "3"]


def test_the_log_is_merged_and_stays_whole(spark, tmp_out, monkeypatch):
    monkeypatch.setattr(store, "SEGMENTS_PER_TIER", 3)
    rows = [(f"r{k % 3}", k, at(1 + k % 9), ("IN_PROGRESS", "SUCCESS", "FAILED", "RESET")[k % 4], "n", k, "e", at(1 + k % 9)) for k in range(22)]
    for k, row in enumerate(rows):
        store.append_run_events(spark.createDataFrame([row], RUN_EVENTS).coalesce(1), tmp_out, name=f"a{k:03d}")
        if k % 2:
            state = store.snapshot_state(spark, tmp_out, START, max_live_appends=1)
    segments = files.read_pointer(spark, f"{tmp_out}/run_events")[1]["segments"]
    assert len(segments) <= 6 and store.run_appends(spark, tmp_out) == []
    key = lambda df: sorted(repr(tuple(r)) for r in df.select(sorted(df.columns)).collect())
    want = spark.createDataFrame(rows, RUN_EVENTS)
    assert key(store.read_run_events(spark, tmp_out)) == key(want)
    assert key(state) == key(fold_sync_state(want, START))
    # A replayed stream batch whose append was merged already counts once.
    store.append_run_events(spark.createDataFrame([rows[3]], RUN_EVENTS), tmp_out, name="a003")
    assert key(store.read_run_events(spark, tmp_out)) == key(want)
    assert key(store.snapshot_state(spark, tmp_out, START)) == key(state)


def write_facts(spark, folder, rows):
    facts(spark, rows)
    spark.table("facts").coalesce(1).write.mode("append").parquet(folder)


def test_stream_and_scheduled_run_share_a_store_and_the_checkpoint_stays(spark, tmp_out):
    folder, root = os.path.join(tmp_out, "in"), os.path.join(tmp_out, "root")
    schema = "ts timestamp_ntz, place string"
    run = lambda rid: finish(stream_report(spark, folder, spark.createDataFrame([], schema).schema, report(rid), "facts", root, "ts", scope="recompute"))
    write_facts(spark, folder, [("2026-01-03", "a")])
    spark.read.parquet(folder).createOrReplaceTempView("facts")
    run("s1")
    write_facts(spark, folder, [("2025-12-03", "a")])
    spark.read.parquet(folder).createOrReplaceTempView("facts")
    run("s1")
    run("s2")   # another report on the same root and files
    st = states(store.snapshot_state(spark, root, START))
    assert st["s1"]["last_sync_timestamp"].isoformat().startswith("2026-01-03")
    st = states(run_reports(spark, [report("r")], root, at(9), default_start=START))
    assert set(st) == {"r", "s1", "s2"} and stored(spark, root) == [("202512", "a", "E", "1"), ("202601", "a", "E", "1")]
    assert {r["report_id"] for r in spark.read.parquet(f"{root}/outbox").collect()} == {"r", "s1", "s2"}
    store.reset_report(spark, root, "s1", datetime.now(timezone.utc))
    report_batch_writer(report("s1"), "facts", root, "ts", scope="recompute")(spark.read.parquet(folder).filter("ts < '2026-01-01'"), 7)
    assert states(store.snapshot_state(spark, root, START))["s1"]["last_sync_timestamp"].isoformat().startswith("2025-12-03")


def test_a_failing_batch_leaves_its_trace(spark, tmp_out):
    facts(spark, [("2026-01-03", "a")])
    write = report_batch_writer(report("r", extra=", CAST(MAX(place) AS INT) AS bad"), "facts", tmp_out, "ts")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        write(spark.table("facts"), 0)
    st = states(store.snapshot_state(spark, tmp_out, START))
    assert st["r"]["sync_status"] == "FAILED" and "CAST_INVALID_INPUT" in st["r"]["error_message"]
    assert spark.read.parquet(f"{tmp_out}/dead_letters").count() == 1


def test_shares_are_merged_replaced_and_compacted(spark, tmp_out):
    shares = partials.Shares(spark, tmp_out, {"n": "sum", "top": "max"}, "p", max_shares=2)
    rows = lambda *r: spark.createDataFrame(list(r), "p string, ou string, n long, top int")
    got = lambda df: sorted(tuple(r) for r in df.collect())
    for k in range(5):
        shares.put(k, rows(("1", "a", 1, k), (str(k), None, 2, -k)))
        shares.compact(k)
    assert got(shares.rows().filter("ou = 'a'")) == [("1", "a", 5, 4)]
    shares.put(4, rows(("1", "a", 10, 0)))   # a replay replaces the share
    assert got(shares.rows(touched_by=4).filter("ou = 'a'")) == [("1", "a", 14, 3)]
    assert shares.rows().filter("p = '4'").count() == 0
    with pytest.raises(ValueError, match="base"):
        shares.put(0, rows(("1", "a", 1, 1)))
    with pytest.raises(ValueError, match="mergeable"):
        partials.merged(rows(), {"n": "avg"})


def test_streamed_state_survives_replays(spark, tmp_out):
    rows = [("r", 1, at(1), "SUCCESS", "R", 3, None, at(1)), ("r", 2, at(2), "FAILED", None, None, "x", None)]
    df = spark.createDataFrame(rows, RUN_EVENTS)
    for _ in range(2):
        ss._publish(ss.fold_partial(df, START), tmp_out)
    assert states(ss.read_streamed_state(spark, tmp_out))["r"]["sync_status"] == "FAILED"


def test_polled_source_takes_each_row_once(spark, tmp_out):
    from reportflow.sources.polled import ParquetClient, to_micros
    path = os.path.join(tmp_out, "t")
    facts(spark, [("2026-01-03", "a"), ("2026-01-04", "b"), ("2026-01-05", "c")])
    spark.table("facts").unionAll(spark.sql("SELECT CAST(NULL AS TIMESTAMP_NTZ), 'x'")).coalesce(1).write.parquet(path)
    client = ParquetClient({"path": path, "time_col": "ts"})
    read = lambda a, b: sorted(v for p in client.pieces(a, b) for batch in client.read(p, a, b) for v in batch.column("place").to_pylist())
    cut = to_micros(datetime(2026, 1, 4))
    assert read(to_micros(datetime(1, 1, 1)), cut) == ["a", "b"] and read(cut, to_micros(client.newest())) == ["c"]
    assert to_micros(client.newest()) == to_micros(datetime(2026, 1, 5))


def test_differences_of_equal_stores_are_none(spark):
    a = long(spark, [("202601", "E", "1"), ("202602", "E", "2")])
    assert dl.verify_differences(a, a).count() == 0
    b = long(spark, [("202601", "E", None), ("202603", "E", "2")])
    got = {(r["period"], r["difference"]) for r in dl.verify_differences(a, b).collect()}
    assert got == {("202601", "changed"), ("202602", "lost"), ("202603", "added")}


def test_to_char_of_nested_and_zoned_values(spark):
    from reportflow.functions.expr import translate_to_char
    run = lambda e: spark.sql(translate_to_char(f"SELECT {e} AS x")).first()["x"]
    assert run("TO_CHAR(TIMESTAMP_NTZ'2026-02-01 15:04:05' AT TIME ZONE 'UTC', 'YYYYMM')") == "202602"
    assert run("TO_CHAR(TIMESTAMP'2026-02-01 00:30:00 UTC' AT TIME ZONE 'America/New_York', 'YYYY-MM-DD HH24')") == "2026-01-31 19"
    assert run("TO_CHAR(TIMESTAMP_NTZ'2026-02-01 15:04:05', 'HH:MI')") == "03:04"
    assert run("""TO_CHAR(TIMESTAMP_NTZ'2026-02-01 15:04:05', 'YYYY-"Q"Q')""") == "2026-Q1"
    for fmt in ("IYYY-IW", "YYYY-WW", "Month", "999"):
        with pytest.raises(ValueError):
            translate_to_char(f"SELECT TO_CHAR(x, '{fmt}')")


def test_files_of_the_merge_query_are_written_by_as_many_tasks_as_read_them(spark, tmp_out, monkeypatch):
    """What one task reads to make the arriving files is one split, not half of the table."""
    class Written(Exception):
        pass

    def stop(*args, **kw):
        raise Written

    folder, sink = os.path.join(tmp_out, "tables"), os.path.join(tmp_out, "sink")
    os.makedirs(folder)
    table(spark, SF, "lineitem").repartition(4).write.parquet(os.path.join(folder, "lineitem.parquet"))
    monkeypatch.setattr(q_store.td, "sources", lambda *a: None)
    monkeypatch.setattr(q_store, "stream_root", lambda *a: sink)
    monkeypatch.setattr(q_store, "stream_report", stop)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        splits = table(spark, folder, "lineitem").rdd.getNumPartitions()
        with pytest.raises(Written):
            q_store.incremental_merge(spark, folder)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    written = [f for f in os.listdir(os.path.join(sink, "incoming", "part0")) if f.endswith(".parquet")]
    assert splits >= 4 and len(written) > 2


def test_a_run_makes_its_leaves_once(spark, tmp_out):
    """Sets, cells and counts read the leaves that the mappings' filters gave; they do not run the filters again."""
    facts(spark, [("2026-01-03", "a"), ("2026-01-04", "b"), ("2026-02-05", "a")])
    seen = spark.sparkContext.accumulator(0)

    def kept(place):
        seen.add(1)
        return True

    spark.udf.register("kept", kept, "boolean")
    report = Report(id="tallied", name="tallied", sql="SELECT 'DS' AS ds, date_format(ts, 'yyyyMM') AS p, place, '1' AS v FROM facts",
                    groupBy=GroupBySpec(dataSet="ds", period="p", orgUnit="place"),
                    dataValueMappings=[DataValueMapping(name="m", dataElement="E", valueColumn="v", filter="kept(place)")])
    state = run_reports(spark, [report], tmp_out, at(1))
    assert [(r["sync_status"], r["records_synced"]) for r in state.collect()] == [("SUCCESS", 3)]
    assert seen.value == 3


def test_a_first_load_is_not_grouped_twice(spark, tmp_out, monkeypatch):
    """One row per cell already: only what meets stored values is merged with them."""
    read = []
    monkeypatch.setattr(store, "_in_folders", lambda s, root, m, inner=store._in_folders: read.append(inner(s, root, m)) or read[-1])
    store.upsert_values(spark, long(spark, [("202601", "E", "1"), ("202601", "E", "2")]), tmp_out)
    store.upsert_values(spark, long(spark, [("202602", "E", "3")]), tmp_out)
    assert read == [None, None]
    monkeypatch.undo()
    assert [v[3] for v in stored(spark, tmp_out)] == ["2", "3"]
