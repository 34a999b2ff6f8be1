"""The streaming run equals the batch run, and a replayed batch changes nothing."""

import os

import pytest
from pyspark.sql import functions as F

from reportflow.operators.dvs import report_values_long
from reportflow.plans import q_store, q_stream
from reportflow.plans import testdata as td
from reportflow.sources.state_store import read_run_events, snapshot_state
from reportflow.sources.tables import TEST_TABLES, register_sources, report_params, run_report_sql, table
from reportflow.streaming.stream import report_batch_writer, stream_report

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch_and_replay_is_idempotent(spark, tmp_out):
    register_sources(spark, SF)
    schema = table(spark, SF, "events").schema
    sink = os.path.join(tmp_out, "sink")
    q = stream_report(spark, SF, schema, td.EVENTS_REPORT, view="events", sink=sink, time_col="ts",
                      glob="events.parquet", order_by=td.EVENTS_ORDER)
    q.awaitTermination()
    assert q.exception() is None
    cols = ["report_id", "dataSet", "period", "orgUnit", "dataElement", "value", "categoryOptionCombo",
            "mapping_idx"]
    streamed = spark.read.parquet(os.path.join(sink, "sent_values")).select(*cols)
    register_sources(spark, SF)
    rows = run_report_sql(spark, td.EVENTS_SQL, report_params(td.DEFAULT_START))
    batch = report_values_long(rows, td.EVENTS_REPORT).select(*cols)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    before = streamed.count()
    # replay batch 0 through the same writer: the batch partition is overwritten, not appended
    writer = report_batch_writer(td.EVENTS_REPORT, "events", sink, "ts", td.EVENTS_ORDER)
    writer(table(spark, SF, "events"), 0)
    assert spark.read.parquet(os.path.join(sink, "sent_values")).count() == before
    ev = read_run_events(spark, sink).collect()
    sets = batch.select("dataSet", "period", "orgUnit").distinct().count()
    assert len(ev) == 1 and ev[0]["event"] == "SUCCESS" and ev[0]["records"] == sets
    assert snapshot_state(spark, sink, td.DEFAULT_START).first()["sync_status"] == "SUCCESS"


def test_a_batch_counts_rows_of_any_age(spark, tmp_out):
    """Rows before the default start are part of a batch, too."""
    register_sources(spark, SF)
    ev = table(spark, SF, "events")
    old = ev.limit(3).withColumn("ts", F.lit("1999-05-01 00:00:00").cast("timestamp_ntz"))
    sink = os.path.join(tmp_out, "sink")
    report_batch_writer(td.EVENTS_REPORT, "events", sink, "ts", td.EVENTS_ORDER)(old, 0)
    kinds = spark.read.parquet(os.path.join(sink, "sent_values")).filter("dataElement = 'ElKind'")
    assert kinds.count() == 3 and kinds.filter("period = '199905'").count() == 3
    register_sources(spark, SF)


def test_stream_queries_read_tables_of_several_files(spark, tmp_out):
    """A table that is a folder of files streams like one that is a file."""
    queries = [q_stream.stream_values, q_stream.stream_recompute, q_store.stream_failure]
    folder = os.path.join(tmp_out, "tables")
    os.makedirs(folder)
    for name in TEST_TABLES:
        if name in ("events", "lineitem"):
            table(spark, SF, name).repartition(3).write.parquet(os.path.join(folder, f"{name}.parquet"))
        else:
            os.symlink(os.path.join(SF, f"{name}.parquet"), os.path.join(folder, f"{name}.parquet"))
    for name in ("events", "lineitem"):   # the queries register what they read
        spark.catalog.dropTempView(name)
    for query in queries:
        one, several = (query(spark, where).checkpoint() for where in (SF, folder))
        assert one.count() == several.count() > 0
        assert one.exceptAll(several).isEmpty()
    register_sources(spark, SF)


def test_a_batch_reads_its_source_once(spark, tmp_out):
    register_sources(spark, SF)
    events, read = table(spark, SF, "events"), spark.sparkContext.accumulator(0)

    def tally(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    batch = events.mapInArrow(tally, events.schema)
    report_batch_writer(td.EVENTS_REPORT, "events", os.path.join(tmp_out, "sink"), "ts", td.EVENTS_ORDER)(batch, 0)
    assert read.value == events.count()
    register_sources(spark, SF)


def test_a_polled_table_is_written_in_files_of_bounded_rows(spark, monkeypatch):
    """A file's row groups are the pieces of a poll: one large file would be one task."""
    class Written(Exception):
        pass

    def stop(source, *args, **kw):
        raise Written

    roots = []
    make = q_store.stream_root
    monkeypatch.setattr(q_store, "POLLED_FILE_ROWS", 50, raising=False)
    monkeypatch.setattr(q_store, "stream_root", lambda *a: roots.append(make(*a)) or roots[-1])
    monkeypatch.setattr(q_store, "run_stream", stop)
    with pytest.raises(Written):
        q_store.stream_polled(spark, SF)
    grown = os.path.join(roots[0].removeprefix("file:"), "table")
    rows = [spark.read.parquet(os.path.join(grown, f)).count() for f in os.listdir(grown) if f.endswith(".parquet")]
    assert len(rows) > 1 and max(rows) <= 50
