"""Queries: the streaming twin of a report run."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportflow.plans import testdata as td
from reportflow.plans.q_reports import DUCK_EVENT_LEAVES
from reportflow.plans.q_state import duck_rollup_values
from reportflow.plans.registry import query
from reportflow.sources.state_store import read_values
from reportflow.sources.tables import table, streamed_path
from reportflow.streaming.stream import finish, stream_report, stream_root


@query("stream_values", oracle=f"""
SELECT report_id, dataSet, period, orgUnit, dataElement, value, categoryOptionCombo, mapping_idx, event_id
FROM ({DUCK_EVENT_LEAVES})
""")
def stream_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events report as a micro-batch stream; its values equal the batch run's."""
    td.sources(spark, sf_dir)
    schema = table(spark, sf_dir, "events").schema
    sink = stream_root(spark, "events-report")
    q = stream_report(spark, streamed_path(sf_dir, "events"), schema, td.EVENTS_REPORT, view="events", sink=sink,
                      time_col="ts", order_by=td.EVENTS_ORDER)
    finish(q)
    vals = spark.read.parquet(os.path.join(sink, "sent_values"))
    return vals.select("report_id", "dataSet", "period", "orgUnit", "dataElement", "value",
                       "categoryOptionCombo", "mapping_idx", F.col("row_order.event_id").alias("event_id"))


@query("stream_recompute", oracle=duck_rollup_values("TIMESTAMP '1990-01-01 00:00:00'"))
def stream_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 for an aggregating report: each micro-batch re-aggregates the periods it touched."""
    td.sources(spark, sf_dir)
    schema = table(spark, sf_dir, "lineitem").schema
    sink = stream_root(spark, "rollup-report")
    q = stream_report(spark, streamed_path(sf_dir, "lineitem"), schema, td.ROLLUP_REPORT, view="lineitem", sink=sink,
                      time_col="l_shipdate", scope="recompute")
    finish(q)
    return read_values(spark, sink).select("report_id", "dataSet", "period", "orgUnit", "dataElement",
                                           "value", "categoryOptionCombo", "mapping_idx")


@query("stream_late_file", oracle=duck_rollup_values("TIMESTAMP '1990-01-01 00:00:00'"))
def stream_late_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several files in batches of their own, one with late rows of old months: equals the full recompute."""
    td.sources(spark, sf_dir)
    whole = table(spark, sf_dir, "lineitem")
    sink = stream_root(spark, "rollup-late")
    files, cut = os.path.join(sink, "incoming"), F.lit("1998-01-01").cast("timestamp_ntz")
    late = (F.col("l_shipdate") < cut) & (F.col("l_orderkey") % 7 == 0)
    whole.filter((F.col("l_shipdate") < cut) & ~late).write.parquet(os.path.join(files, "a"))
    whole.filter(F.col("l_shipdate") >= cut).write.parquet(os.path.join(files, "b"))
    report = td.ROLLUP_REPORT
    try:
        for step in ("first", "late"):
            if step == "late":
                whole.filter(late).write.parquet(os.path.join(files, "c"))
            # The report's fact view holds what has arrived so far.
            spark.read.option("recursiveFileLookup", True).parquet(files).createOrReplaceTempView("lineitem")
            q = stream_report(spark, f"{files}/*", whole.schema, report, view="lineitem", sink=sink,
                              time_col="l_shipdate", glob="part-*.parquet", scope="recompute", max_files_per_trigger=4)
            finish(q)
    finally:
        td.sources(spark, sf_dir)
    return read_values(spark, sink).select("report_id", "dataSet", "period", "orgUnit", "dataElement",
                                           "value", "categoryOptionCombo", "mapping_idx")
