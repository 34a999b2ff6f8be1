"""Fixed schemas of the tables the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

GROUP_BY = T.StructType([
    T.StructField("dataSet", S), T.StructField("period", S), T.StructField("orgUnit", S),
])

MAPPING = T.StructType([
    T.StructField("name", S), T.StructField("dataElement", S), T.StructField("valueColumn", S),
    T.StructField("categoryOptionCombo", S), T.StructField("filter", S),
])

REPORTS = T.StructType([
    T.StructField("id", S), T.StructField("name", S), T.StructField("description", S),
    T.StructField("dataSet", S), T.StructField("sql", S), T.StructField("sqlFile", S),
    T.StructField("parameters", T.MapType(S, S)),
    T.StructField("groupBy", GROUP_BY),
    T.StructField("dataValueMappings", T.ArrayType(MAPPING)),
])

DATA_VALUE = T.StructType([
    T.StructField("dataElement", S), T.StructField("value", S),
    T.StructField("categoryOptionCombo", S),
])

# Long form of delivered values; the target of the keyed upsert.
DATA_VALUES = T.StructType([
    T.StructField("report_id", S), T.StructField("dataSet", S), T.StructField("period", S),
    T.StructField("orgUnit", S), T.StructField("dataElement", S),
    T.StructField("categoryOptionCombo", S), T.StructField("value", S),
    T.StructField("mapping_idx", T.IntegerType()), T.StructField("load_ts", T.TimestampType()),
])

REJECTS = T.StructType([
    T.StructField("report_id", S), T.StructField("reason", S), T.StructField("body", S),
])

# Append-only run log; the sync state is a fold over it.
RUN_EVENTS = T.StructType([
    T.StructField("report_id", S), T.StructField("seq", T.LongType()),
    T.StructField("event_ts", T.TimestampType()), T.StructField("event", S),
    T.StructField("report_name", S), T.StructField("records", T.LongType()),
    T.StructField("error", S), T.StructField("checkpoint", T.TimestampType()),
])

SYNC_STATE = T.StructType([
    T.StructField("report_id", S), T.StructField("report_name", S),
    T.StructField("last_sync_timestamp", T.TimestampType()), T.StructField("sync_status", S),
    T.StructField("records_synced", T.LongType()), T.StructField("error_message", S),
    T.StructField("created_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType()),
])

DEAD_LETTERS = T.StructType([
    T.StructField("report_id", S), T.StructField("body", S), T.StructField("error_message", S),
    T.StructField("redeliveries", T.IntegerType()), T.StructField("failed_at", T.TimestampType()),
])

# Sync status names and run event names.
SYNC_STATUSES = ("PENDING", "IN_PROGRESS", "SUCCESS", "FAILED")
RUN_EVENT_KINDS = ("IN_PROGRESS", "SUCCESS", "FAILED", "RESET")
