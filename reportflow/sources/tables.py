"""Source tables a report's SQL may read (S1) and the SQL runner.

Sources are temp views over parquet (the test data) or JDBC. Reports' SQL runs
through ``spark.sql`` with named parameters, so Catalyst sees one plan and
pushes the checkpoint and equality filters into the scan.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Mapping
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from reportflow.functions.expr import PERIOD_FORMAT, bind_style, translate_to_char

# The table names of the driver-generated test data.
TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

# Default checkpoint when a report has none stored (2020-01-01T00:00:00Z).
DEFAULT_SYNC_START = datetime(2020, 1, 1, tzinfo=timezone.utc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def streamed_path(sf_dir: str, name: str) -> str:
    """A table's path for a file stream, whether the table is one file or a folder of files: Spark streams a path
    without a pattern from folders only."""
    return os.path.join(sf_dir, f"{name}.parque[t]")


def register_sources(spark: SparkSession, sf_dir: str,
                     names: Iterable[str] = TEST_TABLES) -> dict[str, DataFrame]:
    """Register the named parquet tables under ``sf_dir`` as temp views; a missing one raises."""
    out = {}
    for n in names:
        out[n] = spark.read.parquet(os.path.join(sf_dir, f"{n}.parquet"))
        out[n].createOrReplaceTempView(n)
    register_period_function(spark)
    return out


def register_jdbc_source(spark: SparkSession, name: str, url: str, dbtable: str,
                         partition_column: str | None = None, lower_bound: Any = None,
                         upper_bound: Any = None, num_partitions: int | None = None,
                         properties: Mapping[str, str] | None = None) -> DataFrame:
    """A JDBC table as a view, read in parallel ranges of ``partition_column``.

    Without a partition column Spark reads the table in one task, so big tables
    must name one (a numeric, date or timestamp column with its bounds).
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", dbtable)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions or 64)))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    df = reader.load()
    df.createOrReplaceTempView(name)
    return df


def register_period_function(spark: SparkSession) -> None:
    """``calculate_period(d)``: the ``YYYYMM`` period of a date or timestamp.

    A SQL function, so it inlines into the plan (no Python UDF).
    """
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION calculate_period(d TIMESTAMP_NTZ) "
              f"RETURNS STRING RETURN date_format(d, '{PERIOD_FORMAT}')")


def report_params(checkpoint: Any, params: Mapping[str, Any] | None = None) -> dict[str, Any]:
    """Bind ``lastSyncTimestamp`` first, then overlay the report's own parameters."""
    out: dict[str, Any] = {"lastSyncTimestamp": checkpoint}
    out.update(params or {})
    return out


def run_report_sql(spark: SparkSession, sql: str, params: Mapping[str, Any] | None = None) -> DataFrame:
    """Run a report's SQL with named parameters; ``:#name`` and ``:name`` both bind.

    Only parameters the text names are passed, so unused report parameters are
    harmless (T4). A naive checkpoint is read as UTC (never the machine's
    zone); Spark folds it to a literal that is pushed into the scan.
    """
    text = translate_to_char(bind_style(sql))
    args = {}
    for k, v in (params or {}).items():
        if not re.search(r":" + re.escape(k) + r"\b", text):
            continue
        if isinstance(v, datetime) and v.tzinfo is None:
            v = v.replace(tzinfo=timezone.utc)
        args[k] = v
    return spark.sql(text, args=args) if args else spark.sql(text)
