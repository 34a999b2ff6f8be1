"""Report definitions.

A report is a parameterised SQL query, grouping keys and a list of data-value
mappings. Definitions are configuration, but they also live as a Spark table
(``reports``) so many reports can be processed as data, exploded to one row per
mapping with the mapping's position kept.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportflow import schemas
from reportflow.functions.expr import java_trim_str, jtrim, resolve_placeholders


@dataclass(frozen=True)
class GroupBySpec:
    dataSet: str | None = None
    period: str | None = None
    orgUnit: str | None = None


@dataclass(frozen=True)
class DataValueMapping:
    dataElement: str
    valueColumn: str
    categoryOptionCombo: str | None = None
    filter: str | None = None
    name: str | None = None


@dataclass
class Report:
    id: str
    name: str | None = None
    description: str | None = None
    dataSet: str | None = None
    sql: str | None = None
    sqlFile: str | None = None
    parameters: dict[str, Any] = field(default_factory=dict)
    groupBy: GroupBySpec | None = None
    dataValueMappings: list[DataValueMapping] = field(default_factory=list)

    @staticmethod
    def from_dict(d: dict[str, Any]) -> "Report":
        gb = d.get("groupBy")
        maps = d.get("dataValueMappings") or []
        return Report(
            id=d["id"], name=d.get("name"), description=d.get("description"),
            dataSet=d.get("dataSet"), sql=d.get("sql"), sqlFile=d.get("sqlFile"),
            parameters=dict(d.get("parameters") or {}),
            groupBy=GroupBySpec(**gb) if gb else None,
            dataValueMappings=[DataValueMapping(**{k: m.get(k) for k in
                               ("dataElement", "valueColumn", "categoryOptionCombo", "filter", "name")})
                               for m in maps],
        )

    def resolved_sql(self, base_dir: str | None = None) -> str | None:
        """SQL file wins over inline SQL; an unreadable file falls back to inline."""
        if self.sqlFile and java_trim_str(self.sqlFile):
            import os
            path = self.sqlFile if base_dir is None else os.path.join(base_dir, self.sqlFile)
            try:
                with open(path, encoding="utf-8") as fh:
                    return fh.read()
            except OSError:
                pass
        return self.sql

    def to_json(self) -> str:
        return json.dumps(self.to_row(), sort_keys=True)

    def to_row(self) -> dict[str, Any]:
        return {
            "id": self.id, "name": self.name, "description": self.description,
            "dataSet": self.dataSet, "sql": self.sql, "sqlFile": self.sqlFile,
            "parameters": {k: None if v is None else str(v) for k, v in self.parameters.items()},
            "groupBy": None if self.groupBy is None else self.groupBy.__dict__,
            "dataValueMappings": [m.__dict__ for m in self.dataValueMappings],
        }


def reports_frame(spark: SparkSession, reports: list[Report]) -> DataFrame:
    """Definitions as a typed table, position kept as ``pos``."""
    rows = [dict(r.to_row(), pos=i) for i, r in enumerate(reports)]
    schema = T.StructType([*schemas.REPORTS.fields, T.StructField("pos", T.IntegerType())])
    return spark.createDataFrame(rows, schema=schema)


def read_reports_json(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per file holding ``{"reports": [...]}``; ``pos`` keeps the order.

    A file that is not such a document, or a field of another type, raises; it never reads as no reports.
    """
    raw = spark.read.option("multiLine", True).text(path, wholetext=True)
    parsed = raw.select(F.from_json("value", "struct<reports: array<%s>>" % schemas.REPORTS.simpleString(),
                                    {"mode": "FAILFAST"}).alias("doc"))
    if not parsed.filter(F.col("doc.reports").isNull()).isEmpty():
        raise ValueError(f"no list of reports in a definitions file under {path}")
    return (parsed.select(F.posexplode("doc.reports").alias("pos", "r"))
            .select("r.*", "pos"))


def to_reports(reports: DataFrame) -> list[Report]:
    """A ``reports`` table as objects, by position (configuration-sized)."""
    rows = reports.orderBy("pos").collect() if "pos" in reports.columns else reports.collect()
    return [Report.from_dict(r.asDict(recursive=True)) for r in rows]


def validate_reports(reports: DataFrame) -> DataFrame:
    """Reject null or repeated ids (the original kept the last silently)."""
    bad = (reports.groupBy("id").agg(F.count("*").alias("n"))
           .filter(F.col("id").isNull() | (F.col("n") > 1)))
    if bad.limit(1).count():
        raise ValueError("report ids must be present and unique: "
                         + json.dumps([r.asDict() for r in bad.limit(10).collect()]))
    return reports


def explode_mappings(reports: DataFrame) -> DataFrame:
    """One row per (report, mapping) with ``mapping_idx``; a report without mappings keeps one null row."""
    return (reports.select(
        F.col("id").alias("report_id"), F.col("dataSet").alias("report_data_set"),
        F.col("groupBy"),
        F.posexplode_outer("dataValueMappings").alias("mapping_idx", "m"))
        .select("report_id", "report_data_set",
                F.col("groupBy.dataSet").alias("gb_data_set"),
                F.col("groupBy.period").alias("gb_period"),
                F.col("groupBy.orgUnit").alias("gb_org_unit"),
                "mapping_idx",
                F.col("m.name").alias("mapping_name"),
                F.col("m.dataElement").alias("dataElement"),
                F.col("m.valueColumn").alias("valueColumn"),
                F.col("m.categoryOptionCombo").alias("categoryOptionCombo"),
                F.col("m.filter").alias("filter")))


def runnable_reports(reports: DataFrame) -> DataFrame:
    """Reports whose SQL is present and not blank (F10, T23: checked before any state change)."""
    has = lambda c: F.col(c).isNotNull() & (jtrim(F.col(c)) != "")
    return reports.filter(has("sql") | has("sqlFile"))


def report_by_id(reports: DataFrame, report_id: str | None) -> DataFrame:
    """The report with ``id``; with no id, the first configured one (lowest ``pos``)."""
    if report_id is None:
        return reports.orderBy("pos").limit(1)
    return reports.filter(F.col("id") == report_id)


def resolve_report_placeholders(reports: DataFrame, variables: dict[str, str] | None,
                                allow_default: bool = False) -> DataFrame:
    """``${KEY}`` substitution in every text field of the definitions.

    Settings and environment are merged into one dict by the caller (settings
    win). The SQL file's own text gets no pass, as before: only ``sqlFile`` the
    path is resolved.
    """
    r = lambda c: resolve_placeholders(c, variables, allow_default)
    text = ["id", "name", "description", "dataSet", "sql", "sqlFile"]
    out = reports.select(
        *[r(F.col(c)).alias(c) for c in text],
        F.transform_values("parameters", lambda _, v: r(v)).alias("parameters"),
        F.when(F.col("groupBy").isNotNull(), F.struct(
            *[r(F.col("groupBy")[k]).alias(k) for k in ("dataSet", "period", "orgUnit")])).alias("groupBy"),
        F.transform("dataValueMappings", lambda m: F.struct(
            *[r(m[k]).alias(k) for k in ("name", "dataElement", "valueColumn", "categoryOptionCombo",
                                         "filter")])).alias("dataValueMappings"),
        *[F.col(c) for c in reports.columns if c not in text + ["parameters", "groupBy", "dataValueMappings"]])
    return out
