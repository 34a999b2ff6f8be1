"""DataValueSet construction.

Long form first: every (result row, mapping) pair that yields a value becomes
one leaf row ``(dataSet, period, orgUnit, dataElement, value,
categoryOptionCombo, mapping_idx, ...)``. The unpivot is a single projection
(``array(when(filter_i, leaf_i) ...)`` + ``explode``), so the result rows are
read once and never joined with the mappings. Counts and checks read the long
form. Nesting happens only at the edge, where one set is one document: its
shape never depends on its size. A receiver that takes documents up to a size
asks for parts by ``max_values_per_set`` (off by default): contiguous ranges
of the set's leaf order.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportflow.functions.expr import (coalesce_aliases, coc_expr, column_or_const, filter_flag, qcol, resolve_column,
                                       trimmed_text, with_filter_flags)
from reportflow.session import checkpoint_dir
from reportflow.sources.reports import DataValueMapping, GroupBySpec, Report

log = logging.getLogger(__name__)

KEYS = ["dataSet", "period", "orgUnit"]
LEAF = ["dataElement", "value", "categoryOptionCombo"]

# Column aliases of the default (unmapped) path, in lookup order.
DEFAULT_ALIASES = {
    "dataSet": ["dataSet", "dataset"],
    "period": ["period"],
    "orgUnit": ["orgUnit", "orgunit", "org_unit"],
    "dataElement": ["dataElement", "dataelement", "data_element"],
    "value": ["value"],
    "categoryOptionCombo": ["categoryOptionCombo", "categoryoptioncombo", "category_option_combo"],
}

# One document per set; a number splits larger sets into ordered parts with the same keys.
DEFAULT_MAX_VALUES_PER_SET = None
# Leaves that one task sorts where positions are counted.
LEAVES_PER_SORT = 250_000


def _order_struct(df: DataFrame, order_by: Sequence[str] | None) -> Column | None:
    if not order_by:
        return None
    cols = []
    for c in order_by:
        name = resolve_column(df.columns, c)
        if name is None:
            raise ValueError(f"order_by column {c!r} not in result {df.columns}")
        cols.append(qcol(name).alias(name))
    return F.struct(*cols)


def _key_ok(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def _report_id_col(report_id: str | Column | None) -> Column:
    """The report id: a literal for one report, or a column when rows of many reports share a plan."""
    if isinstance(report_id, Column):
        return report_id.cast("string")
    return F.lit(report_id).cast("string")


def values_long(rows: DataFrame, group_by: GroupBySpec | None,
                mappings: Sequence[DataValueMapping] | None,
                order_by: Sequence[str] | None = None, report_id: str | Column | None = None,
                null_key: str = "reject", legacy_coc: bool = False) -> DataFrame:
    """Mapped path (A3) in long form; falls back to the default path without a config."""
    if group_by is None or not mappings:
        return values_long_default(rows, order_by=order_by, report_id=report_id)
    src = with_filter_flags(rows, [m.filter for m in mappings])
    order = _order_struct(rows, order_by)
    leaves = []
    for i, m in enumerate(mappings):
        keep = F.col(filter_flag(i))
        vname = resolve_column(rows.columns, m.valueColumn)
        v = trimmed_text(rows, vname) if vname else F.lit(None).cast("string")
        leaf = F.struct(F.lit(i).alias("mapping_idx"), F.lit(m.dataElement).alias("dataElement"),
                        v.alias("value"),
                        coc_expr(rows, m.categoryOptionCombo, legacy_coc).alias("categoryOptionCombo"))
        leaves.append(F.when(keep & v.isNotNull() & (v != ""), leaf))
    ds = column_or_const(rows, group_by.dataSet, null_key)
    pe = column_or_const(rows, group_by.period, null_key)
    ou = column_or_const(rows, group_by.orgUnit, null_key)
    proj = [_report_id_col(report_id).alias("report_id"), ds.alias("dataSet"), pe.alias("period"),
            ou.alias("orgUnit")]
    if order is not None:
        proj.append(order.alias("row_order"))
    proj.append(F.array(*leaves).alias("_leaves"))
    out = (src.select(*proj)
           .filter(_key_ok(F.col("dataSet")) & _key_ok(F.col("period")) & _key_ok(F.col("orgUnit")))
           .select("report_id", *KEYS,
                   *(["row_order"] if order is not None else []),
                   # Outer: for a plain explode Spark adds a filter on the array, which makes all leaves twice.
                   F.explode_outer("_leaves").alias("_leaf"))
           .filter(F.col("_leaf").isNotNull())
           .select("report_id", *KEYS, "_leaf.dataElement", "_leaf.value",
                   "_leaf.categoryOptionCombo", "_leaf.mapping_idx",
                   *(["row_order"] if order is not None else [])))
    return out


def values_long_default(rows: DataFrame, order_by: Sequence[str] | None = None,
                        report_id: str | None = None) -> DataFrame:
    """Default path (A4): rows already carry keys, element and value under known aliases.

    Null keys drop the row (no constant fallback); a row without element or
    value gives no leaf; empty-string values are kept (the mapped path drops them).
    """
    c = {k: coalesce_aliases(rows, a) for k, a in DEFAULT_ALIASES.items()}
    coc = c["categoryOptionCombo"]
    coc = F.when(coc.isNotNull() & (coc != "") & (F.lower(coc) != "default"), coc)
    order = _order_struct(rows, order_by)
    proj = [_report_id_col(report_id).alias("report_id"),
            *[c[k].alias(k) for k in KEYS], c["dataElement"].alias("dataElement"),
            c["value"].alias("value"), coc.alias("categoryOptionCombo"),
            F.lit(0).alias("mapping_idx")]
    if order is not None:
        proj.append(order.alias("row_order"))
    return (rows.select(*proj)
            .filter(F.col("dataSet").isNotNull() & F.col("period").isNotNull()
                    & F.col("orgUnit").isNotNull() & F.col("dataElement").isNotNull()
                    & F.col("value").isNotNull()))


def rejected_rows(rows: DataFrame, group_by: GroupBySpec | None, report_id: str | Column | None = None,
                  null_key: str = "reject") -> DataFrame:
    """Rows dropped before grouping, with the reason and the row as JSON."""
    body = F.to_json(F.struct(*[qcol(c) for c in rows.columns]))
    if group_by is None:
        c = {k: coalesce_aliases(rows, a) for k, a in DEFAULT_ALIASES.items()}
        missing_key = c["dataSet"].isNull() | c["period"].isNull() | c["orgUnit"].isNull()
        missing_leaf = c["dataElement"].isNull() | c["value"].isNull()
        reason = (F.when(missing_key, F.lit("missing_grouping_key"))
                  .when(missing_leaf, F.lit("missing_element_or_value")))
    else:
        ks = [column_or_const(rows, getattr(group_by, k), null_key) for k in KEYS]
        bad = ~(_key_ok(ks[0]) & _key_ok(ks[1]) & _key_ok(ks[2]))
        reason = F.when(bad, F.lit("missing_grouping_key"))
    return (rows.select(_report_id_col(report_id).alias("report_id"), reason.alias("reason"),
                        body.alias("body"))
            .filter(F.col("reason").isNotNull()))


def report_values_long(rows: DataFrame, report: Report, order_by: Sequence[str] | None = None,
                       **kw) -> DataFrame:
    return values_long(rows, report.groupBy, report.dataValueMappings, order_by=order_by,
                       report_id=report.id, **kw)


def _sort_fields(long: DataFrame) -> list[str]:
    """Leaf order in a set (O3): mapping position, row order, then the leaf itself."""
    return ["mapping_idx", *(["row_order"] if "row_order" in long.columns else []), *LEAF]


def sort_parts(n: int) -> int:
    """Partitions for a range sort of ``n`` leaves: what one task sorts does not grow with them."""
    return max(1, -(-n // LEAVES_PER_SORT))


def with_positions(long: DataFrame, key: list[str]) -> DataFrame:
    """Add ``position``, the leaf's place in its set (from 0), and ``set_size``."""
    return counted_positions(long, key)[0]


def counted_positions(long: DataFrame, key: list[str]) -> tuple[DataFrame, int]:
    """``with_positions`` and the number of leaves.

    Positions come from a range sort over all sets, so a set of any size is
    spread over tasks and equal leaves are told apart by a row number; the
    offsets of a set's parts are sums over the few parts it spans. Leaves are
    numbered where they were sorted and meet only those sums, so parts never
    gather in one task.
    """
    checkpoint_dir(long.sparkSession)
    order = [*key, *_sort_fields(long), "_row"]
    numbered = long.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    n = numbered.count()
    # A part's id goes up by one a row from the part's number times 2^33.
    part = F.shiftright("_at", 33)
    ranged = (numbered.repartitionByRange(sort_parts(n), *[F.col(c) for c in order]).sortWithinPartitions(*order).drop("_row")
              .withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", part).checkpoint())
    sizes = ranged.groupBy(*key, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_from"))
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(k).alias("_k_" + k) for k in key], F.col("_part").alias("_p"), "_from",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                           F.sum("_n").over(Window.partitionBy(*key)).alias("set_size"))
    same = [ranged[k].eqNullSafe(offsets["_k_" + k]) for k in key]   # a key part may be null
    return (ranged.join(offsets, [ranged["_part"] == offsets["_p"], *same])
            .withColumn("position", F.col("_at") - F.col("_from") + F.col("_before"))
            .drop("_at", "_part", "_p", "_from", "_before", *["_k_" + k for k in key])), n


def with_chunks(long: DataFrame, key: list[str], max_values: int) -> DataFrame:
    """Add ``chunk``: the leaf's position in its set, divided by ``max_values``."""
    return (with_positions(long, key).withColumn("chunk", F.floor(F.col("position") / F.lit(max_values)).cast("int"))
            .drop("position", "set_size"))


def nest_dvs(long: DataFrame, max_values_per_set: int | None = DEFAULT_MAX_VALUES_PER_SET) -> DataFrame:
    """Nest leaves into sets ``(report_id, dataSet, period, orgUnit, chunk, dataValues)``.

    Leaves in a set are ordered by mapping position, then row order (or the
    leaf content when no row order is given), as the original emitted them
    mapping by mapping. Sets without leaves do not exist (A5). A set is one
    document (``chunk`` 0) unless ``max_values_per_set`` asks for parts.
    """
    key = [c for c in ["report_id", *KEYS] if c in long.columns]
    long = with_chunks(long, key, max_values_per_set) if max_values_per_set else long.withColumn("chunk", F.lit(0))
    packed = F.struct(*[F.col(c) for c in _sort_fields(long)])
    # Not array_sort: that compares by a lambda.
    aggs = [F.sort_array(F.collect_list(packed)).alias("_vals")]
    has_order = "row_order" in long.columns
    if has_order:
        # O3: sets were emitted in order of first appearance; keep that as a sort key.
        aggs.append(F.min("row_order").alias("first_row"))
    return (long.groupBy(*key, "chunk").agg(*aggs)
            .select(*key, "chunk",
                    F.transform("_vals", lambda x: F.struct(
                        *[x[c].alias(c) for c in LEAF])).alias("dataValues"),
                    *(["first_row"] if has_order else [])))


def aggregate_dvs(rows: DataFrame, report: Report | None, order_by: Sequence[str] | None = None,
                  max_values_per_set: int | None = DEFAULT_MAX_VALUES_PER_SET, **kw) -> DataFrame:
    """Result rows to DataValueSets; the default path when no report config is given."""
    if report is None:
        long = values_long_default(rows, order_by=order_by)
    else:
        long = report_values_long(rows, report, order_by=order_by, **kw)
    return nest_dvs(long, max_values_per_set)


def values_text(values: Column) -> Column:
    """Ordered one-line text of a set's leaves: ``el=value[/coc];...`` (for checks and logs)."""
    return F.array_join(F.transform(values, lambda x: F.concat(
        x["dataElement"], F.lit("="), x["value"],
        F.coalesce(F.concat(F.lit("/"), x["categoryOptionCombo"]), F.lit("")))), ";")


# Sums are exact to 10 decimal places and 28 digits before the point.
SUM_TYPE = "decimal(38,10)"


def is_number(value: Column) -> Column:
    """Plain decimal text that a sum can hold exactly."""
    return F.coalesce(value.rlike(r"^[+-]?[0-9]{1,18}(\.[0-9]{0,10})?$"), F.lit(False))


def unsummed_leaves(long: DataFrame) -> DataFrame:
    """Leaves that ``merge_duplicate_leaves(how="sum")`` cannot add, as rejects."""
    return long.filter(~is_number(F.col("value"))).select(
        "report_id", F.lit("value_not_a_number").alias("reason"), F.to_json(F.struct(*KEYS, *LEAF)).alias("body"))


def merge_duplicate_leaves(long: DataFrame, how: str = "keep") -> DataFrame:
    """Leaves repeating (element, combo) within a set (T8): ``keep`` all (the original),
    ``last`` by mapping then row order, or ``sum`` their numeric values.

    A grouped ``max_by``/``sum`` with map-side combine, so a repeated cell
    costs one partial row per task.
    """
    if how == "keep":
        return long
    key = [c for c in ["report_id", *KEYS, "dataElement", "categoryOptionCombo"] if c in long.columns]
    order = F.struct(F.col("mapping_idx"), *([F.col("row_order")] if "row_order" in long.columns else []),
                     F.col("value"))
    if how == "last":
        rest = [c for c in long.columns if c not in key]
        return (long.groupBy(*key).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_r"))
                .select(*key, *[F.col("_r")[c].alias(c) for c in rest]))
    if how == "sum":
        # Exact decimals in plain text; what is not a plain number is kept apart by unsummed_leaves.
        return (long.filter(is_number(F.col("value"))).groupBy(*key)
                .agg(F.sum(F.col("value").cast(SUM_TYPE)).alias("_s"), F.min("mapping_idx").alias("mapping_idx"),
                     *([F.min("row_order").alias("row_order")] if "row_order" in long.columns else []))
                .withColumn("value", F.regexp_replace(F.regexp_replace(
                    F.format_string("%s", F.col("_s").cast("string")), r"(\.[0-9]*?)0+$", "$1"), r"\.$", ""))
                .drop("_s"))
    raise ValueError(f"how must be 'keep', 'last' or 'sum', got {how!r}")
