"""Row and set reshaping: the script surface re-expressed as column expressions.

The original ran a Groovy script per message. Here a transform is either a
DataFrame function or a mapping of output field to Spark SQL expression, so it
compiles into the plan like any projection.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportflow.functions.expr import elvis, jtrim, string_value_of, truthy

# Defaults of the built-in row-to-set transform.
DEFAULT_DATA_SET = "default"
DEFAULT_COMBO = "default"
COMPLETE_DATE_FORMAT = "yyyy-MM-dd"


def _date_lit(as_of: date | str | Column | None) -> Column:
    if as_of is None:
        return F.date_format(F.current_date(), COMPLETE_DATE_FORMAT)
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of.isoformat() if isinstance(as_of, date) else str(as_of))


def get_or_default(df: DataFrame, name: str, default: Column | str | None) -> Column:
    """``map.getOrDefault(name, default)``: default only when the column is absent (X11).

    Keys are exact, as in a map: a column differing in case is absent. A
    present column holding null stays null.
    """
    if name in df.columns:
        return F.col("`" + name + "`")
    return default if isinstance(default, Column) else F.lit(default)


def ensure_complete_date(sets: DataFrame, as_of: date | str | Column | None = None) -> DataFrame:
    """Finished sets pass through; ``completeDate`` is set to ``as_of`` when missing."""
    d = _date_lit(as_of)
    if "completeDate" in sets.columns:
        return sets.withColumn("completeDate", F.coalesce(F.col("completeDate"), d))
    return sets.withColumn("completeDate", d)


def _combo_kept(c: Column) -> Column:
    t = jtrim(c.cast("string"))
    return c.isNotNull() & (t != "") & (F.lower(t) != "default")


def default_transform(rows: DataFrame, as_of: date | str | Column | None = None) -> DataFrame:
    """One flat row to one set with one leaf.

    dataSet defaults to ``default``, period/orgUnit/dataElement/value to ''
    when the column is absent; the combo is kept only if not blank/``default``.
    Values keep their own type, so numbers stay numbers in JSON.
    """
    combo = get_or_default(rows, "categoryOptionCombo", DEFAULT_COMBO)
    leaf = F.struct(get_or_default(rows, "dataElement", "").alias("dataElement"),
                    get_or_default(rows, "value", "").alias("value"),
                    F.when(_combo_kept(combo), combo).alias("categoryOptionCombo"))
    return rows.select(
        "*",
        get_or_default(rows, "dataSet", DEFAULT_DATA_SET).alias("_o_dataSet"),
        get_or_default(rows, "completeDate", _date_lit(as_of)).alias("_o_completeDate"),
        get_or_default(rows, "period", "").alias("_o_period"),
        get_or_default(rows, "orgUnit", "").alias("_o_orgUnit"),
        F.array(leaf).alias("_o_dataValues"),
    ).select(*[F.col(c) for c in rows.columns if c not in
               ("dataSet", "completeDate", "period", "orgUnit", "dataValues")],
             *[F.col("_o_" + c).alias(c) for c in
               ("dataSet", "completeDate", "period", "orgUnit", "dataValues")])


Transform = Callable[[DataFrame], DataFrame] | Mapping[str, "str | Column"]


def custom_transform(rows: DataFrame, transform: Transform, keep: Sequence[str] = ()) -> DataFrame:
    """User transform (D3): a DataFrame function, or output field -> SQL expression.

    A result that is a single non-struct field is wrapped as ``result``, as a
    script returning a non-map was.
    """
    if callable(transform):
        return transform(rows)
    cols = [F.expr(v).alias(k) if isinstance(v, str) else v.alias(k) for k, v in transform.items()]
    out = rows.select(*[F.col(k) for k in keep], *cols)
    value_fields = [f for f in out.schema.fields if f.name not in keep]
    if len(value_fields) == 1 and not isinstance(value_fields[0].dataType, T.StructType) \
            and value_fields[0].name != "result":
        out = out.withColumnRenamed(value_fields[0].name, "result")
    return out


def example_script(rows: DataFrame, as_of: date | str | Column | None = None,
                   keep: Sequence[str] = ()) -> DataFrame:
    """The sample column-to-field script (D7): keys, one leaf, ``?:`` defaults, text value."""
    def field(name: str) -> Column:
        return F.col("`" + name + "`") if name in rows.columns else F.lit(None).cast("string")
    dtypes = {f.name: f.dataType for f in rows.schema.fields}
    ds, coc = field("dataSet"), field("categoryOptionCombo")
    return rows.select(
        *[F.col(k) for k in keep],
        elvis(ds, dtypes.get("dataSet", T.StringType()), DEFAULT_DATA_SET).alias("dataSet"),
        field("period").alias("period"), field("orgUnit").alias("orgUnit"),
        _date_lit(as_of).alias("completeDate"),
        F.array(F.struct(
            field("dataElement").alias("dataElement"),
            elvis(coc, dtypes.get("categoryOptionCombo", T.StringType()), DEFAULT_COMBO)
            .alias("categoryOptionCombo"),
            string_value_of(field("value")).alias("value"))).alias("dataValues"))


@dataclass(frozen=True)
class ElementPair:
    element: str            # column holding the data element id
    value: str              # column holding the value
    combo: str | None = None  # column holding the combo, optional


def multi_element_unpivot(rows: DataFrame, pairs: Sequence[ElementPair], rule: str = "value_truthy",
                          combo_default: str | None = None, keep: Sequence[str] = (),
                          derived: tuple[str, str, str] | None = None) -> DataFrame:
    """Rows with their leaves as ``dataValues`` (see :func:`element_leaves`)."""
    return rows.select(*[F.col(k) for k in keep],
                       element_leaves(rows, pairs, rule, combo_default, derived).alias("dataValues"))


def element_leaves(rows: DataFrame, pairs: Sequence[ElementPair], rule: str = "value_truthy",
                   combo_default: str | None = None,
                   derived: tuple[str, str, str] | None = None) -> Column:
    """One row to several leaves (D4, D5, D6), built as one filtered array per row.

    ``rule="value_truthy"``: a leaf when the value is truthy (README form; 0 and
    '' are skipped). ``rule="element_and_value"``: element truthy and value not
    null (0 kept; the commented-out example). ``combo_default`` replaces a falsy
    combo (``?: "default"``); values become text with ``String.valueOf``.
    ``derived=(element_id, a, b)`` appends ``a + b`` when both are non-null.
    """
    dtypes = {f.name: f.dataType for f in rows.schema.fields}
    leaves = []
    for p in pairs:
        el, v = F.col(p.element), F.col(p.value)
        if rule == "value_truthy":
            cond = truthy(v, dtypes[p.value])
        elif rule == "element_and_value":
            cond = truthy(el, dtypes[p.element]) & v.isNotNull()
        else:
            raise ValueError(f"unknown rule {rule!r}")
        coc = F.col(p.combo) if p.combo else F.lit(None).cast("string")
        if combo_default is not None:
            coc = elvis(coc, dtypes.get(p.combo, T.StringType()) if p.combo else T.StringType(),
                        combo_default)
        leaves.append(F.when(cond, F.struct(el.cast("string").alias("dataElement"),
                                            coc.cast("string").alias("categoryOptionCombo"),
                                            string_value_of(v).alias("value"))))
    if derived is not None:
        el_id, a, b = derived
        leaves.append(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.struct(
            F.lit(el_id).alias("dataElement"), F.lit(DEFAULT_COMBO).alias("categoryOptionCombo"),
            string_value_of(F.col(a) + F.col(b)).alias("value"))))
    return F.array_compact(F.array(*leaves))
