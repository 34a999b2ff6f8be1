"""Scalar expressions: Java trim, column-or-constant keys, combos, truth, placeholders."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportflow.functions import expr as X


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_jtrim_strips_control_chars_like_java(spark):
    rows = [("\t\n a b \r\n\x00",), (" x ",), (None,), ("",), (" \x1f ",)]
    got = one(spark, X.jtrim(F.col("v")), rows, "v string")
    assert got == ["a b", " x ", None, "", ""]
    assert X.java_trim_str("\t x \x01") == "x"


def test_spark_trim_differs_for_tabs(spark):
    # the reason jtrim exists: SQL trim leaves tabs and newlines
    assert one(spark, F.trim(F.col("v")), [("\tx\n",)], "v string") == ["\tx\n"]


def test_resolve_column_exact_then_case_insensitive():
    assert X.resolve_column(["Period", "org_unit"], "Period") == "Period"
    assert X.resolve_column(["Period", "org_unit"], "period") == "Period"
    assert X.resolve_column(["a"], "b") is None
    with pytest.raises(ValueError):
        X.resolve_column(["Ab", "aB"], "ab")


def test_column_or_const_null_value_rejects_by_default(spark):
    df = spark.createDataFrame([(" ou1 ",), (None,)], "org_unit string")
    strict = [r[0] for r in df.select(X.column_or_const(df, "ORG_UNIT")).collect()]
    legacy = [r[0] for r in df.select(X.column_or_const(df, "org_unit", null_key="name")).collect()]
    const = [r[0] for r in df.select(X.column_or_const(df, " ImspTQPwCqd ")).collect()]
    assert strict == ["ou1", None]
    assert legacy == ["ou1", "org_unit"]          # T6: the original's behaviour behind a flag
    assert const == ["ImspTQPwCqd", "ImspTQPwCqd"]
    assert df.select(X.column_or_const(df, None)).first()[0] is None


def test_coc_column_constant_and_default(spark):
    df = spark.createDataFrame([("real",), ("DEFAULT",), (None,), (" \t",)], "combo string")
    col = [r[0] for r in df.select(X.coc_expr(df, "combo")).collect()]
    legacy = [r[0] for r in df.select(X.coc_expr(df, "combo", legacy_fallback=True)).collect()]
    assert col == ["real", None, None, None]
    assert legacy == ["real", "combo", "combo", "combo"]   # T11 old way emits the column name
    assert df.select(X.coc_expr(df, " HllvX50cXC0 ")).first()[0] == "HllvX50cXC0"
    assert df.select(X.coc_expr(df, "Default")).first()[0] is None
    assert df.select(X.coc_expr(df, "  ")).first()[0] is None
    assert df.select(X.coc_expr(df, None)).first()[0] is None


def test_truthy_and_elvis(spark):
    df = spark.createDataFrame([("", 0, False), (None, None, None), ("x", 2, True)], "s string, n int, b boolean")
    got = df.select(X.truthy(F.col("s"), T.StringType()), X.truthy(F.col("n"), T.IntegerType()),
                    X.truthy(F.col("b"), T.BooleanType()),
                    X.elvis(F.col("s"), T.StringType(), "default")).collect()
    assert [tuple(r) for r in got] == [(False, False, False, "default"), (False, False, False, "default"),
                                       (True, True, True, "x")]


def test_string_value_of(spark):
    assert one(spark, X.string_value_of(F.col("d")), [(1.5,), (None,)], "d double") == ["1.5", "null"]


def test_placeholders(spark):
    df = spark.createDataFrame([("a ${X} b ${UNKNOWN} ${Y}",), ("${X}${X}",), ("none",), (None,),
                                ("${HIV_START:2024-01-01}",)], "v string")
    vars_ = {"X": "${Y}", "Y": "why"}
    got = [r[0] for r in df.select(X.resolve_placeholders(F.col("v"), vars_)).collect()]
    # inserted values are not scanned again; unknown keys stay verbatim (T3 too)
    assert got == ["a ${Y} b ${UNKNOWN} why", "${Y}${Y}", "none", None, "${HIV_START:2024-01-01}"]
    dflt = [r[0] for r in df.select(X.resolve_placeholders(F.col("v"), vars_, allow_default=True)).collect()]
    assert dflt[-1] == "2024-01-01"
    empty = [r[0] for r in df.select(X.resolve_placeholders(F.col("v"), {})).collect()]
    assert empty[0] == "a ${X} b ${UNKNOWN} ${Y}"


def test_bind_style_rewrites_outside_quotes():
    sql = "SELECT ':#keep' AS s FROM t WHERE a > :#lastSyncTimestamp AND b = :x"
    assert X.bind_style(sql) == "SELECT ':#keep' AS s FROM t WHERE a > :lastSyncTimestamp AND b = :x"


def test_boolean_filter_errors_become_false(spark):
    df = X.with_row_struct(spark.createDataFrame([(1, "a"), (5, None)], "v int, s string"))
    cols = [X.boolean_filter(df, f) for f in
            ("v > 2", "row.v > 2", "nope > 1", "v + 1", "s = 'a'", "", None, "v >")]
    got = [tuple(r) for r in df.select(*cols).collect()]
    assert got == [(False, False, False, False, True, True, True, False),
                   (True, True, False, False, False, True, True, False)]


def test_trimmed_text_is_jtrim(spark):
    texts = ["", " ", "a", " a", "a ", "\ta\n", "é", "é ", "\x00x", "x\x1f", "x ", " x", " !", "! ", "\x7f", None]
    df = spark.createDataFrame([(t, 1.5, True) for t in texts], "v string, n double, b boolean")
    for name in df.columns:
        for r in df.select(X.trimmed_text(df, name).alias("got"), X.jtrim(F.col(name).cast("string")).alias("want")).collect():
            assert r["got"] == r["want"]
