"""Reshaping (D1-D7) and metadata operators."""

from pyspark.sql import functions as F

from reportflow.operators import metadata as md
from reportflow.operators.reshape import (ElementPair, custom_transform, default_transform,
                                          ensure_complete_date, example_script, multi_element_unpivot)


def test_complete_date_only_when_missing(spark):
    df = spark.createDataFrame([("a", "2026-01-31"), ("b", None)], "k string, completeDate string")
    got = {r[0]: r[1] for r in ensure_complete_date(df, "2026-02-15").collect()}
    assert got == {"a": "2026-01-31", "b": "2026-02-15"}
    assert ensure_complete_date(df.drop("completeDate"), "2026-02-15").first()["completeDate"] == "2026-02-15"


def test_default_transform_absent_vs_null(spark):
    df = spark.createDataFrame([("202401", None, "E", 5.0, "default")],
                               "period string, orgUnit string, dataElement string, value double, categoryOptionCombo string")
    r = default_transform(df, "2026-02-15").first()
    assert r["dataSet"] == "default"            # absent column -> default
    assert r["orgUnit"] is None                  # present but null stays null (X11)
    assert r["completeDate"] == "2026-02-15"
    leaf = r["dataValues"][0]
    assert leaf["value"] == 5.0 and leaf["categoryOptionCombo"] is None


def test_example_script_and_custom(spark):
    df = spark.createDataFrame([("", "202401", "OU", "E", None, None), ("DS", "p", "o", "E", "C", 1.5)],
                               "dataSet string, period string, orgUnit string, dataElement string, "
                               "categoryOptionCombo string, value double")
    rows = example_script(df, "2026-02-15").collect()
    assert rows[0]["dataSet"] == "default" and rows[0]["dataValues"][0]["categoryOptionCombo"] == "default"
    assert rows[0]["dataValues"][0]["value"] == "null" and rows[1]["dataValues"][0]["value"] == "1.5"
    wrapped = custom_transform(df, {"x": "upper(period)"})
    assert wrapped.columns == ["result"]
    mapped = custom_transform(df, {"dataSet": "coalesce(nullif(dataSet, ''), 'D')", "period": "period"})
    assert [r[0] for r in mapped.collect()] == ["D", "DS"]


def test_multi_element_rules(spark):
    df = spark.createDataFrame([("E1", 0.0, "E2", None, "", 3.0)],
                               "e1 string, v1 double, e2 string, v2 double, e3 string, v3 double")
    pairs = [ElementPair("e1", "v1"), ElementPair("e2", "v2"), ElementPair("e3", "v3")]
    readme = multi_element_unpivot(df, pairs).first()["dataValues"]
    strict = multi_element_unpivot(df, pairs, rule="element_and_value", combo_default="default",
                                   derived=("SUM", "v1", "v3")).first()["dataValues"]
    assert [(x["dataElement"], x["value"]) for x in readme] == [("", "3.0")]
    assert [(x["dataElement"], x["value"], x["categoryOptionCombo"]) for x in strict] == \
        [("E1", "0.0", "default"), ("SUM", "3.0", "default")]


def test_insert_missing_and_members(spark):
    existing = spark.createDataFrame([("a", "A"), ("b", "B")], "id string, name string")
    incoming = spark.createDataFrame([("b", "B2"), ("c", "C2"), ("c", "C1")], "id string, name string")
    new, merged = md.insert_missing(existing, incoming, ["id"])
    assert sorted(tuple(r) for r in new.collect()) == [("c", "C1")]
    assert sorted(tuple(r) for r in merged.collect()) == [("a", "A"), ("b", "B"), ("c", "C1")]
    m = md.assign_all_members(existing, ["admin"])
    assert m.count() == 2 * len(md.USER_ACCESS_LISTS)
    long = md.add_members_long(spark.createDataFrame([("ds", "x"), ("ds", "x")], "s string, m string"),
                               spark.createDataFrame([("ds", "x"), ("ds", "y")], "s string, m string"), ["s", "m"])
    assert sorted(tuple(r) for r in long.collect()) == [("ds", "x"), ("ds", "y")]


def test_add_members_keeps_order(spark):
    df = spark.createDataFrame([(["b", "a", "b"], ["c", "a", "c"])], "e array<string>, n array<string>")
    arr = lambda c: F.transform(c, lambda x: F.struct(x.alias("id")))
    got = df.select(F.transform(md.add_members(arr(F.col("e")), arr(F.col("n"))), lambda x: x["id"])).first()[0]
    assert got == ["b", "a", "b", "c"]


def test_pick_by_priority_with_fallback(spark):
    cands = spark.createDataFrame([(1, "z", "x1"), (1, "default", "x9"), (2, "q", "y2"), (2, "q", "y1")],
                                  "g int, name string, id string")
    groups = spark.createDataFrame([(1,), (2,), (3,)], "g int")
    prio = F.when(F.col("name") == "default", 0).otherwise(2)
    got = {r["g"]: r["picked_id"] for r in md.pick_by_priority(cands, ["g"], "id", prio, groups, "CONST").collect()}
    assert got == {1: "x9", 2: "y1", 3: "CONST"}


def test_specs_urls_tokens(spark):
    df = spark.createDataFrame([("id1|Name|desc|more",), ("id2|Only",)], "s string")
    assert [tuple(r) for r in df.select(*md.split_spec(F.col("s"))).collect()] == \
        [("id1", "Name", "desc|more"), ("id2", "Only", "")]
    urls = spark.createDataFrame([(" http://h:8080/ ",), ("http://h/api",), ("http://h/api/",), ("http://h//",)], "u string")
    assert [r[0] for r in urls.select(md.normalize_url(F.col("u"))).collect()] == \
        ["http://h:8080/api", "http://h/api", "http://h/api", "http://h//api"]
    t = spark.createDataFrame([("a <OU_LEVEL_FACILITY_UID> b <OU_LEVEL_FACILITY_UID>",)], "t string")
    assert t.select(md.fill_token(F.col("t"), "L2")).first()[0] == "a L2 b L2"


def test_dataset_definition(spark):
    df = spark.createDataFrame([("DS", "E2"), ("DS", "E1"), ("DS", "E1")], "ds string, el string")
    r = md.dataset_definition(df, "ds", "el", F.lit("cc")).first()
    assert [x["dataElement"]["id"] for x in r["dataSetElements"]] == ["E1", "E2"]
