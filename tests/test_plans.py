"""Plan shape guarantees: pushdown, pruning, no Python in the hot path, bounded broadcasts."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")   # show whole PushedFilters lists
    return df._jdf.queryExecution().executedPlan().toString()


def test_checkpoint_and_equality_filters_reach_the_scan(spark):
    p = plan(E.queries()["report_rollup"](spark, SF))
    assert "GreaterThan(l_shipdate" in p and "EqualTo(l_returnflag,R)" in p
    # only the four lineitem columns the report needs are read
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in p


def test_recompute_bound_is_a_range_predicate(spark):
    p = plan(E.queries()["incremental_recompute"](spark, SF))
    assert "GreaterThan(l_shipdate,1995-12-31T23:59:59.999999)" in p
    assert "SortMergeJoin" not in p or "LeftSemi" not in p


def test_no_python_udfs_in_report_paths(spark):
    for name in ("report_dvs", "dvs_config", "config_values_long", "sync_state_fold", "upsert_latest",
                 "resolve_placeholders", "parse_delivery_errors", "shared_rollup"):
        p = plan(E.queries()[name](spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
