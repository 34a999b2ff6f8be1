"""Property tests: nesting keeps every leaf, whatever the keys, values and chunk bound."""

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from pyspark.sql import functions as F

from reportflow.operators.dvs import nest_dvs, values_long
from reportflow.sources.reports import DataValueMapping, GroupBySpec

row = st.tuples(st.sampled_from(["DS", "ds2", " ", None]), st.sampled_from(["202401", "202402", None]),
                st.sampled_from(["OU1", "OU|2", "", None]), st.one_of(st.none(), st.integers(-3, 3)),
                st.sampled_from(["a", " b\t", "", None]))
GB = GroupBySpec("ds", "p", "ou")
MAPS = [DataValueMapping("E1", "n"), DataValueMapping("E2", "s", filter="n > 0"),
        DataValueMapping("E3", "s", "ou")]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, max_size=40), bound=st.sampled_from([None, 1, 3, 1000]))
def test_leaves_conserved(spark, rows, bound):
    df = spark.createDataFrame(rows, "ds string, p string, ou string, n int, s string")
    long = values_long(df, GB, MAPS)
    n_long = long.count()
    sets = nest_dvs(long, bound)
    total = sets.agg(F.coalesce(F.sum(F.size("dataValues")), F.lit(0))).first()[0]
    assert total == n_long
    # the number of leaves never exceeds rows x mappings, and no set is empty
    assert n_long <= len(rows) * len(MAPS)
    assert sets.filter(F.size("dataValues") == 0).count() == 0
