"""Keyset paging reads every row exactly once across pages."""

from pyspark.sql import functions as F

from reportflow.operators.paging import paged_extract


def test_pages_cover_all_rows_once(spark):
    df = spark.range(53).select((F.col("id") % 5).alias("t"), F.col("id"))
    seen, after = [], None
    while True:
        page = paged_extract(df, ["t", "id"], 10, after).collect()
        if not page:
            break
        seen += [r["id"] for r in page]
        after = (page[-1]["t"], page[-1]["id"])
    assert sorted(seen) == list(range(53)) and len(seen) == 53
