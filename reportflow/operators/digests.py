"""Which periods of a table have changed: order-free digests per month, kept and compared.

A table without an arrival column does not tell late, changed or deleted rows from old ones. Its digest does: per month
the number of rows and two sums over hashes of their columns, which no order of rows changes. One pass with
map-side aggregation gives a few rows a month; comparing them with the kept ones names the months to read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.functions.expr import qcol

SCHEMA = "month timestamp_ntz, n long, sum_1 decimal(38,0), sum_2 decimal(38,0)"


def period_digests(rows: DataFrame, time_col: str, columns: Sequence[str] | None = None) -> DataFrame:
    """month, n, sum_1, sum_2 of the rows' ``columns`` (default all); rows without a time are the null month."""
    cols = [qcol(c) for c in sorted(columns or rows.columns)]
    # A null takes part by its place, so that (null, 1) and (1, null) differ.
    parts = [x for c in cols for x in (c.isNull(), c)]
    hashed = lambda salt: F.xxhash64(F.lit(salt), *parts).cast("decimal(38,0)")
    return (rows.groupBy(F.date_trunc("month", qcol(time_col)).cast("timestamp_ntz").alias("month"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(hashed(1)).alias("sum_1"), F.sum(hashed(2)).alias("sum_2")))


def changed_periods(before: DataFrame, now: DataFrame) -> DataFrame:
    """month of every digest that is new, differs or is gone, by a full outer join."""
    a, b = before.alias("a"), now.alias("b")
    same = (F.col("a.n") == F.col("b.n")) & F.col("a.sum_1").eqNullSafe(F.col("b.sum_1")) & F.col("a.sum_2").eqNullSafe(F.col("b.sum_2"))
    return (a.join(b, F.col("a.month").eqNullSafe(F.col("b.month")), "full")
            .filter(~F.coalesce(same, F.lit(False))).select(F.coalesce("b.month", "a.month").alias("month")))


def months(changed: DataFrame) -> list[datetime]:
    """The changed months as values; rows without a time belong to no month and no report counts them."""
    return sorted(r["month"] for r in changed.filter(F.col("month").isNotNull()).collect())
