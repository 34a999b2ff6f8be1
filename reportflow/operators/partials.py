"""Kept partial aggregates (A1, A2 under I3): each batch's share of the counts, merged instead of counted again.

A report whose result columns are keys and mergeable measures (``sum`` of counts or sums, ``min``, ``max``) need not
read its months again for every late file. A batch's share is the report's SQL over the batch's rows only, stored under the batch's
name, so a replayed batch replaces its share. The merged rows of the periods a batch touches are a grouped fold of
the shares. Old shares are merged into a base, published by a pointer that says up to which batch it counts.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportflow.functions.expr import qcol
from reportflow.sources import files

FOLDS = {"sum": F.sum, "min": F.min, "max": F.max}
# Shares above this number are merged into the base.
MAX_SHARES = 32


def merged(rows: DataFrame, folds: Mapping[str, str]) -> DataFrame:
    """Rows with equal keys (all columns without a fold) as one, measures folded; columns and types stay."""
    unknown = {f for f in folds.values() if f not in FOLDS} | {c for c in folds if c not in rows.columns}
    if unknown:
        raise ValueError(f"not a mergeable measure of {rows.columns}: {sorted(unknown)}")
    keys = [c for c in rows.columns if c not in folds]
    out = rows.groupBy(*[qcol(k) for k in keys]).agg(*[FOLDS[f](qcol(c)).cast(rows.schema[c].dataType).alias(c) for c, f in folds.items()])
    return out.select(*[qcol(c) for c in rows.columns])


class Shares:
    """The shares of one report under ``folder``; ``period_col`` is the key that says which rows a batch touches."""

    def __init__(self, spark: SparkSession, folder: str, folds: Mapping[str, str], period_col: str, max_shares: int = MAX_SHARES):
        self.spark, self.folder, self.folds, self.period_col, self.max_shares = spark, folder, folds, period_col, max_shares

    def _numbers(self, above: int) -> list[int]:
        found = [int(n.removeprefix("share-")) for n in files.finished_folders(self.spark, self.folder, "share-")]
        return [n for n in found if n > above]

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.folder, name))

    def put(self, batch: int, rows: DataFrame) -> None:
        """Store (or replace) a batch's share; batches already in the base can't be replaced."""
        through = files.read_pointer(self.spark, self.folder)[1].get("through", -1)
        if batch <= through:
            raise ValueError(f"batch {batch} is part of the base, which counts up to batch {through}")
        merged(rows, self.folds).write.mode("overwrite").parquet(os.path.join(self.folder, f"share-{batch:012d}"))

    def rows(self, touched_by: int | None = None) -> DataFrame:
        """The merged rows, of all periods or of those in one batch's share."""
        _, base = files.read_pointer(self.spark, self.folder)
        names = [base["name"]] if base else []
        names += [f"share-{n:012d}" for n in self._numbers(base.get("through", -1))]
        if not names:
            raise ValueError(f"no shares under {self.folder}")
        parts = [self._read(n) for n in names]
        if touched_by is not None:
            # A few periods, whatever the batch's rows: as values they reach the shares' scans.
            own = self._read(f"share-{touched_by:012d}").select(qcol(self.period_col).alias("p")).distinct()
            periods = [r["p"] for r in own.collect()]
            parts = [p.filter(qcol(self.period_col).isin(periods)) for p in parts]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return merged(out, self.folds)

    def compact(self, newest: int) -> None:
        """Merge the shares before ``newest`` (which may still be replayed) into the base once there are too many."""
        number, base = files.read_pointer(self.spark, self.folder)
        old = [n for n in self._numbers(base.get("through", -1)) if n < newest]
        if len(old) < self.max_shares:
            return
        parts = [self._read(f"share-{n:012d}") for n in old] + ([self._read(base["name"])] if base else [])
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        name = f"base-{files.fresh_name()}"
        merged(out, self.folds).write.parquet(os.path.join(self.folder, name))
        files.write_pointer(self.spark, self.folder, number, {"name": name, "through": old[-1]})
        for n in old:
            files.delete(self.spark, os.path.join(self.folder, f"share-{n:012d}"))
        if base:
            files.delete(self.spark, os.path.join(self.folder, base["name"]))
