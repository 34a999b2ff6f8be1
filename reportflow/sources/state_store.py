"""Tables kept between runs (S8, S6 sink, S7 sink): run log, state snapshots, values.

All paths are on the storage the cluster shares (a root folder per deployment).
Writes go through Spark; folder listing uses the Hadoop FileSystem API the
session already has, so the same code works on HDFS, object stores and local
disks.

* ``run_events`` is append-only, the source of truth for the sync state (T16: no
  read-modify-write of a shared file). Every append is a folder of its own, and every
  attempt of a run has appends of its own; only a replayed stream batch overwrites its own.
  Appends that a snapshot holds are merged into segments once there are many, and the
  segments into larger ones, so a run lists and reads a bounded number of folders however old the log is.
* State snapshots are written to a new version folder and name the appends they
  hold; a run folds just the appends that its snapshot lacks, whatever times their
  events bear. A missing store reads as empty; a version that exists but cannot be
  read raises instead of silently resetting every report, as the original did.
* ``data_values`` holds one value per cell (data set, period, org unit, element, combo), whichever
  report sent it last. An upsert reads the (data set, period) pairs it touches, writes them to new
  folders and publishes these with one pointer: until then, and if the run is lost, readers see the old values.
"""

from __future__ import annotations

import os
import time

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportflow import schemas
from reportflow.operators.delivery import VALUE_KEY
from reportflow.operators.state import combine_partial, finalize_state, fold_partial, run_event
from reportflow.session import checkpoint_dir
from reportflow.sources import files
from reportflow.sources.files import exists, fresh_name

# Above this many touched (data set, period) pairs the folders to read are found by a join instead of by name.
MAX_PRUNED_PARTITIONS = 10_000
# Appends held by a snapshot are merged into a segment above this number, and so many segments of one tier into the next.
MAX_LIVE_APPENDS = 64
SEGMENTS_PER_TIER = 8
# A publication that lost against another one is tried again this often.
PUBLISH_ATTEMPTS = 5


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet table at ``path``; an absent table is empty, an unreadable one raises."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


# ---- run log -----------------------------------------------------------------

APPENDED = T.StructType([*schemas.RUN_EVENTS.fields, T.StructField("append", T.StringType())])


def _log(root: str) -> str:
    return os.path.join(root, "run_events")


def append_run_events(events: DataFrame, root: str, name: str | None = None) -> str:
    """Append to the run log and return the append's name. A given ``name`` makes a repeated append (a replayed
    stream batch) overwrite its first try; runs leave it out, so every attempt is kept."""
    name = name or fresh_name()
    (events.select(*[F.col(f.name).cast(f.dataType) for f in schemas.RUN_EVENTS.fields])
     .write.mode("overwrite").parquet(os.path.join(_log(root), f"append={name}")))
    return name


def run_appends(spark: SparkSession, root: str) -> list[str]:
    """Names of the appends that are folders of their own, not merged yet."""
    return [n.removeprefix("append=") for n in files.finished_folders(spark, _log(root), "append=")]


def _read_appends(spark: SparkSession, root: str, appends: Sequence[str]) -> DataFrame:
    if not appends:
        return spark.createDataFrame([], APPENDED)
    paths = [os.path.join(_log(root), f"append={n}") for n in appends]
    return spark.read.schema(APPENDED).option("basePath", _log(root)).parquet(*paths)


def read_run_events(spark: SparkSession, root: str, appends: Sequence[str] | None = None) -> DataFrame:
    """The run log, or the named appends of it."""
    if appends is not None:
        return _read_appends(spark, root, appends).drop("append")
    live = run_appends(spark, root)
    out = _read_appends(spark, root, live)
    segments = [s["name"] for s in files.read_pointer(spark, _log(root))[1].get("segments", [])]
    if segments:
        merged = spark.read.schema(APPENDED).parquet(*[os.path.join(_log(root), s) for s in segments])
        # A merged append whose folder is (still or again) there counts once.
        out = out.unionByName(merged.filter(~F.col("append").isin(live)))
    return out.drop("append")


def compact_log(spark: SparkSession, root: str, held: Sequence[str], max_live: int = MAX_LIVE_APPENDS) -> None:
    """Merge the appends in ``held`` (those a snapshot has folded) into a segment once there are more than ``max_live``.

    ``SEGMENTS_PER_TIER`` segments of one tier become one of the next, so every event is rewritten a number of times
    that is the logarithm of the log's length. Folders go only after the pointer names what replaces them.
    """
    live = sorted(set(held) & set(run_appends(spark, root)))
    if len(live) <= max_live:
        return
    number, content = files.read_pointer(spark, _log(root))
    segments, merged, tier = content.get("segments", []), [], 0
    while Counter(s["tier"] for s in segments)[tier] >= SEGMENTS_PER_TIER - 1:
        merged += [s for s in segments if s["tier"] == tier]
        segments = [s for s in segments if s["tier"] != tier]
        tier += 1
    rows = _read_appends(spark, root, live)
    if merged:
        rows = rows.unionByName(spark.read.schema(APPENDED).parquet(*[os.path.join(_log(root), s["name"]) for s in merged])
                                .filter(~F.col("append").isin(live)))
    name = f"segment-{fresh_name()}"
    rows.coalesce(max(1, min(len(live) + 64 * len(merged), 64))).write.parquet(os.path.join(_log(root), name))
    try:
        files.write_pointer(spark, _log(root), number, {"segments": [*segments, {"name": name, "tier": tier}]})
    except files.Conflict:   # another run has merged them
        files.delete(spark, os.path.join(_log(root), name))
        return
    for n in live:
        files.delete(spark, os.path.join(_log(root), f"append={n}"))
    for s in merged:
        files.delete(spark, os.path.join(_log(root), s["name"]))


def reset_report(spark: SparkSession, root: str, report_id: str, at: datetime) -> None:
    """Put a report back to its default start and PENDING (the state service's reset call)."""
    append_run_events(spark.range(1).select(*run_event(
        F.lit(report_id), F.lit(time.time_ns()), F.lit(at), "RESET")), root)


# ---- state snapshots ---------------------------------------------------------

def latest_state_version(spark: SparkSession, root: str) -> str | None:
    base = os.path.join(root, "sync_state")
    done = files.finished_folders(spark, base, "v=", "appends/_SUCCESS")   # written last
    return os.path.join(base, done[-1]) if done else None


def read_state_partial(spark: SparkSession, root: str) -> tuple[DataFrame, set[str]] | None:
    """Newest finished snapshot of the partial fold and the live appends it holds, or None without one."""
    v = latest_state_version(spark, root)
    if v is None:
        return None
    held = spark.read.parquet(os.path.join(v, "appends")).collect()   # names of unmerged appends only
    return spark.read.parquet(os.path.join(v, "partial")), {r[0] for r in held}


def current_partial(spark: SparkSession, root: str, default_start) -> tuple[DataFrame, list[str]]:
    """Snapshot + the appends it lacks, and the names of all live appends that the result holds.

    Events may arrive in any order of their times: each field keeps the order it was last set at, so
    folding late appends into a snapshot gives what folding the whole log gives.
    """
    appends = run_appends(spark, root)
    snap = read_state_partial(spark, root)
    if snap is None:
        return fold_partial(read_run_events(spark, root), default_start), appends
    partial, held = snap
    fresh = [n for n in appends if n not in held]
    if not fresh:
        return partial, appends
    return combine_partial(partial, fold_partial(read_run_events(spark, root, fresh), default_start)), appends


def snapshot_state(spark: SparkSession, root: str, default_start, keep_versions: int = 2,
                   max_live_appends: int = MAX_LIVE_APPENDS) -> DataFrame:
    """Write a new version of the state, remove all but the newest ``keep_versions`` and merge what the log has too many of;
    returns the state."""
    partial, appends = current_partial(spark, root, default_start)
    base = os.path.join(root, "sync_state")
    path = os.path.join(base, f"v={fresh_name()}")
    partial.write.mode("errorifexists").parquet(os.path.join(path, "partial"))
    spark.createDataFrame([(n,) for n in appends], "append string").coalesce(1).write.parquet(os.path.join(path, "appends"))
    for old in files.finished_folders(spark, base, "v=", "appends/_SUCCESS")[:-keep_versions]:
        files.delete(spark, os.path.join(base, old))
    compact_log(spark, root, appends, max_live_appends)
    return finalize_state(spark.read.parquet(os.path.join(path, "partial")))


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """Newest finished snapshot as the state table; no store means no state."""
    snap = read_state_partial(spark, root)
    if snap is None:
        return spark.createDataFrame([], schemas.SYNC_STATE)
    return finalize_state(snap[0])


# ---- values ------------------------------------------------------------------

PAIR = ["dataSet", "period"]
MANIFEST = T.StructType([T.StructField(c, T.StringType()) for c in (*PAIR, "v")])
STORED = T.StructType([*schemas.DATA_VALUES.fields, T.StructField("v", T.StringType())])


@dataclass(frozen=True)
class Staged:
    """A version of ``data_values`` that is written but not published yet."""

    root: str
    after: int
    manifest: str


def _values(root: str) -> str:
    return os.path.join(root, "data_values")


def _manifest(spark: SparkSession, root: str) -> tuple[int, DataFrame]:
    """The published version's number, and the folder of each of its (data set, period) pairs."""
    number, content = files.read_pointer(spark, _values(root))
    if not content:
        return number, spark.createDataFrame([], MANIFEST)
    return number, spark.read.schema(MANIFEST).parquet(os.path.join(_values(root), content["manifest"]))


def _in_folders(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame | None:
    """The values in the manifest's folders: read by name, or by a join if there are very many; None without folders."""
    base = _values(root)
    pairs = manifest.limit(MAX_PRUNED_PARTITIONS + 1).collect()
    if not pairs:
        return None
    reader = spark.read.schema(STORED).option("basePath", base)
    if len(pairs) <= MAX_PRUNED_PARTITIONS:
        return reader.parquet(*[os.path.join(base, files.partition_path(spark, v=r["v"], dataSet=r["dataSet"], period=r["period"]))
                                for r in pairs]).drop("v")
    return reader.parquet(base).join(manifest, [*PAIR, "v"], "left_semi").drop("v")


def last_sent(incoming: DataFrame) -> DataFrame:
    """One row per cell: the last by load time, mapping and row order, then by value."""
    cols = [f.name for f in schemas.DATA_VALUES.fields]
    order = ["load_ts", "mapping_idx", *(["row_order"] if "row_order" in incoming.columns else []), "value"]
    rest = [c for c in cols if c not in VALUE_KEY]
    return (incoming.withColumns({c: F.col(c).cast(schemas.DATA_VALUES[c].dataType) for c in cols})
            .groupBy(*VALUE_KEY).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
            .select(*VALUE_KEY, *[F.col("_r")[c].alias(c) for c in rest]).select(*cols))


def stage_values(spark: SparkSession, incoming: DataFrame, root: str,
                 replaced: tuple[str, Sequence[str]] | None = None) -> Staged | None:
    """Write ``incoming`` long values merged with the stored ones to new folders; nothing is visible before ``publish``.

    The last value sent of a cell wins (S6): within the incoming values by mapping and row order, on the first load
    too; against the stored ones the incoming one, whichever report stored it. ``replaced`` (report id, periods) says that the
    incoming values are all there are of the report in these periods: its other cells there go. None: nothing to do.
    """
    checkpoint_dir(spark)
    cols = [f.name for f in schemas.DATA_VALUES.fields]
    rest = [c for c in cols if c not in VALUE_KEY]
    inc = last_sent(incoming).checkpoint()
    number, manifest = _manifest(spark, root)
    touched = inc.select(*PAIR).distinct()
    if replaced is not None:
        touched = touched.unionByName(manifest.filter(F.col("period").isin(list(replaced[1]))).select(*PAIR)).distinct()
    touched = touched.checkpoint()
    if touched.isEmpty():
        return None
    existing = _in_folders(spark, root, manifest.join(touched, PAIR, "left_semi"))
    merged = inc   # one row per cell already; a grouping is needed only where values are stored
    if existing is not None:
        if replaced is not None:
            existing = existing.filter((F.col("report_id") != replaced[0]) | ~F.col("period").isin(list(replaced[1])))
        both = existing.select(*cols, F.lit(0).alias("_side")).unionByName(inc.withColumn("_side", F.lit(1)))
        merged = (both.groupBy(*VALUE_KEY).agg(F.max_by(F.struct(*rest), F.col("_side")).alias("_r"))
                  .select(*VALUE_KEY, *[F.col("_r")[c].alias(c) for c in rest]).select(*cols))
    v = fresh_name()
    # Few files per pair; AQE splits a hot pair over several tasks.
    merged.hint("rebalance", *PAIR).write.partitionBy(*PAIR).parquet(os.path.join(_values(root), f"v={v}"))
    written = read_or_empty(spark, os.path.join(_values(root), f"v={v}"), schemas.DATA_VALUES).select(*PAIR).distinct()
    name = os.path.join("_manifests", f"m-{v}")
    (manifest.join(touched, PAIR, "left_anti").select(*PAIR, "v").unionByName(written.withColumn("v", F.lit(v)))
     .coalesce(1).write.parquet(os.path.join(_values(root), name)))
    return Staged(root, number, name)


def publish(spark: SparkSession, staged: Staged) -> None:
    """Make a staged version the one that readers see, by one pointer; folders that neither it nor the version before needs go."""
    base = _values(staged.root)
    before = files.read_pointer(spark, base)[1]
    files.write_pointer(spark, base, staged.after, {"manifest": staged.manifest, "before": before.get("manifest")})
    if before.get("before"):
        read = lambda m: spark.read.schema(MANIFEST).parquet(os.path.join(base, m))
        kept = read(staged.manifest).unionByName(read(before["manifest"]))
        for r in read(before["before"]).join(kept, MANIFEST.names, "left_anti").toLocalIterator():
            files.delete(spark, os.path.join(base, files.partition_path(spark, v=r["v"], dataSet=r["dataSet"], period=r["period"])))
        files.delete(spark, os.path.join(base, before["before"]))


def upsert_values(spark: SparkSession, incoming: DataFrame, root: str,
                  replaced: tuple[str, Sequence[str]] | None = None) -> None:
    """Stage and publish; if another run published in between, merge again with what it left."""
    for attempt in range(PUBLISH_ATTEMPTS):
        staged = stage_values(spark, incoming, root, replaced)
        if staged is None:
            return
        try:
            publish(spark, staged)
            return
        except files.Conflict:
            if attempt == PUBLISH_ATTEMPTS - 1:
                raise


def read_values(spark: SparkSession, root: str) -> DataFrame:
    """The published values, one per cell."""
    stored = _in_folders(spark, root, _manifest(spark, root)[1])
    return spark.createDataFrame([], schemas.DATA_VALUES) if stored is None else stored.select(*schemas.DATA_VALUES.names)
