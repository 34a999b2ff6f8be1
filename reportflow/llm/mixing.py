"""Mixing sources to target weights by pivotal dependent rounding.

Targets: the sources, by code point with null last, weigh 5, 2, 1, repeating; they share 150 % of all words; a target
stops at twice its source's size and the excess is shared again by weight. This is min(2 size, level * weight) for one
water level, found by a few aggregations over the table of sources.

Rounding: a document of a source with r = target / size is taken floor(r) times, and once more with the fractional
probability p. Two fractional documents at a time exchange words, up for one and down for the other in the random
direction that keeps each probability's mean, until one of them is integral; the other goes on. So the words taken of a
source differ from its target by less than one document. First every bucket of a source's documents is paired off in
one pass that holds a single open document, then the open documents of ``FAN_IN`` buckets at a time, up a reduction
tree, until one is left of each source, which is drawn. All draws are hashes of the documents' keys, so reruns and other
partitionings agree.

Defined results: a null or empty text has size 0 and nothing is taken; null is a source; rows that repeat doc_id, source
and text are numbered and rounded one by one, like different ones; an empty table gives no rows. Only doc_id, text and source are
read; ``mixed`` keeps all columns as they are.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportflow.llm.merkle import ranked
from reportflow.session import checkpoint_dir

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MAX_COPIES = 2
BUCKET_UNITS = 4096
FAN_IN = 64
#: A table of sources up to this many rows is broadcast; a larger one is joined by shuffle.
BROADCAST_SOURCES = 100_000

#: Likewise the table of keys that several rows have.
BROADCAST_KEYS = 200_000

_WORD = r"[^\x20\x09-\x0D]+"
_KEY = ("doc_id", "source", "key")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.xxhash64(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text").alias("key"),
        F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("size"))


def _repeated(rows: DataFrame) -> DataFrame | None:
    """The keys that several rows have; None without any."""
    repeated = rows.groupBy("key").count().where("count > 1").select("key").checkpoint()
    n = repeated.count()
    return (F.broadcast(repeated) if n <= BROADCAST_KEYS else repeated) if n else None


def _numbered(rows: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """The rows with a key of their own each: of rows with one key, all but the first get new ones by their number.

    Which of several equal rows has which number makes no difference. They are numbered over a range sort, so a row repeated any
    number of times is spread.
    """
    if repeated is None:
        return rows
    numbered, _ = ranked(rows.join(repeated, "key", "left_semi").withColumn("grp", F.col("key")), ["doc_id"])
    own = F.when(F.col("rank") == 0, F.col("key")).otherwise(F.xxhash64("key", "rank"))
    return rows.join(repeated, "key", "left_anti").unionByName(numbered.withColumn("key", own).select(*rows.columns))


def _joined(left: DataFrame, right: DataFrame, names: tuple[str, ...], how: str = "inner") -> DataFrame:
    """Equi-join on ``names`` where null equals null; the right copies of the names go."""
    renamed = right.select(*[F.col(c).alias(f"__{c}") if c in names else F.col(c) for c in right.columns])
    on = [left[c].eqNullSafe(renamed[f"__{c}"]) for c in names]
    return left.join(renamed, on, how).drop(*[f"__{c}" for c in names])


def targets(rows: DataFrame) -> DataFrame:
    """source, source_size, units and target of every source of (source, size) rows."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("units"))
    # The running number of each source: its place in a range-sorted part, after the sources of the parts before.
    parts = (sums.repartitionByRange(F.col("source").isNull(), F.col("source"))
             .withColumn("part", F.spark_partition_id()).checkpoint())
    place = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    before, offsets = 0, []
    for part, n in sorted((r[0], r[1]) for r in parts.groupBy("part").count().collect()):
        offsets.append(F.when(F.col("part") == part, F.lit(before)))
        before += n
    if not offsets:
        return sums.withColumn("target", F.lit(0.0))
    number = F.row_number().over(place) - 1 + F.coalesce(*offsets)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (number % len(WEIGHTS) + 1).cast("int"))
    parts = parts.withColumn("weight", weight.cast("long")).checkpoint()
    total = parts.agg(F.sum("source_size")).first()[0] or 0
    limit = F.col("source_size") * F.lit(float(MAX_COPIES))
    level = 0.0
    while True:
        full = limit <= F.lit(level) * F.col("weight")
        capped, weights = parts.agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))).first()
        new = (TOTAL_SHARE * total - (capped or 0.0)) / weights if weights else level
        if new <= level:
            break
        level = new
    return parts.select("source", "source_size", "units", F.least(limit, F.lit(level) * F.col("weight")).alias("target"))


def _draw(*keys: int) -> float:
    """A number in [0, 1) that the keys settle."""
    x = 0x9E3779B97F4A7C15
    for k in keys:
        x = (x ^ (k & 0xFFFFFFFFFFFFFFFF)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
        x = (x ^ (x >> 29)) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
        x ^= x >> 32
    return (x >> 11) / (1 << 53)


def exchange(a: float, p: float, b: float, q: float, u: float) -> tuple[float, float]:
    """Move words between two documents of sizes a and b until one probability is 0 or 1; u settles the direction."""
    up, down = min(a * (1 - p), b * q), min(a * p, b * (1 - q))
    if u * (up + down) < down:
        p, q = (1.0 if a * (1 - p) <= b * q else p + up / a), (0.0 if b * q <= a * (1 - p) else q - up / b)
    else:
        p, q = (0.0 if a * p <= b * (1 - q) else p - down / a), (1.0 if b * (1 - q) <= a * p else q + down / b)
    return _snap(p), _snap(q)


def _snap(p: float) -> float:
    return 0.0 if p < 1e-12 else 1.0 if p > 1 - 1e-12 else p


_UNIT = "doc_id long, source string, key long, unit_size long, p double, bucket long, last boolean"


def _pair_off(rows: DataFrame) -> DataFrame:
    """Pair off the open units (0 < p < 1) of every (source, bucket); at most one of each stays open.

    A sorted stream with one open unit in memory: a bucket of any size takes constant memory. Large units go first, so
    that the one left open is mostly small, and with it the distance to the target.
    """
    names = ["doc_id", "source", "key", "unit_size", "p", "bucket", "last"]

    def run(batches):
        at, open_row = None, None
        for batch in batches:
            out = []
            for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                row = list(row)
                group = (row[1], row[5])
                if group != at:
                    if open_row is not None:
                        out.append(open_row)
                    at, open_row = group, None
                if not 0.0 < row[4] < 1.0:
                    out.append(row)
                elif open_row is None:
                    open_row = row
                else:
                    u = _draw(open_row[2], row[2])
                    open_row[4], row[4] = exchange(open_row[3], open_row[4], row[3], row[4], u)
                    if 0.0 < open_row[4] < 1.0:
                        out.append(row)
                    else:
                        out.append(open_row)
                        open_row = row
                        if not 0.0 < row[4] < 1.0:
                            out.append(row)
                            open_row = None
            yield _batch(out)
        if open_row is not None:
            yield _batch([open_row])

    def _batch(out):
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names)

    return (rows.select(*names).repartition("source", "bucket")
            .sortWithinPartitions("source", "bucket", F.desc("unit_size"), "key", "doc_id").mapInArrow(run, _UNIT))


def copies(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id, source, key and copies of every one of (doc_id, source, key, size) rows with different keys, and the table of sources."""
    checkpoint_dir(rows.sparkSession)
    by_source = targets(rows).checkpoint()
    few = by_source.count() <= BROADCAST_SOURCES
    units = rows.withColumnRenamed("size", "unit_size")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + 1e-12)
    p = F.when((F.col("unit_size") > 0) & (ratio - whole > 1e-12), ratio - whole).otherwise(F.lit(0.0))
    buckets = F.ceil(F.col("units") / BUCKET_UNITS).cast("long")
    dealt = _joined(units, F.broadcast(by_source) if few else by_source, ("source",)).select(
        *_KEY, "unit_size", p.alias("p"), F.pmod(F.xxhash64("key", F.lit(7)), buckets).alias("bucket"),
        F.lit(False).alias("last"))
    most = (by_source.agg(F.max("units")).first()[0] or 1) // BUCKET_UNITS + 1
    level = _pair_off(dealt).checkpoint()
    still_open = (F.col("p") > 0) & (F.col("p") < 1)
    settled = level.where(~still_open)
    while most > 1:
        most = -(-most // FAN_IN)
        level = _pair_off(level.where(still_open).withColumn("bucket", F.floor(F.col("bucket") / FAN_IN))).checkpoint()
        settled = settled.unionByName(level.where(~still_open))
    # One open unit of each source is left at most: its probability is drawn.
    draw = F.pmod(F.xxhash64("key", F.lit(77)), F.lit(1 << 30)) / float(1 << 30)
    last = level.where(still_open).withColumn("p", F.when(draw < F.col("p"), F.lit(1.0)).otherwise(F.lit(0.0)))
    extra = settled.unionByName(last).select(*_KEY, F.round("p").cast("long").alias("extra"))
    done = _joined(extra, F.broadcast(by_source) if few else by_source, ("source",)).select(
        *_KEY, (whole.cast("long") + F.col("extra")).alias("copies"))
    return done, by_source


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken words of every row."""
    checkpoint_dir(docs.sparkSession)
    rows = _rows(docs).checkpoint()
    rows = _numbered(rows, _repeated(rows))
    done, by_source = copies(rows)
    few = by_source.count() <= BROADCAST_SOURCES
    told = _joined(_joined(rows, done, _KEY), F.broadcast(by_source) if few else by_source, ("source",))
    return told.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                       "source", "copies")


def mixed(docs: DataFrame) -> DataFrame:
    """The rows themselves, each repeated as often as the mix takes it, with all columns of the input."""
    checkpoint_dir(docs.sparkSession)
    rows = _rows(docs).checkpoint()
    repeated = _repeated(rows)
    done, _ = copies(_numbered(rows, repeated))
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text")
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("source").cast("string").alias("source"), key.alias("key"))
    told = _joined(_numbered(whole, repeated), done.where("copies > 0"), _KEY)
    return told.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
