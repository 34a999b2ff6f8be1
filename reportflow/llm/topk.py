"""Exact top-k search by inner product over a pivot-distance index.

Every component x becomes floor(64 x). One more component, sqrt(L - |v|^2) with L the largest squared length, makes all
vectors equally long, so that the largest inner product is the smallest distance: d(q, v)^2 = |q|^2 + L - 2 q.v, with
the query's own extra component 0.

Index: pivots are chosen from a bounded sample (``SAMPLE_ROWS``; a documented bound on the fit alone). Every vector is
keyed by its nearest pivot and its distance to it. The vectors of a pivot, sorted by distance, are cut into annuli of at
most ``ANNULUS_ROWS`` rows. Equal vectors are one class, with its k + 1 smallest vec_ids: no result can hold more of them, so
a vector that a third of all rows share is one row of the index, and one query.

Search: a query at distance D of a pivot is at least |D - r| from every vector at distance r of it. First each query
is scored in its own annulus and the neighbouring ones, which gives its k-th best score so far; then the search expands
to the annuli whose distances can still hold a better one around each pivot. The rest are stopped by the triangle
inequality, which loses nothing. Queries meet an annulus in blocks of at most ``QUERY_ROWS``, so no task and no group
grows with the table. The scores are integers; bounds are widened by a rounding margin.

Defined results: vectors that are null or hold null or non-finite components take no part; the table's length is the
most frequent one but 0 (of equally frequent ones the smallest), and vectors of another length take no part; squared
lengths of 2^62 or more, whose scores are no 64-bit integers, raise an error; ties go to the smaller vec_id; rows that repeat a vec_id count as one (the first by value); a null vec_id takes no
part; an empty table gives no rows. Only vec_id and embedding are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportflow.session import checkpoint_dir

TOP_K = 20
SCALE = 64
QUERY_EVERY = 20
SAMPLE_ROWS = 4096
PIVOTS = 64
ANNULUS_ROWS = 2048
QUERY_ROWS = 1024
NEAR_ANNULI = 1
#: The queries of one vector above this number are dealt over several parts.
QUERIES_PER_PART = 500
#: Up to this many such vectors are broadcast.
BROADCAST_CLASSES = 20_000
MARGIN = 1e-6
LOWEST = -(1 << 62)
#: Up to this many bounds of annuli are broadcast; more are joined by shuffle.
BROADCAST_ANNULI = 500_000


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the floored vector as packed 64-bit integers, of every row that takes part."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.alias("w"))

    def pack(batches):
        for batch in batches:
            lists = batch.column("w")
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = np.diff(lists.offsets.to_numpy())
            ends = np.cumsum(sizes)
            packed = [values[e - n:e].tobytes() for n, e in zip(sizes, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(packed, pa.binary())], ["vec_id", "v"])

    return rows.mapInArrow(pack, "vec_id long, v binary").groupBy("vec_id").agg(F.min("v").alias("v"))


def classes(rows: DataFrame, members: int) -> DataFrame:
    """vec_id (the smallest), ids (the ``members`` smallest) and v of every distinct vector.

    The rank is limited in every task before rows are shuffled, so a class of any size meets in one task with few of its rows.
    """
    least = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("n", F.row_number().over(least)).where(F.col("n") <= members)
    return few.groupBy("v").agg(F.min("vec_id").alias("vec_id"), F.sort_array(F.collect_list("vec_id")).alias("ids")).select("vec_id", "ids", "v")


def _integers(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dims)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return _integers(column, dims).astype(np.float64)


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """The vectors with the component that makes all of them equally long."""
    return np.hstack([x, np.sqrt(np.maximum(0.0, longest - (x * x).sum(1)))[:, None]])


def choose_pivots(sample: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Centres of the sample after a few rounds of assignment and averaging, from spread-out starts."""
    rng = np.random.default_rng(3)
    sample = np.unique(sample, axis=0)
    centers = sample[rng.permutation(len(sample))[:count]]
    for _ in range(8):
        near = _distances(sample, centers).argmin(1)
        centers = np.array([sample[near == k].mean(0) if (near == k).any() else centers[k] for k in range(len(centers))])
    return centers


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T))


class Index:
    """rows: vec_id, ids, annulus, v of every class; bounds: annulus, pivot, low, high; all: vec_id, v of every vector; and the pivots."""

    def __init__(self, vectors: DataFrame, k: int = TOP_K, pivots: int = PIVOTS, annulus_rows: int = ANNULUS_ROWS):
        checkpoint_dir(vectors.sparkSession)
        self.k = k
        rows = scaled(vectors).checkpoint()
        most = rows.groupBy(F.length("v").alias("n")).count().where("n > 0").orderBy(F.desc("count"), "n").first()
        self.dims = most[0] // 8 if most else 0
        self.empty = not self.dims
        if self.empty:
            return
        dims = self.dims
        self.all = rows.where(F.length("v") == dims * 8)
        rows = classes(self.all, k + 1).checkpoint()

        def lengths(batches):
            for batch in batches:
                x = _matrix(batch.column("v"), dims)
                yield pa.RecordBatch.from_arrays([pa.array([float((x * x).sum(1).max(initial=0.0))])], ["n"])

        self.longest = longest = rows.select("v").mapInArrow(lengths, "n double").agg(F.max("n")).first()[0]
        if longest >= 2.0**62:
            raise ValueError("vectors too long: their inner products are no 64-bit integers")
        draw = F.xxhash64("vec_id", F.lit(3))
        sample = rows.select("v").orderBy(draw, "vec_id").limit(SAMPLE_ROWS).collect()
        x = np.array([np.frombuffer(r[0], np.int64) for r in sample], float)
        self.pivots = centers = choose_pivots(_lifted(x, longest), pivots)

        def key(batches):
            for batch in batches:
                d = _distances(_lifted(_matrix(batch.column("v"), dims), longest), centers)
                near = d.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("ids"), batch.column("v"), pa.array(near, pa.int32()),
                     pa.array(d[np.arange(len(near)), near], pa.float64())], ["vec_id", "ids", "v", "pivot", "distance"])

        def cut(batches):
            """Annuli of a sorted part: a new one for a new pivot and after ``annulus_rows`` rows."""
            part, n, size, pivot = None, 0, 0, None
            for batch in batches:
                names = []
                part = batch.column("part")[0].as_py() if batch.num_rows and part is None else part
                for p in batch.column("pivot").to_pylist():
                    if p != pivot or size == annulus_rows:
                        n, size, pivot = n + 1, 0, p
                    size += 1
                    names.append((part << 32) + n)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "ids", "v", "pivot", "distance")), pa.array(names, pa.int64())],
                                                 ["vec_id", "ids", "v", "pivot", "distance", "annulus"])

        keyed = rows.mapInArrow(key, "vec_id long, ids array<long>, v binary, pivot int, distance double")
        placed = keyed.repartitionByRange("pivot", "distance", "vec_id").sortWithinPartitions("pivot", "distance", "vec_id")
        self.rows = (placed.withColumn("part", F.spark_partition_id().cast("long"))
                     .mapInArrow(cut, "vec_id long, ids array<long>, v binary, pivot int, distance double, annulus long").checkpoint())
        self.bounds = self.rows.groupBy("annulus").agg(
            F.first("pivot").alias("pivot"), F.min("distance").alias("low"), F.max("distance").alias("high")).checkpoint()

    def _scored(self, pairs: DataFrame) -> DataFrame:
        """query_id, vec_id, score of the k + 1 best of every (query class, annulus) pair that are better than the query's floor.

        pairs: query_id, qv, block, floor, floor_id, annulus; floor_id settles ties of score. Each (annulus, block) group holds one annulus and one query block.
        """
        dims, most = self.dims, self.k + 1
        # Sums of products stay under the largest squared length: floats hold them exactly up to 2^53, integers all of them.
        numbers = _matrix if self.longest < 2.0**53 else _integers
        blocks = pairs.select(F.col("annulus").alias("of"), F.col("block").alias("for")).distinct()
        vectors = self.rows.select("annulus", "vec_id", "ids", "v").join(
            blocks, F.col("annulus") == F.col("of")).select("of", "for", "vec_id", "ids", "v")

        def score(key, left, right):
            first = left.column("vec_id").combine_chunks().to_numpy()
            order = np.argsort(first)
            first = first[order]
            lists = left.column("ids").combine_chunks()
            members, starts = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            starts = starts - starts[0]
            x = numbers(left.column("v").combine_chunks(), dims)[order]
            out_q, out_v, out_s = [], [], []
            queries = right.column("query_id").combine_chunks().to_numpy()
            floors = right.column("floor").combine_chunks().to_numpy()
            floor_ids = right.column("floor_id").combine_chunks().to_numpy()
            q = numbers(right.column("qv").combine_chunks(), dims)
            for at in range(0, len(queries), 256):
                found = np.rint(q[at:at + 256] @ x.T).astype(np.int64)
                for query, low, low_id, scores in zip(queries[at:at + 256], floors[at:at + 256], floor_ids[at:at + 256], found, strict=True):
                    hit = np.flatnonzero((scores > low) | ((scores == low) & (first < low_id)))
                    if len(hit) > most:  # by score, then by smallest id: each class holds at least one of the best
                        hit = hit[np.lexsort((first[hit], -scores[hit]))[:most]]
                    ids = [members[starts[order[k]]:starts[order[k] + 1]] for k in hit]
                    own = np.repeat(scores[hit], [len(i) for i in ids])
                    ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
                    if len(ids) > most:
                        best = np.lexsort((ids, -own))[:most]
                        ids, own = ids[best], own[best]
                    out_q.append(np.full(len(ids), query))
                    out_v.append(ids)
                    out_s.append(own)
            return pa.table({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s)})

        return (vectors.groupBy("of", "for").cogroup(pairs.groupBy("annulus", "block"))
                .applyInArrow(score, "query_id long, vec_id long, score long"))

    def search(self, queries: DataFrame) -> DataFrame:
        """query_id, rank, vec_id and score of the k best other vectors of each query (rows vec_id, v of the index)."""
        k = self.k
        asked = queries.select(F.col("vec_id").alias("of_query"), F.col("v").alias("qv"))
        told = self.best(asked.select(F.col("qv").alias("v")).distinct())
        # A class's k + 1 best hold the k best others of each of its queries. The queries of one class are dealt over tasks.
        sizes = asked.groupBy("qv").count()
        parts = F.ceil(F.col("count") / QUERIES_PER_PART).cast("long")
        many = sizes.where(F.col("count") > QUERIES_PER_PART).select("qv", parts.alias("parts")).checkpoint()
        many = F.broadcast(many) if many.count() <= BROADCAST_CLASSES else many
        dealt = asked.join(many, "qv", "left").withColumn("part", F.pmod(F.xxhash64("of_query", F.lit(12)), F.coalesce("parts", F.lit(1).cast("long"))))
        spread = told.join(sizes, "qv").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("count")
        found = dealt.join(spread, ["qv", "part"]).where("of_query != vec_id")
        order = Window.partitionBy("of_query").orderBy(F.desc("score"), "vec_id")
        return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                .select(F.col("of_query").alias("query_id"), "rank", "vec_id", "score"))

    def best(self, vectors: DataFrame) -> DataFrame:
        """qv, vec_id and score of the k + 1 best vectors for each of the distinct ``vectors`` (v) of the index."""
        dims, longest, centers, k = self.dims, self.longest, self.pivots, self.k + 1
        queries = self.rows.join(vectors, "v", "left_semi").checkpoint()
        block = F.pmod(F.xxhash64("vec_id", F.lit(33)), F.lit(max(1, -(-queries.count() // QUERY_ROWS))))
        asked = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("qv"), block.alias("block"), "annulus")
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

        # The query's own annulus and its neighbours by distance give a first k-th best score.
        near = asked.select("query_id", "qv", "block", F.lit(LOWEST).alias("floor"), F.lit(0).cast("long").alias("floor_id"), F.explode(F.array(
            *[F.col("annulus") + step for step in range(-NEAR_ANNULI, NEAR_ANNULI + 1)])).alias("annulus"))
        seeds = self._scored(near).checkpoint()
        floors = (seeds.withColumn("n", F.row_number().over(best)).where(F.col("n") == k)
                  .select("query_id", F.col("score").alias("floor"), F.col("vec_id").alias("floor_id")))

        def spread(batches):
            """The distances of each query to the pivots, which are few and fixed."""
            for batch in batches:
                q = _matrix(batch.column("qv"), dims)
                d = _distances(np.hstack([q, np.zeros((len(q), 1))]), centers)
                n, m = d.shape
                # A vector that scores at least the floor is no farther from the query than this.
                floor = batch.column("floor").to_numpy(zero_copy_only=False)
                reach = np.sqrt(np.maximum(0.0, (q * q).sum(1) + longest - 2.0 * floor)) * (1 + MARGIN) + MARGIN * (1 + np.sqrt(longest))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch.column("query_id").to_numpy(), m)), pa.array(np.tile(np.arange(m), n), pa.int32()),
                     pa.array((d - reach[:, None]).ravel()), pa.array((d + reach[:, None]).ravel())],
                    ["query_id", "pivot", "from", "to"])

        known = asked.join(floors, "query_id", "left").withColumns(
            {"floor": F.coalesce("floor", F.lit(LOWEST)), "floor_id": F.coalesce("floor_id", F.lit(0).cast("long"))})
        rings = known.select("query_id", "qv", "floor").mapInArrow(spread, "query_id long, pivot int, from double, to double")
        bounds = F.broadcast(self.bounds) if self.bounds.count() <= BROADCAST_ANNULI else self.bounds
        # Annuli that the ring around each pivot touches; all others are ruled out by the triangle inequality.
        rest = (rings.join(bounds, "pivot").where((F.col("high") >= F.col("from")) & (F.col("low") <= F.col("to")))
                .select("query_id", "annulus")
                .join(near.select("query_id", "annulus"), ["query_id", "annulus"], "left_anti")
                .join(known.select("query_id", "qv", "block", "floor", "floor_id"), "query_id").checkpoint())
        found = seeds.unionByName(self._scored(rest)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return found.join(asked.select("query_id", "qv"), "query_id").select("qv", "vec_id", "score")


def nearest(vectors: DataFrame, k: int = TOP_K, every: int = QUERY_EVERY) -> DataFrame:
    """The k best other vectors of each vector whose vec_id is divisible by ``every``, exactly."""
    index = Index(vectors, k)
    if index.empty:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return index.search(index.all.where(F.col("vec_id") % every == 0))
