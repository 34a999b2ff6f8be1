"""Near-duplicate classes by one-permutation MinHash with optimal densification, bands and star-shaped candidates.

1. Each text becomes its set of distinct word shingles (64-bit hashes). Texts with equal sets are one class at once,
   so a group of copies, whatever its size, goes on as one row.
2. One permutation: the hash range is cut into ``bands * rows`` equal bins and each bin keeps its smallest hash. An empty
   bin copies a non-empty one that a fixed random sequence for that bin points to first (optimal densification), which
   keeps bins of a pair equal with the probability of its resemblance, for short texts too.
3. Each band of ``rows`` bins gives a bucket key. A bucket of m classes gives m - 1 candidate edges, a star around one
   class, never m^2 pairs. Each candidate that the sizes allow is confirmed on the full sets.
4. Connected components of the confirmed links by alternating large and small stars. Buckets that still hold classes of
   several components get stars around ``STARS`` other centres, until a round adds no link.
5. What is left is settled exactly: all pairs of classes of different components that share a bucket are compared. Buckets
   with the same largest component are settled together, so a class that meets a family in many buckets is loaded and compared
   once; blocks hold about ``BLOCK_SHINGLES`` shingles a side. Pairs inside a component need no look, so this costs the classes
   outside a family times those around it, and the stars only make that small. The result does not depend on them.

No bucket has a cap. A pair at the threshold 0.8 shares no bucket with a probability of (1 - 0.8^5)^36, under 1e-6.

doc_id identifies a document. Defined results: null text, empty text and text without words have the empty set, size 0, and link with nothing; fewer
words than a shingle form one shingle; repeated rows fall in one class; a null doc_id takes part in no link and is kept;
an empty table gives no rows. Only doc_id and text are read, so further columns can't clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.llm.common import as_strings, binary_column, mix64, shingle_sets, small_batches, unused
from reportflow.session import checkpoint_dir

SHINGLE_WORDS = 5
THRESHOLD_PCT = 80
BANDS = 36
ROWS = 5
MEMBERS_PER_CHUNK = 256
STARS = 3
BLOCK_SHINGLES = 1 << 18
#: Tables of ids and links, eight bytes a value, are broadcast up to this size; larger ones are joined by shuffle.
BROADCAST_BYTES = 32 << 20
#: Copies of one set above this number are dealt over several tasks where rows meet their class.
COPIES_PER_TASK = 1000
PROBES = 64
ROWS_PER_TASK = 250_000
SETS_PER_TASK = 2000


class Signature:
    """Maps a sorted set of 64-bit hashes to band keys."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        self.edges = np.array([(k << 64) // self.bins for k in range(self.bins)], np.uint64)
        rng = np.random.default_rng(7)
        self.probes = rng.integers(0, self.bins, (PROBES, self.bins))
        self.factors = mix64(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
        self.band_salt = mix64(np.arange(1001, 1001 + bands, dtype=np.uint64))

    def band_keys(self, found: np.ndarray) -> np.ndarray:
        at = np.append(np.searchsorted(found, self.edges), len(found))
        full = at[1:] > at[:-1]
        least = found[np.minimum(at[:-1], len(found) - 1)]
        empty = np.flatnonzero(~full)
        for probe in self.probes:
            if not len(empty):
                break
            source = probe[empty]
            ok = full[source]
            least[empty[ok]] = least[source[ok]]
            empty = empty[~ok]
        if len(empty):  # hardly any bin is full: the next full bin, counted around
            filled = np.flatnonzero(full)
            least[empty] = least[filled[np.searchsorted(filled, empty) % len(filled)]]
        grouped = least.reshape(self.bands, self.rows) * self.factors
        return mix64(grouped.sum(axis=1, dtype=np.uint64) ^ self.band_salt).view(np.int64)


def signatures(docs: DataFrame, shingle_words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, set_key (equal for equal sets) and the band keys of every row."""

    def run(batches):
        signature = Signature(bands, rows)
        none = np.zeros(0, np.int64)
        for batch in small_batches(batches):
            sizes, keys, found = [], [], []
            for s in shingle_sets(as_strings(batch.column("text")), shingle_words):
                sizes.append(len(s))
                keys.append(s.sum(dtype=np.uint64).tobytes() + np.bitwise_xor.reduce(mix64(s), initial=0).astype(np.uint64).tobytes() + len(s).to_bytes(4, "big"))
                found.append(signature.band_keys(s) if len(s) else none)
            lengths = np.cumsum([0, *map(len, found)], dtype=np.int32)
            flat = np.concatenate(found) if found else none
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), binary_column(keys),
                 pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat, pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def _sized(df: DataFrame, rows_per_task: int) -> tuple[DataFrame, int]:
    """The table, written to the checkpoint folder, in the partitions that its rows need, and its number of rows.

    The rounds below work on small leftovers of a large table: many nearly empty tasks would cost more than the work.
    """
    kept = df.checkpoint()
    n = kept.count()
    return kept.coalesce(max(1, -(-n // rows_per_task))), n


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if 8 * n * len(df.columns) <= BROADCAST_BYTES else df


def full_sets(docs: DataFrame, wanted: DataFrame, shingle_words: int) -> DataFrame:
    """doc_id and the whole shingle set (sorted 64-bit hashes) of the documents whose doc_id is in ``wanted``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted, n = _sized(wanted, ROWS_PER_TASK)

    def run(batches):
        for batch in small_batches(batches):
            sets = [s.tobytes() for s in shingle_sets(as_strings(batch.column("text")), shingle_words)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), binary_column(sets)], ["doc_id", "words"])

    return texts.join(_small(wanted, n), "doc_id", "left_semi").mapInArrow(run, "doc_id long, words binary")


def met_pairs(own: DataFrame, centers: DataFrame, threshold_pct: int) -> DataFrame:
    """The pairs (center, member) of each class and the centres of its buckets that lie in other components and whose sizes allow
    a link (own: key, rep, n, component; centers: key, centers).

    Members of a family share many buckets and meet the same centres there, so a class gathers its centres, at most those of
    its bands, before its pairs are made.
    """

    def allowed(c: F.Column) -> F.Column:
        return (F.col("component") != c["component"]) & (100 * F.least(F.col("n"), c["n"]) >= threshold_pct * F.greatest(F.col("n"), c["n"]))

    met = (own.join(centers, "key").select("rep", F.transform(F.filter("centers", allowed), lambda c: c["rep"]).alias("met"))
           .where(F.size("met") > 0).groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("met"))).alias("met")))
    return (met.select("rep", F.explode("met").alias("other"))
            .select(F.least("rep", "other").alias("center"), F.greatest("rep", "other").alias("member")).distinct())


def confirmed(candidates: DataFrame, n: int, sets: DataFrame, threshold_pct: int) -> DataFrame:
    """The ``n`` candidate edges (center, member) whose full shingle sets reach the threshold.

    Members of a centre are dealt out in chunks, so a centre with very many members is spread; each chunk gets the
    centre's set once, and a task holds one centre's set at a time.
    """
    members = candidates.groupBy("center").agg(F.ceil(F.count("*") / MEMBERS_PER_CHUNK).cast("long").alias("chunks"))
    loads = (candidates.join(_small(members, n), "center")
             .select("center", F.pmod(F.xxhash64("member"), "chunks").alias("chunk"), F.col("member").alias("doc_id"), F.lit(1).alias("role"))
             .unionByName(members.select("center", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
                                         F.col("center").alias("doc_id"), F.lit(0).alias("role"))))
    rows = (sets.join(_small(loads, n), "doc_id")
            .repartition(F.col("center"), F.col("chunk"))
            .sortWithinPartitions("center", "chunk", "role", "doc_id"))

    def run(batches):
        center, known = None, None
        for batch in small_batches(batches, "words"):
            out: list[tuple[int, int]] = []
            columns = [batch.column(c).to_pylist() for c in ("center", "doc_id", "role", "words")]
            for own, doc, role, words in zip(*columns, strict=True):
                s = np.frombuffer(words, np.uint64)
                if role == 0:
                    center, known = own, s
                elif own == center:
                    both = len(np.intersect1d(s, known, assume_unique=True))
                    if 100 * both >= threshold_pct * (len(s) + len(known) - both):
                        out.append((own, doc))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return rows.select("center", "doc_id", "role", "words").mapInArrow(run, "a long, b long")


class Block:
    """Sets held together, so that the overlaps of another set with all of them are counted at once."""

    def __init__(self, held: list[tuple[int, int, np.ndarray]]):
        self.reps, self.components = (np.array([h[k] for h in held], np.int64) for k in (0, 1))
        self.sizes = np.array([len(s) for *_, s in held])
        hashes = np.concatenate([s for *_, s in held])
        order = np.argsort(hashes)
        self.hashes, self.owner = hashes[order], np.repeat(np.arange(len(held)), self.sizes)[order]

    def links(self, rep: int, component: int, s: np.ndarray, threshold_pct: int) -> list[tuple[int, int]]:
        """The set's links to the held ones of other components, one a component."""
        at = np.searchsorted(self.hashes, s)
        n = np.searchsorted(self.hashes, s, side="right") - at
        ends = np.cumsum(n)
        both = np.bincount(self.owner[np.repeat(at - ends + n, n) + np.arange(ends[-1])], minlength=len(self.sizes))
        hit = np.flatnonzero((100 * both >= threshold_pct * (len(s) + self.sizes - both)) & (self.components != component))
        return [(rep, int(self.reps[hit[k]])) for k in np.unique(self.components[hit], return_index=True)[1]]


def settled(own: DataFrame, sets: DataFrame, threshold_pct: int) -> DataFrame:
    """Links (a, b) between the components of a bucket, all its pairs compared on full sets (own: key, rep, n, component).

    Home: the largest component of a bucket. The classes of all buckets of one home outside of it are dealt to the first
    ``outer`` cells, those inside to ``inner`` further ones. A block is an outer cell with itself or a later cell: it holds the
    first and streams the second.
    """
    homes = (own.groupBy("key", "component").agg(F.sum("n").alias("n")).groupBy("key")
             .agg(F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("parts"))
             .where("parts > 1").select("key", F.col("top.component").alias("home")))
    members = own.join(homes, "key").select("home", "rep", "n", "component").distinct().checkpoint()
    outside = F.col("component") != F.col("home")
    cells = members.groupBy("home").agg(
        F.ceil(F.sum(F.when(outside, F.col("n")).otherwise(0)) / BLOCK_SHINGLES).cast("long").alias("outer"),
        F.ceil(F.sum(F.when(outside, 0).otherwise(F.col("n"))) / BLOCK_SHINGLES).cast("long").alias("inner"))
    zero, draw = F.lit(0).cast("long"), F.xxhash64("rep", F.lit(5))
    placed = members.join(cells, "home").select(
        "home", F.col("rep").alias("doc_id"), "component",
        F.when(outside, F.pmod(draw, "outer")).otherwise(F.col("outer") + F.pmod(draw, "inner")).alias("cell"),
        F.explode(F.sequence(zero, F.col("outer") - 1 + F.when(outside, F.col("inner")).otherwise(zero))).alias("other"))
    loads, n = _sized(placed.select("home", F.least("cell", "other").alias("first"), F.greatest("cell", "other").alias("second"),
                                    "cell", "doc_id", "component"), ROWS_PER_TASK)
    rows = (sets.join(_small(loads, n), "doc_id")
            .repartition("home", "first", "second").sortWithinPartitions("home", "first", "second", "cell", "doc_id"))

    def run(batches):
        name, held, block = None, [], None

        def inside() -> list[tuple[int, int]]:
            """The links inside a block of one cell, when all of it is there."""
            if name is None or name[1] != name[2] or len(held) < 2:
                return []
            own_block = Block(held)
            return [link for h in held for link in own_block.links(*h, threshold_pct)]

        def table(out):
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in small_batches(batches, "words"):
            out: list[tuple[int, int]] = []
            columns = [batch.column(c).to_pylist() for c in ("home", "first", "second", "cell", "doc_id", "component", "words")]
            for home, first, second, cell, doc, component, words in zip(*columns, strict=True):
                if (home, first, second) != name:
                    out += inside()
                    name, held, block = (home, first, second), [], None
                one = doc, component, np.frombuffer(words, np.uint64)
                if cell == first:
                    held.append(one)
                elif held:
                    block = block or Block(held)
                    out += block.links(*one, threshold_pct)
            yield table(out)
        yield table(inside())

    return rows.select("home", "first", "second", "cell", "doc_id", "component", "words").mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame, n: int) -> DataFrame:
    """node, component (its smallest node) of every node of the ``n`` undirected edges (a, b), by alternating stars."""
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(max(1, -(-2 * n // ROWS_PER_TASK)))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(_small(least, n), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        now, n = _sized(large.join(_small(least, n), "u")
                        .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                  F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                        .select("e.*").where("u != v").distinct(), ROWS_PER_TASK)
        state = n, now.agg(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()[0]
        if state == before:
            break
        before = state
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, threshold_pct: int = THRESHOLD_PCT,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id) and kept (the class's first document) of every row."""
    checkpoint_dir(docs.sparkSession)
    signed = signatures(docs, shingle_words, bands, rows).checkpoint()
    classes = (signed.where("n_shingles > 0 and doc_id is not null").groupBy("set_key")
               .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.count("*").alias("copies")))
    buckets = classes.select("rep", "n", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("m"), F.min("rep").alias("low")).where("m > 1")
    # Only buckets of several classes go on: one row for each class and bucket.
    buckets, _ = _sized(buckets.join(shared.select("key", "low"), "key").select(
        "key", "rep", "n", (F.col("rep") == F.col("low")).alias("first")), ROWS_PER_TASK)
    # The sets of the documents in them are made once, not in every round.
    sets, _ = _sized(full_sets(docs, buckets.select(F.col("rep").alias("doc_id")).distinct(), shingle_words), SETS_PER_TASK)

    tested, n_tested, found, n_found = None, 0, None, 0
    round_no = 0

    def with_components() -> DataFrame:
        if found is None:
            return buckets.withColumn("component", F.col("rep"))
        return buckets.join(_small(found.withColumnRenamed("node", "rep"), n_found), "rep", "left").withColumn(
            "component", F.coalesce("component", "rep"))

    def linked_by(links: DataFrame, n_links: int) -> tuple[DataFrame, int]:
        # What is known of the components goes on as their stars.
        known = links if found is None else links.unionByName(found.select(F.col("component").alias("a"), F.col("node").alias("b")))
        return _sized(components(known, n_links + n_found), ROWS_PER_TASK)

    while True:
        own = with_components()
        # First a star around the smallest class, then some around drawn ones: m - 1 edges each.
        draws = [F.xxhash64("rep", F.lit(round_no * STARS + k)) for k in range(STARS)] if round_no else [F.col("rep")]
        stars = [F.struct(f"c{k}.rep", f"c{k}.n", f"c{k}.component") for k in range(len(draws))]
        centers = (own.groupBy("key")
                   .agg(*[F.min(F.struct(d.alias("draw"), "rep", "n", "component")).alias(f"c{k}") for k, d in enumerate(draws)],
                        F.min("component").alias("low"), F.max("component").alias("high"))
                   .where("low < high").select("key", F.array_distinct(F.array(*stars)).alias("centers")))
        candidates = met_pairs(own, centers, threshold_pct)
        if tested is not None:
            candidates = candidates.join(_small(tested, n_tested), ["center", "member"], "left_anti")
        candidates, n = _sized(candidates, ROWS_PER_TASK)
        fresh, n_fresh = _sized(confirmed(candidates, n, sets, threshold_pct), ROWS_PER_TASK)
        if not n_fresh:
            break
        tested, n_tested = (candidates if tested is None else tested.unionByName(candidates)), n_tested + n
        found, n_found = linked_by(fresh, n_fresh)
        round_no += 1
    # The first star has compared each bucket's smallest class with all others; all other pairs are settled here.
    left, n_left = _sized(settled(with_components().where(~F.col("first")), sets, threshold_pct), ROWS_PER_TASK)
    if n_left:
        found, n_found = linked_by(left, n_left)

    reps = classes.select("set_key", "rep", "copies")
    if found is not None:
        reps = reps.join(_small(found.withColumnRenamed("node", "rep"), n_found), "rep", "left").select(
            "set_key", "copies", F.coalesce("component", "rep").alias("class_id"))
    else:
        reps = reps.withColumnRenamed("rep", "class_id")
    rows = signed.select("doc_id", "n_shingles", "set_key")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()   # of no class
    # The rows of a class with many copies are dealt over several tasks, and its row goes to each of them.
    parts = F.ceil(F.col("copies") / COPIES_PER_TASK).cast("long")
    many, n_many = _sized(reps.where(F.col("copies") > COPIES_PER_TASK).select("set_key", parts.alias("parts")), ROWS_PER_TASK)
    dealt = rows.where(~alone).join(_small(many, n_many), "set_key", "left").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.coalesce("parts", F.lit(1).cast("long"))))
    spread = reps.select("set_key", "class_id", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    told = dealt.join(spread, ["set_key", "part"]).select(
        "doc_id", "n_shingles", F.col("class_id").alias("component_id"), (F.col("class_id") == F.col("doc_id")).alias("kept"))
    return told.unionByName(rows.where(alone).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")))


def deduplicated(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, threshold_pct: int = THRESHOLD_PCT) -> DataFrame:
    """The rows and columns of ``docs`` with one document of each near-duplicate class: the smallest doc_id.

    Rows that repeat a kept doc_id leave one; rows with a null doc_id all stay.
    """
    found = near_duplicates(docs, shingle_words, threshold_pct).where("doc_id is not null").checkpoint()
    dropped = found.where(~F.col("kept")).select("doc_id").distinct().checkpoint()
    repeated = found.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id").checkpoint()

    name = unused(docs, "own_id")

    def side(ids: DataFrame) -> DataFrame:
        return _small(ids.withColumnRenamed("doc_id", name), ids.count())

    own = docs["doc_id"].cast("long") == F.col(name)
    if repeated.isEmpty():
        return docs.join(side(dropped), own, "left_anti")
    once = docs.join(side(repeated), own, "left_semi").dropDuplicates(["doc_id"])
    return docs.join(side(dropped.unionByName(repeated)), own, "left_anti").unionByName(once)
