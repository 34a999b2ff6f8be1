"""Merkle manifest of a dataset: a content-addressed store of digests and their children, and proofs by descent from the root.

H is the lowercase hex SHA-256 of its inputs, concatenated; digests go in as hex text. A row's leaf is H of doc_id, source, lang,
n_chars and text, each ``-`` if null, else its UTF-8 byte count, ``:`` and the value. Leaves of a lang ascend by doc_id; every two
consecutive nodes (the last alone if there is no second) become their H until one is left, the lang's subroot. The subroots, null first,
then by UTF-8 bytes, become the root in the same way.

1. Ranks: leaves are sorted by range over (lang, doc_id, leaf); a row's rank is its place in its part plus what earlier
   parts hold of its lang, so a lang that holds most rows is spread like any other.
2. Store: ``DIGIT`` levels at a time, 2^DIGIT consecutive nodes of a lang are folded to one. A record is that digest and the levels
   below it (its children and theirs), keyed by the digest alone; equal subtrees are one record. The subroots form one more such tree.
3. Proofs: requests descend from the root by the digits of their rank, most significant first. All requests that still share a prefix go on
   as one row: it finds its record by digest, and goes on as one row for each child that requests ask for, carrying the siblings
   that the digit leaves out. At the leaves, the segments of the path are reversed: siblings from leaf to root.

A round handles ``DIGIT`` levels, so the number of rounds is the logarithm of the largest lang to base 256. What is shuffled is the leaves and the
store, about 500 bytes a row in all and no texts. Only counts go to the driver.

Defined results: null doc_ids come first in their lang; rows of one doc_id go by leaf, and equal rows are leaves of their own
with equal digests; a lang with one row has that leaf as its subroot, and a single lang's subroot is the root (its proof
is H of nothing); an empty table gives no rows. Columns other than the five are not read, so they can't clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportflow.session import checkpoint_dir

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a record: 2^8 children.
DIGIT = 8
#: Tables of parts and groups of up to this many rows (under 100 bytes each) are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 100_000
#: Rows of one task: nodes and requests of about 200 bytes, and records, which hold up to 2^DIGIT nodes and those above them.
NODES_PER_TASK = 20_000
RECORDS_PER_TASK = 64
STEP = "struct<left:boolean,digest:string>"


def row_digest(values: dict[str, Column]) -> Column:
    """H of the fields in their order."""
    def framed(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[framed(values[f]) for f in FIELDS]).cast("binary"), 256)


def group_key(lang: Column) -> Column:
    """The lang as text that is never null and sorts null first."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def _sized(df: DataFrame, rows_per_task: int) -> tuple[DataFrame, int]:
    """The table, written to the checkpoint folder, in the partitions that its rows need, and its number of rows.

    The upper rounds work on ever smaller tables: many nearly empty tasks would cost more than the work.
    """
    kept = df.checkpoint()
    n = kept.count()
    return kept.coalesce(max(1, -(-n // rows_per_task))), n


def ranked(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with their rank (from 0) in their ``grp`` by ``order``, and the size of that group as ``n``; and the largest such size."""
    rows, count = _sized(rows.withColumn("tie", F.monotonically_increasing_id()), NODES_PER_TASK)
    by = ["grp", *order, "tie"]   # equal rows are spread, too
    if count > NODES_PER_TASK:
        rows = rows.repartitionByRange(*by)
    dealt = rows.sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)).checkpoint()
    parts, _ = _sized(dealt.groupBy("grp", "part").agg(F.min("at").alias("low"), F.count("*").alias("held")), NODES_PER_TASK)
    earlier = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts, n = _sized(parts.select("grp", "part", "low", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"),
                                   F.sum("held").over(Window.partitionBy("grp")).alias("n")), NODES_PER_TASK)
    largest = parts.agg(F.max("n")).first()[0] or 0
    return (dealt.join(_small(parts, n), ["grp", "part"])
            .withColumn("rank", F.col("before") + F.col("at") - F.col("low")).drop("part", "low", "before", "at", "tie")), largest


def _folded(nodes: Column, levels: Column) -> Column:
    """The nodes and the ``levels`` levels above them, as an array of arrays."""
    def above(x: Column) -> Column:
        pairs = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / 2).cast("int"))
        return F.transform(pairs, lambda i: F.sha2(F.concat(F.get(x, 2 * i), F.coalesce(F.get(x, 2 * i + 1), F.lit(""))).cast("binary"), 256))

    steps = F.slice(F.array(*[F.lit(k) for k in range(1, DIGIT + 1)]), F.lit(1), levels)
    return F.aggregate(steps, F.array(nodes), lambda done, _: F.concat(done, F.array(above(F.element_at(done, -1)))))


@dataclass(frozen=True)
class Tree:
    """The records of all groups by round of ``DIGIT`` levels from the leaves up, and the groups' roots (grp, n, digest)."""

    rounds: tuple[DataFrame, ...]
    roots: DataFrame


def build(nodes: DataFrame, largest: int) -> Tree:
    """The trees of all groups of nodes (grp, rank, n, digest); ``largest``: the size of the largest group."""
    now = nodes.select("grp", F.col("rank").alias("at"), F.col("n").alias("m"), "n", "digest")
    rounds, roots = [], now.where("m = 1").select("grp", "n", "digest")
    while largest > 1:
        # The last round of a group has just the levels that its nodes need.
        levels = F.when(F.col("m") > 1 << DIGIT, F.lit(DIGIT)).otherwise(F.ceil(F.log2("m"))).cast("int")
        blocks = (now.where("m > 1").groupBy("grp", F.shiftright("at", DIGIT).alias("up"))
                  .agg(F.first("n").alias("n"), F.first("m").alias("m"), F.sort_array(F.collect_list(F.struct("at", "digest"))).alias("x"))
                  .select("grp", "up", "n", "m", _folded(F.col("x.digest"), levels).alias("below")))
        blocks, _ = _sized(blocks.withColumn("digest", F.element_at(F.element_at("below", -1), 1)), RECORDS_PER_TASK)
        # Content-addressed: equal subtrees are stored once.
        rounds.append(blocks.select("digest", "below").dropDuplicates(["digest"]))
        now = blocks.select("grp", F.col("up").alias("at"), F.ceil(F.col("m") / (1 << DIGIT)).cast("long").alias("m"), "n", "digest")
        roots = roots.unionByName(now.where("m = 1").select("grp", "n", "digest"))
        largest = -(-largest // (1 << DIGIT))
    return Tree(tuple(rounds), _sized(roots, NODES_PER_TASK)[0])


def _segment(below: Column, digit: Column) -> Column:
    """The siblings that a child's digit leaves out, from the child up; an empty digest where it has none."""
    levels = F.slice(F.array(*[F.lit(k) for k in range(DIGIT)]), F.lit(1), F.size(below) - 1)

    def step(k: Column) -> Column:
        own = F.call_function("shiftright", digit, k)
        beside = own.bitwiseXOR(F.lit(1))
        return F.struct((own % 2 == 1).alias("left"), F.coalesce(F.get(F.get(below, k), beside), F.lit("")).alias("digest"))

    return F.transform(levels, step)


def descend(tree: Tree, start: DataFrame, requests: DataFrame) -> DataFrame:
    """The requests (grp, rank and further columns) with their ``path``: segments of siblings from the tree's roots down.

    ``start``: grp, path; the segments above each group's root (an empty array at the top).
    """
    roots, _ = _sized(tree.roots.join(start, "grp"), NODES_PER_TASK)
    prefix = lambda k: F.call_function("shiftright", F.col("rank"), F.lit(min(DIGIT * k, 63)))
    top = len(tree.rounds)
    height = F.lit(0)   # rounds of a group: those that leave it more than one node
    for k in range(top):
        height = height + (F.col("n") > F.lit(1 << min(DIGIT * k, 62))).cast("int")
    roots = roots.withColumn("height", height)
    now = None
    for k in range(top, 0, -1):
        starting = roots.where(F.col("height") == k).select("grp", F.lit(0).cast("long").alias("at"), "digest", "path")
        now = starting if now is None else now.unionByName(starting)
        found = now.join(tree.rounds[k - 1], "digest").select("grp", "at", "path", "below")
        # Requests with the same prefix go on together.
        if k > 1:
            asked = requests.select("grp", prefix(k - 1).alias("child")).distinct()
        else:
            asked = requests.withColumn("child", F.col("rank"))
        asked = asked.groupBy("grp", F.call_function("shiftright", F.col("child"), F.lit(DIGIT)).alias("at")).agg(
            F.collect_list(F.struct(*[c for c in asked.columns if c != "grp"])).alias("asked"))
        found = found.join(asked, ["grp", "at"]).select("grp", "path", "below", F.explode("asked").alias("a"))
        digit = F.pmod(F.col("a.child"), F.lit(1 << DIGIT)).cast("int")
        path = F.concat("path", F.array(_segment(F.col("below"), digit))).alias("path")
        if k > 1:
            now, _ = _sized(found.select("grp", F.col("a.child").alias("at"), F.get(F.element_at("below", 1), digit).alias("digest"), path), NODES_PER_TASK)
        else:
            now = found.select("grp", "a.*", path).drop("child")
    alone = requests.join(roots.where("height = 0").select("grp", "path"), "grp")
    return alone if now is None else now.unionByName(alone)


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, leaf, lambda done, s: F.sha2(F.when(s["left"], F.concat(s["digest"], done))
                                                           .otherwise(F.concat(done, s["digest"])).cast("binary"), 256))


@dataclass(frozen=True)
class Manifest:
    """Leaves (grp, rank, n, digest and further columns), the trees of all groups, and the tree of their subroots."""

    leaves: DataFrame
    trees: Tree
    top: Tree
    subroots: DataFrame   # grp, subroot, rank, n


def manifest(leaves: DataFrame) -> Manifest:
    """The manifest of leaves (grp, doc_id, digest and further columns)."""
    checkpoint_dir(leaves.sparkSession)
    leaves, largest = ranked(leaves, ["doc_id", "digest"])
    trees = build(leaves, largest)
    subroots, n_groups = ranked(trees.roots.select(F.lit("").alias("grp"), F.col("grp").alias("own"), "digest"), ["own"])
    return Manifest(leaves, trees, build(subroots, n_groups), subroots)


def proofs(found: Manifest, requests: DataFrame) -> DataFrame:
    """The requested leaves (rows of ``found.leaves``) with subroot, root and ``steps``: their siblings from leaf to root."""
    nothing = F.array().cast(f"array<array<{STEP}>>")
    top = descend(found.top, found.top.roots.select("grp", nothing.alias("path")), found.subroots.select("grp", "rank", "own", "digest"))
    start, n = _sized(top.select(F.col("own").alias("grp"), "path", F.col("digest").alias("subroot")), NODES_PER_TASK)
    root = found.top.roots.select("digest").first()   # one row, none for an empty table
    paths = descend(found.trees, start.select("grp", "path"), requests.drop("n"))
    return (paths.join(_small(start.select("grp", "subroot"), n), "grp").withColumn("root", F.lit(root[0] if root else None).cast("string"))
            .withColumn("steps", F.flatten(F.reverse("path"))).drop("path"))


def audit(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and the root that the row gives after tampering, see ``tampered``.

    Where 7 divides crc32 of the decimal doc_id, n_chars is one more when the row is read again (null stays null).
    """
    given = {f: F.col(f) for f in FIELDS}
    doc_id = F.col("doc_id").cast("string")
    again = F.when(F.crc32(doc_id) % 7 == 0, row_digest({**given, "n_chars": F.col("n_chars") + 1}))
    leaves = docs.select(*FIELDS).select(group_key(F.col("lang")).alias("grp"), F.col("doc_id").cast("long").alias("doc_id"),
                                         row_digest(given).alias("digest"), again.alias("tampered"))
    found = manifest(leaves)
    proved = proofs(found, found.leaves)
    out = proved.withColumn("folded_root", folded(F.coalesce("tampered", "digest"), F.col("steps")))
    return out.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root",
                      F.sha2(F.array_join(F.col("steps.digest"), "").cast("binary"), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
