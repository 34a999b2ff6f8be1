"""Document fingerprints: bottom-k sketches of shingle hashes.

A fingerprint holds the ``K`` smallest distinct 64-bit hashes of a text's shingles (five words; shorter texts are one
shingle), written as hexadecimal digits in ascending order. Two sketches merge by taking the ``K`` smallest of both, so
sketches of parts give the sketch of the whole. From sketches alone follow the resemblance of two texts, the containment
of one in the other and the number of distinct shingles; with fewer than ``K`` shingles all three are exact.

Defined results: null and empty texts have the empty fingerprint, like each other (likeness 1) and unlike any other
text (0); equal texts have equal fingerprints; rows with equal doc_id follow each other by their text's hash, a null
doc_id comes last; one row is its own next document; an empty table gives no rows. Only doc_id and text are read (and
the grouping column of ``merged``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.llm.common import as_strings, shingle_sets
from reportflow.session import checkpoint_dir

K = 128
SHINGLE_WORDS = 5
ROWS_PER_PART = 4000
GROUPS_IN_TASK = 2000
_RANGE = float(1 << 64)


def sketches(strings: pa.Array, k: int = K, shingle_words: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The ``k`` smallest distinct shingle hashes of each text, ascending."""
    for s in shingle_sets(strings, shingle_words):
        yield s[:k].copy()


def as_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def distinct_shingles(sketch: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below ``k``."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) / (float(sketch[-1]) / _RANGE)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard likeness: the share of the merged sketch that both sketches hold."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = merge(a, b, k)
    return float(np.isin(both, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum()) / len(both)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b holds."""
    if not len(a):
        return 1.0
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k) if len(b) else 0.0
    return min(1.0, shared / distinct_shingles(a, k))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and the estimated number of distinct shingles of every row."""

    def run(batches):
        for batch in batches:
            found = list(sketches(as_strings(batch.column("text"))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(as_text, found), pa.string()),
                 pa.array([distinct_shingles(s) for s in found], pa.float64())], ["doc_id", "fingerprint", "n_distinct"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string, n_distinct double")


def merged(docs: DataFrame, by: str) -> DataFrame:
    """One sketch for each value of ``by``: every task merges its rows first, then the tasks' sketches meet by value."""

    def combine(rows: Iterator[tuple[str | None, np.ndarray]], sorted_rows: bool):
        held: dict[str | None, np.ndarray] = {}
        for group, sketch in rows:
            if group not in held and len(held) >= (1 if sorted_rows else GROUPS_IN_TASK):
                yield held
                held = {}
            held[group] = merge(held[group], sketch) if group in held else sketch
        yield held

    def batch_of(held):
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(map(as_text, held.values()), pa.string())], ["by", "fingerprint"])

    def first(batches):
        rows = (x for b in batches for x in zip(b.column("by").to_pylist(), sketches(as_strings(b.column("text"))), strict=True))
        yield from map(batch_of, combine(rows, False))

    def second(batches):
        rows = ((g, from_text(s)) for b in batches for g, s in zip(b.column("by").to_pylist(), b.column("fingerprint").to_pylist(), strict=True))
        yield from map(batch_of, combine(rows, True))

    parts = docs.select(F.col(by).cast("string").alias("by"), "text").mapInArrow(first, "by string, fingerprint string")
    whole = parts.repartition("by").sortWithinPartitions("by").mapInArrow(second, "by string, fingerprint string")
    return whole.withColumnRenamed("by", by)


def _with_next(docs: DataFrame, rows_per_part: int) -> DataFrame:
    """Rows dealt to parts by ranges of doc_id and sorted in them; each part ends with the first rows of the next one.

    Only doc_id is read to find the ranges. Columns: part, tail, doc_id, text.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    n = ids.count()
    parts = max(1, -(-n // rows_per_part))
    cuts = ids.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)] or [0.5], 10 * parts + 1000)).first()[0] or []
    cuts = sorted(set(cuts)) if parts > 1 else []
    bounds = np.array(cuts, np.int64)

    def part_of(values: np.ndarray, valid: np.ndarray) -> np.ndarray:
        return np.where(valid, np.searchsorted(bounds, values, side="right"), len(bounds) + 1)

    def read(batch, name):
        column = batch.column(name)
        return column.fill_null(0).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)

    def parts_only(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(part_of(*read(batch, "doc_id")), pa.int64()), batch.column("doc_id")], ["part", "doc_id"])

    # The first doc_id of each part: as many rows as there are parts.
    firsts = sorted((r[0], r[1]) for r in ids.mapInArrow(parts_only, "part long, doc_id long")
                    .groupBy("part").agg(F.min("doc_id").alias("first")).collect())
    before = {part: firsts[k - 1][0] for k, (part, _) in enumerate(firsts)}
    first_of = dict(firsts)

    def deal(batches):
        for batch in batches:
            values, valid = read(batch, "doc_id")
            own = part_of(values, valid)
            lead = [k for k in range(len(own))
                    if (first_of[int(own[k])] == int(values[k]) if valid[k] else first_of[int(own[k])] is None)]
            take = np.concatenate([np.arange(len(own)), np.array(lead, np.int64)])
            part = np.concatenate([own, np.array([before[int(own[k])] for k in lead], np.int64)])
            tail = np.concatenate([np.zeros(len(own), np.int32), np.ones(len(lead), np.int32)])
            rows = batch.take(pa.array(take))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(tail, pa.int32()), rows.column("doc_id"), rows.column("text")],
                                             ["part", "tail", "doc_id", "text"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return (source.mapInArrow(deal, "part long, tail int, doc_id long, text string")
            .repartition(max(1, len(firsts)), "part")
            .sortWithinPartitions("part", "tail", F.col("doc_id").asc_nulls_last(), F.xxhash64("text")))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the first as many code points of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compared(docs: DataFrame, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness to each other and to the next document's."""
    checkpoint_dir(docs.sparkSession)

    def run(batches):
        held = None  # part, doc_id, text and sketch of the row that waits for its next one
        for batch in batches:
            strings = as_strings(batch.column("text"))
            texts = strings.to_pylist()
            own = list(sketches(strings))
            ready = []
            for part, tail, doc, text, sketch in zip(batch.column("part").to_pylist(), batch.column("tail").to_pylist(),
                                                     batch.column("doc_id").to_pylist(), texts, own, strict=True):
                if held is not None and held[0] == part:
                    ready.append((*held[1:], text, sketch))
                held = None if tail else (part, doc, text, sketch)
            changed = [edited(text, after) for _, text, _, after, _ in ready]
            new = list(sketches(pa.array(changed, pa.large_string())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in ready], pa.int64()), pa.array([len(r[1]) for r in ready], pa.int64()),
                 pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                 pa.array([as_text(r[2]) for r in ready], pa.string()), pa.array(map(as_text, new), pa.string()),
                 pa.array([resemblance(r[2], s) for r, s in zip(ready, new, strict=True)], pa.float64()),
                 pa.array([resemblance(r[2], r[4]) for r in ready], pa.float64())],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return _with_next(docs, rows_per_part).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
