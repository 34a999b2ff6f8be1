"""Maximal periodic runs of words by a dictionary of basic factors.

1. The words of a slice of texts get exact numbers (Arrow's dictionary encoding), apart for each text.
2. Dictionary of basic factors: for every power of two L, equal factors of L words of one text get one name, made from the
   names of their two halves. Factors that occur once in their text get none; they equal nothing.
3. For each L, the successor of a factor is its next occurrence. Successors at a distance d <= 2L that go on by the same
   distance (i, i + d, i + 2d) are an arithmetic progression and propose the period d; of neighbouring places with one
   proposal the first is kept. A run of period q and length >= 4q holds such a progression for the L in [q, 2q).
4. Each proposal is extended to both sides, with the names as jumps of L words, longest first. Stretches that are too
   short go, and of several periods of one stretch the smallest stays (by Fine and Wilf it divides the others).

A run is a stretch of consecutive words with smallest period q and length >= max(min_length, min_exponent * q) that no neighbouring
word extends keeping the period. ``collapsed`` is the text without the words that any run holds after its first q.

Everything is one pass over the rows, without a shuffle. Working memory is that of a slice of about 1 MB of text, or of one
longer text: words times the number of levels up to the longest repeat, 4 bytes each.

Words are maximal runs of characters other than space and 0x09-0x0D, compared exactly (case counts). Defined results: null and empty
texts and texts without words have no run and an empty ``collapsed``; repeated rows give repeated rows; an empty table
gives no rows. Only doc_id and text are read, so further columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportflow.llm.common import as_strings, bytes_and_offsets, small_batches, word_bounds

MIN_LENGTH = 6
MIN_EXPONENT = 4
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
RUN = "struct<start:long,length:long,period:long>"


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One number for each distinct word, exact."""
    lengths = ends - starts
    compact = data[np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())]
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(compact)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


class Factors:
    """Names of the factors of 1, 2, 4, ... words; -1 where a factor ends outside its text or occurs in it once."""

    def __init__(self, numbers: np.ndarray, bounds: np.ndarray, longest: int):
        """``bounds``: where each text's words begin (length n + 1); ``longest``: the longest factor worth naming."""
        n = len(numbers)
        self.names: list[np.ndarray] = []
        self.successors: list[np.ndarray] = []
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        places = np.arange(n)
        keys = text * (int(numbers.max(initial=0)) + 1) + numbers
        size = 1
        while True:
            order = np.argsort(keys, kind="stable")
            at, sorted_keys = places[order], keys[order]
            same = np.concatenate((sorted_keys[1:] == sorted_keys[:-1], [False])) if len(at) else np.zeros(0, bool)
            repeated = same | np.concatenate(([False], same[:-1])) if len(at) else same
            names = np.full(n + 1, -1, np.int32)
            names[at[repeated]] = np.cumsum(~np.concatenate(([False], same[:-1])))[repeated] if len(at) else 0
            following = np.full(n + 1, n, np.int64)
            following[at[:-1][same[:-1]]] = at[1:][same[:-1]]
            if not repeated.any():
                break
            self.names.append(names)
            self.successors.append(following)
            if size >= longest:
                break
            # A factor of twice the length repeats only if both its halves do.
            places = np.flatnonzero(names[:n] >= 0)
            places = places[places + size < n]
            places = places[names[places + size] >= 0]
            places = places[text[places] == text[places + size]]
            keys = names[places].astype(np.int64) * (n + 1) + names[places + size]
            size *= 2

    def proposals(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances of the arithmetic progressions of successors."""
        found = []
        for level, following in enumerate(self.successors):
            size = 1 << level
            distance = following - np.arange(len(following))
            distance[following == len(following) - 1] = 0
            ok = (2 * distance > size) & (distance <= 2 * size)
            ok[ok] = distance[following[ok]] == distance[ok]
            ok[1:] &= ~(ok[:-1] & (distance[1:] == distance[:-1]))
            at = np.flatnonzero(ok)
            found.append((at, distance[at]))
        return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))

    def extended(self, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many words before and from each place equal the ones a period later."""
        before, after = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            names, size = self.names[level], 1 << level
            top = level == len(self.names) - 1
            for forward in (True, False):
                open_ = np.arange(len(at))
                while len(open_):
                    left = at[open_] + after[open_] if forward else at[open_] - before[open_] - size
                    inside = left >= 0
                    own = names[np.maximum(left, 0)]
                    equal = inside & (own >= 0) & (own == names[np.minimum(np.maximum(left, 0) + period[open_], len(names) - 1)])
                    open_ = open_[equal]
                    (after if forward else before)[open_] += size
                    if not top:
                        break
        return before, after


def find_runs(numbers: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start, then period; starts count over all texts."""
    longest = max(1, int(np.diff(bounds).max(initial=0)) // min_exponent)
    factors = Factors(numbers, bounds, longest)
    if not factors.names:
        return np.zeros((0, 3), np.int64)
    at, period = factors.proposals()
    before, after = factors.extended(at, period)
    runs = np.stack([at - before, before + after + period, period], axis=1)
    runs = runs[runs[:, 1] >= np.maximum(min_length, min_exponent * period)]
    # Of the periods of one stretch the smallest.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def greatest(runs: np.ndarray) -> np.ndarray:
    """Index of the run with the greatest length / period, compared exactly; ties by start, then period."""
    best = 0
    ratio = runs[:, 1] / runs[:, 2]
    for k in np.flatnonzero(ratio >= ratio.max() * (1 - 1e-9)):   # rounding can't move a ratio further than that
        if int(runs[k, 1]) * int(runs[best, 2]) > int(runs[best, 1]) * int(runs[k, 2]) or ratio[best] < ratio.max() * (1 - 1e-9):
            best = int(k)
    return runs[best]


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    at = np.flatnonzero(kept)
    text_of = np.searchsorted(bounds, at, side="right") - 1
    last = np.ones(len(at), bool)
    last[:-1] = text_of[1:] != text_of[:-1]
    lengths = ends[at] - starts[at]
    taken = lengths + ~last
    to = np.cumsum(taken)
    padded = np.append(data, np.uint8(0x20))
    out = padded[np.repeat(starts[at] - (to - taken), taken) + np.arange(taken.sum())]
    out[(to - 1)[~last]] = 0x20
    sizes = np.zeros(len(bounds) - 1, np.int64)
    np.add.at(sizes, text_of, taken)
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.string())


def _slice(batch: pa.RecordBatch, min_length: int, min_exponent: int) -> pa.RecordBatch:
    data, offsets = bytes_and_offsets(as_strings(batch.column("text")))
    starts, ends, bounds = word_bounds(data, offsets)
    n_texts = batch.num_rows
    runs = np.zeros((0, 3), np.int64)
    if len(starts):
        runs = find_runs(word_numbers(data, starts, ends), bounds, min_length, min_exponent)
    text_of = np.searchsorted(bounds, runs[:, 0], side="right") - 1
    dropped = np.zeros(len(starts) + 1, np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(dropped)[:-1] == 0
    own = runs.copy()
    own[:, 0] -= bounds[text_of]
    cuts = np.searchsorted(text_of, np.arange(n_texts + 1))
    fields = ("start", "length", "period")
    structs = pa.StructArray.from_arrays([pa.array(own[:, k]) for k in range(3)], fields)
    listed = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), structs)
    top = [dict(zip(fields, map(int, greatest(own[a:b])), strict=True)) if b > a else None for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(np.diff(bounds)), listed, pa.array(top, structs.type),
         joined(data, starts, ends, bounds, kept) if len(starts) else pa.array([""] * n_texts, pa.string())],
        ["doc_id", "n_words", "runs", "top", "collapsed"])


def runs_of(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (by start, then period), top (greatest exponent; null without runs) and collapsed text of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            yield _slice(batch, min_length, min_exponent)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, f"doc_id long, n_words long, runs array<{RUN}>, top {RUN}, collapsed string")


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, where crc32 of the decimal doc_id ends in 0 with the words from one place on repeated by a period.

    With g = crc32 div 10 and n words, the words from a = g mod n on repeat their first p = 1 + (n - a) div (3 + g mod 8).
    """
    doc_id = F.col("doc_id").cast("long")
    crc = F.crc32(doc_id.cast("string"))
    g = F.floor(crc / 10)
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD_PATTERN), F.lit(0))
    n = F.size(words)
    a = F.pmod(g, n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    edited = F.array_join(F.concat(F.slice(words, F.lit(1), a), repeated), " ")
    return docs.select(doc_id.alias("doc_id"), F.when((F.pmod(crc, F.lit(10)) == 0) & F.col("text").rlike(WORD_PATTERN), edited)
                       .otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The runs as counts, the greatest run and digests of all runs and of the collapsed text."""

    def decimal(run: Column, field: str) -> Column:
        return run[field].cast("string")

    lines = F.transform("runs", lambda r: F.concat(decimal(r, "start"), F.lit(","), decimal(r, "length"), F.lit(","), decimal(r, "period"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), F.col("top.length").alias("length"),
        F.col("top.period").alias("period"), F.expr("(1000 * top.length) div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
