"""Shared vector helpers for whole texts held in Arrow batches.

A batch is cut into slices of a few MB so that the working arrays stay small whatever the batch size; no text is
ever cut. Words are maximal runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 1 << 20
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package when the driver was started in another folder.

    On a cluster the package is installed or sent along (``--py-files``); a path that is not there is passed over.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def as_strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one string array; null becomes the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    return pc.fill_null(column, "")


def bytes_and_offsets(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offset of each text in them (length n + 1)."""
    n = len(strings)
    if n == 0 or strings.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + n + 1]
    data = np.frombuffer(strings.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text gets a range of its own."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def small_batches(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``limit`` bytes of a text or binary column, so that what is made of them stays small, too."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in slices(np.concatenate(([0], np.cumsum(sizes))), limit):
            yield batch.slice(a, b - a)


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the range of its words (length n + 1)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each lower-cased word, eight bytes at a time, mixed after each step: no pattern of bytes cancels out."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.concatenate((_LOWER[data], np.zeros(8, np.uint8)))
    eight = np.ndarray(len(data) + 1, "<u8", buffer=padded, strides=(1,))
    lengths = ends - starts
    found = mix64(lengths.astype(np.uint64) * _STEP)
    at, left, own = starts, lengths, np.arange(len(starts))
    while len(own):
        bits = np.minimum(left, 8).astype(np.uint64) * np.uint64(8)
        part = eight[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - bits))
        found[own] = mix64((found[own] ^ part) + _STEP)
        more = left > 8
        at, left, own = at[more] + 8, left[more] - 8, own[more]
    return found


def shingle_sets(strings: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles of ``size`` words.

    A text with fewer words gives its whole word sequence as one shingle; a text without words gives none.
    """
    data, offsets = bytes_and_offsets(strings)
    factors = mix64(np.arange(101, 101 + size, dtype=np.uint64)) | np.uint64(1)
    for at, to in slices(offsets):
        own = offsets[at:to + 1] - offsets[at]
        part = data[offsets[at]:offsets[to]]
        starts, ends, words = word_bounds(part, own)
        hashes = word_hashes(part, starts, ends)
        if len(hashes) >= size:
            n = len(hashes) - size + 1
            rolled = hashes[:n] * factors[0]
            for j in range(1, size):
                rolled += hashes[j:j + n] * factors[j]
            rolled = mix64(rolled)
        else:
            rolled = np.zeros(0, np.uint64)
        for k in range(to - at):
            a, b = int(words[k]), int(words[k + 1])
            if b - a >= size:
                found = np.sort(rolled[a:b - size + 1])
                if len(found) > 1:
                    found = found[np.concatenate(([True], found[1:] != found[:-1]))]
                yield found
            elif b > a:
                short = np.uint64(b - a)
                yield mix64((hashes[a:b] * factors[:b - a]).sum(dtype=np.uint64, keepdims=True) + short)
            else:
                yield np.zeros(0, np.uint64)


def binary_column(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())
