"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model file is compiled to three machines: the normaliser (spaces to the space mark, a mark put first where the model
asks for it), the piece transducer (one arc for each piece, from the place where it starts to where it ends) and byte
fallback (a path of byte pieces for every character that no piece covers). A text is composed with them and the path of
least weight in the tropical semiring gives its pieces:

* unigram models: an arc weighs minus its piece's score, an uncovered character the least score minus 10;
* BPE models: an arc weighs 0 where the two pieces it joins are what merging their joint text gives, and is absent
  (weight infinity) elsewhere. Merging is settled by neighbouring pieces alone, so exactly one path has finite weight, and
  it is the merge order's result. Every place keeps one state: the last piece of its prefix's only path.

A place between characters that lie in no piece together cuts every path, so the shortest path is the joined path of the
parts, and parts (mostly words) are kept in a bounded store of each worker.

Only the identity normaliser is compiled (the given model's); a model with another rule table is refused.

Defined results: null text gives null ids, empty text none; decode gives null for null. Texts of any length are taken
whole, in time linear in their length. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterable
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.llm.common import small_batches

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
STORE_PARTS = 100_000
STORE_CHARS = 64
STORE_JOINS = 300_000
_INFINITE = float("inf")


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (b[i] & 127) << shift
        i += 1
        if b[i - 1] < 128:
            return value, i
        shift += 7


def _fields(b: bytes):
    """Field number and value of a protocol buffer message."""
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        if key & 7 == 0:
            value, i = _varint(b, i)
        else:
            n, i = {1: (8, i), 5: (4, i)}[key & 7] if key & 7 != 2 else _varint(b, i)
            value, i = b[i:i + n], i + n
        yield key >> 3, value


class Model:
    """Pieces, kinds and settings of a model file."""

    def __init__(self, content: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.type, self.prefix, self.tidy, self.escape, rule = UNIGRAM, True, True, True, b""
        for number, value in _fields(content):
            if number == 1:
                f = dict(_fields(value))
                self.pieces.append(f[1].decode())
                self.scores.append(struct.unpack("<f", f[2])[0] if 2 in f else 0.0)
                self.kinds.append(f.get(3, NORMAL))
            elif number == 2:
                self.type = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                f = dict(_fields(value))
                rule = f.get(2, b"")
                self.prefix, self.tidy, self.escape = bool(f.get(3, 1)), bool(f.get(4, 1)), bool(f.get(5, 1))
        if rule or self.tidy or not self.escape:
            raise ValueError("only the identity normaliser with escaped spaces is compiled")
        if self.type not in (UNIGRAM, BPE):
            raise ValueError("the model must be unigram or BPE")


class Transducer:
    """The compiled machines of a model, and the shortest path through them."""

    def __init__(self, content: bytes):
        m = self.model = Model(content)
        self.ids = {p: k for k, p in enumerate(m.pieces) if m.kinds[k] in (NORMAL, USER)}
        self.byte_ids = {int(p[3:5], 16): k for k, p in enumerate(m.pieces) if m.kinds[k] == BYTE}
        self.unknown = m.kinds.index(UNKNOWN)
        self.unknown_weight = 10.0 - min((m.scores[k] for k in self.ids.values()), default=0.0)
        # Where no piece holds a character next to another, every path has a place between them.
        inner = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        after_mark = any(a != MARK and b == MARK for a, b in inner)
        alone = "".join(c for c in "\n\t\r" if c not in self.ids and not any(c in pair for pair in inner))
        single = f"[{alone}]|" if alone else ""
        self.parts = re.compile(".+" if after_mark else f"{single}{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+", re.S)
        self.store: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._joins: dict[int, bool] = {}
        self.bpe = m.type == BPE
        self.sizes = [len(p) for p in m.pieces]
        self.arcs = ahocorasick.Automaton()
        for piece, k in self.ids.items():
            self.arcs.add_word(piece, k)
        self.arcs.make_automaton()
        self.text_of = []
        for k, p in enumerate(m.pieces):
            self.text_of.append(b"" if m.kinds[k] == CONTROL else bytes([int(p[3:5], 16)]) if m.kinds[k] == BYTE
                                else " ⁇ ".encode() if m.kinds[k] == UNKNOWN else p.replace(MARK, " ").encode())

    def normalise(self, text: str) -> str:
        """The normaliser's output; the marks stand for spaces."""
        return (MARK if self.model.prefix and text else "") + text.replace(" ", MARK)

    def merged(self, text: str) -> list[str]:
        """Merge order by definition: the best-scored neighbouring pair first, the leftmost of equals."""
        parts = list(text)
        scores, ids = self.model.scores, self.ids
        while True:
            best, at = -_INFINITE, -1
            for k in range(len(parts) - 1):
                piece = ids.get(parts[k] + parts[k + 1])
                if piece is not None and scores[piece] > best:
                    best, at = scores[piece], k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def joins(self, left: int, right: int) -> bool:
        """Whether the arc of piece ``right`` may follow that of ``left`` (0: the start, or an uncovered character)."""
        if len(self._joins) > STORE_JOINS:
            self._joins.clear()
        a, b = self.model.pieces[left] if left else "", self.model.pieces[right]
        known = self._joins[left << 20 | right] = self.merged(a + b) == ([a, b] if left else [b])
        return known

    def path(self, part: str) -> list[int]:
        """Output labels on the path of least weight from the part's start to its end, with byte fallback.

        The arcs come from the piece transducer by the place where they end.
        """
        n, sizes, joins = len(part), self.sizes, self._joins
        last, weight = [-1] * (n + 1), [_INFINITE] * (n + 1)
        last[0], weight[0], done = 0, 0.0, 0
        for at, piece in self.arcs.iter(part):
            while done < at:  # an uncovered character is an arc of its own, spelled in bytes
                done += 1
                if last[done] < 0:
                    last[done], weight[done] = 0, weight[done - 1] + self.unknown_weight
            end = at + 1
            start = end - sizes[piece]
            if self.bpe:
                if last[end] < 0 <= last[start]:
                    known = joins.get(last[start] << 20 | piece)
                    if known is None:
                        known = self.joins(last[start], piece)
                    if known:
                        last[end] = piece
            else:
                arc = weight[start] - self.model.scores[piece]
                if start + 1 < end and part[end - 1] not in self.ids and weight[end] == _INFINITE:
                    last[end], weight[end] = 0, weight[end - 1] + self.unknown_weight
                if arc < weight[end]:
                    last[end], weight[end] = piece, arc
        while done < n:
            done += 1
            if last[done] < 0:
                last[done], weight[done] = 0, weight[done - 1] + self.unknown_weight
        out: list[int] = []
        at = n
        while at:
            piece = last[at]
            if piece:
                out.append(piece)
                at -= sizes[piece]
            else:
                at -= 1
                out += [self.byte_ids[b] for b in reversed(part[at].encode())] if self.byte_ids else [self.unknown]
        return out[::-1]

    def packed(self, part: str) -> bytes:
        """The part's ids as 32-bit integers. Short parts are kept: the newer and the older half of the store, and what
        is used again moves to the newer one."""
        found = self.store.get(part) or self.older.get(part) or array("i", self.path(part)).tobytes()
        if len(part) <= STORE_CHARS:
            if len(self.store) >= STORE_PARTS:
                self.older, self.store = self.store, {}
            self.store[part] = found
        return found

    def encode_packed(self, text: str) -> bytes:
        get = self.store.get
        packed = self.packed
        return b"".join([get(p) or packed(p) for p in self.parts.findall(self.normalise(text))])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), np.int32).tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """Inverse transduction: the pieces' text, bytes joined to characters, the leading mark dropped."""
        table = self.text_of
        out = b"".join([table[k] for k in ids])
        if self.model.prefix and out[:1] == b" ":
            out = out[1:]
        return out.decode("utf-8", "replace")


@lru_cache(maxsize=4)
def transducer(content: bytes) -> Transducer:
    return Transducer(content)


def _content(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _id_lists(texts: list[str | None], packed: list[bytes]) -> pa.Array:
    """Lists of ids; null where the text is null."""
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
    missing = np.array([*(t is None for t in texts), False])
    return pa.ListArray.from_arrays(pa.array(offsets, mask=missing if missing.any() else None),
                                    pa.array(np.frombuffer(b"".join(packed), np.int32), pa.int32()))


def encode(docs: DataFrame, model_path: str = DEFAULT_MODEL, column: str = "text", into: str = "ids") -> DataFrame:
    """All columns and the ids of the text column. The model file (under 1 MB) is read by the driver and sent along."""
    content = _content(model_path)
    names = [c for c in docs.columns if c != into]

    def run(batches):
        machine = transducer(content)
        for batch in small_batches(batches, column):
            texts = batch.column(column).to_pylist()
            packed = [b"" if t is None else machine.encode_packed(t) for t in texts]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), _id_lists(texts, packed)], [*names, into])

    rows = docs.select(*names)
    return rows.mapInArrow(run, rows.withColumn(into, F.lit(None).cast("array<int>")).schema)


def decode(rows: DataFrame, model_path: str = DEFAULT_MODEL, column: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns and the text that the id column stands for."""
    content = _content(model_path)
    names = [c for c in rows.columns if c != into]

    def run(batches):
        machine = transducer(content)
        for batch in batches:
            ids = batch.column(column)
            texts = pa.array([None if not ids[k].is_valid else machine.decode(ids[k].values.to_numpy(zero_copy_only=False).tolist())
                              for k in range(len(ids))], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), texts], [*names, into])

    kept = rows.select(*names)
    return kept.mapInArrow(run, kept.withColumn(into, F.lit(None).cast("string")).schema)


def tokenised(docs: DataFrame, model_path: str = DEFAULT_MODEL, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``keep``, n_pieces, ids and round_trip: whether decoding gives the normalised text back.

    Encoding and decoding run in one pass over the rows, so the ids don't leave the task in between.
    """
    content = _content(model_path)
    names = ["doc_id", *keep]
    rows = docs.select(*names, "text")

    def run(batches):
        machine = transducer(content)
        for batch in small_batches(batches):
            texts = batch.column("text").to_pylist()
            packed = [b"" if t is None else machine.encode_packed(t) for t in texts]
            same = [None if t is None else machine.decode(array("i", p)) == t.replace(MARK, " ")
                    for t, p in zip(texts, packed, strict=True)]
            sizes = np.array([len(p) // 4 for p in packed], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sizes), _id_lists(texts, packed), pa.array(same, pa.bool_())],
                [*names, "n_pieces", "ids", "round_trip"])

    schema = (rows.drop("text").withColumn("n_pieces", F.lit(None).cast("long"))
              .withColumn("ids", F.lit(None).cast("array<int>")).withColumn("round_trip", F.lit(None).cast("boolean")).schema)
    return rows.mapInArrow(run, schema)
