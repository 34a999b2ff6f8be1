"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns give the base spans (email, ip, card, phone). The field looks at every mention of a text: words around an
``@`` or a written-out ``[at]``, and digit groups of 7 to 19 digits (longer groups are cut at spaces). Its labels are
the four kinds and "other". Potentials: the mention's shape (log-linear), neighbouring mentions (chain), and equal
normalised mentions anywhere in the text (all mentions of a key meet in one node of that key, so edges stay linear and
no mention is more than two steps from another). Mentions that the patterns found are observed: what they say of their
key reaches every other mention of it directly, however many there are, and unobserved ones cannot outvote it. Loopy
sum-product messages run along the other edges until they change no more. So a phone number that is later written
without its country sign is found by its earlier form, each time. Base spans always stay; the field adds mentions
whose kind has a belief over one half and that touch no base span.

The weights tell matches from the same mentions without their telling mark, so a shape alone seldom counts. They are
fitted on all mentions of all rows, labelled by the patterns, and drawn back to a prior of "other". The fit needs only how
often each set of features has each label, and each pair of labels an edge: Spark counts these, and there are few of them.

Defined results: null and empty texts have no spans; repeated rows each get a result; an empty table gives no rows.
Only doc_id and text are read; ``mask`` keeps all columns as they are but text and n_chars.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.llm.common import small_batches

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
#: Messages are settled when none changes by more; loops that swing on end after so many rounds.
SETTLED = 1e-3
MOST_ROUNDS = 200
NEAR_CHARS = 80
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_GROUP = re.compile(r"\+?\(?[0-9](?:[\x20().-]{0,3}[0-9])+")
_PART = re.compile(r"[^\x20]+")
_WRITTEN_AT = re.compile(r"\x20?[\[(]at[\])]\x20?")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_DIGIT = re.compile(r"[0-9]")

FEATURES = ("bias", "at", "written_at", "domain", "no_local", "digits_7_8", "digits_9_12", "digits_13_15", "digits_16",
            "digits_17_19", "plus", "paren", "dash", "space", "dots_3", "octets", "luhn")
#: Marks that make a mention a match by the patterns, and what it has without them.
TELLING = {1: 2, 10: None, 15: None, 16: None}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if k % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _local_start(text: str, at: int, floor: int) -> int:
    while at > floor and text[at - 1] in _LOCAL:
        at -= 1
    return at


def _emails(text: str) -> list[Span]:
    """Leftmost matches, found from each ``@``: no other start can match, so long words cost no second look."""
    out: list[Span] = []
    floor, at = 0, text.find("@")
    while at >= 0:
        start = _local_start(text, at, floor)
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            floor = m.end()
        at = text.find("@", max(at + 1, floor))
    return out


def _addresses(text: str) -> list[Span]:
    """Each four numbers in a row of dotted numbers are one match."""
    out: list[Span] = []
    for m in _DOTTED.finditer(text):
        parts = m[0].split(".")
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append(("ip", at, end))
            at = end + 1
    return out


def base_spans(text: str) -> list[Span]:
    """Matches of the four patterns, by kind as listed, then start; code points, end exclusive."""
    out = _emails(text) if "@" in text else []
    if _DIGIT.search(text):
        out += _addresses(text)
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


def _mentions(text: str) -> list[tuple[int, int, str, list[int]]]:
    """start, end, key and feature numbers of every mention, by start."""
    out = []
    spots = [(m.start(), m.end(), True) for m in _WRITTEN_AT.finditer(text)] if "at]" in text or "at)" in text else []
    at = text.find("@")
    while at >= 0:
        spots.append((at, at + 1, False))
        at = text.find("@", at + 1)
    floor = 0
    for a, b, written in sorted(spots):
        start = _local_start(text, a, floor)
        domain = _DOMAIN.match(text, b)
        end = floor = domain.end() if domain else b
        if start < a and domain:
            out.append((start, end, text[start:a].lower() + "@" + domain[0].lower(),
                        [0, 2 if written else 1, 3]))
        elif start < a or domain:
            out.append((start, end, f"@{start}", [0, 2 if written else 1, *([3] if domain else []), *([4] if start == a else [])]))
    if _DIGIT.search(text):
        for m in _GROUP.finditer(text):
            if m.end() - m.start() < 7:
                continue
            whole = sum(c.isdigit() for c in m[0])
            cuts = [(m.start(), m[0])] if whole <= 19 else [(m.start() + p.start(), p[0]) for p in _PART.finditer(m[0])]
            for start, body in cuts:
                digits = _NOT_DIGIT.sub("", body)
                n = len(digits)
                if not 7 <= n <= 19:
                    continue
                marks = [0, 5 if n <= 8 else 6 if n <= 12 else 7 if n <= 15 else 8 if n == 16 else 9]
                marks += [k for k, c in ((10, "+"), (11, "("), (12, "-"), (13, " ")) if c in body]
                if body.count(".") == 3:
                    marks.append(14)
                    if all(p.isascii() and p.isdigit() and int(p) <= 255 for p in body.split(".")):
                        marks.append(15)
                if n >= 13 and luhn(digits):
                    marks.append(16)
                out.append((start, start + len(body), digits if body.count(".") == 3 else digits[-7:], marks))
    return sorted(out, key=lambda x: x[:2])


def _observed(mentions, base: list[Span]) -> np.ndarray:
    """The kind of the base span that a mention touches, or "other"."""
    out = np.full(len(mentions), OTHER)
    spans = sorted((a, b, KINDS.index(kind)) for kind, a, b in base)
    k = 0
    for i, (start, end, _, _) in enumerate(mentions):
        while k < len(spans) and spans[k][1] <= start:
            k += 1
        if k < len(spans) and spans[k][0] < end:
            out[i] = spans[k][2]
    return out


class Field:
    """Weights of the shape, chain and skip potentials."""

    def __init__(self, shape: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.shape, self.chain, self.skip = shape, chain, skip

    @staticmethod
    def prior() -> np.ndarray:
        shape = np.zeros((len(FEATURES), OTHER + 1))
        shape[0, OTHER] = 4.0
        return shape

    @classmethod
    def fit(cls, mentions: dict[tuple[tuple[int, ...], int], int], edges: tuple[np.ndarray, np.ndarray]) -> Field:
        """mentions: number of mentions by features and weak label; edges: numbers of chain and skip edges by label pair."""
        labels = OTHER + 1
        seen = [(f, v, n) for (f, v), n in sorted(mentions.items())]
        # The same mention without its telling mark is no match by itself; only its context may say otherwise.
        seen += [([TELLING.get(k, k) for k in f if TELLING.get(k, k) is not None], OTHER, n) for f, v, n in seen if v != OTHER]
        x = np.array([np.isin(np.arange(len(FEATURES)), f) for f, *_ in seen], float).reshape(-1, len(FEATURES))
        y = np.array([v for _, v, _ in seen], int)
        count = np.array([n for *_, n in seen], float)
        shape = cls.prior()
        if len(y):
            target = np.eye(labels)[y]
            weight = 1.0 / np.sqrt(np.bincount(y, count, minlength=labels)[y])  # rare kinds count too
            weight *= count / np.average(weight, weights=count)
            prior, pull = shape.copy(), 0.02
            for _ in range(400):
                z = x @ shape
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                shape -= 0.5 * (x.T @ ((p - target) * weight[:, None]) / count.sum() + pull * (shape - prior))

        def agreement(which: int, limit: float) -> np.ndarray:
            """Log-odds of label pairs on edges against independence, smoothed and bounded."""
            pairs = edges[which] + 0.5
            pairs = pairs + pairs.T
            share = pairs / pairs.sum()
            alone = share.sum(1)
            return np.clip(np.log(share / np.outer(alone, alone)), -limit, limit)

        chain = agreement(0, 0.5)
        skip = np.minimum(agreement(1, 6.0), 0.0) + np.diag(np.full(labels, 4.0))
        return cls(shape, chain, skip)

    def beliefs(self, marks: list[list[int]], observed: np.ndarray, chain: list[tuple[int, int]], skip: list[tuple[int, int]]) -> np.ndarray:
        """Label beliefs of all mentions of a batch by loopy sum-product messages; documents share no edge."""
        n, labels = len(marks), OTHER + 1
        own = np.array([self.shape[f].sum(0) for f in marks]).reshape(n, labels)
        seen = observed != OTHER
        own[seen] = -30.0
        own[seen, observed[seen]] = 0.0
        root = np.arange(n)  # the first mention with the same key
        for i, j in skip:
            root[j] = root[i]
        votes = np.zeros((n, labels))
        np.add.at(votes, (root[seen], observed[seen]), 1.0)
        told = votes.sum(1) > 0
        says = np.log(votes[told] / votes[told].sum(1, keepdims=True) @ np.exp(self.skip))
        of = np.cumsum(told) - 1
        repeat = ~seen & told[root]
        own[repeat] += says[of[root[repeat]]]
        # Keys without an observed mention: two mentions are joined, more of them meet in a node without a shape.
        size = np.bincount(root, minlength=n)
        many = ~told & (size > 2)
        node = n + np.cumsum(many) - 1
        meet = [(int(i), int(node[root[i]])) for i in np.flatnonzero(many[root])]
        skip = [(i, j) for i, j in skip if not told[root[i]] and size[root[i]] == 2] + meet
        own = np.concatenate([own, np.zeros((int(many.sum()), labels))])
        ends = np.array([*chain, *skip], int).reshape(-1, 2)
        if len(ends):
            table = np.concatenate([np.repeat(self.chain[None], len(chain), 0), np.repeat(self.skip[None], len(skip), 0)])
            source, target = np.concatenate([ends[:, 0], ends[:, 1]]), np.concatenate([ends[:, 1], ends[:, 0]])
            table = np.concatenate([table, table.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(ends)) + len(ends), np.arange(len(ends))])
            sent = np.zeros((len(source), labels))
            for _ in range(MOST_ROUNDS):
                total = own.copy()
                np.add.at(total, target, sent)
                z = (total[source] - sent[back])[:, :, None] + table
                top = z.max(1)
                new = top + np.log(np.exp(z - top[:, None, :]).sum(1))
                new -= new.max(1, keepdims=True)
                change = np.abs(new - sent).max()
                sent = 0.5 * sent + 0.5 * new
                if change < SETTLED:
                    break
            np.add.at(own, target, sent)
        own = own[:n]
        p = np.exp(own - own.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def _edges(mentions, first: int = 0) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    chain = [(first + i, first + i + 1) for i in range(len(mentions) - 1)
             if mentions[i + 1][0] - mentions[i][1] <= NEAR_CHARS]
    last: dict[str, int] = {}
    skip = []
    for i, (_, _, key, _) in enumerate(mentions):
        if key in last:
            skip.append((first + last[key], first + i))
        last[key] = i
    return chain, skip


def find_spans(texts: list[str | None], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    base = [base_spans(t or "") for t in texts]
    found = [_mentions(t or "") for t in texts]
    marks, chain, skip, observed = [], [], [], []
    for spans, mentions in zip(base, found, strict=True):
        c, s = _edges(mentions, len(marks))
        chain += c
        skip += s
        observed.append(_observed(mentions, spans))
        marks += [m[3] for m in mentions]
    out = []
    if marks:
        seen = np.concatenate(observed)
        p = field.beliefs(marks, seen, chain, skip)
        kinds = np.where((p.max(1) > 0.5) & (seen == OTHER), p.argmax(1), OTHER)
    at = 0
    for spans, mentions in zip(base, found, strict=True):
        added = [(KINDS[kinds[at + i]], a, b) for i, (a, b, _, _) in enumerate(mentions) if kinds[at + i] != OTHER] if mentions else []
        at += len(mentions)
        out.append((spans, sorted(spans + added, key=lambda s: (KINDS.index(s[0]), s[1]))))
    return out


def fit(docs: DataFrame) -> Field:
    """Fit the field on all mentions of all rows."""

    def run(batches):
        found: Counter[tuple[int, str, int]] = Counter()  # statistic, features or first label, (second) label
        for batch in small_batches(batches):
            for text in batch.column("text").to_pylist():
                mentions = _mentions(text)
                kinds = _observed(mentions, base_spans(text)).tolist()
                found.update((0, ",".join(map(str, m[3])), v) for m, v in zip(mentions, kinds, strict=True))
                for which, pairs in enumerate(_edges(mentions), 1):
                    found.update((which, str(kinds[i]), kinds[j]) for i, j in pairs)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in found], pa.int32()), pa.array([k[1] for k in found], pa.string()),
             pa.array([k[2] for k in found], pa.int32()), pa.array(list(found.values()), pa.int64())], ["which", "key", "label", "n"])

    counts = (docs.select("text").where(F.col("text").rlike("[0-9@]")).mapInArrow(run, "which int, key string, label int, n long")
              .groupBy("which", "key", "label").agg(F.sum("n").alias("n")).collect())
    mentions, edges = {}, np.zeros((2, OTHER + 1, OTHER + 1))
    for which, key, label, n in counts:
        if which:
            edges[which - 1, int(key), label] = n
        else:
            mentions[tuple(map(int, key.split(","))), label] = n
    return Field.fit(mentions, (edges[0], edges[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256 of the base spans and all spans of every row."""
    field = fit(docs)

    def run(batches):
        for batch in small_batches(batches):
            found = find_spans(batch.column("text").to_pylist(), field)
            counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts,
                 pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string()),
                 pa.array([joined(spans) for _, spans in found], pa.string())],
                ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each run of touching or overlapping spans replaced by its first kind."""
    out, at = [], 0
    merged: list[list] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """All rows and columns, with every span of text masked and n_chars recounted where a text changes."""
    field = fit(docs)
    names = docs.columns

    def run(batches):
        for batch in small_batches(batches):
            texts = batch.column("text").to_pylist()
            changed = {k: masked(texts[k], spans) for k, (_, spans) in enumerate(find_spans(texts, field)) if spans}
            columns = {name: batch.column(name) for name in names}
            columns["text"] = pa.array([changed.get(k, t) for k, t in enumerate(texts)], pa.string())
            if "n_chars" in columns:
                sizes = columns["n_chars"].to_pylist()
                columns["n_chars"] = pa.array([len(changed[k]) if k in changed else n for k, n in enumerate(sizes)], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return docs.mapInArrow(run, docs.schema)
