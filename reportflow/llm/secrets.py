"""Secrets in text: fixed patterns, and windows of high entropy in candidate strings.

Base spans: assign (a credential word, a sign and a value of 12 or more characters), access (key ids of 18 or more) and
hex (runs of 16 or more). Added spans: every maximal run of key characters of at least ``WINDOW`` is a candidate; for
each character class (hexadecimal digits, base-64 characters) a window of ``WINDOW`` characters slides over the class's
runs in it, and its Shannon entropy follows from counts that each step changes by one character in and one out. Windows
at or over the class's threshold that mix digits with letters join to a span. The allow-list suppresses added spans,
never base ones: windows that touch a placeholder, a run of the alphabet or of digits or a UUID are left out, and so are
spans that are paths of plain words; the rest of the run counts. An added span inside a base span is left out.

Defined results: null and empty texts have no spans; repeated rows each get a result; an empty table gives no rows.
Texts are taken whole, in time linear in their length. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reportflow.llm.common import as_strings, bytes_and_offsets

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
BASE = 3
WINDOW = 20
#: Bits a character a window needs, by class; 20 characters hold 4.32 at most, and 4 if they are hexadecimal.
THRESHOLD = {"entropy_hex": 3.0, "entropy_base64": 3.9}
Span = tuple[str, int, int]

_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_CLASS = {"entropy_hex": re.compile(r"[0-9A-Fa-f]{20,}"), "entropy_base64": re.compile(r"[A-Za-z0-9+/_-]{20,}")}

# Texts that a real key does not hold (compared in lower case).
_PLACEHOLDERS = re.compile(r"example|changeme|placeholder|your[_-]|x{4,}|0{7,}|1234567|abcdefg")
_UUID = re.compile(r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}")
_LOWER = {c: c + 32 for c in range(65, 91)}
_PLAIN_PATH = re.compile(r"[A-Za-z]*(?:[/_-][A-Za-z]*|[/_-][0-9]{1,4})*")

_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[[*range(48, 58), *range(97, 103)]] = True
_KEY_BYTE = np.zeros(256, bool)
_KEY_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *map(ord, "+/_=-")]] = True


def base_spans(text: str) -> list[Span]:
    """Matches of the three patterns by start, then kind as listed; code points, end exclusive."""
    out: list[Span] = []
    if "=" in text or ":" in text:
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end() - m.start(1) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return _ordered(out)


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


_C_LOG_C = [0.0, *(c * math.log2(c) for c in range(1, WINDOW + 1))]


def window_entropies(run: str, size: int = WINDOW) -> list[float]:
    """Shannon entropy, in bits a character, of every window of a run; each step updates two counts."""
    counts: dict[str, int] = {}
    total = 0.0
    out = []
    for k, c in enumerate(run):
        if k >= size:
            old = run[k - size]
            n = counts[old]
            total += _C_LOG_C[n - 1] - _C_LOG_C[n]
            counts[old] = n - 1
        n = counts.get(c, 0)
        total += _C_LOG_C[n + 1] - _C_LOG_C[n]
        counts[c] = n + 1
        if k >= size - 1:
            out.append(math.log2(size) - total / size)
    return out


def _mixed(text: str) -> bool:
    """Three digits at least, letters too; in long keys of both cases fewer digits are common, so one is enough there."""
    digits = sum(c.isdigit() for c in text)
    lower, upper = any(c.islower() for c in text), any(c.isupper() for c in text)
    return digits >= (1 if lower and upper else 3) and (lower or upper)


def allowed_parts(candidate: str) -> list[tuple[int, int]]:
    """Start and end of every placeholder and UUID, by start; a run of the alphabet or of digits counts as far as it goes."""
    low = candidate.translate(_LOWER)
    out = [m.span() for m in _UUID.finditer(candidate)]
    at = 0
    while m := _PLACEHOLDERS.search(low, at):
        a, at = m.span()
        if m[0] in ("1234567", "abcdefg"):
            while a > 0 and ord(low[a]) - ord(low[a - 1]) == 1:
                a -= 1
            while at < len(low) and ord(low[at]) - ord(low[at - 1]) == 1:
                at += 1
        out.append((a, at))
    return sorted(out)


def entropy_spans(text: str) -> list[Span]:
    """Joined windows of high entropy of each class, without the allow-listed ones."""
    out: list[Span] = []
    for m in _CANDIDATE.finditer(text):
        if _PLAIN_PATH.fullmatch(m[0]):
            continue
        parts = allowed_parts(m[0])
        for kind, pattern in _CLASS.items():
            part = 0
            for run in pattern.finditer(m[0]):
                body, first = run[0], run.start()
                at = m.start() + first
                span: list[int] | None = None
                for k, bits in enumerate(window_entropies(body)):
                    while part < len(parts) and parts[part][1] <= first + k:
                        part += 1
                    if bits < THRESHOLD[kind] or (part < len(parts) and parts[part][0] < first + k + WINDOW):
                        continue
                    if span and k <= span[1]:
                        span[1] = k + WINDOW
                    else:
                        if span:
                            out.append((kind, at + span[0], at + span[1]))
                        span = [k, k + WINDOW]
                if span:
                    out.append((kind, at + span[0], at + span[1]))
    return [s for s in out if _mixed(text[s[1]:s[2]]) and not _PLAIN_PATH.fullmatch(text[s[1]:s[2]])]


def all_spans(text: str, base: list[Span]) -> list[Span]:
    """The base spans and the entropy spans that lie in none of them; of two classes the longer span is taken."""
    inside = sorted((a, b) for _, a, b in base)
    reach = np.maximum.accumulate([b for _, b in inside]) if inside else []
    starts = [a for a, _ in inside]
    fresh = []
    last_end = -1
    for kind, a, b in sorted(entropy_spans(text), key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        k = int(np.searchsorted(starts, a, side="right")) - 1
        if (k >= 0 and reach[k] >= b) or b <= last_end:
            continue
        fresh.append((kind, a, b))
        last_end = max(last_end, b)
    return _ordered(base + fresh)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def _texts_with_runs(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, least: int) -> np.ndarray:
    """Which texts may hold a run of ``least`` member bytes (runs over a text's end only say "maybe")."""
    mask = np.concatenate(([False], member[data], [False]))
    change = np.flatnonzero(mask[1:] != mask[:-1])
    starts, ends = change[::2], change[1::2]
    long = ends - starts >= least
    out = np.zeros(len(offsets) - 1, bool)
    for a, b in zip(starts[long], ends[long], strict=True):
        first = int(np.searchsorted(offsets, a, side="right")) - 1
        last = int(np.searchsorted(offsets, b, side="left"))
        out[first:last] = True
    return out


def find_spans(strings: pa.Array) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text; texts without a sign of either are passed over at byte level."""
    data, offsets = bytes_and_offsets(strings)
    hexes = _texts_with_runs(data, offsets, _HEX_BYTE, 16)
    keys = _texts_with_runs(data, offsets, _KEY_BYTE, WINDOW)
    out = []
    for k in range(len(strings)):
        part = data[offsets[k]:offsets[k + 1]].tobytes()
        if not (hexes[k] or keys[k] or b"=" in part or b":" in part or b"AKIA" in part):
            out.append(([], []))
            continue
        text = part.decode()
        base = base_spans(text)
        out.append((base, all_spans(text, base) if keys[k] else base))
    return out


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256 of the base spans and all spans of every row."""

    def run(batches):
        for batch in batches:
            found = find_spans(as_strings(batch.column("text")))
            counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS[:BASE]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts,
                 pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string()),
                 pa.array([joined(spans) for _, spans in found], pa.string())],
                ["doc_id", *(f"n_{kind}" for kind in KINDS[:BASE]), "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
