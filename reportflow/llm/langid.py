"""Language identification by hierarchical discrimination.

A linear support vector machine per language family picks the family; inside it, one-versus-one linear support vector
machines vote between the closely related languages. Features are the square roots of hashed byte 1-, 2- and 3-gram
counts over the whole text (letters lower-cased, other ASCII as space), scaled to length 1.

Training rows are the documents with text and lang whose crc32(doc_id as text) mod 3 is not 1. The classifier is fitted
on at most ``max_docs_per_lang`` of them a language (the smallest hashes of doc_id), a documented bound; prediction
covers every row and its whole text, and sees neither lang, source nor doc_id.

Defined results: null text, empty text and text without a letter give ``und`` with score 0; a null doc_id is never held
out; repeated rows each get a result; without training rows every text is ``und``; an empty table gives no rows. Of the
input only doc_id, text and lang are read, so further columns can't clash.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportflow.llm.common import as_strings, bytes_and_offsets, small_batches

DIMENSIONS = 4096
MAX_DOCS_PER_LANG = 400
UNKNOWN = "und"
#: A text is in no learned language if both the decisions taken for it (family, language in it) and its likeness to the mean of every
#: learned language (cosine) are far below what held-out labelled rows have. Of a sample of those, at most ``MAX_DOCS_PER_LANG`` a
#: language, the value that this share of rows lies under is taken; the bound for a decision's score (geometric mean) is
#: half way from there to 0.5, which is no evidence, and that for the likeness ``LIKENESS_KEPT`` of it, so that clean texts stay.
LOW_SHARE, LIKENESS_KEPT = 0.005, 0.75
#: Texts of fewer bytes with a letter stay: a word or two are too little to tell.
SHORT_BYTES = 32

# Language families by ISO 639-1 code. A language not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"),
}

_TEXT = np.full(256, 32, np.uint8)
_TEXT[97:123] = np.arange(97, 123)
_TEXT[65:91] = np.arange(97, 123)
_TEXT[128:] = np.arange(128, 256)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
PIECE = 1 << 20


def family_of(lang: str) -> str:
    for family, langs in FAMILIES.items():
        if lang in langs:
            return family
    return f"own:{lang}"


def _prepared(data: np.ndarray) -> np.ndarray:
    """Letters in lower case (also those of the Latin-1 block in UTF-8), everything else in ASCII as space."""
    out = _TEXT[data]
    if len(out) > 1:
        capital = (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)
        out[1:][capital] += 32
    return out


def features(data: np.ndarray) -> np.ndarray:
    """Feature vector of one text's bytes; long texts are counted piece by piece."""
    counts = np.zeros(DIMENSIONS)
    for at in range(0, len(data), PIECE):
        b = _prepared(data[at:at + PIECE + 2]).astype(np.uint32)
        own = min(PIECE, len(data) - at)
        code = np.zeros(len(b), np.uint32)
        for n in range(3):
            code = code[:len(b) - n] * np.uint32(256) + b[n:] if n else b.copy()
            hashed = ((code + np.uint32(n * 77)) * np.uint32(2654435761)) >> np.uint32(20)
            counts += np.bincount(hashed[:own], minlength=DIMENSIONS)
    out = np.sqrt(counts)
    norm = np.linalg.norm(out)
    return out / norm if norm else out


def has_letter(data: np.ndarray, text) -> bool:
    """True if the text holds a Unicode letter; ``text`` is called only when no ASCII letter is found."""
    return bool(_LETTER[data].any()) or (bool((data >= 128).any()) and any(c.isalpha() for c in text()))


def linear_svm(x: np.ndarray, y: np.ndarray, epochs: int = 30, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Hinge-loss linear classifier by averaged subgradient steps; y is +1 or -1, classes weigh alike."""
    rng = np.random.default_rng(20)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    w, b, sum_w, sum_b, step = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0, 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), 32):
            rows = order[k:k + 32]
            step += 1
            rate = 1.0 / (penalty * (step + 100))
            wrong = y[rows] * (x[rows] @ w + b) < 1
            grad = (y[rows] * weight[rows] * wrong) / len(rows)
            w = w * (1 - rate * penalty) + rate * (grad @ x[rows])
            b += 0.1 * rate * penalty * grad.sum()
            sum_w += w
            sum_b += b
    return sum_w / max(1, step), sum_b / max(1, step)


@dataclass
class LanguageModel:
    """Families with their one-versus-rest machines, and the one-versus-one machines of each family's languages."""

    families: list[str] = field(default_factory=list)
    langs: dict[str, list[str]] = field(default_factory=dict)
    family_w: np.ndarray | None = None
    family_b: np.ndarray | None = None
    pairs: dict[str, list[tuple[int, int, np.ndarray, float]]] = field(default_factory=dict)
    means: np.ndarray | None = None
    #: Least score a decision and least likeness of texts in a learned language; 0 and -1 keep all.
    decided: float = 0.0
    alike: float = -1.0

    def evidence(self, x: np.ndarray) -> tuple[float, float]:
        """Score a decision and likeness of a text."""
        lang, score = self.predict(x)
        decisions = (len(self.families) > 1) + (len(self.langs[family_of(lang)]) > 1)
        return score ** (1.0 / max(1, decisions)), float((self.means @ x).max())

    def calibrate(self, xs: list[np.ndarray]) -> None:
        """Set the bounds of ``knows`` by texts that are in learned languages."""
        if self.families and xs:
            found = np.array([self.evidence(x) for x in xs])
            score, likeness = np.quantile(found, LOW_SHARE, axis=0, method="lower")
            self.decided, self.alike = float(min(score, (score + 0.5) / 2)), float(LIKENESS_KEPT * likeness)

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        if not self.families:
            return UNKNOWN, 0.0
        score = 1.0
        k = 0
        if len(self.families) > 1:
            margins = self.family_w @ x + self.family_b
            k = int(np.argmax(margins))
            rest = np.delete(margins, k).max()
            score = _squash(margins[k] - rest)
        family = self.families[k]
        langs = self.langs[family]
        if len(langs) == 1:
            return langs[0], score
        votes, sums = np.zeros(len(langs)), np.zeros(len(langs))
        margin_of = {}
        for i, j, w, b in self.pairs[family]:
            m = float(w @ x + b)
            votes[i if m >= 0 else j] += 1
            sums[i] += m
            sums[j] -= m
            margin_of[i, j], margin_of[j, i] = m, -m
        best = max(range(len(langs)), key=lambda i: (votes[i], sums[i], -i))
        closest = min(margin_of[best, j] for j in range(len(langs)) if j != best)
        return langs[best], score * _squash(2 * closest)

    def knows(self, x: np.ndarray) -> bool:
        """False if neither the machines tell the text's language nor the text is like one; without languages True."""
        if not self.families:
            return True
        decided, alike = self.evidence(x)
        return decided >= self.decided or alike >= self.alike


def _squash(margin: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(2 * margin, -50, 50))))


def train(rows: list[tuple[str, np.ndarray]]) -> LanguageModel:
    """Fit the hierarchy on (lang, features) rows."""
    model = LanguageModel()
    if not rows:
        return model
    labels = np.array([lang for lang, _ in rows], dtype=object)
    x = np.array([v for _, v in rows])
    for lang in sorted(set(labels)):
        model.langs.setdefault(family_of(lang), []).append(lang)
    model.families = sorted(model.langs)
    means = np.array([x[labels == lang].mean(0) for lang in sorted(set(labels))])
    model.means = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
    of = np.array([family_of(lang) for lang in labels], dtype=object)
    if len(model.families) > 1:
        fitted = [linear_svm(x, np.where(of == f, 1.0, -1.0)) for f in model.families]
        model.family_w = np.array([w for w, _ in fitted])
        model.family_b = np.array([b for _, b in fitted])
    for family, langs in model.langs.items():
        model.pairs[family] = []
        for i in range(len(langs)):
            for j in range(i + 1, len(langs)):
                use = (labels == langs[i]) | (labels == langs[j])
                w, b = linear_svm(x[use], np.where(labels[use] == langs[i], 1.0, -1.0))
                model.pairs[family].append((i, j, w, b))
    return model


def held_out() -> F.Column:
    """True for the documents that training must not see."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(rows: DataFrame, limit: int) -> list[tuple[str, np.ndarray]]:
    """lang and features of at most ``limit`` rows (lang, text, doc_id) of each language, whatever way rows are dealt out."""
    draw = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 30))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return []
    # About twice the bound a language goes on to the ranking below, which then keeps exactly the bound.
    share = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(int(min(1.0, 2 * limit / n) * (1 << 30))))
                         for lang, n in sorted(counts.items())])
    near = rows.withColumn("draw", draw).where(F.col("draw") <= share)
    keep = Window.partitionBy("lang").orderBy("draw", "doc_id", F.xxhash64("text"))
    sample = near.withColumn("rank", F.row_number().over(keep)).where(F.col("rank") <= limit)

    def vectors(batches):
        for batch in small_batches(batches):
            data, offsets = bytes_and_offsets(as_strings(batch.column("text")))
            langs = batch.column("lang").to_pylist()
            out = [(lang, features(part).astype(np.float32).tobytes()) for k, lang in enumerate(langs)
                   if has_letter(part := data[offsets[k]:offsets[k + 1]], lambda p=part: bytes(p).decode())]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.string()),
                                              pa.array([v for _, v in out], pa.binary())], ["lang", "v"])

    found = sample.mapInArrow(vectors, "lang string, v binary").collect()
    return sorted(((r[0], np.frombuffer(r[1], np.float32).astype(float)) for r in found), key=lambda r: (r[0], r[1].tobytes()))


def fit(docs: DataFrame, max_docs_per_lang: int = MAX_DOCS_PER_LANG) -> LanguageModel:
    """Train on a bounded sample of the training rows."""
    rows = docs.select("doc_id", "text", "lang").where(
        ~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN))
    return train(_sample(rows, max_docs_per_lang))


def calibrated(model: LanguageModel, docs: DataFrame, max_docs_per_lang: int = MAX_DOCS_PER_LANG) -> LanguageModel:
    """The model with its bounds for known languages, by a sample of the held-out rows labelled with a learned language."""
    learned = [lang for langs in model.langs.values() for lang in langs]
    rows = docs.select("doc_id", "text", "lang").where(held_out() & F.col("text").isNotNull() & F.col("lang").isin(learned))
    model.calibrate([x for _, x in _sample(rows, max_docs_per_lang)] if learned else [])
    return model


def predict(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with lang_pred and score, from the text alone."""
    source = docs.select(*keep, *([] if "text" in keep else ["text"]))
    kept_fields = [f for f in source.schema.fields if f.name in keep]

    def run(batches):
        for batch in small_batches(batches):
            strings = as_strings(batch.column("text"))
            data, offsets = bytes_and_offsets(strings)
            langs, scores = [], []
            for k in range(len(strings)):
                part = data[offsets[k]:offsets[k + 1]]
                known = has_letter(part, lambda k=k: strings[k].as_py())
                lang, score = model.predict(features(part)) if known else (UNKNOWN, 0.0)
                langs.append(lang)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept_fields), pa.array(langs, pa.string()),
                 pa.array(scores, pa.float64())], [*(f.name for f in kept_fields), "lang_pred", "score"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept_fields)
    return source.mapInArrow(run, f"{ddl}, lang_pred string, score double")


def identify(docs: DataFrame, max_docs_per_lang: int = MAX_DOCS_PER_LANG) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    model = fit(docs, max_docs_per_lang)
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def in_known_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows whose text is in a learned language, as they are; rows without text or without a letter go.

    A text goes if its score a decision and its likeness are both under the model's bounds (``calibrated``); a model without them, or
    without a learned language, keeps every text with a letter.
    """
    names = docs.columns

    def run(batches):
        for batch in small_batches(batches):
            strings = as_strings(batch.column("text"))
            data, offsets = bytes_and_offsets(strings)
            keep = []
            for k in range(len(strings)):
                part = data[offsets[k]:offsets[k + 1]]
                keep.append(has_letter(part, lambda k=k: strings[k].as_py()) and (len(part) < SHORT_BYTES or model.knows(features(part))))
            yield batch.filter(pa.array(keep, pa.bool_())).select(names)

    return docs.mapInArrow(run, docs.schema)
