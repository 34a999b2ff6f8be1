"""Places where an operator once did less than the whole job."""

import numpy as np
import pyarrow as pa
import pytest

import helpers as H
from reportflow.llm import langid, near_dup, pii, secrets, topk
from reportflow.llm.common import shingle_sets


def hot_bucket():
    """Texts with one bucket in common: the first is like none, then four pairs of two that are alike."""
    for seed in range(500):
        shared, *own = (" ".join(f"{c}{seed}x{k}" for k in range(n)) for c, n in zip("sabcde", (40, 20, 20, 20, 20, 20), strict=True))
        texts = [f"{shared} {own[0]}", *(f"{shared} {o}{end}" for o in own[1:] for end in (" end", ""))]
        sign = near_dup.Signature(1, 1)
        if len({sign.band_keys(s)[0] for s in shingle_sets(pa.array(texts, pa.large_string()), 2)}) == 1:
            return texts
    raise AssertionError("no such texts")


@pytest.mark.parametrize("block", [1 << 18, 100, 30])
def test_pairs_without_the_first_centre(spark, monkeypatch, block):
    """Round 0 finds no link; the pairs lie in one block or in different cells."""
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", block, raising=False)
    texts = hot_bucket()
    sets = [(k, H.shingles(t, 2)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = near_dup.near_duplicates(docs, shingle_words=2, bands=1, rows=1)
    want = {0: 0, **{k: k - (k + 1) % 2 for k in range(1, 9)}}
    assert dict(H.pairs(got, "doc_id", "component_id")) == H.linked_components(sets) == want


@pytest.mark.parametrize("repeats", [2, 10, 20, 1000])
@pytest.mark.parametrize("margin", [0.0, 1.0, 3.0])
def test_every_repeat_of_an_observed_mention(repeats, margin):
    """Unmarked repeats that lean to "other" by the margin, after and before the observed mention of their key."""
    labels = pii.OTHER + 1
    shape = np.zeros((len(pii.FEATURES), labels))
    shape[0, pii.OTHER] = margin
    field = pii.Field(shape, np.zeros((labels, labels)), 4.0 * np.eye(labels))
    skip = [(k, k + 1) for k in range(repeats)]
    for at in (0, repeats // 2):
        observed = np.full(repeats + 1, pii.OTHER)
        observed[at] = pii.KINDS.index("phone")
        p = field.beliefs([[0]] * (repeats + 1), observed, [], skip)
        assert (p.argmax(1) == pii.KINDS.index("phone")).all() and p.max(1).min() > 0.5
    assert (field.beliefs([[0]] * (repeats + 1), np.full(repeats + 1, pii.OTHER), [], skip).argmax(1) == pii.OTHER).all() or not margin


@pytest.mark.parametrize("repeats", [2, 10, 1000])
def test_every_repeat_in_a_text(spark, repeats):
    field = pii.fit(H.documents(spark))
    text = "joe@x.org and later " + "joe [at] x.org, then once more " * repeats
    assert len(pii.find_spans([text], field)[0][1]) == 1 + repeats
    assert not pii.find_spans([text[20:]], field)[0][1]


def test_language_decision_takes_effect(spark):
    docs = H.documents(spark)
    model = langid.calibrated(langid.fit(docs), docs)
    foreign = ["日本語のテキストです。これは長い文章であり、学習されていない言語です。", "это русский текст о погоде и городе, который мы не видели",
               "to jest polski tekst którego nie znamy wcale", "qzxv wkjq zzxq vvkw qxqz jjwq kkzv"]
    rows = spark.createDataFrame([(-1 - k, t) for k, t in enumerate(foreign)], "doc_id long, text string")
    known = docs.where("lang is not null and text rlike '[A-Za-z]'").select("doc_id", "text")
    kept = langid.in_known_language(known.unionByName(rows), model)
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in known.select("doc_id").collect())


def test_without_a_learned_language(spark):
    rows = spark.createDataFrame([(1, "a text"), (2, "12 !"), (3, None)], "doc_id long, text string")
    assert H.pairs(langid.in_known_language(rows, langid.LanguageModel()), "doc_id") == [(1,)]


KEY = "aB3dE5gH7jK9mN1pQ3sT5uV7wX9yZ1"


def test_keys_beside_allowed_parts():
    uuid = "550e8400-e29b-41d4-a716-446655440000"
    for before, after in ((f"/orgs/{uuid}/keys/", ""), ("example_key=", ""), ("", "/xxxxxxxx"), ("your_", ""), ("AbCdEfGhIjKlMnOp0123456789/", "/" + uuid)):
        text = f"{before}{KEY}{after}"
        spans = secrets.find_spans(pa.array([text], pa.large_string()))[0][1]
        assert any(a <= len(before) + 6 and b >= len(before) + len(KEY) - 6 for _, a, b in spans), text
        allowed = [text.find(p) for p in (uuid, "example", "xxxxxxxx", "your_", "0123456789") if p in text]
        assert not any(a <= k < b for _, a, b in spans for k in allowed), (text, spans)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    for text in (alphabet, "0123456789abcdef" * 3, uuid, f"/orgs/{uuid}/keys/list/of/names"):
        assert not [s for s in secrets.find_spans(pa.array([text], pa.large_string()))[0][1] if s[0].startswith("entropy")], text


@pytest.mark.parametrize("odd", [[], [1.0, 0.0, 0.0]])
def test_length_of_the_table(spark, odd):
    rows = [(0, odd), (20, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [-1.0, 0.2])]
    got = topk.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert sorted(H.pairs(got, "query_id", "rank", "vec_id", "score")) == [(20, 1, 1, 2048), (20, 2, 2, -4096)]


def test_large_components(spark):
    rows = [(0, [2.0**24 + 1, 3.0]), (1, [2.0**24, 5.0]), (2, [2.0**24 - 1, 7.0]), (3, [2.0**22, -1.0])]
    want = [sum(int(64 * a) * int(64 * b) for a, b in zip(rows[0][1], v, strict=True)) for _, v in rows[1:]]
    rows += [(4, [2.0**25, 0.0])]
    want += [int(64 * rows[0][1][0]) * 2**31]
    got = topk.nearest(spark.createDataFrame(rows[:-1], "vec_id long, embedding array<double>"))
    assert [r["score"] for r in got.orderBy("rank").collect()] == want[:3]
    with pytest.raises(ValueError):
        topk.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    rows = [(0, [1.0, 0.0]), (1, [2.0**25 - 1, 0.0]), (2, [-(2.0**24), 1.0])]
    got = topk.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert [r["score"] for r in got.orderBy("rank").collect()] == [64 * 64 * (2**25 - 1), -64 * 64 * 2**24]
