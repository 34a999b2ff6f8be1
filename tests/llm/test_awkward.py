"""Every operator on nulls, empty and very long texts, ties, repeated rows, clashing columns and empty tables."""

import corpus_pipeline
import pytest

import helpers as H
from reportflow.llm import (fingerprints, langid, lm_mixing, mixing, near_dup, pii, secrets, sentencepiece_fst, token_counts,
                            topk)
from reportflow.session import checkpoint_dir

PER_ROW = {
    "op1": sentencepiece_fst.tokenised, "op2": secrets.detect, "op4": fingerprints.compared, "op5": lm_mixing.scored,
    "op6": token_counts.counted, "op7": mixing.mix, "op8": pii.detect, "op9": langid.identify,
    "op10": lambda d: near_dup.near_duplicates(d, shingle_words=2)}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_each_row(spark, name):
    docs = H.awkward(spark)
    got = PER_ROW[name](docs)
    key = lambda x: (x is not None, x or 0)
    assert sorted((r["doc_id"] for r in got.collect()), key=key) == sorted((r["doc_id"] for r in docs.collect()), key=key)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(spark, name):
    assert PER_ROW[name](H.empty(spark)).count() == 0


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_defined_results(spark):
    docs = H.awkward(spark)
    near = by_id(near_dup.near_duplicates(docs, shingle_words=2))
    assert near[1]["component_id"] == near[2]["component_id"] == near[13]["component_id"] == 1 and not near[2]["kept"]
    assert near[14]["n_shingles"] == 1 and near[15]["component_id"] == 14
    assert near[4]["n_shingles"] == near[5]["n_shingles"] == near[6]["n_shingles"] == 0
    assert all(near[k]["component_id"] == k and near[k]["kept"] for k in (4, 5, 6, 9))
    assert near[None]["component_id"] is None and near[None]["kept"]
    lang = by_id(langid.identify(docs))
    assert all((lang[k]["lang_pred"], lang[k]["score"]) == ("und", 0.0) for k in (4, 5, 6, 7)) and not lang[None]["held_out"]
    assert all(0 <= r["score"] <= 1 for r in lang.values())
    mix = by_id(mixing.mix(docs))
    assert mix[4]["size"] == 0 == mix[4]["taken"] and mix[5]["size"] == 0
    spans = by_id(pii.detect(docs))
    assert spans[12]["n_email"] == spans[12]["n_phone"] == spans[12]["n_card"] == 1 and spans[4]["spans"] == ""
    found = by_id(secrets.detect(docs))
    assert found[12]["n_assign"] == 1 and found[12]["n_hex"] == 1 and found[5]["spans"] == ""
    scores = by_id(lm_mixing.scored(docs))
    assert scores[4]["n_tokens"] == scores[5]["n_tokens"] == 1 and scores[4]["score"] == pytest.approx(scores[6]["score"])
    pieces = by_id(sentencepiece_fst.tokenised(docs))
    assert pieces[4]["ids"] is None and pieces[5]["ids"] == [] and all(r["round_trip"] is not False for r in pieces.values())
    prints = by_id(fingerprints.compared(docs))
    assert prints[1]["fingerprint"] == prints[2]["fingerprint"] == prints[13]["fingerprint"] and prints[5]["fingerprint"] == ""
    assert prints[5]["near_next"] == 1.0 and prints[8]["n_chars"] == 150_000


def test_vectors(spark):
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 0.0]),
            (5, [float("inf"), 0.0]), (6, [0.5, 0.5, 0.5]), (None, [1.0, 1.0]), (7, [-1.0, 0.2]), (40, []), (8, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, score string, rank int")
    got = H.pairs(topk.nearest(df), "query_id", "rank", "vec_id", "score")
    best = lambda q, ids: [(q, n + 1, i, s) for n, (i, s) in enumerate(ids)]
    assert sorted(got) == best(0, [(1, 4096), (20, 4096), (8, 0), (7, -4096)]) + best(20, [(0, 4096), (1, 4096), (8, 0), (7, -4096)])
    assert topk.nearest(df.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    checkpoint_dir(spark)
    for name, docs in (("awkward", H.awkward(spark)), ("empty", H.empty(spark))):
        columns = docs.columns
        for k, (stage, fn) in enumerate(corpus_pipeline.STAGES):
            out = fn(spark, docs, H.SF)
            if k + 1 < len(corpus_pipeline.STAGES):
                assert out.columns == columns, stage
            out.write.parquet(path := f"{tmp_path}/{name}{k}")
            docs = spark.read.parquet(path)
            if name == "empty":
                assert docs.count() == 0
            elif stage == "near_dedup":
                ids = [r["doc_id"] for r in docs.collect()]
                assert ids.count(1) == 1 and 2 not in ids and 13 not in ids and 14 in ids and 15 not in ids
            elif stage == "pii":
                text = {r["doc_id"]: r["text"] for r in docs.collect()}
                assert text[12].startswith("mail [EMAIL] or [PHONE], card [CARD], token")
                assert text[1] == H.ENGLISH * 3
