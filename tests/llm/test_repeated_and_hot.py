"""Rows that repeat, keys that hold many rows, clashing names and words made to collide."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from helpers import linked_components, pairs, shingles
from reportflow.llm import common, mixing, near_dup, topk


def test_mixing_rounds_repeated_rows_one_by_one(spark):
    """50 equal rows and 50 others of one source: taken words within one document of the target, as for different rows."""
    word = "w " * 100
    rows = [(7, word, "a", "x")] * 50 + [(100 + k, f"{k} " + "v " * 99, "a", "y") for k in range(50)]
    rows += [(1000 + k, f"{k} " + "u " * 99, "b", "z") for k in range(40)] + [(2000 + k, f"{k} " + "t " * 99, "c", "z") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows) and all(r["taken"] <= 2 * r["size"] for r in got)
    for source in "abc":
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) < 100
    again = sorted((r["doc_id"], r["taken"]) for r in mixing.mix(df.repartition(7)).collect())
    assert again == sorted((r["doc_id"], r["taken"]) for r in got)
    kept = mixing.mixed(df)
    assert kept.columns == df.columns and kept.count() * 100 == sum(r["taken"] for r in got)
    assert kept.where("doc_id = 7").count() * 100 == sum(r["taken"] for r in got if r["doc_id"] == 7)


def test_words_of_alternating_parity_do_not_collide():
    """The pattern that makes polynomials modulo 2^64 collide, at several lengths, and words that differ in one byte."""
    words = []
    for size in (1024, 2048, 4096):
        bits = [bin(k).count("1") % 2 for k in range(size)]
        words += ["".join("ab"[b] for b in bits), "".join("ab"[1 - b] for b in bits)]
    words += ["x" * k for k in range(1, 40)] + ["x" * k + "\0" for k in range(1, 40)] + ["A" * 9 + "b", "a" * 9 + "c"]
    data, offsets = common.bytes_and_offsets(common.as_strings(pa.array([" ".join(words)])))
    starts, ends, _ = common.word_bounds(data, offsets)
    assert len(np.unique(common.word_hashes(data, starts, ends))) == len(words)
    upper = np.frombuffer(b"ABC abc", np.uint8)
    assert len(np.unique(common.word_hashes(upper, np.array([0, 4]), np.array([3, 7])))) == 1


def test_deduplicated_with_clashing_columns(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    df = spark.createDataFrame([(1, text, "a", "b"), (2, text, "c", "d"), (3, "other words", "e", "f"), (3, "other words", "e", "f")],
                               "doc_id long, text string, __id string, Own_ID string")
    got = near_dup.deduplicated(df)
    assert got.columns == df.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 3]


def test_families_of_borderline_copies_lose_no_link(spark, monkeypatch):
    """Many classes that share most of a base, in small blocks: the components of all pairs."""
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 400)
    rng = random.Random(5)
    rows = []
    for base in range(4):
        text = [f"b{base}w{k}" for k in range(60)]
        for _ in range(60):
            edited = [w if rng.random() > rng.choice([0.02, 0.06, 0.1]) else f"n{rng.randrange(10**6)}" for w in text]
            rows.append((len(rows) + 1, " ".join(edited)))
    rows += [(len(rows) + k + 1, rows[0][1]) for k in range(30)] + [(1000 + k, "") for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(near_dup, "COPIES_PER_TASK", 4)
    want = linked_components([(i, shingles(t, 2)) for i, t in rows])
    assert dict(pairs(near_dup.near_duplicates(df, 2), "doc_id", "component_id")) == want
    assert len(set(want.values())) < len(rows) - 100


def test_topk_with_a_vector_shared_by_a_third(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES_PER_PART", 3)
    rng = np.random.default_rng(2)
    shared = rng.normal(size=6)
    rows = [(k, [float(x) for x in (shared if k % 3 == 0 else rng.normal(size=6) if k % 5 else -shared)]) for k in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = np.floor(64 * np.array([r[1] for r in rows])).astype(np.int64)
    want = []
    for q in range(0, 300, 20):
        scores = v @ v[q]
        best = sorted((k for k in range(300) if k != q), key=lambda k: (-scores[k], k))[:20]
        want += [(q, n + 1, k, int(scores[k])) for n, k in enumerate(best)]
    assert sorted(pairs(topk.nearest(df), "query_id", "rank", "vec_id", "score")) == sorted(want)
    assert topk.Index(df).rows.count() < 220


def test_topk_counts_repeated_ids_once(spark):
    df = spark.createDataFrame([(20, [1.0]), (20, [1.0]), (1, [1.0]), (2, [1.0])], "vec_id long, embedding array<double>")
    got = topk.nearest(df).where(F.col("query_id") == 20)
    assert sorted(r["vec_id"] for r in got.collect()) == [1, 2]


def test_a_class_meets_a_centre_once_however_many_buckets_they_share(spark):
    """60 classes of 20 shared buckets with three centres: the rows made on the way are the pairs, not pairs times buckets."""
    own = spark.createDataFrame([(key, rep, 10 if rep < 50 else 100, rep) for key in range(20) for rep in range(60)],
                                "key long, rep long, n long, component long")
    centers = spark.createDataFrame([(key, [(0, 10, 0), (1, 10, 1), (2, 10, 2)]) for key in range(20)],
                                    "key long, centers array<struct<rep:long,n:long,component:long>>")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        met = near_dup.met_pairs(own, centers, 80)
        got = sorted((r["center"], r["member"]) for r in met.collect())
        made, nodes = [], [met._jdf.queryExecution().executedPlan()]
        while nodes:
            node = nodes.pop()
            children = node.children()
            nodes += [children.apply(k) for k in range(children.size())]
            if node.nodeName() == "Generate":
                made.append(node.metrics().apply("numOutputRows").value())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert got == sorted({(c, m) for c in range(3) for m in range(c + 1, 50)})
    assert made and max(made) <= 2 * len(got)
