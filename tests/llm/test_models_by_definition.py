"""Beliefs, features, decisions and entropy spans against their definitions, worked out one by one."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from reportflow.llm import langid, lm_mixing, pii, secrets

LABELS = pii.OTHER + 1


def enumerated(own, edges, free):
    """Marginals of all labellings: own potentials by node, edges as (i, j, table)."""
    out = np.zeros((len(own), LABELS))
    for labels in itertools.product(range(LABELS), repeat=len(own)):
        w = sum(own[k][v] for k, v in enumerate(labels)) + sum(t[labels[i], labels[j]] for i, j, t in edges)
        for k, v in enumerate(labels):
            out[k, v] += math.exp(w)
    out /= out.sum(1, keepdims=True)
    return out[:free]


@pytest.fixture(params=range(4))
def field(request):
    rng = np.random.default_rng(request.param)
    skip = rng.normal(size=(LABELS, LABELS)) + np.diag(np.full(LABELS, 2.0))
    return pii.Field(rng.normal(size=(len(pii.FEATURES), LABELS)), rng.normal(size=(LABELS, LABELS)), skip + skip.T)


def test_beliefs_on_a_chain_with_a_skip_edge(field):
    """1 - 0 - 2 - 3 without a cycle: messages give the exact marginals."""
    marks = [[0], [0, 1], [0, 2], [1, 3]]
    own = [field.shape[m].sum(0) for m in marks]
    got = field.beliefs(marks, np.full(4, pii.OTHER), [(0, 1), (2, 3)], [(0, 2)])
    want = enumerated(own, [(0, 1, field.chain), (2, 3, field.chain), (0, 2, field.skip)], 4)
    assert np.allclose(got, want, atol=1e-3)


def test_beliefs_of_one_key_meet_in_a_node(field):
    """Three mentions of one text, none observed: a fourth node without a shape joins them."""
    marks = [[0], [0, 4], [2]]
    own = [field.shape[m].sum(0) for m in marks] + [np.zeros(LABELS)]
    got = field.beliefs(marks, np.full(3, pii.OTHER), [], [(0, 1), (1, 2)])
    assert np.allclose(got, enumerated(own, [(k, 3, field.skip) for k in range(3)], 3), atol=1e-3)


def test_an_observed_mention_tells_its_repeats(field):
    marks, seen = [[0], [1], [0, 2]], np.array([2, pii.OTHER, pii.OTHER])
    fixed = np.full(LABELS, -30.0)
    fixed[2] = 0.0
    own = [fixed, field.shape[[1]].sum(0), field.shape[[0, 2]].sum(0)]
    got = field.beliefs(marks, seen, [], [(0, 1), (1, 2)])
    assert np.allclose(got, enumerated(own, [(0, 1, field.skip), (0, 2, field.skip)], 3), atol=1e-3)


def slow_features(text):
    """Hashed byte 1-, 2- and 3-grams, letters lower-cased, other ASCII as space; square roots, length one."""
    b = bytearray(text.encode())
    for k, c in enumerate(b):
        b[k] = c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32
        if k and b[k - 1] == 0xC3 and 0x80 <= c <= 0x9E and c != 0x97:
            b[k] = c + 32
    counts = Counter()
    for n in range(3):
        for k in range(len(b) - n):
            code = 0
            for c in b[k:k + n + 1]:
                code = code * 256 + c
            counts[((code + n * 77) * 2654435761 % 2**32) >> 20] += 1
    v = np.array([math.sqrt(counts[k]) for k in range(langid.DIMENSIONS)])
    return v / np.linalg.norm(v) if v.any() else v


@pytest.mark.parametrize("text", ["", "a", "Ab", "Où est ÉTÉ? ×", "123 !!", "日本 x", "the Quick\nbrown" * 40])
def test_features_by_definition(text):
    assert np.allclose(langid.features(np.frombuffer(text.encode(), np.uint8)), slow_features(text))


def test_decisions_by_definition():
    rng = random.Random(4)
    words = {lang: [f"{c}{rng.choice('aeiou')}{c}{k}" .replace(str(k), "xyz"[k % 3]) for k in range(9)] for lang, c in zip(("en", "de", "fr", "es", "ja"), "tkmsn", strict=True)}
    make = lambda lang: " ".join(rng.choice(words[lang]) for _ in range(30))
    model = langid.train(sorted(((lang, slow_features(make(lang))) for lang in words for _ in range(12)), key=lambda r: (r[0], r[1].tobytes())))
    assert model.families == ["germanic", "own:ja", "romance"]
    for lang in words:
        x = slow_features(make(lang))
        margins = [float(w @ x + b) for w, b in zip(model.family_w, model.family_b, strict=True)]
        family = model.families[max(range(3), key=lambda k: margins[k])]
        langs = model.langs[family]
        wins = Counter()
        for i, j, w, b in model.pairs[family]:
            wins[langs[i] if float(w @ x + b) >= 0 else langs[j]] += 1
        best = max(langs, key=lambda k: wins[k]) if wins else langs[0]
        got, score = model.predict(x)
        assert got == best == lang and 0 < score <= 1


def slow_entropy_spans(text):
    """Every window of every run of a class, counted anew; windows that overlap an allowed part are left out; touching ones joined."""
    out = []
    for m in secrets._CANDIDATE.finditer(text):
        if secrets._PLAIN_PATH.fullmatch(m[0]):
            continue
        allowed = secrets.allowed_parts(m[0])
        for kind, pattern in secrets._CLASS.items():
            for run in pattern.finditer(m[0]):
                spans = []
                for k in range(run.start(), run.end() - secrets.WINDOW + 1):
                    counts = Counter(m[0][k:k + secrets.WINDOW])
                    bits = -sum(c / secrets.WINDOW * math.log2(c / secrets.WINDOW) for c in counts.values())
                    if bits < secrets.THRESHOLD[kind] - 1e-9 or any(a < k + secrets.WINDOW and b > k for a, b in allowed):
                        continue
                    if spans and k <= spans[-1][1]:
                        spans[-1][1] = k + secrets.WINDOW
                    else:
                        spans.append([k, k + secrets.WINDOW])
                out += [(kind, m.start() + a, m.start() + b) for a, b in spans]
    return [s for s in out if secrets._mixed(text[s[1]:s[2]]) and not secrets._PLAIN_PATH.fullmatch(text[s[1]:s[2]])]


def test_added_secret_spans_by_definition():
    rng = random.Random(9)
    parts = ["aB3dE5gH7jK9mN1pQ3sT", "0f1e2d3c4b5a69788796", "a" * 12, "example", "550e8400-e29b-41d4-a716-446655440000", "/", "+", "=", " ", "xxxx", "1234567", "Zq9", "token=", "é"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(1500)]
    added = 0
    for text, (base, every) in zip(made, secrets.find_spans(pa.array(made, pa.large_string())), strict=True):
        assert sorted(secrets.entropy_spans(text)) == sorted(slow_entropy_spans(text))
        covered = [(a, b) for _, a, b in base]
        fresh = []
        for kind, a, b in sorted(slow_entropy_spans(text), key=lambda s: (s[1], -s[2], secrets.KINDS.index(s[0]))):
            if not any(x <= a and b <= y for x, y in covered) and not any(b <= y for _, _, y in fresh):
                fresh.append((kind, a, b))
        assert sorted(every) == sorted(base + fresh)
        added += len(fresh)
    assert added > 200


def test_weights_of_the_field_come_from_all_mentions(spark):
    """Beyond 4,000 documents, and beyond 2,000 mentions of one: the statistics are those of all of them."""
    def rows(n):
        return spark.range(n).selectExpr("id as doc_id", "case when id % 97 = 0 then concat('mail x', id, '@y.org') else concat('call ', 1000000 + id) end as text")
    seen, given = [], pii.Field.fit
    try:
        pii.Field.fit = lambda mentions, edges: seen.append((mentions, edges)) or given(mentions, edges)
        pii.fit(rows(7000))
        pii.fit(spark.createDataFrame([(1, "1234567 , " * 3000)], "doc_id long, text string"))
    finally:
        pii.Field.fit = given
    assert sum(seen[0][0].values()) == 7000 and sum(n for (_, v), n in seen[0][0].items() if v != pii.OTHER) == 73
    assert sum(seen[1][0].values()) == 3000 and [e.sum() for e in seen[1][1]] == [2999, 2999]


def test_start_weights_of_the_mixer_come_from_all_training_texts(spark):
    """Over 512 texts: every one has its part in the start weights, wherever it lies."""
    texts = [(k, " ".join(f"w{zlib.crc32(f'{k} {j}'.encode()) % 997}" for j in range(150))) for k in range(900)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model, start = lm_mixing.fit(docs), np.full((lm_mixing.PREDICTORS, lm_mixing.GATES), lm_mixing.START_WEIGHT, np.float32)
    training = [t for k, t in texts if zlib.crc32(str(k).encode()) % 7 != 2]
    fresh = lm_mixing.Model(model.code, model.bits, model.order0, model.table, start, 0.1)
    data = np.frombuffer("".join(training).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in training])))
    summed, n = fresh.bit_costs(*lm_mixing.stream(data, offsets, model.code.symbol))[2]
    assert n > 512 and np.allclose(model.weights, summed / n, atol=1e-6)


def test_mixer_by_definition_and_its_learning_pass_makes_no_costs():
    """Bit by bit: costs and last weights; the pass for the start weights learns the same without an array of costs."""
    rng = np.random.default_rng(7)
    code = lm_mixing.Code(np.bincount(rng.integers(97, 105, 500), minlength=256), 10, 100)
    table = code.stored_odds(rng.integers(0, 9, (sum(lm_mixing.table_rows(10)), lm_mixing.SYMBOLS)) ** 3).ravel()
    order0 = code.log_odds(rng.integers(0, 50, (1, lm_mixing.SYMBOLS)))[0]
    model = lm_mixing.Model(code, 10, order0, table, np.full((lm_mixing.PREDICTORS, lm_mixing.GATES), 0.4, np.float32), 0.1)
    texts = ["", "a", " ", "abc  hg", *(" ".join("".join(chr(97 + k) for k in rng.integers(0, 8, n)) for n in rng.integers(1, 9, words))
                                       for words in (3, 60, 150))]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    s, begin = lm_mixing.stream(data, np.concatenate(([0], np.cumsum([len(t) for t in texts]))), code.symbol)
    costs, _, (summed, n) = model.bit_costs(s, begin)
    rows, place = lm_mixing.contexts(s, begin, 10)
    expected, last, agreed = [], [], 0
    for a, b in zip(begin, begin[1:], strict=False):
        for start in range(a, b, lm_mixing.SEGMENT):
            weights, change, n_open = model.weights.astype(float), np.zeros((lm_mixing.PREDICTORS, lm_mixing.GATES)), 0
            for i in range(start, min(start + lm_mixing.SEGMENT, b)):
                for step in code.steps[code.begin[s[i]]:code.begin[s[i]] + code.length[s[i]]].tolist():
                    node, bit = step >> 1, step & 1
                    x = np.array([*(table[(int(r[i]) + f) * lm_mixing.SYMBOLS + node] / lm_mixing.ODDS_STEPS
                                    for r, f in zip(rows, model.first_row, strict=True)), order0[node]])
                    if min(x[:3]) >= lm_mixing.AGREED or max(x[:3]) <= -lm_mixing.AGREED:
                        mixed, agreed = x[:3].mean(), agreed + 1
                    else:
                        gate = 2 * place[i] + (code.depth[node] > 2)
                        mixed = x @ weights[:, gate]
                        change[:, gate] += x * (bit - 1 / (1 + np.exp(-mixed))) * lm_mixing.RATE
                        n_open += 1
                        if n_open % lm_mixing.TOGETHER == 0:
                            weights, change = weights + change, np.zeros_like(change)
                    expected.append(np.log1p(np.exp((1 - 2 * bit) * np.clip(mixed, -14, 14))))
            if n_open >= lm_mixing.SEGMENT:
                last.append(weights + change)
    assert agreed > 20 and n == len(last) > 1 and np.allclose(costs, expected, atol=2e-4) and np.allclose(summed, np.sum(last, 0), atol=1e-3)
    learned, n_learned = model.learn(s, begin)
    assert n_learned == n and np.array_equal(learned, summed)


def test_counts_of_hashes():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5000):
        h = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        there = dict(zip(h.tolist(), rng.integers(1, 99, len(h)).tolist(), strict=True))
        asked = np.concatenate([h, rng.integers(0, 2**64, 500, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        got = lm_mixing.Counts(h[::-1], np.array([there[x] for x in h[::-1].tolist()], np.int64)).of(asked)
        assert got.tolist() == [there.get(x, 0) for x in asked.tolist()]
