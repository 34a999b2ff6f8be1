"""The manifest, the URL cascade and the periodic runs against brute-force versions, and on awkward rows."""

import hashlib
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import Row

from helpers import WORD, awkward, documents, empty
from reportflow.llm import merkle, periodic_runs, queries, url_cascade

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- periodic runs -----------------------------------------------------------

def brute_runs(w, min_length=6, min_exponent=4):
    found = {}
    for q in range(1, len(w) // min_exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, min_exponent * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_op13(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


@pytest.mark.parametrize("seed", range(30))
def test_runs_of_random_sequences(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(rng.randrange(1, 12)):
        letters = rng.choice([1, 2, 3, 8])
        x = [rng.randrange(letters) for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):
            unit = [rng.randrange(letters + 1) for _ in range(rng.randrange(1, 14))]
            at = rng.randrange(len(x) + 1)
            x[at:at] = (unit * 9)[:rng.randrange(1, 9 * len(unit))]
        texts.append(x)
    bounds = np.cumsum([0, *map(len, texts)])
    got = [tuple(map(int, r)) for r in periodic_runs.find_runs(np.array([v for x in texts for v in x], np.int64), bounds)]
    want = [(s + int(b), n, q) for x, b in zip(texts, bounds, strict=False) for s, n, q in sorted(brute_runs(x), key=lambda r: (r[0], r[2]))]
    assert got == want


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.select(*names).collect()), key=repr)


OP13 = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_op13_equals_brute_force(spark):
    docs = documents(spark)
    want = sorted((brute_op13(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()), key=repr)
    assert rows_of(queries.op13_periodic_runs(spark, SF), *OP13) == want
    assert any(r[1] for r in want) and any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in want)


def test_op13_awkward_rows(spark):
    rows = awkward(spark)
    got = periodic_runs.digests(periodic_runs.runs_of(periodic_runs.with_repeats(rows)))
    assert rows_of(got, *OP13) == sorted((brute_op13(r["doc_id"], r["text"]) for r in rows.select("doc_id", "text").collect()), key=repr)
    assert periodic_runs.digests(periodic_runs.runs_of(periodic_runs.with_repeats(empty(spark)))).count() == 0


def test_runs_and_collapsed_text(spark):
    df = spark.createDataFrame([(1, "x a b a b\ta b a b y"), (2, "z z z z z"), (3, None), (4, "Z z Z z Z z Z z é é é é é é")], "doc_id long, text string")
    got = {r["doc_id"]: ([tuple(x) for x in r["runs"]], r["top"] and tuple(r["top"]), r["collapsed"]) for r in periodic_runs.runs_of(df).collect()}
    assert got[1] == ([(1, 8, 2)], (1, 8, 2), "x a b y")
    assert got[2] == ([], None, "z z z z z") and got[3] == ([], None, "")
    assert got[4] == ([(0, 8, 2), (8, 6, 1)], (8, 6, 1), "Z z é")


# ---- manifest ----------------------------------------------------------------

def brute_tree(nodes):
    """Root, and for each node its siblings from bottom to top."""
    places, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for k, at in enumerate(places):
            paths[k].append((at % 2 == 1, nodes[at ^ 1] if at ^ 1 < len(nodes) else ""))
        nodes = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
        places = [at // 2 for at in places]
    return nodes[0], paths


def brute_op11(rows):
    def leaf(r, more=0):
        values = [r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"]]
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    subroots, own = [], []
    for lang in langs:
        members = sorted(groups[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        subroot, paths = brute_tree([leaf(r) for r in members])
        subroots.append(subroot)
        own.append(list(zip(members, paths, strict=True)))
    root, tops = brute_tree(subroots)
    out = []
    for subroot, members, top in zip(subroots, own, tops, strict=True):
        for r, path in members:
            steps = path + top
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            done = leaf(r, int(tampered))
            for left, beside in steps:
                done = sha(beside + done if left else done + beside)
            out.append((r["doc_id"], leaf(r), subroot, root, sha("".join(b for _, b in steps)), done, done == root))
    return sorted(out, key=repr)


OP11 = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_op11_equals_brute_force(spark):
    got = rows_of(queries.op11_merkle_manifest(spark, SF), *OP11)
    assert got == brute_op11(documents(spark).collect())
    assert {r[-1] for r in got} == {True, False}


def test_op11_awkward_rows(spark):
    rows = awkward(spark)
    assert rows_of(merkle.audit(rows), *OP11) == brute_op11(rows.collect())
    assert merkle.audit(empty(spark)).count() == 0
    one = rows.where("doc_id = 3")
    assert rows_of(merkle.audit(one), *OP11) == brute_op11(one.collect())


def test_op11_several_rounds_and_repeated_rows(spark, monkeypatch):
    """Records of two levels: many rounds; a third of the rows are one row repeated."""
    monkeypatch.setattr(merkle, "DIGIT", 2)
    rows = [Row(doc_id=i, source="s", lang="a" if i % 3 else "b", n_chars=i, text=f"text {i}") for i in range(90)]
    rows += [Row(doc_id=7, source="s", lang="a", n_chars=7, text="same")] * 45 + [Row(doc_id=5, source=None, lang=f"l{k}", n_chars=None, text=None) for k in range(11)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert rows_of(merkle.audit(df), *OP11) == brute_op11(rows)


def test_op11_proofs_of_some_requests(spark):
    df = documents(spark).withColumn("digest", merkle.row_digest({f: merkle.F.col(f) for f in merkle.FIELDS}))
    found = merkle.manifest(df.select(merkle.group_key(merkle.F.col("lang")).alias("grp"), "doc_id", "digest"))
    asked = found.leaves.where("rank % 10 = 3")
    got = merkle.proofs(found, asked).withColumn("again", merkle.folded(merkle.F.col("digest"), merkle.F.col("steps")))
    assert got.count() == asked.count() and got.where("again != root").count() == 0


# ---- URL cascade -------------------------------------------------------------

def brute_judge(url, rules):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = []
    for key, verdict in rules:
        h, p = key.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(key), len(h), key, verdict))
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1?x#y", "http://example.com/en", "http://example.com/en/", "http://com/en/",
        "http://notexample.com/en/a", "x://a.net/es/", "x://a.net/fr/?q", "x://a.net/de/", "x://net/es/x", "http://a.com", "http://a.com?/x", "http://a.com:80/x",
        "a://b://c.com/", "http://..com/", "http://éxample.com/en/", "http://" + "a." * 5000 + "com/" + "x" * 100_000, "http://m.www.example.com/en/x"]


def test_op12_awkward_urls(spark):
    df = spark.createDataFrame([(k, u, "r") for k, u in enumerate(URLS)] * 2, "page_id long, url string, rule string")
    got = url_cascade.judge(df, url_cascade.rules_table(spark, url_cascade.RULES))
    want = [(k, *brute_judge(u, url_cascade.RULES)) for k, u in enumerate(URLS)] * 2
    assert rows_of(got, "page_id", "host", "path", "rule", "verdict") == sorted(want, key=repr)
    assert url_cascade.judge(df.limit(0), url_cascade.rules_table(spark, url_cascade.RULES)).count() == 0
    assert {r["verdict"] for r in url_cascade.judge(df, url_cascade.rules_table(spark, [])).collect()} == {"allow"}


@pytest.mark.parametrize("join_instead", [False, True])
def test_op12_many_rules_need_several_levels(spark, monkeypatch, join_instead):
    rng = random.Random(3)
    hosts = [f"h{k}.d{k % 40}.{rng.choice(['com', 'net'])}" for k in range(600)]
    rules = sorted({f"{rng.choice([h, h.split('.', 1)[1]])}/{rng.choice(['', 'a/', 'b/'])}" for h in hosts[:300]})
    rules = [(k, rng.choice(["allow", "block"])) for k in rules]
    urls = [f"https://{'w.' * rng.randrange(2)}{h}/{rng.choice(['', 'a/x', 'b/y', 'c'])}" for h in hosts]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    if join_instead:
        monkeypatch.setattr(url_cascade, "MAX_FILTER_BITS", 64)
    else:
        universe = df.select(url_cascade.F.explode(url_cascade.keys_of(*url_cascade.host_and_path(url_cascade.F.col("url")), [(2, 1), (3, 1), (2, 3), (3, 3)])).alias("key"))
        made = url_cascade.cascade(url_cascade.rules_table(spark, rules).select("key"), universe, universe.distinct().count())
        assert len(made.levels) >= 3
    got = url_cascade.judge(df, url_cascade.rules_table(spark, rules))
    assert rows_of(got, "page_id", "host", "path", "rule", "verdict") == sorted(((k, *brute_judge(u, rules)) for k, u in enumerate(urls)), key=repr)
