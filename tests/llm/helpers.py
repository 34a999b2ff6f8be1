"""Brute-force versions and awkward rows for the tests of the llm subpackage."""

import re

from pyspark.sql import Row
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Further columns whose names clash with those that the operators use themselves.
    *[T.StructField(c, T.StringType()) for c in ("score", "key", "part", "component_id", "ids", "row", "lang_pred", "copies")]])
CLASH = ("s", "k", "p", "c", "i", "r", "l", "n")

ENGLISH = "the quick brown fox jumps over the lazy dog and then it runs back to the old house near the river "
GERMAN = "der schnelle braune Fuchs springt über den faulen Hund und läuft dann zurück zum alten Haus am Fluss "


def awkward(spark):
    """Nulls, empty and very long texts, ties and repeated rows."""
    rows = [
        (1, ENGLISH * 3, "en", "b"), (2, ENGLISH * 3, "en", "b"), (2, ENGLISH * 3, "en", "b"), (3, GERMAN * 3, "de", "a"),
        (4, None, "en", "a"), (5, "", None, None), (6, " \t\n ", "de", "a"), (7, "12345 !!! ###", None, "b"),
        (8, "x" * 150_000, "en", "b"), (9, (ENGLISH + GERMAN) * 700, None, None), (None, GERMAN * 2, "de", None), (None, None, None, None),
        (10, "日本語 𝒳𝒴 é\u0000 ▁a", "ja", "é"), (11, "1" * 60_000 + "@" * 200 + "a" * 30_000, None, "c"),
        (12, "mail joe.doe@mail.example.org or +1 (017) 555-7713, card 4111 1111 1111 1111, token = \"a1b2c3d4e5f6a7b8\"", "en", "c"),
        (13, ENGLISH.upper() * 3, "en", "c"), (14, "one", "en", "c"), (15, "One ", "en", "c")]
    return spark.createDataFrame([Row(*r, None if r[1] is None else len(r[1]), *CLASH) for r in rows], DOCUMENTS)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(lowered(text))


def shingles(text, size):
    w = words(text)
    return frozenset(zip(*[w[k:] for k in range(size)])) if len(w) >= size else frozenset([tuple(w)]) if w else frozenset()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else float(len(a) == len(b))


def linked_components(sets, pct=80):
    """Smallest id reachable over links of pairs of (id, set), all pairs compared."""
    parent = {k: k for k, _ in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1:]:
            if a and b and 100 * min(len(a), len(b)) >= pct * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= pct * (len(a) + len(b) - both):
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
    return {k: find(k) for k, _ in sets}


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs(df, *names):
    return [tuple(r[n] for n in names) for r in df.select(*names).collect()]
