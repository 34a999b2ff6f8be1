"""The registered queries of this subpackage: op1 to op13 over the given tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reportflow.llm import (fingerprints, langid, lm_mixing, merkle, mixing, near_dup, periodic_runs, pii, secrets,
                            sentencepiece_fst, token_counts, topk, url_cascade)
from reportflow.llm.common import importable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    return langid.identify(_table(spark, sf_dir, "documents"))


@_query
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document on two-word shingles."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=2)


ORACLES["op10_near_duplicates"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(w) < 2 THEN w
                        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
    FROM d
), x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
e AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (
    SELECT doc_id, doc_id AS r FROM s
    UNION
    SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r) AS component_id, s.doc_id = min(r) AS kept
FROM s JOIN reach USING (doc_id) GROUP BY s.doc_id, s.s
"""


@_query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: pattern spans and those that the field adds."""
    return pii.detect(_table(spark, sf_dir, "documents"))


@_query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


@_query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, and whether decoding them gives the normalised text back."""
    return sentencepiece_fst.tokenised(_table(spark, sf_dir, "documents"))


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py over the documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@_query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: pattern spans and windows of high entropy."""
    return secrets.detect(_table(spark, sf_dir, "documents"))


@_query
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, compared."""
    return fingerprints.compared(_table(spark, sf_dir, "documents"))


@_query
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of every query vector by integer inner product."""
    return topk.nearest(_table(spark, sf_dir, "embeddings"))


ORACLES["op3_exact_topk"] = """
WITH vecs AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM vecs q JOIN vecs c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@_query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens, tokens and forward score of every document."""
    return token_counts.counted(_table(spark, sf_dir, "documents"))


@_query
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under word counts and under the context-mixing model."""
    return lm_mixing.scored(_table(spark, sf_dir, "documents"))


@_query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, some of them with planted repeats, and the texts without them."""
    return periodic_runs.digests(periodic_runs.runs_of(periodic_runs.with_repeats(_table(spark, sf_dir, "documents"))))


ORACLES["op13_periodic_runs"] = r"""
WITH crc AS (
    SELECT DISTINCT doc_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
             lambda ch: CAST(ascii(ch) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
             lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) AS crc
    FROM documents WHERE doc_id IS NOT NULL
), d AS (
    SELECT row_number() OVER () AS row_no, documents.doc_id, coalesce(crc, 1) AS crc, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents LEFT JOIN crc ON documents.doc_id = crc.doc_id
), a AS (
    SELECT *, len(w) AS n, CASE WHEN crc % 10 = 0 AND len(w) > 0 THEN (crc // 10) % len(w) END AS first FROM d
), p AS (
    SELECT *, 1 + (n - first) // (3 + (crc // 10) % 8) AS period FROM a
), e AS (
    SELECT row_no, doc_id, n, CASE WHEN first IS NULL THEN w
             ELSE list_transform(range(n), lambda i: w[CASE WHEN i >= first THEN first + (i - first) % period ELSE i END + 1]) END AS w
    FROM p
), x AS (SELECT row_no, n, unnest(w) AS w, unnest(range(n)) AS i FROM e),
same AS (
    SELECT a.row_no, b.i - a.i AS period, a.i FROM x a JOIN x b ON a.row_no = b.row_no AND a.w = b.w AND b.i > a.i AND 4 * (b.i - a.i) <= a.n
), stretches AS (
    SELECT row_no, period, min(i) AS start, count(*) + period AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY row_no, period ORDER BY i) AS island FROM same)
    GROUP BY row_no, period, island HAVING count(*) + period >= greatest(6, 4 * period)
), runs AS (SELECT row_no, start, length, min(period) AS period FROM stretches GROUP BY ALL),
told AS (
    SELECT row_no, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY row_no
), best AS (
    SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY row_no ORDER BY length / period DESC, start, period) = 1
), dropped AS (
    SELECT DISTINCT row_no, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
    SELECT x.row_no, string_agg(w, ' ' ORDER BY x.i) AS text FROM x ANTI JOIN dropped ON x.row_no = dropped.row_no AND x.i = dropped.i GROUP BY x.row_no
)
SELECT e.doc_id, coalesce(n_runs, 0) AS n_runs, best.start, best.length, best.period, (1000 * best.length) // best.period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM e LEFT JOIN told ON e.row_no = told.row_no LEFT JOIN best ON e.row_no = best.row_no LEFT JOIN kept ON e.row_no = kept.row_no
"""


@_query
def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, longest fitting rule and verdict of every page's URL."""
    return url_cascade.judge(_table(spark, sf_dir, "pages"), url_cascade.rules_table(spark, url_cascade.RULES))


ORACLES["op12_url_filters"] = r"""
WITH r(host, path, verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), p AS (
    SELECT row_number() OVER () AS row_no, page_id,
           translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), f AS (
    SELECT p.row_no, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.verdict, length(r.host || r.path)) AS verdict
    FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY p.row_no
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN f USING (row_no)
"""


@_query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether its row, some of them tampered with, gives the root."""
    return merkle.audit(_table(spark, sf_dir, "documents"))


ORACLES["op11_merkle_manifest"] = r"""
WITH RECURSIVE crc AS (
    SELECT DISTINCT doc_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
             lambda ch: CAST(ascii(ch) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
             lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) AS crc
    FROM documents WHERE doc_id IS NOT NULL
), d AS (
    SELECT row_number() OVER () AS row_no, documents.doc_id, coalesce('=' || lang, '') AS grp, n_chars + 1 AS more, coalesce(crc % 7 = 0, false) AS tampered,
           coalesce(strlen(CAST(documents.doc_id AS VARCHAR)) || ':' || documents.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
             || coalesce(strlen(lang) || ':' || lang, '-') AS head,
           coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS chars, coalesce(strlen(text) || ':' || text, '-') AS body
    FROM documents LEFT JOIN crc ON documents.doc_id = crc.doc_id
), leaves AS (
    SELECT row_no, doc_id, grp, sha256(head || chars || body) AS leaf,
           CASE WHEN tampered THEN sha256(head || coalesce(strlen(CAST(more AS VARCHAR)) || ':' || more, '-') || body)
                ELSE sha256(head || chars || body) END AS again
    FROM d
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM leaves
), tree AS (
    SELECT 0 AS lvl, grp, pos, n AS m, leaf AS digest FROM ranked
    UNION ALL
    SELECT lvl + 1, grp, pos // 2, (m + 1) // 2, sha256(digest || coalesce(beside, ''))
    FROM (SELECT *, lead(digest) OVER (PARTITION BY grp ORDER BY pos) AS beside FROM tree WHERE m > 1) WHERE pos % 2 = 0
), subroots AS (
    SELECT grp, digest AS subroot, lvl AS height, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE m = 1
), top AS (
    SELECT 0 AS lvl, pos, n AS m, subroot AS digest FROM subroots
    UNION ALL
    SELECT lvl + 1, pos // 2, (m + 1) // 2, sha256(digest || coalesce(beside, ''))
    FROM (SELECT *, lead(digest) OVER (ORDER BY pos) AS beside FROM top WHERE m > 1) WHERE pos % 2 = 0
), levels AS (SELECT DISTINCT grp, lvl FROM tree WHERE m > 1),
top_levels AS (SELECT DISTINCT lvl FROM top WHERE m > 1),
steps AS (
    SELECT r.row_no, l.lvl AS step, (r.pos >> l.lvl) % 2 = 1 AS on_left, coalesce(s.digest, '') AS sibling
    FROM ranked r JOIN levels l ON r.grp = l.grp LEFT JOIN tree s ON s.grp = l.grp AND s.lvl = l.lvl AND s.pos = xor(r.pos >> l.lvl, 1)
    UNION ALL
    SELECT r.row_no, g.height + l.lvl, (g.pos >> l.lvl) % 2 = 1, coalesce(s.digest, '')
    FROM ranked r JOIN subroots g ON r.grp = g.grp CROSS JOIN top_levels l LEFT JOIN top s ON s.lvl = l.lvl AND s.pos = xor(g.pos >> l.lvl, 1)
), folded AS (
    SELECT row_no, 0 AS step, again AS digest FROM leaves
    UNION ALL
    SELECT f.row_no, f.step + 1, sha256(CASE WHEN on_left THEN sibling || digest ELSE digest || sibling END)
    FROM folded f JOIN steps s ON f.row_no = s.row_no AND f.step = s.step
), ends AS (SELECT row_no, max_by(digest, step) AS folded_root FROM folded GROUP BY row_no),
proofs AS (SELECT row_no, sha256(string_agg(sibling, '' ORDER BY step)) AS proof FROM steps GROUP BY row_no)
SELECT r.doc_id, r.leaf, g.subroot, t.digest AS root, coalesce(p.proof, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = t.digest AS verified
FROM ranked r JOIN subroots g ON r.grp = g.grp JOIN ends e ON r.row_no = e.row_no LEFT JOIN proofs p ON r.row_no = p.row_no CROSS JOIN (SELECT digest FROM top WHERE m = 1) t
"""
