"""URL rules judged through a cascade of Bloom filters: exact membership of every key of the corpus, without a join.

A rule is a host and a path, written as one key (``example.com/en/``), that allows or blocks. It fits its host and all
subdomains if the URL's path starts with the rule's; the longest fitting key wins (ties: the longer host).

1. Keys of a URL: its last labels joined with the first characters of its path, for each pair of label count and path
   length that occurs among the rules. A rule fits exactly if its key is one of them.
2. Cascade: the first filter encodes all listed keys. Every key of the corpus that it lets through without being listed is
   encoded by the second one; listed keys that pass the second are encoded by the third, and so on until a level has no false positive.
   The first filter's rate is |listed| / (sqrt(2) * |keys|), that of the others 1/2, so each level is about half of the last.
3. A key is listed if the first level that rejects it is an even one (or if it passes an odd number of levels, all of them). This
   is exact for every key of the corpus that the cascade was built over, and for every rule.
4. A second cascade, with the blocking rules as listed keys and the allowing ones as all keys, tells what the longest rule says.

All of it are DataFrame functions: bits are grouped into 64-bit words by ``bit_or`` and become a literal array, which goes to the
tasks with the plan; a page is judged in the scan's own stage. Size: bits of the first filter are 1.44 * log2(1/rate) for each
rule, about 35 at a ratio of 10^7 keys to a rule, and all other levels together hold about 4 more; a filter of more than
``MAX_FILTER_BITS`` is not built, and the keys are joined with the rules by a shuffle instead (same rows).
Only keys that pass the first filter are shuffled while building: about as many as there are rules.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; path: from there up to ``?``, ``#`` or the end.
Defined results: a null URL or one without ``://`` has an empty host and path, and no rule; a URL without a rule is allowed, as it
is in no list; repeated rows give repeated rows; a rule listed twice counts once, and one that both allows and blocks blocks;
without rules everything is allowed; an empty table gives no rows. Further columns are not read and can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportflow.session import checkpoint_dir

# The rules of the contract, as (key, verdict).
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
#: 32 MB as a literal of the plan.
MAX_FILTER_BITS = 1 << 28
#: Shapes of keys (label count, path length) that a URL is cut into; one expression each.
MAX_SHAPES = 1000


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """key, verdict of rules given as pairs."""
    return spark.createDataFrame(list(rules), "key string, verdict string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    given = F.coalesce(url, F.lit(""))
    return (F.translate(F.regexp_extract(given, "://([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(given, "://[^/?#]*([^?#]*)", 1))


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """The pairs of label count and path length among the rules, longest key first as far as shapes tell."""
    host = F.substring_index("key", "/", 1)
    found = (rules.select(_labels(host).alias("labels"), (F.length("key") - F.length(host)).alias("path"))
             .distinct().limit(MAX_SHAPES + 1).collect())
    if len(found) > MAX_SHAPES:
        raise ValueError(f"rules of more than {MAX_SHAPES} shapes (label count, path length)")
    return sorted((r["labels"], r["path"]) for r in found)


def keys_of(host: Column, path: Column, kinds: Sequence[tuple[int, int]]) -> Column:
    """All keys of a URL that a rule could have, as an array without nulls."""
    if not kinds:
        return F.array().cast("array<string>")
    labels = _labels(host)
    return F.array_compact(F.array(*[
        F.when((labels >= n) & (F.length(path) >= size), F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, size)))
        for n, size in kinds]))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: 64-bit words as an array literal, its size and number of hashes."""

    words: Column
    bits: int
    hashes: int
    salt: int

    def holds(self, key: Column) -> Column:
        """Whether all of the key's bits are set."""
        found = None
        for at in _places(key, self.bits, self.hashes, self.salt):
            bit = F.get(self.words, F.shiftright(at, 6).cast("int")).bitwiseAND(_bit(at)) != 0
            found = bit if found is None else found & bit
        return found


def _places(key: Column, bits: int, hashes: int, salt: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(salt), F.lit(k)), F.lit(bits).cast("long")) for k in range(hashes)]


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))


def _sized(n: int, rate: float) -> tuple[int, int]:
    """Bits (whole words) and hashes of a filter of ``n`` keys with about this rate of false positives."""
    bits = max(64, math.ceil(n * math.log2(1 / rate) / math.log(2) / 64) * 64)
    return bits, max(1, round(math.log2(1 / rate)))


def bloom(keys: DataFrame, n: int, rate: float, salt: int) -> Level:
    """The filter of a table's ``n`` keys (column key)."""
    bits, hashes = _sized(n, rate)
    set_bits = (keys.select(F.explode(F.array(*_places(F.col("key"), bits, hashes, salt))).alias("at"))
                .groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(_bit(F.col("at"))).alias("set")))
    words = {r["word"]: r["set"] for r in set_bits.collect()}   # bounded by MAX_FILTER_BITS
    text = ",".join(str(words.get(k, 0)) for k in range(bits // 64))
    return Level(F.split(F.lit(text), ",").cast("array<bigint>"), bits, hashes, salt)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def listed(self, key: Column) -> Column:
        """Exact membership: the parity of the first level that rejects the key."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for k in range(len(self.levels) - 1, -1, -1):
            answer = F.when(~self.levels[k].holds(key), F.lit(k % 2 == 1)).otherwise(answer)
        return answer


def cascade(listed: DataFrame, universe: DataFrame, distinct_keys: int) -> Cascade | None:
    """The cascade of ``listed`` keys (distinct) over all keys of ``universe`` (repeats allowed); both have the column key.

    ``distinct_keys`` (about) only sets the first filter's size. None if that would be over ``MAX_FILTER_BITS``.
    """
    checkpoint_dir(listed.sparkSession)
    inside = listed.select("key").checkpoint()
    n = inside.count()
    levels: list[Level] = []
    outside = None
    while n:
        rate = 0.5 if levels else min(0.5, n / (math.sqrt(2) * max(distinct_keys, 1)))
        if _sized(n, rate)[0] > MAX_FILTER_BITS:
            return None
        level = bloom(inside, n, rate, len(levels))
        levels.append(level)
        if outside is None:
            passed = universe.select("key").where(level.holds(F.col("key"))).distinct().join(inside, "key", "left_anti")
        else:
            passed = outside.where(level.holds(F.col("key")))
        # What this level lets through wrongly is what the next one encodes.
        outside, inside = inside, passed.checkpoint()
        n = inside.count()
    return Cascade(tuple(levels))


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule (null: none fits) and verdict of every page; ``rules``: key, verdict."""
    rules = rules.where("key like '%/%'").groupBy("key").agg(F.max(F.col("verdict") == BLOCK).alias("blocks"))
    kinds = shapes(rules)
    host, path = host_and_path(F.col("url"))
    cut = pages.select("page_id", host.alias("host"), path.alias("path"))
    keys = keys_of(F.col("host"), F.col("path"), kinds)
    universe = cut.select(F.explode(keys).alias("key"))
    count = universe.agg(F.approx_count_distinct("key")).first()[0]
    inside = cascade(rules, universe, count)
    blocking = cascade(rules.where("blocks"), rules.where("not blocks"), rules.where("not blocks").count())
    if inside is None or blocking is None:
        return _judged_by_join(cut, keys, rules)
    fitting = F.filter(keys, inside.listed)
    longest = F.array_max(F.transform(fitting, lambda k: F.struct(
        F.length(k).alias("length"), F.length(F.substring_index(k, "/", 1)).alias("host"), k.alias("key"))))
    return _with_verdict(cut.withColumn("rule", longest["key"]), blocking.listed(F.col("rule")))


def _with_verdict(cut: DataFrame, blocks: Column) -> DataFrame:
    return cut.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull() & blocks, F.lit(BLOCK)).otherwise(F.lit(ALLOW)).alias("verdict"))


def _judged_by_join(cut: DataFrame, keys: Column, rules: DataFrame) -> DataFrame:
    """The same rows for lists whose filters would be too large to go along with the plan: distinct URL parts meet the rules."""
    parts = cut.select("host", "path").distinct()
    found = (parts.select("host", "path", F.explode(keys).alias("key")).join(rules, "key")
             .groupBy("host", "path").agg(F.max_by(F.struct("key", "blocks"), F.struct(
                 F.length("key"), F.length(F.substring_index("key", "/", 1)), "key")).alias("r")))
    return _with_verdict(cut.join(found, ["host", "path"], "left").withColumn("rule", F.col("r.key")), F.coalesce("r.blocks", F.lit(False)))
