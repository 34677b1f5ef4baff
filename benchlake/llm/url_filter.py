"""URL filters: a Bloom filter cascade gives exact membership of url keys in rule lists.

A rule is a host with a path prefix; it fits its host, every subdomain, and every path that
starts with the prefix.  A url therefore has few candidate keys: each suffix of its host with
each path prefix of a length that occurs in the rules.  The candidate keys of all urls are the
complete key universe.  Level 0 of the cascade encodes the listed keys, level 1 the keys of the
universe that level 0 passes wrongly, level 2 the listed keys that level 1 passes wrongly, and so
on until a level passes nothing wrongly.  Membership is then decided by the first level that
turns a key away, without a join and exactly for every key of the universe.

Level 0's rate of false positives is chosen so that about as many wrong keys pass as are listed,
so every level and the whole cascade follow the size of the list and only the logarithm of the
universe.  The filters are gathered as bit words, and their bytes are checked against
``max_filter_bytes`` before any is used; a longer list is matched by a shuffled join of the
candidate keys instead.

DataFrame code throughout.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import materialise

MAX_FILTER_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for NULL or without '://'."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "(?s)^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """Array of the keys of rules that could fit, longest rule first: every host suffix at a dot
    with every path prefix of the given lengths (a shorter path has no such prefix)."""
    labels = F.split(host, "\\.")
    suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    prefixes = F.array_compact(F.array(*[
        F.when(F.char_length(path) >= n, F.substring(path, 1, n)) for n in sorted(set(lengths), reverse=True)]))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    keys = F.array_sort(keys, lambda a, b: F.when(F.char_length(a) != F.char_length(b), F.char_length(b) - F.char_length(a))
                        .when(a < b, -1).when(a > b, 1).otherwise(0))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(keys)


def _bits(key: Column, level: int, size: int, hashes: int) -> list[Column]:
    """The positions of a key in a filter of ``size`` bits."""
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(size)) for i in range(hashes)]


class Filter:
    """One level: ``size`` bits in words of 32, as a literal array."""

    def __init__(self, keys: DataFrame, n: int, rate: float, level: int):
        per_key = max(1.0, -math.log(rate) / math.log(2) ** 2)
        self.level, self.size = level, max(64, math.ceil(n * per_key))
        self.hashes = max(1, round(per_key * math.log(2)))
        at = keys.select(F.explode(F.array(*_bits(F.col("key"), level, self.size, self.hashes))).alias("bit"))
        words = at.groupBy(F.floor(F.col("bit") / 32).cast("int").alias("w")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 32).cast("int"))).alias("x"))
        table = [0] * (self.size // 32 + 1)
        for w, x in words.collect():  # at most size / 32 rows, within the checked bound
            table[w] = x
        self.words = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")

    def passes(self, key: Column) -> Column:
        """Whether a key may be encoded (never false for an encoded key)."""
        hit = F.lit(True)
        for bit in _bits(key, self.level, self.size, self.hashes):
            word = F.get(self.words, F.floor(bit / 32).cast("int"))
            hit = hit & (F.call_function("shiftright", word, (bit % 32).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return hit


def filter_bytes(listed: int, universe: int) -> int:
    """Bytes that the cascade takes at most, by its first level and the geometric rest."""
    rate = first_rate(listed, universe)
    return math.ceil(listed * (1.5 - math.log2(rate) * 1.5 + 8) / 8) + 1024


def first_rate(listed: int, universe: int) -> float:
    """False-positive rate of level 0: about ``listed`` wrong keys of the universe pass."""
    return min(0.5, max(1, listed) / max(1, universe) / math.sqrt(2))


def build(listed: DataFrame, universe: DataFrame, max_levels: int = 64) -> list[Filter]:
    """The cascade of ``listed`` keys over ``universe`` (both one column ``key``, distinct)."""
    inside, levels = materialise(listed.join(universe, "key", "left_semi")), []
    n, total = inside.count(), universe.count()
    if not n:
        return levels
    first = Filter(inside, n, first_rate(n, total), 0)
    levels.append(first)
    wrong = materialise(universe.where(first.passes(F.col("key"))).join(inside, "key", "left_anti"))
    encode, other = wrong, inside  # the next level encodes ``encode``; ``other`` may pass it wrongly
    while m := encode.count():
        if len(levels) == max_levels:
            raise RuntimeError(f"the cascade doesn't end within {max_levels} levels")
        level = Filter(encode, m, 0.5, len(levels))
        levels.append(level)
        encode, other = materialise(other.where(level.passes(F.col("key")))), encode
    return levels


def member(key: Column, levels: list[Filter]) -> Column:
    """Whether a key of the universe is listed: the first level that turns it away decides."""
    out = F.lit(len(levels) % 2 == 1)
    for i, level in reversed(list(enumerate(levels))):
        out = F.when(~level.passes(key), F.lit(i % 2 == 1)).otherwise(out)
    return out


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], default: str = "allow", url: str = "url",
          max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """One row per page: page_id, host, path, rule (or NULL) and verdict.

    ``rules``: pairs (verdict, host/path prefix), verdict allow or block.  The longest fitting rule wins; a url that no rule
    fits isn't listed and gets ``default``.  A rule listed with both verdicts, or without a path, is an error.

    * NULL url or no '://': empty host and path, no rule.  Urls of any length, repeated urls and
      rows are judged alike; a NULL page_id stays NULL.
    * Only page_id and the url are read; other columns may have any name.  Empty tables give no rows.
    """
    keys = {}
    for verdict, rule in rules:
        if verdict not in ("allow", "block") or "/" not in rule:
            raise ValueError(f"not a rule: {verdict} {rule}")
        if keys.setdefault(rule, verdict) != verdict:
            raise ValueError(f"{rule} has two verdicts")
    lengths = sorted({len(rule) - rule.index("/") for rule in keys}) or [1]
    spark = pages.sparkSession
    host, path = parts(F.col(url))
    rows = pages.select("page_id", F.explode(F.array(F.struct(host.alias("host"), path.alias("path")))).alias("u")).select(
        "page_id", "u.host", "u.path")
    listed = {v: spark.createDataFrame([(k,) for k, x in sorted(keys.items()) if x == v], "key string") for v in ("allow", "block")}
    universe = materialise(rows.select(F.explode(candidate_keys(F.col("host"), F.col("path"), lengths)).alias("key")).distinct())
    if sum(filter_bytes(len(keys), 1 << 40) for _ in listed) > max_filter_bytes:
        return _joined(rows, keys, listed, lengths, default)
    cascades = {v: build(x, universe) for v, x in listed.items()}
    cand = candidate_keys(F.col("host"), F.col("path"), lengths)
    rows = rows.withColumn("c", F.explode(F.array(cand)))
    first = lambda v: F.get(F.filter("c", lambda k: member(k, cascades[v])), F.lit(0))
    rows = rows.select("page_id", "host", "path", F.explode(F.array(F.struct(first("allow").alias("a"), first("block").alias("b")))).alias("r"))
    a, b = F.col("r.a"), F.col("r.b")
    wins = F.when(b.isNull() | (F.char_length(a) > F.char_length(b)), a).otherwise(b)
    verdict = F.when(a.isNull() & b.isNull(), F.lit(default)).when(wins.eqNullSafe(a), F.lit("allow")).otherwise(F.lit("block"))
    return rows.select("page_id", "host", "path", wins.alias("rule"), verdict.alias("verdict"))


def _joined(rows, keys, listed, lengths, default):
    """The way for lists beyond the filter bound: distinct urls' candidates joined with the rules."""
    rules = listed["allow"].withColumn("verdict", F.lit("allow")).unionByName(listed["block"].withColumn("verdict", F.lit("block")))
    urls = rows.select("host", "path").distinct()
    found = (urls.select("host", "path", F.explode(candidate_keys(F.col("host"), F.col("path"), lengths)).alias("key"))
             .join(rules, "key").groupBy("host", "path")
             .agg(F.max(F.struct(F.char_length("key"), "key", "verdict")).alias("best")))
    out = rows.join(found, ["host", "path"], "left")
    return out.select("page_id", "host", "path", F.col("best.key").alias("rule"),
                      F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
