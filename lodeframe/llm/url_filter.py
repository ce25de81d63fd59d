"""URL filters by a cascade of Bloom filters.

Listed keys and the complete universe of keys that the corpus can ask for are both known when the
filter is built. Level 0 holds the listed keys. Level 1 holds the universe's keys that level 0 lets
through by mistake, level 2 the listed keys that level 1 lets through, and so on until no mistake is
left. A key of the universe is listed exactly if the number of levels it passes in a row is odd. The
levels are constants of the plan: judging urls needs no join and no shuffle.

A url can only ask for keys of the shapes that the rules have: its last n labels, for each label
count n in the rules, followed by the path's first m characters, for each path length m in the rules.
So the universe has at most (label counts x path lengths) keys a url.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written

#: The driver holds a level's bits and the plan carries them; a larger level is refused (see `build_cascade`).
MAX_LEVEL_BYTES = 1 << 18
MIN_BITS, MAX_HASHES, MAX_LEVELS = 4096, 32, 64


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


#: The rules of the production query: fixed values.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def url_host(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)")).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)")).otherwise("")
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, rules) -> Column:
    """array<string>: every key that a rule of one of the rules' shapes could have and fit this url."""
    labels = F.split(host, r"\.", -1)
    keys = []
    for n in sorted({r.host.count(".") + 1 for r in rules}):
        suffix = F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n), ".")
        for m in sorted({len(r.path) for r in rules}):
            keys.append(F.when((F.size(labels) >= n) & (F.length(path) >= m), F.concat(suffix, F.substring(path, 1, m))))
    return F.array_distinct(F.array_compact(F.array(*keys)))


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    depth: int
    words: tuple[int, ...]

    def passes(self, key: Column) -> Column:
        table = F.expr(f"array({','.join(f'{w}L' if w > -(1 << 63) else 'shiftleft(1L, 63)' for w in self.words)})")
        out = F.lit(True)
        for at in positions(key, self.bits, self.hashes, self.depth):
            word = F.element_at(table, (F.shiftright(at, 6) + 1).cast("int"))
            out = out & (F.call_function("shiftrightunsigned", word, (at % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1)
        return out


def positions(key: Column, bits: int, hashes: int, depth: int) -> list[Column]:
    """Double hashing: the i-th position is (a + i * b) mod bits.

    The hashes differ by depth: with the same ones, keys that collide on one level would collide on all.
    """
    a, b = F.xxhash64(F.lit(2 * depth + 1), key), F.xxhash64(F.lit(2 * depth + 2), key)
    return [F.pmod(F.shiftright(a, 8) + F.lit(i) * F.shiftright(b, 8), F.lit(bits)).cast("long") for i in range(hashes)]


def build_level(keys: DataFrame, count: int, miss: float, depth: int) -> Level:
    """A Bloom filter of the column `key`, built by one aggregation over 64-bit words."""
    count = max(1, count)
    bits = max(MIN_BITS, 64 * math.ceil(-count * math.log(miss) / math.log(2) ** 2 / 64))
    if bits // 8 > MAX_LEVEL_BYTES:
        raise ValueError(f"a level of {bits // 8} bytes is over MAX_LEVEL_BYTES")
    hashes = min(MAX_HASHES, max(1, round(bits / count * math.log(2))))
    at = keys.select(F.explode(F.array(*positions(F.col("key"), bits, hashes, depth))).alias("at"))
    rows = at.groupBy(F.shiftright("at", 6).cast("int").alias("word")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("v")).collect()
    words = [0] * (bits // 64)
    for r in rows:
        words[r["word"]] = r["v"]
    return Level(bits, hashes, depth, tuple(words))


def build_cascade(listed: DataFrame, universe: DataFrame, miss: float | None = None, deeper: float = 0.5) -> list[Level]:
    """Levels for the listed keys against the universe (both: one string column `key`, distinct).

    Each later level is built from what the one before lets through: about miss x universe keys, then
    shrinking by `deeper`. By default miss is one in the universe's size, so level 0 takes about
    1.5 x log2(universe) bits a listed key and the later levels hold next to nothing, at any size of the
    corpus. A level over MAX_LEVEL_BYTES raises; that takes some 50,000 listed keys. Mistakes left
    after MAX_LEVELS raise too: a cascade is exact or is not built.
    """
    miss = miss or 1.0 / max(100, universe.count())
    inside = listed
    outside = universe.join(listed, "key", "left_anti")
    levels: list[Level] = []
    count = inside.count()
    while count:
        if len(levels) == MAX_LEVELS:
            raise ValueError(f"mistakes are left after {MAX_LEVELS} levels")
        level = build_level(inside, count, miss if not levels else deeper, len(levels))
        levels.append(level)
        inside, outside = written(outside.where(level.passes(F.col("key"))), "false"), inside
        count = inside.count()
    return levels


def member(levels: list[Level], key: Column) -> Column:
    """True exactly if a key of the universe is listed."""
    out = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        out = F.when(levels[i].passes(key), out).otherwise(F.lit(i % 2 == 1))
    return out


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", otherwise: str = "allow",
          miss: float | None = None) -> DataFrame:
    """One row per input row: id_col, host, path, rule, verdict.

    One cascade holds the keys of the block rules, one those of the allow rules; the longest key that
    either lists is the rule that counts. Where none is listed the url is on no list and gets
    `otherwise`. Defined results: a null url, or one without "://", has an empty host and path and fits
    no rule; an empty table gives no rows; repeated rows are judged alike; other columns are ignored.
    """
    urls = pages.select(F.col(id_col).alias("__id"), F.coalesce(F.col(url_col), F.lit("")).alias("__url"))
    split = urls.select("__id", url_host(F.col("__url")).alias("host"), url_path(F.col("__url")).alias("path"))
    keyed = split.withColumn("__keys", candidate_keys(F.col("host"), F.col("path"), rules))
    universe = written(keyed.select(F.explode("__keys").alias("key")).distinct(), "universe")
    spark = pages.sparkSession
    cascades = {}
    for verdict in ("allow", "block"):
        keys = sorted({r.key for r in rules if r.verdict == verdict})
        listed = spark.range(1).select(F.explode(F.array(*[F.lit(k) for k in keys])).alias("key")) if keys \
            else universe.limit(0)
        cascades[verdict] = build_cascade(listed, universe, miss)
    best = F.array_max(F.transform(
        F.filter("__keys", lambda x: member(cascades["allow"], x) | member(cascades["block"], x)),
        lambda x: F.struct(F.length(x).alias("n"), x.alias("key"))))
    found = keyed.withColumn("rule", best["key"])
    verdict = F.when(F.col("rule").isNull(), F.lit(otherwise)) \
        .when(member(cascades["block"], F.col("rule")), F.lit("block")).otherwise(F.lit("allow"))
    return found.select(F.col("__id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))
