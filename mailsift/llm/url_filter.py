"""URL filters: rules by host and path, and a blocklist held as a Bloom filter cascade.

A cascade answers membership exactly for every key of the corpus. Level 1 is a
Bloom filter of the listed keys; level 2 one of the unlisted keys that level 1
lets through; level 3 one of the listed keys that level 2 lets through, and so
on until a level lets no wrong key through. A key is listed if the first level
that does not hold it is an even one. The levels are a few bits a key and go to
every task; no url is joined to the list.

Should the filters of a list exceed ``BROADCAST_BYTES``, the keys are joined to
the list by a shuffle instead; same answers.

Defined cases: null urls and urls without ``://`` have empty host and path and
are allowed unless the empty key is listed; an empty list lists nothing;
repeated keys count once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsift.llm.common import BROADCAST_BYTES, Work

# Rules: host and path prefix, and the verdict.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
# Names of sites that a list of unwanted hosts takes in, with any prefix or ending.
UNWANTED = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
_MASK = (1 << 62) - 1  # leaves room for the steps
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host_: Column, path_: Column, rules=RULES) -> Column:
    """The longest rule that fits (of equals the first by code point), as a struct (rule, verdict), or null."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in reversed(ordered):
        site, _, rest = rule.partition("/")
        fits = ((host_ == site) | F.endswith(host_, F.lit("." + site))) & F.startswith(path_, F.lit("/" + rest))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


@dataclass
class Level:
    """A Bloom filter: ``hashes`` probes into ``bits`` bits."""

    words: np.ndarray
    bits: int
    hashes: int

    def holds(self, keys: np.ndarray) -> np.ndarray:
        step = (keys.view(np.uint64) >> np.uint64(32)) | np.uint64(1)
        a = (keys & _MASK).view(np.uint64)
        found = np.ones(len(a), bool)
        for i in range(self.hashes):
            at = (a + np.uint64(i) * step) % np.uint64(self.bits)
            found &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found


def _shape(count: int, rate: float) -> tuple[int, int]:
    hashes = max(1, round(-np.log2(rate)))
    return max(64, int(np.ceil(-count * np.log(rate) / np.log(2) ** 2))), hashes


def _level_hash(key: Column, level: int) -> Column:
    return F.xxhash64(key, F.lit(level))


class Cascade:
    """Built over all keys of a corpus; ``universe`` has the columns key and listed."""

    def __init__(self, universe: DataFrame, max_bytes: int = BROADCAST_BYTES):
        self.work = work = Work(universe.sparkSession)
        keys = work.keep(universe.groupBy(F.coalesce("key", F.lit("")).alias("key")).agg(F.max("listed").alias("listed")))
        self.levels: list[Level] = []
        self.listed = keys.where("listed").select("key")
        inside, outside = self.listed, keys.where("NOT listed").select("key")
        count, others = inside.count(), outside.count()
        used = 0
        while count:
            # The first level lets through about as many wrong keys as there are listed ones.
            rate = min(0.5, max(count / max(others, 1), 1e-6)) if not self.levels else 0.5
            bits, hashes = _shape(count, rate)
            used += bits // 8
            if used > max_bytes:
                self.levels = None
                return
            self.levels.append(self._encode(inside, bits, hashes))
            wrong = work.keep(outside.where(self._holds(F.col("key"), len(self.levels) - 1)))
            inside, outside = wrong, inside
            others, count = count, wrong.count()

    def _encode(self, keys: DataFrame, bits: int, hashes: int) -> Level:
        """Set the bits of all keys, one row per word of 64; their number is bounded by ``max_bytes``."""
        step = F.shiftrightunsigned("h", 32).bitwiseOR(F.lit(1))
        probes = [(F.col("h").bitwiseAND(F.lit(_MASK)) + step * i) % F.lit(bits) for i in range(hashes)]
        at = keys.select(_level_hash(F.col("key"), len(self.levels)).alias("h")).select(F.explode(F.array(*probes)).alias("at"))
        bit = F.expr("shiftleft(1L, cast(at % 64 as int))")
        rows = at.groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
        words = np.zeros(-(-bits // 64), np.int64)
        words[[r.word for r in rows]] = [r.bits for r in rows]
        return Level(words.view(np.uint64), bits, hashes)

    def _holds(self, key: Column, number: int) -> Column:
        level = self.levels[number]

        @F.pandas_udf("boolean")
        def holds(hashes: pd.Series) -> pd.Series:
            return pd.Series(level.holds(hashes.to_numpy(np.int64, copy=True)))

        return holds(_level_hash(key, number))

    def is_listed(self, df: DataFrame, key: Column, name: str = "listed") -> DataFrame:
        """``df`` with a boolean column that says whether the key is listed."""
        key = F.coalesce(key, F.lit(""))
        if self.levels is None:
            marks = self.listed.select(F.col("key").alias("_listed_key"))
            return df.join(marks, key == F.col("_listed_key"), "left").withColumn(name, F.col("_listed_key").isNotNull()).drop("_listed_key")
        levels = self.levels
        if not levels:
            return df.withColumn(name, F.lit(False))

        @F.pandas_udf("boolean")
        def listed(*hashes: pd.Series) -> pd.Series:
            answer = np.full(len(hashes[0]), len(levels) % 2 == 1)
            open_ = np.ones(len(answer), bool)
            for number, (level, column) in enumerate(zip(levels, hashes)):
                out = open_ & ~level.holds(column.to_numpy(np.int64, copy=True))
                answer[out] = number % 2 == 1
                open_ &= ~out
            return pd.Series(answer)

        return df.withColumn(name, listed(*[_level_hash(key, i) for i in range(len(levels))]))


def unwanted_hosts(hosts: DataFrame, names=UNWANTED) -> DataFrame:
    """The universe of hosts (key), each marked as listed or not."""
    pattern = r"(^|\.)(" + "|".join(names) + r")\."
    return hosts.select("key", F.col("key").rlike(pattern).alias("listed"))


def judge(pages: DataFrame, url_col: str = "url", rules=RULES, universe: DataFrame | None = None) -> DataFrame:
    """``pages`` with host, path, rule and verdict (columns of these names give way)."""
    own = ("host", "path", "rule", "verdict")
    url = F.col(url_col).cast("string")
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in own]
    parsed = pages.select(F.struct(*kept).alias("row"), host(url).alias("host"), path(url).alias("path"))
    if universe is None:
        universe = unwanted_hosts(parsed.select(F.col("host").alias("key")).distinct())
    marked = Cascade(universe).is_listed(parsed, F.col("host"), "_listed")
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    return marked.withColumn("_rule", rule).select(
        "row.*", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("_listed"), "block").otherwise("allow")).alias("verdict"),
    )
