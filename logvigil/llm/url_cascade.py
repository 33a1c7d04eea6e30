"""URL filters by a Bloom filter cascade, in built-in functions only.

Every url asks for the keys that could decide it: each host suffix with as many labels as some rule has, joined to
each path start as long as some rule's path. The distinct keys of the whole corpus are the universe. Level 0 of a
cascade holds the listed keys; level 1 holds the universe's keys that level 0 takes wrongly; level 2 the listed keys
that level 1 takes wrongly; and so on until a level takes none wrongly. Over the universe the answer is exact, and
judging a url takes bit tests only: no join and no shuffle.

The filters are literals of the plan. ``max_bytes`` bounds them: n listed keys take 1.44 log2(1/rate) bits each, and later
levels shrink. A list beyond the bound is looked up by a shuffled join on the same keys instead.

A url asks only for keys that it can form, so no null key meets a filter. Null urls and urls without ``://`` have an empty host and path, match no rule and get the default verdict, as do keys
that no list has. Repeated urls get equal verdicts; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

MAX_BYTES = 8 << 20


@dataclass(frozen=True)
class Level:
    words: tuple[int, ...]  # 64 bits each, signed
    probes: int

    def takes(self, key: Column, salt: int) -> Column:
        """Whether all bits of the key are set."""
        bits = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")  # folded to one literal

        def test(at: Column) -> Column:
            return F.getbit(F.get(bits, (at / 64).cast("int")), (at % 64).cast("int")) == 1

        return reduce(Column.__and__, [test(p) for p in positions(key, salt, self.probes, 64 * len(self.words))])


def positions(key: Column, salt: int, probes: int, bits: int) -> list[Column]:
    """Double hashing: ``probes`` bit positions of a key."""
    first, step = F.xxhash64(key, F.lit(salt)), F.xxhash64(F.lit(salt), key)
    spread = lambda h: F.pmod(h, F.lit(bits).cast("bigint"))
    return [spread(spread(first) + F.lit(i).cast("bigint") * spread(step)) for i in range(probes)]


def build_level(keys: DataFrame, n: int, rate: float, salt: int) -> Level:
    """One Bloom filter over ``keys`` (column ``key``): the bits are set by a distributed aggregation, one row a word."""
    bits = max(64, 64 * math.ceil(n * 1.4427 * math.log2(1 / rate) / 64))
    probes = max(1, round(math.log2(1 / rate)))
    at = keys.select(F.explode(F.array(*positions(F.col("key"), salt, probes, bits))).alias("at"))
    rows = at.groupBy((F.col("at") / 64).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("b")).collect()
    words = [0] * (bits // 64)
    for r in rows:
        words[r.w] = r.b
    return Level(tuple(words), probes)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """Exact membership for every key of the universe: the first level that refuses the key decides."""
        out = F.lit(len(self.levels) % 2 == 1)  # taken by all: in the set of the last level
        for i in reversed(range(len(self.levels))):
            out = F.when(self.levels[i].takes(key, i), out).otherwise(F.lit(i % 2 == 1))
        return out

    @property
    def bytes(self) -> int:
        return 8 * sum(len(x.words) for x in self.levels)


def build_cascade(universe: DataFrame, listed: DataFrame, rates: tuple[float, float] = (0.02, 0.5), max_bytes: int = MAX_BYTES) -> Cascade | None:
    """The cascade that tells ``listed`` from the rest of ``universe`` (both distinct, column ``key``).

    ``rates``: false positives of level 0 and of the later ones. None if the filters would pass ``max_bytes``.
    """
    inside, n = listed, listed.count()
    if n * 1.4427 * math.log2(1 / rates[0]) / 8 > max_bytes:
        return None
    outside = universe.join(listed, "key", "left_anti")
    levels: list[Level] = []
    while n:
        level = build_level(inside, n, rates[min(len(levels), 1)], len(levels))
        levels.append(level)
        taken = stored(outside.filter(level.takes(F.col("key"), len(levels) - 1)), "cascade")
        inside, outside, n = taken, inside, taken.count()
        if Cascade(tuple(levels)).bytes + n / 4 > max_bytes:
            return None
    return Cascade(tuple(levels))


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty for null or where ``://`` is missing."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), upper, upper.lower())
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """(labels of the host, length of the path) that occur in the rules. Their number is bounded by the longest host times the longest
    path, whatever the number of rules."""
    labels = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1
    return sorted((r[0], r[1]) for r in rules.select(labels, F.length("path")).distinct().collect())


def asked(host: Column, path: Column, of: list[tuple[int, int]]) -> Column:
    """Array of (key, n: its length, h: its host's length) for every shape of a rule that could fit the url.

    The shapes are one literal, so that the plan is the same for one shape and for a thousand."""
    have = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    every = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(n).alias("n")) for k, n in of])

    def one(s: Column) -> Column:
        suffix = F.call_function("substring_index", host, F.lit("."), F.negative(s["k"]))
        return F.struct(F.concat(suffix, F.substring(path, F.lit(1), s["n"])).alias("key"), (F.length(suffix) + s["n"]).alias("n"), F.length(suffix).alias("h"))

    fits = F.filter(every, lambda s: (have >= s["k"]) & (F.length(host) > 0) & (F.length(path) >= s["n"]))
    return F.transform(fits, one)


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", max_bytes: int = MAX_BYTES) -> DataFrame:
    """``pages`` with host, path, rule and verdict. ``rules``: (host, path, verdict allow or block), a path starting with ``/``.

    The longest rule wins, on a tie the one with the longer host, then ``block``. Every key of a url is tested by one higher-order
    function, so the plan grows with the levels of the cascades (about the logarithm of the list), not with the rules' shapes.
    """
    clean = rules.select(F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").filter("host <> ''").distinct()
    of = shapes(clean)
    base = pages.drop("host", "path", "rule", "verdict")
    host, path = parts(base[url_col])
    base = base.withColumns({"host": host, "path": path})
    if not of:
        return base.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    keys = asked(F.col("host"), F.col("path"), of)
    universe = stored(base.select("host", "path").distinct().select(F.explode(keys).alias("k")).select("k.key").distinct(), "universe")
    listed = {v: stored(clean.filter(F.col("verdict") == v).select(F.concat("host", "path").alias("key")).distinct(), "listed") for v in ("allow", "block")}
    cascades = {v: build_cascade(universe, k, max_bytes=max_bytes) for v, k in listed.items()}
    if None in cascades.values():
        return _judge_by_join(base, clean, keys, default)

    def hits(verdict: str, cascade: Cascade) -> Column:
        inside = F.filter("_keys", lambda k: cascade.contains(k["key"]))
        return F.transform(inside, lambda k: F.struct(k["n"].alias("n"), k["h"].alias("h"), F.lit(verdict).alias("verdict"), k["key"].alias("rule")))

    found = [hits(v, c) for v, c in cascades.items() if c.levels]
    best = F.array_max(F.concat(*found)) if found else F.lit(None).cast("struct<n:int,h:int,verdict:string,rule:string>")
    out = base.withColumn("_keys", keys).withColumn("_best", best)
    return out.withColumns({"rule": F.col("_best.rule"), "verdict": F.coalesce(F.col("_best.verdict"), F.lit(default))}).drop("_best", "_keys")


def _judge_by_join(base: DataFrame, clean: DataFrame, keys: Column, default: str) -> DataFrame:
    """For lists beyond the filters' bound: distinct (host, path) pairs are resolved by a shuffled join and joined back."""
    asks = base.select("host", "path").distinct().select("host", "path", F.explode(keys).alias("a")).select("host", "path", "a.*")
    listed = clean.select(F.concat("host", "path").alias("key"), "verdict")
    best = asks.join(listed, "key").groupBy("host", "path").agg(F.max(F.struct("n", "h", "verdict", F.col("key").alias("rule"))).alias("_best"))
    out = base.join(best, ["host", "path"], "left").select(*base.columns, "_best")
    return out.withColumns({"rule": F.col("_best.rule"), "verdict": F.coalesce(F.col("_best.verdict"), F.lit(default))}).drop("_best")


#: The rules of the query.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]

_RULE_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
URL_SQL = rf"""with r(rh, rp, rv) as (values {_RULE_SQL}),
u as (select page_id, case when strpos(coalesce(url, ''), '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as (select page_id, translate(regexp_extract(rest, '(?s)^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) as path from u)
select page_id, host, path, (select rh || rp from r where (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) order by length(rh || rp) desc limit 1) as rule,
coalesce((select rv from r where (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) order by length(rh || rp) desc limit 1), 'allow') as verdict from p"""
