"""URL filters by rules and an exact Bloom filter cascade, in DataFrame functions alone.

Level 1 of the cascade is a Bloom filter of the listed keys. Level 2 holds the keys of the universe that level 1 takes
for listed though they are not (only what level 1 takes is held against the list), level 3 the listed keys that level 2
takes for those, and so on until no key is taken wrongly. For any key of the universe the first level that says no
decides, and it is right: membership is exact, tested row by row without a join. Levels are arrays of 64-bit words read
through scalar subqueries. A filter is kept below ``FILTER_BYTES``: with more keys, listed or taken wrongly, the keys are
dealt by their hash to several cascades.

For hosts the keys are domains: the universe has every domain above a host of the corpus that has no more labels than the
longest listed one, and a host is tested by each of its own.
"""

from __future__ import annotations

import functools
import math
import operator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.frames import kept_table, narrow

#: (bits for a key, hashes) of the first level and of those after it.
FIRST_LEVEL, LATER_LEVELS = (10, 7), (4, 3)
FILTER_BYTES = 16 << 20
#: The share of unlisted keys that the first level takes, rounded up.
FIRST_WRONG = 0.01
MAX_LEVELS = 40


@dataclass
class Level:
    words: DataFrame
    n_words: int
    hashes: int
    seed: int

    def holds(self, key: Column) -> Column:
        words, found = self.words.scalar(), F.lit(True)
        for at in self.places(key):
            word = F.get(words, F.shiftright(at, 6).cast("int"))
            found = found & (F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return found

    def places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.seed), F.lit(j)), F.lit(64 * self.n_words)) for j in range(self.hashes)]


@dataclass
class Cascade:
    """parts: for each share of the keys its levels."""

    parts: list[list[Level]] = field(default_factory=list)

    def listed(self, key: Column | str) -> Column:
        """Whether the key, one of the universe, is listed; null is not."""
        key = F.col(key) if isinstance(key, str) else key
        share = F.pmod(F.xxhash64(F.lit("share"), key), F.lit(len(self.parts)))
        verdict = functools.reduce(lambda rest, i: F.when(share == i, self._decided(self.parts[i], key)).otherwise(rest), range(len(self.parts)), F.lit(False))
        return F.coalesce(key.isNotNull() & verdict, F.lit(False))

    @staticmethod
    def _decided(levels: list[Level], key: Column) -> Column:
        """The first level that says no: an odd one means not listed, an even one listed."""
        verdict = F.lit(len(levels) % 2 == 1)
        for number in range(len(levels), 0, -1):
            verdict = F.when(~levels[number - 1].holds(key), F.lit(number % 2 == 0)).otherwise(verdict)
        return verdict


def _level(keys: DataFrame, n_keys: int, shape: tuple[int, int], seed: int) -> Level:
    """A Bloom filter of the keys: set bits are put together word by word before and after the shuffle."""
    bits, hashes = shape
    level = Level(None, max(1, math.ceil(n_keys * bits / 64)), hashes, seed)
    at = keys.select(F.explode(F.array(*level.places(F.col("key")))).alias("at"))
    set_bits = at.select(F.shiftright("at", 6).alias("i"), F.expr("shiftleft(1L, int(at & 63))").alias("word"))
    empty = keys.sparkSession.range(level.n_words).select(F.col("id").alias("i"), F.lit(0).cast("bigint").alias("word"))
    words = set_bits.union(empty).groupBy("i").agg(F.bit_or("word").alias("word"))
    row = words.agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("all")).select(F.col("all.word").alias("words"))
    level.words = kept_table(row, "bloom")
    return level


def build_cascade(universe: DataFrame) -> Cascade:
    """universe: every key that will be asked for (``key``, distinct and not null) and whether it is ``listed``."""
    return cascade_of(universe.where("listed").select("key"), universe.select("key"))


def cascade_of(listed: DataFrame, universe: DataFrame) -> Cascade:
    """listed: the keys of the list, in the universe or not; universe: every key that will be asked for. Both have distinct keys
    that are not null, in ``key``."""
    n_listed, n_asked = listed.count(), universe.count()
    bits = max(n_listed * FIRST_LEVEL[0], n_asked * FIRST_WRONG * LATER_LEVELS[0])
    shares = max(1, math.ceil(bits / 8 / FILTER_BYTES))
    cascade = Cascade()
    for share in range(shares):
        inside, asked = (keys.where(F.pmod(F.xxhash64(F.lit("share"), F.col("key")), F.lit(shares)) == share) for keys in (listed, universe))
        levels, n = [], inside.count()
        while n:
            if len(levels) == MAX_LEVELS:
                raise ValueError("the cascade does not end: the list holds a key that it does not hold")
            levels.append(_level(inside, n, LATER_LEVELS if levels else FIRST_LEVEL, len(levels)))
            taken = asked.where(levels[-1].holds(F.col("key")))
            # after the first level both sides are known: listed keys, and those that it took wrongly
            wrong = kept_table(taken.join(inside, "key", "left_anti") if len(levels) == 1 else taken, "cascade")
            inside, asked, n = wrong, inside, wrong.count()
        cascade.parts.append(levels)
    return cascade


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path. Host: after the first :// up to /, ? or # or the end, A-Z lower-cased; path: then up to ? or # or the
    end. Both are empty for null and for a url without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def parent_domains(host: Column, labels: int) -> list[Column]:
    """The domains of one to ``labels`` labels above the host, itself included; the host where it has fewer."""
    return [F.substring_index(host, ".", -n) for n in range(1, labels + 1)]


def judge(pages: DataFrame, rules: list[Rule], domains: DataFrame, url: str = "url", key: str = "page_id") -> DataFrame:
    """page key, host, path, the longest rule that fits, and the verdict: the rule's, else block for a host that is listed or
    lies below a listed domain, else allow. ``domains``: the listed domains, one column ``domain``.

    Null urls and urls without :// have an empty host, which no list holds: allow. Equally long rules that fit: the first
    in the list. Repeated rows are judged each; an empty table gives none; null and repeated domains are passed over;
    other columns are not carried.
    """
    host, path = split_url(F.col("url"))
    rows = narrow(pages, page_id=key, url=url).withColumns({"host": host, "path": path})
    keys = domains.where("domain <> ''").select(F.col("domain").alias("key")).distinct()
    labels = keys.agg(F.max(F.size(F.split("key", r"\."))).alias("n")).first()["n"] or 0
    listed = F.lit(False)
    if labels:
        above = parent_domains(F.col("host"), labels)
        hosts = rows.where("host <> ''").select("host").distinct()
        universe = kept_table(hosts.select(F.explode(F.array_distinct(F.array(*above))).alias("key")).distinct(), "domains")
        cascade = cascade_of(kept_table(keys, "listed"), universe)
        listed = (F.col("host") != "") & functools.reduce(operator.or_, [cascade.listed(domain) for domain in above])
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):  # the last that fits wins
        fits = ((F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host))) & F.startswith("path", F.lit(r.path))
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    verdict = F.coalesce(verdict, F.when(listed, "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
