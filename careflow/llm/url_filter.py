"""URL filters by Bloom filter cascades, in DataFrame functions only.

A rule is a host and the start of a path; it fits that host and its subdomains. The keys of a URL
are its host's suffixes joined to its path's starts, of the label counts and path lengths that the
lists have, so "does a rule fit" is "is a key in the list", and the longest listed key is the rule.

A cascade answers that exactly for every key of the corpus, without a join. Its first filter holds
the listed keys; the corpus's keys that pass it without being listed, its false positives, go into
a second filter; the listed keys that pass the second into a third; and so on until a filter lets
nothing through that it should not. A key is listed if the number of filters it passes before the
first that it fails is odd. What is compared with the corpus passes the first filter before it is
shuffled, and that filter has enough sections for the corpus's number of keys to let through about
as many false keys as there are listed ones: the lists bound the filters, not the corpus.

A filter is an array of 64-bit words in sections of its own; a key sets, in one word of every
section, the four bits that its hash names, and passes if they are all set. So a test is a handful
of integer operations inside generated code. The arrays reach the tasks as scalar subqueries. A
list with more than ``max_filter_keys`` keys is dealt by hash into as many cascades as keep each
below that bound (one filter: 13 MB at most); a key looks into its own cascade alone.

Verdicts: the longest fitting rule's; where none fits, block if the host or a domain above it is
in ``listed`` and allow if not.

Defined cases: a NULL url, or one without ``://``, has an empty host and path, fits no rule and is
allowed; ports and user names are part of the host, as the contract cuts it; repeated rows are
judged alike; NULL and repeated list entries count not at all and once, as do rules that no URL can
fit (an empty host, a slash in it, a path that does not begin with one); equally long rules go to
the longer host; a rule that is listed both ways blocks; an empty table gives no rows and an empty
list fits nothing; columns of the input beside id and url are left behind.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.llm.common import stage

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


MASK_BITS = 4       # bits that a key sets in a word
KEY_BITS = 16       # bits of a section for each key: passes 1 of 300 other keys
SECTION_WORTH = 8   # a section divides the false keys by about 2 ** 8


@dataclass(frozen=True)
class Params:
    max_filter_keys: int = 1 << 20  # keys of one cascade
    most_sections: int = 6          # of a first filter, from the corpus's number of keys
    later_sections: int = 1         # of the filters behind it


def in_list(spark: SparkSession, rows: Sequence[tuple], *names: str) -> DataFrame:
    """A small fixed list as a table made by the JVM."""
    made = [F.struct(*[F.lit(v).cast("string").alias(n) for v, n in zip(r, names)]) for r in rows]
    kind = "array<struct<" + ",".join(f"{n}:string" for n in names) + ">>"
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*made).cast(kind)))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


@dataclass(frozen=True)
class Shape:
    """The label counts and path lengths that occur together in lists: the keys worth asking."""

    kinds: tuple[tuple[int, int], ...]

    @staticmethod
    def of(rules: DataFrame) -> Shape:
        """Bounded by labels times path lengths of the list, never by its rows."""
        kinds = rules.select(F.size(F.split("host", r"\.", -1)).alias("labels"),
                             F.length("path").alias("chars")).distinct()
        return Shape(tuple(sorted((r["labels"], r["chars"]) for r in kinds.collect())))

    def keys(self, host: Column, path: Column) -> list[tuple[Column, Column]]:
        """(suffix of the host, key) of every kind; NULL where the URL is too short for it."""
        labels, out = F.size(F.split(host, r"\.", -1)), []
        for n, chars in self.kinds:
            suffix = F.substring_index(host, ".", -n)
            key = F.concat(suffix, F.substring(path, 1, chars))
            fits = (host != "") & (labels >= n) & (F.length(path) >= chars)
            out.append((suffix, F.when(fits, key)))
        return out


@dataclass
class Filter:
    """One Bloom filter: ``sections`` of ``words`` words, in a one-row table."""

    table: DataFrame
    words: int
    sections: int
    level: int

    @staticmethod
    def mask(key: Column) -> Column:
        """The bits that a key sets in its words."""
        h = F.xxhash64(key, F.lit(-1))
        bits = [F.call_function("shiftleft", F.lit(1).cast("long"),
                                F.shiftrightunsigned(h, 6 * j).bitwiseAND(F.lit(63)).cast("int"))
                for j in range(MASK_BITS)]
        return reduce(Column.bitwiseOR, bits)

    @staticmethod
    def places(key: Column, words: int, sections: int, level: int) -> list[Column]:
        """A key's word in every section. Each level hashes the key anew, so two keys that meet in
        one filter part in another."""
        return [(F.pmod(F.xxhash64(key, F.lit(level), F.lit(n)), F.lit(words)) + n * words).cast("int")
                for n in range(sections)]

    @staticmethod
    def build(keys: DataFrame, count: int, sections: int, level: int, name: str) -> Filter:
        words, key = max(1, -(-count * KEY_BITS // 64)), F.col("key")
        places = Filter.places(key, words, sections, level)
        bits = keys.select(F.explode(F.array(*places)).alias("w"), Filter.mask(key).alias("b"))
        # One row per word of one filter, which max_filter_keys bounds.
        every = keys.sparkSession.range(words * sections, numPartitions=1).select(
            F.col("id").cast("int").alias("w"), F.lit(0).cast("long").alias("b"))
        dense = bits.unionByName(every).groupBy("w").agg(F.bit_or("b").alias("b"))
        row = dense.agg(F.sort_array(F.collect_list(F.struct("w", "b"))).alias("x"))
        return Filter(stage(row.select(F.transform("x", lambda x: x["b"]).alias("bits")), name),
                      words, sections, level)

    def passes(self, key: Column, mask: Column) -> Column:
        bits = self.table.scalar()
        return reduce(Column.__and__, [F.bitwise_not(F.get(bits, w)).bitwiseAND(mask) == 0
                                       for w in self.places(key, self.words, self.sections, self.level)])


@dataclass
class Cascade:
    """Filters in turn: listed keys, their false positives, ..."""

    filters: list[Filter] = field(default_factory=list)

    def holds(self, key: Column, mask: Column) -> Column:
        """Whether a key of the corpus, with its ``Filter.mask``, is listed."""
        out = F.lit(len(self.filters) % 2 == 1)
        for n, f in reversed(list(enumerate(self.filters))):
            out = F.when(~f.passes(key, mask), F.lit(n % 2 == 1)).otherwise(out)
        return out

    @staticmethod
    def build(listed: DataFrame, universe: DataFrame, universe_rows: int, name: str, p: Params) -> Cascade:
        """``listed``: distinct keys, at most ``max_filter_keys``; ``universe``: every key of the
        corpus, repeats allowed, ``universe_rows`` its number or an upper bound."""
        out, n = Cascade(), listed.count()
        if not n:
            return out
        need = math.ceil(math.log2(max(universe_rows / n, 2)) / SECTION_WORTH)
        first = Filter.build(listed, n, min(need, p.most_sections), 0, f"{name}-0")
        out.filters.append(first)
        key = F.col("key")
        found = universe.where(first.passes(key, Filter.mask(key))).select("key", F.lit(False).alias("listed"))
        passed = stage(found.unionByName(listed.select("key", F.lit(True).alias("listed")))
                       .groupBy("key").agg(F.max("listed").alias("listed")), f"{name}-passed")
        # The keys to hold in the next filter, and those that should not pass it.
        inside, outside = passed.where("NOT listed").select("key"), passed.where("listed").select("key")
        while count := inside.count():
            level = len(out.filters)
            f = Filter.build(inside, count, p.later_sections, level, f"{name}-{level}")
            out.filters.append(f)
            inside, outside = outside.where(f.passes(key, Filter.mask(key))), inside
        return out


@dataclass
class Members:
    """Exact membership in a list of any size: one cascade, or several dealt by hash."""

    cascades: list[Cascade]

    def holds(self, key: Column, mask: Column) -> Column:
        mine = Members._deal(key, len(self.cascades))
        return reduce(lambda rest, n: F.when(mine == n, self.cascades[n].holds(key, mask)).otherwise(rest),
                      range(1, len(self.cascades)), self.cascades[0].holds(key, mask))

    @staticmethod
    def _deal(key: Column, parts: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts))

    @staticmethod
    def build(listed: DataFrame, universe: DataFrame, rows: int, name: str, p: Params) -> Members:
        """``listed`` (key) against the keys of ``universe`` (key), which has ``rows`` rows or fewer."""
        listed = listed.where("key IS NOT NULL").distinct()
        parts = -(-listed.count() // (p.max_filter_keys // 2 or 1)) or 1
        if parts > 1:  # read once for every part
            listed = stage(listed, f"{name}-keys")
        mine = Members._deal(F.col("key"), parts)
        return Members([Cascade.build(listed.where(mine == n), universe.where(mine == n), rows // parts + 1,
                                      f"{name}-{n}", p) for n in range(parts)])


def _universe(urls: DataFrame, shape: Shape) -> DataFrame:
    keys = [k for _, k in shape.keys(F.col("host"), F.col("path"))]
    return urls.select(F.explode(F.array(*keys).cast("array<string>")).alias("key")).where("key IS NOT NULL")


def _asked(urls: DataFrame, shape: Shape, members: Members) -> tuple[DataFrame, list[tuple[Column, Column]]]:
    """``urls`` with a column per key and one per mask, and every (key, whether it is listed)."""
    found = shape.keys(F.col("host"), F.col("path"))
    names = [f"k{n}" for n in range(len(found))]
    with_keys = urls.select("*", *[k.alias(n) for n, (_, k) in zip(names, found)])
    asked = with_keys.select("*", *[Filter.mask(F.col(n)).alias(f"m{n}") for n in names])
    return asked, [(F.col(n), F.col(n).isNotNull() & members.holds(F.col(n), F.col(f"m{n}"))) for n in names]


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame, p: Params = Params(),
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: id, host, path, rule, verdict. ``rules`` has host, path and verdict (allow or
    block), ``listed`` the hosts to block where no rule fits."""
    url, key = F.col(url_col), F.concat("host", "path").alias("key")
    cut = pages.select(F.col(id_col).alias("i"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = cut.count()
    rules = rules.where("verdict IN ('allow', 'block') AND length(host) > 0 AND host NOT LIKE '%/%'"
                        " AND (path = '' OR path LIKE '/%')")
    hosts = listed.where("length(host) > 0").select("host", F.lit("").alias("path"))
    shape, domains = Shape.of(rules), Shape.of(hosts)
    # Three lists: which keys are rules, which of the rules block, which hosts are listed.
    any_rule = Members.build(rules.select(key), _universe(cut, shape), rows * len(shape.kinds), "rules", p)
    blocking = Members.build(rules.where("verdict = 'block'").select(key), rules.select(key), rules.count(), "block", p)
    bad = Members.build(hosts.select(key), _universe(cut, domains), rows * len(domains.kinds), "listed", p)

    asked, fits = _asked(cut, shape, any_rule)
    longest = [F.when(fit, F.struct(F.length(k).alias("n"), F.length(F.substring_index(k, "/", 1)).alias("h"), k.alias("rule")))
               for k, fit in fits]
    best = F.array_max(F.array(*longest).cast("array<struct<n:int,h:int,rule:string>>"))
    ruled = asked.select("i", "host", "path", best["rule"].alias("rule"))
    ruled = ruled.select("*", Filter.mask(F.col("rule")).alias("m"))
    asked, above = _asked(ruled, domains, bad)
    verdict = (F.when(F.col("rule").isNotNull(), F.when(blocking.holds(F.col("rule"), F.col("m")), "block")
                      .otherwise("allow"))
               .otherwise(F.when(reduce(Column.__or__, [x for _, x in above], F.lit(False)), "block")
                          .otherwise("allow")))
    return asked.select(F.col("i").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))
