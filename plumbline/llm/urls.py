"""URL filters by a Bloom filter cascade, in DataFrame functions only.

Level 1 is a Bloom filter of the listed keys; level 2 one of the keys of the corpus that level 1 takes
falsely; level 3 one of the listed keys that level 2 takes falsely, and so on, until a level takes no key
falsely. As every key of the corpus took part, walking the levels decides membership exactly, and the
corpus is filtered by an expression, without a join.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import cut

#: (action, host, path) of the default rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Bits of a level (32 MB, of some 9 million keys); a list that needs more is cut into parts by a hash of its keys.
MOST_BITS = 1 << 28
#: Shapes of rules that a URL is asked for one by one; of more, the hosts that have rules are found first.
SHAPES = 32


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: DataFrame  # one row, words array<long>: at most MOST_BITS, and read by every task as one value


@dataclass(frozen=True)
class Cascade:
    """Levels of a cascade; contains() is exact for the keys that it was built with."""

    levels: tuple[Level, ...]

    def columns(self, name: str) -> list[Column]:
        """The levels as columns, scalar subqueries that the optimizer puts where contains() reads them: each in one place."""
        return [level.words.scalar().alias(f"{name}{i}") for i, level in enumerate(self.levels)]

    def contains(self, name: str) -> Callable[[Column], Column]:
        """A function from a key column to a boolean column, of rows with columns(name); a null key is in no list."""

        def ask(key: Column) -> Column:
            # Odd levels hold listed keys, even levels the others: the first level without the key decides.
            answer = F.lit(len(self.levels) % 2 == 1)
            for i in range(len(self.levels) - 1, -1, -1):
                answer = F.when(_maybe(self.levels[i], i, key, F.col(f"{name}{i}")), answer).otherwise(F.lit(i % 2 == 1))
            return F.coalesce(F.when(key.isNotNull(), answer), F.lit(False))

        return ask


@dataclass(frozen=True)
class Parts:
    """A list in parts, each a cascade of its own over the keys that the same hash deals to it."""

    parts: tuple[Cascade | Parts, ...]
    seed: int

    def columns(self, name: str) -> list[Column]:
        return [c for i, part in enumerate(self.parts) for c in part.columns(f"{name}{i}_")]

    def contains(self, name: str) -> Callable[[Column], Column]:
        asks = [part.contains(f"{name}{i}_") for i, part in enumerate(self.parts)]

        def ask(key: Column) -> Column:
            out, at = F.lit(False), _part(key, self.seed, len(self.parts))
            for i, one in enumerate(asks):
                out = F.when(at == i, one(key)).otherwise(out)
            return F.coalesce(out, F.lit(False))

        return ask


def _part(key: Column, seed: int, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(f"part {seed}"), key), F.lit(parts))


def _places(level: int, bits: int, hashes: int, key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(level * 64 + j), key), F.lit(bits)) for j in range(hashes)]


def _maybe(level: Level, number: int, key: Column, words: Column) -> Column:
    return F.forall(
        F.array(*_places(number, level.bits, level.hashes, key)), lambda p: F.getbit(F.element_at(words, (F.shiftright(p, 6) + 1).cast("int")), F.pmod(p, F.lit(64)).cast("int")) == 1
    )


def _bits(n: int, rate: float) -> int:
    return max(64, -(-math.ceil(n * -math.log(rate) / math.log(2) ** 2) // 64) * 64)


def _level(keys: DataFrame, number: int, n: int, rate: float) -> Level:
    """A Bloom filter of n keys with about this rate of false positives."""
    bits, hashes = _bits(n, rate), max(1, round(-math.log2(rate)))
    places = keys.select(F.explode(F.array(*_places(number, bits, hashes, F.col("key")))).alias("p"))
    got = places.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(p, 64) as int))")).alias("set"))
    every = keys.sparkSession.range(bits // 64).join(got, F.col("id") == F.col("word"), "left").select("id", F.coalesce("set", F.lit(0).cast("long")).alias("set"))
    # One row by design: the filter, of at most MOST_BITS whatever the input.
    ordered = every.agg(F.array_sort(F.collect_list(F.struct("id", "set"))).alias("all"))
    return Level(bits, hashes, cut(ordered.select(F.transform("all", lambda x: x["set"]).alias("words"))))


def _rate(n: int, rest: int) -> float:
    return min(0.5, max(1e-6, math.sqrt(2) * n / max(1, rest)))


def build(listed: DataFrame, universe: DataFrame, seed: int = 0) -> Cascade | Parts:
    """The cascade of the listed keys over the universe, each a DataFrame with a string column key.

    Keys may repeat; nulls are passed over. Listed keys need not occur in the universe. A level's rate is
    such that about as many keys of the other side pass as the level holds, so levels shrink with the list.
    If a level would exceed MOST_BITS, both sides are cut into parts.
    """
    inside = cut(listed.where("key is not null").distinct())
    outside = cut(universe.where("key is not null").distinct().join(inside, "key", "left_anti"))
    n, rest = inside.count(), outside.count()
    # The second level holds some n keys, too, with a rate of its own.
    bits = max(_bits(n, _rate(n, rest)), _bits(2 * n, 0.25)) if n > 1 else 0
    if bits > MOST_BITS:
        parts = -(-5 * bits // (4 * MOST_BITS)) + 1
        mine = lambda side, i: side.where(_part(F.col("key"), seed, parts) == i)
        return Parts(tuple(build(mine(inside, i), mine(outside, i), seed + 1) for i in range(parts)), seed)
    levels: list[Level] = []
    while n:
        level = _level(inside, len(levels), n, 0.25 if levels else _rate(n, rest))
        levels.append(level)
        passed = cut(outside.select("key", level.words.scalar().alias("words")).where(_maybe(level, len(levels) - 1, F.col("key"), F.col("words"))).select("key"))
        # The keys that a level takes falsely are what the next one holds; its own keys are the next one's outside.
        inside, outside = passed, inside
        n = inside.count()
    return Cascade(tuple(levels))


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or no ://."""
    after = F.substring_index(url, "://", 1)
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.length(after) + F.lit(4))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty for null or no ://."""
    after = F.substring_index(url, "://", 1)
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.length(after) + F.lit(4))).otherwise("")
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def candidates(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Keys that a rule for this URL may have, longest first: the host's last labels with the path's first characters.

    shapes: (labels of the host, characters of the path) that rules have, so a host of however many labels gives
    only so many keys. A key is host, a space, and the path's start.
    """
    keys = F.array(*[
        F.when((_labels(host) >= n) & (F.length(path) >= m), F.concat(F.substring_index(host, ".", -n), F.lit(" "), F.substring(path, 1, m))) for n, m in shapes
    ]) if shapes else F.array().cast("array<string>")
    return _longest_first(F.filter(keys, lambda k: k.isNotNull()))


def _longest_first(keys: Column) -> Column:
    ordered = F.sort_array(F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), F.instr(k, F.lit(" ")).alias("host"), k.alias("key"))), asc=False)
    return F.transform(ordered, lambda s: s["key"])


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] | DataFrame = RULES, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id_col, host, path, rule, verdict) for every row of pages.

    rules: (allow or block, host, path), or a DataFrame of action, host and path. A rule fits its host and all
    subdomains if the URL's path starts with the rule's; the longest that fits decides, the longer host among
    equals. rule is the host and the path of it; without one it is null and the verdict is default. Both lists are
    cascades over all keys that any URL of pages could match by, in parts where they are long. A null URL or one without :// has an empty host and path, which no rule with a host fits. Repeated rows and null ids
    stay; other columns are not read.
    """
    spark: SparkSession = pages.sparkSession
    table = rules if isinstance(rules, DataFrame) else spark.createDataFrame([tuple(r) for r in rules], "action string, host string, path string")
    listed = cut(table.select("action", F.concat("host", F.lit(" "), "path").alias("key"), _labels(F.col("host")).alias("n"), F.length("path").alias("m")).where("key is not null").distinct())
    if not listed.groupBy("key").count().where("count > 1").isEmpty():
        raise ValueError("a rule both allows and blocks")
    url = F.col(url_col)
    rows = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    shapes = listed.select("n", "m").distinct()
    # At most SHAPES of them come here.
    few = sorted((r["n"], r["m"]) for r in shapes.limit(SHAPES + 1).collect())
    if len(few) <= SHAPES:
        rows = rows.withColumn("_keys", candidates(F.col("host"), F.col("path"), few))
    else:
        rows = _by_host(rows, listed, sorted(r["n"] for r in shapes.select("n").distinct().collect()))  # labels of hosts, some dozens
    universe = cut(rows.select(F.explode("_keys").alias("key")).distinct())
    cascades = [build(listed.where(F.col("action") == action).select("key"), universe) for action in ("allow", "block")]
    allow, block = (c.contains(f"_{name}") for c, name in zip(cascades, ("allow", "block"), strict=True))
    hits = F.filter(F.transform("_keys", lambda k: F.struct(k.alias("key"), allow(k).alias("allow"), block(k).alias("block"))), lambda s: s["allow"] | s["block"])
    # Each column is read in one place from here on, so that the projections become one and no row ever holds a filter.
    asked = rows.select(id_col, "host", "path", "_keys").select("*", *cascades[0].columns("_allow"), *cascades[1].columns("_block"))
    judged = asked.select(id_col, "host", "path", F.try_element_at(hits, F.lit(1)).alias("_hit"))
    verdict = F.when(F.col("_hit").isNull(), F.lit(default)).when(F.col("_hit.allow"), F.lit("allow")).otherwise(F.lit("block"))
    return judged.select(id_col, "host", "path", F.replace(F.col("_hit.key"), F.lit(" "), F.lit("")).alias("rule"), verdict.alias("verdict"))


def _by_host(rows: DataFrame, listed: DataFrame, labels: list[int]) -> DataFrame:
    """rows with _keys, longest first: the ends of the host that have rules, each with the path's starts of the lengths that its rules have.

    Two more cascades tell them: one of the hosts of rules, one of hosts with the lengths of their paths. So a URL is
    asked for its own host's shapes, however many the list has.
    """
    ends = F.array(*[F.when(_labels(F.col("host")) >= n, F.substring_index("host", ".", -n)) for n in labels])
    rows = rows.withColumn("_ends", F.filter(ends, lambda e: e.isNotNull()))
    rules = listed.select(F.substring_index("key", " ", 1).alias("host"), "m")
    hosts = build(rules.select(F.col("host").alias("key")), rows.select(F.explode("_ends").alias("key")))
    known = rows.select("*", *hosts.columns("_host"))
    found = known.select(*[c for c in rows.columns if c != "_ends"], F.filter("_ends", hosts.contains("_host")).alias("_ends"))
    # As many as paths of rules have different lengths.
    lengths = cut(rules.agg(F.sort_array(F.collect_set("m"), asc=False).alias("lengths")))
    pair = lambda e, m: F.concat(e, F.lit(" "), m.cast("string"))
    met = found.select(F.explode("_ends").alias("e")).distinct().select("e", F.explode(lengths.scalar()).alias("m"))
    pairs = build(rules.select(pair(F.col("host"), F.col("m")).alias("key")), met.select(pair(F.col("e"), F.col("m")).alias("key")))
    has = pairs.contains("_pair")
    asked = found.withColumn("_lengths", F.when(F.size("_ends") > 0, lengths.scalar()).otherwise(F.array().cast("array<int>"))).select("*", *pairs.columns("_pair"))
    own = lambda e: F.filter("_lengths", lambda m: (m <= F.length("path")) & has(pair(e, m)))
    keys = F.flatten(F.transform("_ends", lambda e: F.transform(own(e), lambda m: F.concat(e, F.lit(" "), F.substr(F.col("path"), F.lit(1), m)))))
    return asked.select(*[c for c in rows.columns if c != "_ends"], _longest_first(keys).alias("_keys"))
