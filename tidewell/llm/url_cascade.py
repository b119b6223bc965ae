"""URL filter with a cascade of Bloom filters.

A rule is a host and a path prefix. Every rule has a shape: how many labels its host has and how long its path is. For each shape
of the rules a URL has one key at most, its own last labels and the start of its path, so a rule fits exactly if the
key of its shape is the rule. What is asked of a list is thus plain membership of keys, and the keys of all URLs are the universe.

A cascade answers that without a join and without errors: level 1 encodes the listed keys, level 2 the keys of the universe that level 1
takes wrongly, level 3 the listed keys that level 2 takes wrongly, and so on until a level takes none wrongly. The levels are arrays of
64-bit words inside the expression. Level 1 grows with the list and the logarithm of the universe, the others shrink; a list has
at most :data:`MAX_RULES` rules, hence all levels together stay below about 10 MB.

Defined results: a null URL, or one without ``://``, has an empty host and path and fits no rule. Repeated rows and ids are judged row by
row. Other columns are ignored, whatever their names. A rule on both lists blocks.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialize

MAX_RULES = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def shapes_of(rules: list[str]) -> list[tuple[int, int]]:
    """(labels of the host, characters of the path) that occur in the rules."""
    return sorted({(host.count(".") + 1, len(path)) for host, path in map(split_rule, rules)})


def keys_of(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """For each shape the key of a URL that is long enough for it, as an array."""
    labels = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    keys = [
        F.when((labels >= n) & (F.length(path) >= size), F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, size)))
        for n, size in shapes
    ]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


@dataclass(frozen=True)
class Level:
    seed: int
    hashes: int
    bits: int
    words: tuple[int, ...]

    def takes(self, key: Column) -> Column:
        # The JSON text is folded to one array literal when the plan is optimised.
        words = F.from_json(F.lit("[" + ",".join(map(str, self.words)) + "]"), "array<bigint>")
        found = F.lit(True)
        for place in places(key, self.seed, self.hashes, self.bits):
            word = F.get(words, F.shiftright(place, 6).cast("int"))
            found = found & (F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1)
        return found


def places(key: Column, seed: int, hashes: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed), F.lit(i)), F.lit(bits).cast("long")) for i in range(hashes)]


def build_level(keys: DataFrame, count: int, seed: int, rate: float) -> Level:
    """A Bloom filter over ``keys`` (column ``key``, ``count`` rows) with about ``rate`` false positives."""
    hashes = max(1, round(-math.log2(rate)))
    bits = max(64, 64 * math.ceil(count * hashes / math.log(2) / 64))
    set_bits = keys.select(F.explode(F.array(*places(F.col("key"), seed, hashes, bits))).alias("place"))
    words = set_bits.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(pmod(place, 64L) as int))")).alias("bits")
    )
    held = [0] * (bits // 64)
    for row in words.collect():  # bits / 64 rows at most, bounded with the rules
        held[row["word"]] = row["bits"]
    return Level(seed, hashes, bits, tuple(held))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Whether ``key``, which is in the universe or listed, is listed."""
        found = F.lit(False)
        for level in reversed(self.levels):
            found = level.takes(key) & ~found
        return found if self.levels else F.lit(False)


def build_cascades(universe: DataFrame, size: int, lists: list[list[str]]) -> list[Cascade]:
    """A cascade for each list that makes no mistake on any ``key`` of ``universe`` (``size`` rows at most, repeats allowed).

    The universe is read once: what passes the first level of any list is written, and the further levels are built from that.
    """
    lists = [sorted(set(listed)) for listed in lists]
    if (most := max(map(len, lists), default=0)) > MAX_RULES:
        raise ValueError(f"{most} rules; a cascade takes {MAX_RULES}")
    spark, key = universe.sparkSession, F.col("key")
    inside = [spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(x)), "array<string>")).alias("key")) for x in lists]
    used = [number for number, listed in enumerate(lists) if listed]
    if not used:
        return [Cascade(()) for _ in lists]
    first = {n: build_level(inside[n], len(lists[n]), 1, min(0.5, len(lists[n]) / max(1.0, 2.0 * size))) for n in used}
    # Few keys pass level 1: the listed ones and about half as many others. They are told apart by grouping with the lists.
    takers = F.array_compact(F.array(*(F.when(first[n].takes(key), F.lit(n)) for n in used)))
    passed = universe.select("key", F.explode(takers).alias("list"), F.lit(0).alias("listed"))
    for n in used:
        passed = passed.unionByName(inside[n].select("key", F.lit(n).alias("list"), F.lit(1).alias("listed")))
    marked = materialize(passed.groupBy("list", "key").agg(F.max("listed").alias("listed")), "passed_keys")
    out = []
    for n in range(len(lists)):
        levels = [first[n]] if n in first else []
        wrong = marked.where((F.col("list") == n) & (F.col("listed") == 0)).select("key")
        right, count = inside[n], wrong.count()
        while count:
            level = build_level(wrong, count, len(levels) + 1, 0.5)
            levels.append(level)
            wrong, right = right.where(level.takes(key)), wrong
            count = wrong.count()
        out.append(Cascade(tuple(levels)))
    return out


def build_cascade(universe: DataFrame, listed: list[str]) -> Cascade:
    """The cascade for one list."""
    return build_cascades(universe, universe.count(), [listed])[0]


def judge(pages: DataFrame, allow: list[str], block: list[str], otherwise: str = "allow") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (the longest that fits, or null) and ``verdict`` of each page.

    Of rules of one length, the one with the longer host counts. Pages that fit no rule get ``otherwise``.
    """
    shapes = shapes_of([*allow, *block])
    parsed = pages.select(
        pages["page_id"].cast("long").alias("page_id"), host_of(pages["url"]).alias("host"), path_of(pages["url"]).alias("path")
    )
    keyed = parsed.withColumn("keys", keys_of(F.col("host"), F.col("path"), shapes))
    universe = keyed.select(F.explode("keys").alias("key"))
    # A page has one key for each shape at most; rows are counted from the footers of the files.
    allowed, blocked = build_cascades(universe, pages.count() * max(1, len(shapes)), [allow, block])

    def rank(key: Column) -> Column:
        blocks = blocked.holds(key)
        fits = F.when(blocks, F.lit("block")).when(allowed.holds(key), F.lit("allow"))
        return F.struct(F.length(key).alias("size"), F.instr(F.concat(key, F.lit("/")), "/").alias("host"), key.alias("rule"), fits.alias("verdict"))

    ranked = F.filter(F.transform("keys", rank), lambda x: x["verdict"].isNotNull())
    best = keyed.withColumn("best", F.array_max(ranked))
    return best.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict")
    )
