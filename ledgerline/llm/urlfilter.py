"""URL filters: exact membership in a list of keys by a cascade of Bloom filters.

The keys that the corpus can ask for (its universe) are known. Level 1 encodes the listed keys; level 2 the
keys of the universe that level 1 takes for listed by mistake; level 3 the listed keys that level 2 takes for
mistakes; and so on until a level makes no mistake. For keys of the universe the first level that denies a key
decides, and the answer is exact. A filter has a bounded size, and is a constant of the plan: no join.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.native import let
from ledgerline.llm.tables import stored

#: Largest filter that is put into a plan. A list that needs more is refused; its caller may use ``listed_by_join``.
MOST_BYTES = 8 << 20
#: Bits per key at the first level and at all others, and the hashes that suit them.
FIRST, LATER = (10, 7), (3, 2)
MOST_LEVELS = 40


@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    hashes: int
    words: tuple[int, ...]


def _positions(key: Column, number: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(number * 64 + i), key), F.lit(bits).cast("bigint")) for i in range(hashes)]


def _level(keys: DataFrame, number: int, n: int) -> Level:
    per_key, hashes = FIRST if number == 1 else LATER
    bits = max(64, -(-n * per_key // 64) * 64)
    if bits // 8 > MOST_BYTES:
        raise ValueError(f"a filter of {bits // 8} bytes exceeds {MOST_BYTES}; use listed_by_join")
    places = keys.select(F.explode(F.array(*_positions(F.col("key"), number, bits, hashes))).alias("p"))
    one = F.expr("shiftleft(1L, cast(p % 64 as int))")
    words = [0] * (bits // 64)
    for r in places.groupBy(F.expr("cast(p div 64 as int)").alias("word")).agg(F.bit_or(one).alias("bits")).collect():
        words[r["word"]] = r["bits"]
    return Level(number, bits, hashes, tuple(words))


def _passes(key: Column, level: Level) -> Column:
    """Whether a level takes the key for one of its own."""
    words = F.from_json(F.lit(json.dumps(level.words)), "array<bigint>")
    tests = None
    for p in _positions(key, level.number, level.bits, level.hashes):
        bit = F.call_function("getbit", F.get(words, F.floor(p / 64).cast("int")), F.pmod(p, F.lit(64)).cast("int"))
        tests = bit == 1 if tests is None else tests & (bit == 1)
    return tests


def cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """Levels for the listed keys over a universe, both with a column ``key``. Null keys are in neither.

    Which keys of the universe are listed is settled by one grouping, without a join; each level then
    reads the universe's keys that the previous one passed, which shrink by the filter's error rate.
    """
    both = universe.select("key", F.lit(False).alias("listed")).unionByName(listed.select("key", F.lit(True).alias("listed")))
    keys = stored(both.where("key IS NOT NULL").groupBy("key").agg(F.max("listed").alias("listed")), "universe")
    members, levels, encoded = keys.where("listed"), [], True
    others = keys.where("NOT listed")
    while (n := members.count()) and len(levels) < MOST_LEVELS:
        level = _level(members, len(levels) + 1, n)
        levels.append(level)
        mistaken = stored(others.where(_passes(F.col("key"), level)), "mistaken")
        members, others, encoded = mistaken, members, not encoded
    if len(levels) == MOST_LEVELS:
        raise ValueError("the cascade does not end")
    return levels


def listed_in(key: Column, levels: list[Level]) -> Column:
    """Whether a key of the universe is listed."""
    verdict = F.lit(len(levels) % 2 == 1)
    for i, level in reversed(list(enumerate(levels))):
        verdict = F.when(~_passes(key, level), F.lit(i % 2 == 1)).otherwise(verdict)
    return F.coalesce(verdict, F.lit(False))


def listed_by_join(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows whose ``key`` is listed, for lists that are too long for a filter."""
    return rows.join(listed.select("key").distinct(), "key", "left_semi")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; else empty."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """Keys of the rules that could fit: the host or a domain above it, then a beginning of the path of a listed length.

    The longest come first.
    """

    def keys(labels: Column) -> Column:
        above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))

        def of(domain: Column) -> Column:
            ends = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(path))
            return F.transform(ends, lambda n: F.concat(domain, F.substring(path, F.lit(1), n)))

        return F.flatten(F.transform(above, of))

    every = let(F.split(host, "\\."), keys)
    ranked = F.sort_array(F.transform(F.array_distinct(every), lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))), asc=False)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.transform(ranked, lambda r: r["key"]))


def judge(pages: DataFrame, rules: dict[str, str], blocked: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every url.

    ``rules`` maps host and path (``net/``) to allow or block; the longest that fits a url wins. Where none fits, a
    url whose host and path are in ``blocked`` (a column ``key``) is blocked, any other allowed. A null url, or one without
    ``://``, has no host and no path; no rule fits it. Repeated rows are kept.
    """
    spark = pages.sparkSession
    urls = pages.select(pages[key].alias("page_id"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"))
    urls = stored(urls, "urls")
    host, path, whole = F.col("host"), F.col("path"), F.concat("host", "path")
    lengths = sorted({len(r) - len(r.split("/")[0]) for r in rules})
    asked = candidates(host, path, lengths)
    verdicts = F.create_map(*(F.lit(x) for r in rules.items() for x in r)) if rules else F.lit(None).cast("map<string,string>")
    listed = spark.createDataFrame([(r,) for r in rules], "key string")
    levels = cascade(listed, urls.select(F.explode(asked).alias("key")))
    mistaken = cascade(blocked.select("key").distinct(), urls.where("host <> ''").select(whole.alias("key")))
    rule = F.get(F.filter(asked, lambda k: listed_in(k, levels)), F.lit(0))
    method = F.when((host != "") & listed_in(whole, mistaken), "block").otherwise("allow")
    judged = urls.select("page_id", "host", "path", rule.alias("rule"), method.alias("method"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce(verdicts[F.col("rule")], "method").alias("verdict"))


def spam_keys(pages: DataFrame, url: str = "url", html: str = "html", most: float = 0.02) -> DataFrame:
    """Host and path (``key``) of pages of whose html more than the share ``most`` are the signs ``*``, ``$`` and ``%``."""
    body = F.coalesce(pages[html], F.lit(""))
    signs = F.length(F.regexp_replace(body, "[^*$%]+", ""))
    spam = pages.where(signs > most * F.length(body)).select(host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"))
    return spam.where("host <> ''").select(F.concat("host", "path").alias("key"))
