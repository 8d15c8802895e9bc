"""URL rules by a Bloom filter cascade, in DataFrame functions only.

A rule is ``host/path`` and fits its host, all subdomains, and every path that begins with its path; the longest rule
wins. The keys of a url are its host endings joined with its path beginnings, of the label counts and path lengths that
rules have, so a url has few keys whatever its length.

A list of rules becomes a cascade over all keys of the corpus: level 0 holds the listed keys; level 1 the corpus keys
that level 0 takes for listed by mistake; level 2 the listed keys that level 1 takes for mistakes; and so on until no
mistake is left. Walking the levels then answers exactly for every key of the corpus, without a join. Level 0 uses
log2(corpus keys / listed keys) bits per key, later levels one hash each, so the filters grow with the list of rules and
the logarithm of the corpus. They are literals of the plan; ``MOST_BYTES`` checks their size.

Null urls, and urls without ``://``, have an empty host and path; no rule fits them and the verdict is the default one.
Repeated rows give one result row each. Empty tables and empty rule lists are fine.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import settled

BITMAP = 32768  # bits of one bitmap of bitmap_construct_agg
MOST_BYTES = 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Level(NamedTuple):
    bits: int
    hashes: int
    data: bytes


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _spots(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits)) for i in range(hashes)]


def _encoded(keys: DataFrame, level: int, bits: int, hashes: int) -> Level:
    """The filter of ``keys``; at most ``bits`` bits come to the driver, as bitmaps of 32768."""
    spots = keys.select(F.explode(F.array(*_spots(F.col("key"), level, bits, hashes))).alias("spot"))
    parts = (
        spots.groupBy(F.floor(F.col("spot") / BITMAP).alias("part"))
        .agg(F.bitmap_construct_agg(F.pmod("spot", F.lit(BITMAP))).alias("bitmap"))
        .collect()
    )
    data = bytearray(-(-bits // BITMAP) * BITMAP // 8)
    for row in parts:
        data[row["part"] * BITMAP // 8 : (row["part"] + 1) * BITMAP // 8] = row["bitmap"]
    return Level(bits, hashes, bytes(data[: -(-bits // 8)]))


def _passes(key: Column, number: int, level: Level) -> Column:
    found = F.lit(True)
    for spot in _spots(key, number, level.bits, level.hashes):
        byte = F.conv(F.hex(F.substring(F.lit(level.data), (F.floor(spot / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        bit = F.pmod(spot, F.lit(8)).cast("int")
        found = found & (F.floor(byte / F.pow(F.lit(2), bit)).cast("int") % 2 == 1)
    return found


def member(key: Column, cascade: list[Level]) -> Column:
    """Whether a key of the corpus is listed: the first level that it fails decides."""
    answer = F.lit(len(cascade) % 2 == 1)
    for number in reversed(range(len(cascade))):
        answer = F.when(~_passes(key, number, cascade[number]), F.lit(number % 2 == 1)).otherwise(answer)
    return answer


def cascade(listed: DataFrame, universe: DataFrame, bits_per_key: float | None = None) -> list[Level]:
    """The levels for the column ``key`` of ``listed`` over that of ``universe`` (repeats are fine in both)."""
    listed = settled(listed.select("key").distinct(), "listed")
    size = listed.count()
    if not size:
        return []
    ratio = max(2, universe.count() / size)
    hashes = max(1, math.ceil(math.log2(ratio)))
    wide = bits_per_key or hashes / math.log(2)
    levels: list[Level] = []
    inside, outside = listed, universe  # what the next level holds, and what it must tell apart from that
    while size:
        bits = max(8, math.ceil(wide * size))
        if bits > 8 * MOST_BYTES:
            raise ValueError("the list of rules needs a filter beyond MOST_BYTES; cut it into several lists")
        levels.append(_encoded(inside, len(levels), bits, hashes))
        mistaken = outside.where(_passes(F.col("key"), len(levels) - 1, levels[-1])).select("key").distinct()
        if len(levels) == 1:
            mistaken = settled(mistaken, "mistaken").join(listed, "key", "left_anti")
        inside, outside = settled(mistaken, "mistaken"), inside
        size, wide, hashes = inside.count(), 1 / math.log(2), 1
    return levels


def _keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """The keys of a url that could be rules, longest first."""
    have = F.size(F.split(host, r"\."))
    found = [
        F.when((have >= n) & (F.char_length(path) >= m), F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, m)))
        for n in labels
        for m in lengths
    ]
    some = F.filter(F.array(*found), lambda k: k.isNotNull()) if found else F.array().cast("array<string>")
    return F.transform(F.array_sort(F.transform(some, lambda k: F.struct((-F.char_length(k)).alias("n"), k.alias("k")))), lambda s: s["k"])


def judged(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    bits_per_key: float | None = None,
) -> DataFrame:
    """page_id, host, path, the longest rule that fits (else null) and its verdict (else the default), for every row.

    ``rules`` has the columns verdict (``allow`` or ``block``) and rule; a rule listed as both blocks.
    """
    rules = rules.select(F.col("verdict"), F.col("rule")).dropna()
    host = F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER)
    path = F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)")
    rules = settled(rules.select("verdict", F.concat(host, path).alias("key"), F.size(F.split(host, r"\.")).alias("labels"), F.char_length(path).alias("chars")), "rules")
    shape = rules.agg(F.array_sort(F.collect_set("labels")).alias("labels"), F.array_sort(F.collect_set("chars")).alias("chars")).first()
    urls = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    keyed = urls.withColumn("keys", _keys(F.col("host"), F.col("path"), shape["labels"], shape["chars"]))
    universe = keyed.select(F.explode("keys").alias("key"))
    blocked = cascade(rules.where("verdict = 'block'"), universe, bits_per_key)
    allowed = cascade(rules.where("verdict = 'allow'"), universe, bits_per_key)
    fits = F.filter("keys", lambda k: member(k, blocked) | member(k, allowed))
    return keyed.withColumn("rule", F.get(fits, F.lit(0))).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.when(F.col("rule").isNull(), F.lit(default)).when(member(F.col("rule"), blocked), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
    )
