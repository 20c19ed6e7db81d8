"""URL rules held in Bloom filter cascades; all of it DataFrame functions.

A rule is a host and a path prefix. The keys that a url may have are the host
suffixes and path prefixes of the lengths that occur among the rules, joined:
``net/es/``. Over all keys of the corpus, level 1 of a cascade encodes the
listed keys, level 2 the unlisted keys that pass level 1, level 3 the listed
keys that pass level 2, and so on until no key passes wrongly. A key's answer
is then exact for every key of the corpus, without a join.

Level 1 lets through about as many unlisted keys as there are listed ones, so
the bits follow the number of rules and only the logarithm of the corpus.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditpath.llm.common import cut, set_aside

#: A cascade's bits travel inside the query; more than this many are refused.
MAX_BITS = 1 << 26
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (action, host, path)
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@dataclass(frozen=True)
class Level:
    n_bits: int
    n_hashes: int
    words: tuple[int, ...]


def host_of(url: Column) -> Column:
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _positions(key: Column, level: int, n_bits: int, n_hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(n_bits)) for j in range(n_hashes)]


def _size(n: int, rate: float) -> tuple[int, int]:
    """Bits and hashes for n keys at a rate of false positives."""
    hashes = max(1, round(-math.log2(rate)))
    bits = math.ceil(-hashes * n / math.log(1 - rate ** (1 / hashes))) if n else 64
    return max(64, -(-bits // 64) * 64), hashes


def _encode(keys: DataFrame, level: int, n_bits: int, n_hashes: int) -> Level:
    """Sets the keys' bits; rows are 64-bit words, combined before the shuffle."""
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), level, n_bits, n_hashes))).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
    rows = (
        at.groupBy(F.floor(F.col("at") / 64).cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .collect()  # n_bits / 64 rows at most, of a checked number
    )
    words = [0] * (n_bits // 64)
    for r in rows:
        words[r["word"]] = r["bits"]
    return Level(n_bits, n_hashes, tuple(words))


def _passes(key: Column, number: int, level: Level) -> Column:
    words = F.split(F.lit(",".join(map(str, level.words))), ",").cast("array<bigint>")  # folded to a literal
    tests = [
        F.getbit(F.get(words, F.floor(at / 64).cast("int")), (at % 64).cast("int")) == 1
        for at in _positions(key, number, level.n_bits, level.n_hashes)
    ]
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def build_cascade(universe: DataFrame) -> list[Level]:
    """Levels for the distinct rows ``key``, ``listed`` of the complete universe of keys."""
    sizes = {r["listed"]: r["n"] for r in universe.groupBy("listed").agg(F.count("*").alias("n")).collect()}
    n_in, n_out = sizes.get(True, 0), sizes.get(False, 0)
    if not n_in:
        return []
    rate = min(0.5, n_in / (math.sqrt(2) * n_out)) if n_out else 0.5
    encoded, n, levels, total = universe, n_in, [], 0
    while n:
        number = len(levels) + 1
        n_bits, n_hashes = _size(n, rate if number == 1 else 0.5)
        total += n_bits
        if total > MAX_BITS:
            raise ValueError(f"the cascade needs over {MAX_BITS} bits for {n_in} listed keys")
        side = F.col("listed") if number % 2 else ~F.col("listed")
        levels.append(_encode(encoded.where(side), number, n_bits, n_hashes))
        # the other side's keys that pass go to the next level, this side's stay
        encoded = encoded.where(side | _passes(F.col("key"), number, levels[-1]))
        n = encoded.where(~side).count()
    return levels


def is_listed(key: Column, levels: list[Level]) -> Column:
    """Exact membership for keys of the universe; null keys are not listed."""
    answer = F.lit(len(levels) % 2 == 1)
    for number in range(len(levels), 0, -1):
        answer = F.when(~_passes(key, number, levels[number - 1]), F.lit(number % 2 == 0)).otherwise(answer)
    return F.coalesce(answer & key.isNotNull(), F.lit(False))


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The url's keys for each (labels, path characters), longest first; null where it is too short."""
    labels = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    keys = [
        F.when(
            (labels >= n) & (F.char_length(path) >= size),
            F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, size)),
        )
        for n, size in shapes
    ]
    by_length = F.array_sort(
        F.array(*[F.struct((-F.char_length(k)).alias("a"), F.lit(-n).alias("b"), k.alias("key")) for (n, _), k in zip(shapes, keys)])
    )
    return F.filter(F.transform(by_length, lambda x: x["key"]), lambda k: k.isNotNull())


def judge_urls(pages: DataFrame, rules=RULES, default: str = "allow", url_col: str = "url") -> DataFrame:
    """Adds host, path, rule and verdict to every row.

    The longest fitting rule wins; between equally long ones that with more
    host labels. A url that no rule fits gets ``default``. A null url, or one
    without ``://``, has an empty host and path and fits no rule. Repeated rows
    stay; without rules or rows nothing is encoded. Columns named host, path,
    rule or verdict are replaced; all others stay, whatever their names.
    """
    return set_aside(pages, {"__keys", "__allow", "__block"}, lambda own: _judge_urls(own, rules, default, url_col))


def _judge_urls(pages: DataFrame, rules, default: str, url_col: str) -> DataFrame:
    listed = {action: sorted({h + p for a, h, p in rules if a == action}) for action in ("allow", "block")}
    if both := set(listed["allow"]) & set(listed["block"]):
        raise ValueError(f"rules that allow and block: {sorted(both)}")
    shapes = sorted({(h.count(".") + 1, len(p)) for _, h, p in rules})
    out = pages.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    if not shapes:
        return out.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    keys = candidate_keys(F.col("host"), F.col("path"), shapes)
    universe = cut(out.select(F.explode(keys).alias("key")).distinct())
    cascades = {}
    for action in ("allow", "block"):
        cascades[action] = build_cascade(universe.withColumn("listed", F.col("key").isin(listed[action])))

    def first(action: str) -> Column:
        return F.get(F.filter("__keys", lambda k: is_listed(k, cascades[action])), F.lit(0))

    at = lambda k: F.coalesce(F.array_position("__keys", k), F.lit(1 << 30))
    out = out.withColumn("__keys", keys)
    out = out.withColumns({"__allow": first("allow"), "__block": first("block")})
    blocked = F.col("__block").isNotNull() & (at(F.col("__block")) < at(F.col("__allow")))
    rule = F.when(blocked, F.col("__block")).otherwise(F.col("__allow"))
    verdict = F.when(rule.isNull(), F.lit(default)).when(blocked, F.lit("block")).otherwise(F.lit("allow"))
    return out.withColumns({"rule": rule, "verdict": verdict}).drop("__keys", "__allow", "__block")
