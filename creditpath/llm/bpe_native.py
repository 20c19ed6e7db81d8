"""The merge fold of byte-level BPE as Spark higher-order functions, for tables of distinct words.

A word's bytes are an array of binary pieces; each step of an ``aggregate``
ranks all joined neighbours and merges the first pair of the lowest rank. The
rank map is a literal: an array of slots, looked up by a piece's hash, and the
full hash and rank at each slot. No Python runs in the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditpath.llm.bpe import read_ranks

#: Slots and places in each; a piece sits in one of its slot's places.
SLOTS, PLACES = 1 << 16, 9
NO_RANK = 2**31 - 1


class RankMap:
    """Literal arrays of hashes and ranks, and the expression that looks a piece up."""

    def __init__(self, spark: SparkSession, path: str):
        ranks = read_ranks(path)
        rows = [(bytearray(piece), rank) for piece, rank in ranks.items()]
        hashed = spark.createDataFrame(rows, "piece binary, rank int").select("rank", F.xxhash64("piece").alias("h"))
        places: list[list[tuple[int, int]]] = [[] for _ in range(SLOTS)]
        for r in hashed.collect():  # the vocabulary's size
            places[r["h"] % SLOTS].append((r["h"], r["rank"]))
        if max(map(len, places)) > PLACES:
            raise ValueError(f"over {PLACES} pieces share a slot")
        flat = [p for slot in places for p in [*slot, *[(0, NO_RANK)] * (PLACES - len(slot))]]
        hashes = _literal([h for h, _ in flat], "bigint").alias("hashes")
        self.literal = F.struct(hashes, _literal([r for _, r in flat], "int").alias("ranks"))

    def bound(self, use) -> Column:
        """``use(table)`` with the literal bound to a variable, so that it stands in the plan once."""
        return F.get(F.transform(F.array(self.literal), use), F.lit(0))


def rank_of(piece: Column, table: Column) -> Column:
    """A piece's rank, or NO_RANK: of the places of its slot the one with its hash."""

    def found(h: Column) -> Column:
        at = (F.pmod(h, F.lit(SLOTS)) * PLACES).cast("int")
        places = F.slice(table["hashes"], at + 1, F.lit(PLACES))
        place = F.array_position(places, h).cast("int")
        return F.when(place > 0, F.get(table["ranks"], at + place - 1)).otherwise(F.lit(NO_RANK))

    return F.get(F.transform(F.array(F.xxhash64(piece)), found), F.lit(0))


def _literal(values: list[int], kind: str) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")  # folded once


def encode_distinct_words(words: DataFrame, path: str) -> DataFrame:
    """word (binary) and ids (array<int>) of every row; an empty word has no ids, a null one null ids."""
    word = F.col("word")
    pieces = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.substring(word, i, F.lit(1)))
    pieces = F.when(F.length(word) == 0, F.array().cast("array<binary>")).otherwise(pieces)

    def encoded(table: Column) -> Column:
        def step(p: Column, _: Column) -> Column:
            pairs = F.transform(
                F.slice(p, F.lit(1), F.greatest(F.size(p) - 1, F.lit(0))),
                lambda a, i: F.struct(rank_of(F.concat(a, F.get(p, i + 1)), table).alias("rank"), i.alias("at")),
            )
            return F.when(F.size(p) < 2, p).otherwise(_merged(p, F.array_min(pairs)))

        start = F.when(rank_of(word, table) != NO_RANK, F.array(word)).otherwise(pieces)
        folded = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1))), start, step)
        return F.transform(folded, lambda p: rank_of(p, table))

    ids = RankMap(words.sparkSession, path).bound(encoded)
    return words.select("word", F.when(word.isNotNull(), ids).alias("ids"))


def _merged(p: Column, best: Column) -> Column:
    """The pieces with the pair at ``best.at`` joined, if it has a rank."""

    def joined(b: Column) -> Column:
        at = b["at"]
        rest = F.greatest(F.size(p) - at - 2, F.lit(0))
        both = F.array(F.concat(F.get(p, at), F.get(p, at + 1)))
        whole = F.concat(F.slice(p, F.lit(1), at), both, F.slice(p, at + 3, rest))
        return F.when(b["rank"] == NO_RANK, p).otherwise(whole)

    return F.get(F.transform(F.array(best), joined), F.lit(0))


def decode_ids(ids: Column, path: str) -> Column:
    """The bytes of an array of ids: their pieces, looked up in a literal array and concatenated."""
    ranks = read_ranks(path)
    by_id = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        by_id[rank] = piece
    table = F.transform(F.split(F.lit(",".join(p.hex() for p in by_id)), ","), F.unhex)
    return F.aggregate(ids, F.lit(b"").cast("binary"), lambda out, i: F.concat(out, F.get(table, i)))
