"""Sequence packing by minimum bin slack.

Documents are cut into full windows and one shorter rest each. Rests of equal
length are interchangeable, so the packing is planned on the histogram of
lengths, at most one row per length up to the window: for each window a
subset-sum over the remaining multiset, kept as the bits of one integer, finds
the sum closest to the capacity, the counts are backtracked, and the pattern
is used as often as the histogram allows. The plan's size is bounded by the
window, whatever the corpus. Spark then numbers the pieces of each length and
looks their sequence and offset up in the plan.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditpath.llm.bpe import Vocabulary
from creditpath.llm.common import Shared, batch_slices, cut

WINDOW = 1024
END_ID = 0
#: Pieces of one length are numbered in buckets of about this many rows.
BUCKET_ROWS = 50_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(docs: DataFrame, vocabulary_path: str, window: int = WINDOW) -> DataFrame:
    """Pieces of at most ``window`` ids of every document; the id 0 ends a document.

    A null text counts as empty: its only piece is the end id. Repeated rows
    give repeated pieces. Columns other than doc_id and text are not read.
    """
    vocabulary = Vocabulary(docs.sparkSession, vocabulary_path)

    def run(batches):
        encoder = vocabulary.encoder()
        for batch in batches:
            docs_, rows = batch.column("doc_id").to_pylist(), []
            encoded = (ids for _, _, texts in batch_slices(batch) for ids in encoder.encode(texts))
            for doc, ids in zip(docs_, encoded):
                ids = np.append(ids, END_ID).astype("<u4")
                rows += [
                    (doc, a, len(piece := ids[a : a + window]), zlib.crc32(piece), len(ids))
                    for a in range(0, len(ids), window)
                ]
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def _reachable(counts: dict[int, int], window: int) -> tuple[list[int], list[int]]:
    """Lengths, longest first, and the sums (bits) reachable before each and after all of them."""
    mask = (1 << window + 1) - 1
    lengths = sorted(counts, reverse=True)
    sums = [1]
    for length in lengths:
        bits, left = sums[-1], min(counts[length], window // length)
        part = 1
        while left:  # powers of two of the count
            take = min(part, left)
            bits |= bits << take * length & mask
            left -= take
            part *= 2
        sums.append(bits)
    return lengths, sums


def _fullest(counts: dict[int, int], window: int) -> dict[int, int]:
    """The multiset of remaining lengths with the sum closest to the window, at least one piece."""
    lengths, sums = _reachable(counts, window)
    total, chosen = sums[-1].bit_length() - 1, {}
    for i in range(len(lengths) - 1, -1, -1):
        n = 0
        while not sums[i] >> total & 1:
            total -= lengths[i]
            n += 1
        if n:
            chosen[lengths[i]] = n
    return chosen


def plan_windows(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Runs of equal sequences, as (length, first rank, pieces in each, first sequence, repeats, first offset).

    A run gives ``repeats`` sequences ``pieces`` pieces of that length each,
    from the given offset on, taken in the order of their ranks.
    """
    left = {k: n for k, n in histogram.items() if n > 0}
    if any(not 0 < k <= window for k in left):
        raise ValueError("a piece is longer than the window")
    used = dict.fromkeys(left, 0)
    runs, sequence = [], 0
    while left:
        chosen = _fullest(left, window)
        repeats = min(left[k] // n for k, n in chosen.items())
        offset = 0
        for k in sorted(chosen, reverse=True):
            n = chosen[k]
            runs.append((k, used[k], n, sequence, repeats, offset))
            used[k] += n * repeats
            offset += n * k
            left[k] -= n * repeats
            if not left[k]:
                del left[k]
        sequence += repeats
    return runs


def number_pieces(pieces: DataFrame) -> DataFrame:
    """Adds ``rank``, gapless from 0 among the pieces of a length.

    Pieces are dealt into hash buckets, each numbered on its own after the
    pieces of the buckets before it, so that a frequent length isn't one task's.
    """
    total = pieces.count()
    buckets = max(1, -(-total // BUCKET_ROWS) * 4)
    keys = ["doc_id", "start", "doc_tokens", "ids_crc32"]
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket")
    base = sizes.select(
        "length", "bucket", (F.sum("n").over(before) - F.col("n")).alias("before")
    )
    inside = Window.partitionBy("length", "bucket").orderBy(*keys)
    numbered = dealt.withColumn("inside", F.row_number().over(inside) - 1)
    return numbered.join(base, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("inside"))


def place_pieces(numbered: DataFrame, runs: list[tuple], spark: SparkSession) -> DataFrame:
    """Looks every numbered piece up in the plan; the plan holds a few rows per possible length."""
    by_length: dict[int, list] = {}
    for run in runs:
        by_length.setdefault(run[0], []).append(run)
    shared = Shared(spark, {k: np.array(sorted(v), np.int64) for k, v in by_length.items()})

    def run_(batches):
        plans = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for k in np.unique(length):
                rows = np.flatnonzero(length == k)
                plan = plans[int(k)]
                r = plan[np.searchsorted(plan[:, 1], rank[rows], side="right") - 1]
                inside = rank[rows] - r[:, 1]
                sequence[rows] = r[:, 3] + inside // r[:, 2]
                offset[rows] = r[:, 5] + inside % r[:, 2] * k
            columns = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank"]
    return numbered.select(*cols).mapInArrow(run_, PIECES + ", sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary_path: str, window: int = WINDOW) -> DataFrame:
    """One row per piece with its place: sequence and offset, gapless from 0 in each sequence.

    An empty table gives no rows. Sequences of a full window or of a power of
    two need no padding. Pieces are written to the shared folder once, as both
    the histogram and the placement read them.
    """
    pieces = cut(token_pieces(docs, vocabulary_path, window))
    counts = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()  # one row per length
    runs = plan_windows({r["length"]: r["n"] for r in counts}, window)
    return place_pieces(number_pieces(pieces), runs, docs.sparkSession)
