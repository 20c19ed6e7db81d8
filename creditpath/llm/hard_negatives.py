"""Hard negatives of anchors by integer inner product, filtered through rotated one-bit codes.

Vectors are turned by one fixed random rotation. A row's code holds the sign of
each turned component; c, the code as a unit vector, and the row's direction o
have the stored alignment a = <c, o>. An anchor's direction q is rounded to
BITS bits a component, so that b = <c, q> is a few popcounts of the code with
bit planes of q, up to the length e of what the rounding left.

Both directions are taken apart along c: <o, q> = a*b + <o', q'>, where o' and
q' are what is orthogonal to c. By Cauchy-Schwarz the last term is at most
sqrt(1 - a^2) * sqrt(1 - b^2), so with b known up to e the score lies in an
interval for certain. Rows whose interval can't reach the k-th best lower bound
of the anchor's block, or the wanted band of scores, are left out; the rest are
scored in integers. No row is lost to the estimate.

The anchors meet all rows in blocks of bounded size, each pair of blocks in a
task of its own; a block gives at most k rows an anchor.

Vectors that are null, hold a null or non-finite component, differ in length
from most (of equally frequent lengths the longest stays), or whose squared
integer length reaches 2^62 take no part, nor do rows without id or label. Of
rows with one id the one with the smallest label, then vector, counts. An empty
table gives an empty result; columns besides the three named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditpath.llm.common import cut

#: Rows or anchors of one block on average, and the least number of blocks of rows.
BLOCK_ROWS = 1 << 16
MIN_BLOCKS = 16
#: Bits to which an anchor's turned components are rounded.
BITS = 6
#: Anchors whose intervals are held at once.
ANCHORS_AT_ONCE = 16
#: Relative margin for rounding in double precision.
MARGIN = 1e-9
SEED = 11

CODED = "id long, label int, v array<long>, code array<long>, align double, norm double"


def usable(rows: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, label and v (scaled components, rounded down) of the rows that take part."""
    x = F.col("x")
    good = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    named = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"), F.col(vector_col).cast("array<double>").alias("x")
    )
    whole = named.dropna().where(good & (F.size("x") > 0)).select(
        "id", "label", F.transform(x, lambda c: F.floor(c * scale)).alias("v")
    )
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    one = whole.where(square < 2.0**62).groupBy("id").agg(F.min(F.struct("label", "v")).alias("row"))
    return one.select("id", "row.label", "row.v")


def rotation(dim: int) -> np.ndarray:
    turned, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return turned * np.sign(np.diag(r))


def packed_bits(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words."""
    n, dim = flags.shape
    padded = np.zeros((n, -(-dim // 64) * 64), bool)
    padded[:, :dim] = flags
    return np.packbits(padded, axis=1).view(np.uint64)


def lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * width, pa.array(values.ravel()))


def matrix(column, n: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(n, -1)


def encode(rows: DataFrame, dim: int) -> DataFrame:
    """Code, alignment and length beside each row."""

    def run(batches):
        turn = rotation(dim)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column("v"), batch.num_rows)
            norm = np.linalg.norm(v.astype(np.float64), axis=1)
            turned = (v / np.where(norm > 0, norm, 1)[:, None]) @ turn
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("id", "label", "v")),
                    lists(packed_bits(turned > 0).view(np.int64)),
                    pa.array(np.abs(turned).sum(axis=1) / np.sqrt(dim)),
                    pa.array(norm),
                ],
                names=["id", "label", "v", "code", "align", "norm"],
            )

    return rows.mapInArrow(run, CODED)


class Block:
    """Rows of one block: arrays by column."""

    def __init__(self, table: pa.Table):
        n = table.num_rows
        self.id, self.label = (table.column(c).to_numpy() for c in ("id", "label"))
        self.v = matrix(table.column("v"), n)
        self.code = matrix(table.column("code"), n).view(np.uint64)
        self.align, self.norm = (table.column(c).to_numpy() for c in ("align", "norm"))
        self.exact = self.v.astype(np.float64)

    def scores(self, rows: np.ndarray, v: np.ndarray, norm: float) -> np.ndarray:
        """Integer inner products; in doubles where every partial sum is an exact one."""
        if len(rows) and float(self.norm[rows].max()) * norm < 2.0**52:
            return (self.exact[rows] @ v.astype(np.float64)).astype(np.int64)
        return np.einsum("ij,j->i", self.v[rows], v)


def intervals(v: np.ndarray, norm: np.ndarray, rows: Block, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score that each anchor (rows of v) may have with each row."""
    dim = v.shape[1]
    q = (v / np.where(norm > 0, norm, 1)[:, None]) @ turn
    low = q.min(axis=1, keepdims=True)
    step = (q.max(axis=1, keepdims=True) - low) / ((1 << BITS) - 1)
    step[step == 0] = 1
    level = np.rint((q - low) / step).astype(np.int64)
    rest = np.linalg.norm(q - (low + step * level), axis=1, keepdims=True)
    ones = np.bitwise_count(rows.code).sum(axis=1, dtype=np.int64)
    weighted = np.zeros((len(v), len(rows.id)), np.int64)
    for bit in range(BITS):
        plane = packed_bits(level >> bit & 1 > 0)
        for w in range(plane.shape[1]):
            weighted += np.bitwise_count(plane[:, w, None] & rows.code[None, :, w]).astype(np.int64) << bit
    # components under the code's ones count with plus, the others with minus
    sum_q = low * dim + step * level.sum(axis=1, keepdims=True)
    b = (2 * (low * ones + step * weighted) - sum_q) / np.sqrt(dim)
    a = np.minimum(rows.align, 1)
    least, most = np.clip(b - rest - MARGIN, -1, 1), np.clip(b + rest + MARGIN, -1, 1)
    beside = np.sqrt(1 - a * a)
    at = np.clip(a, least, most)
    high = a * at + beside * np.sqrt(1 - at * at)
    at = np.clip(-a, least, most)
    below = a * at - beside * np.sqrt(1 - at * at)
    size = norm[:, None] * rows.norm
    return (below - MARGIN) * size - 1, (high + MARGIN) * size + 1


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def kth_largest(x: np.ndarray, k: int) -> float:
    return np.partition(x, len(x) - k)[len(x) - k] if len(x) >= k else -np.inf


def in_blocks(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, search, schema: str) -> DataFrame:
    """Every block of rows with every block of anchors; blocks are dealt by a hash of the id."""
    g, a = max(MIN_BLOCKS, -(-n_rows // BLOCK_ROWS)), max(1, -(-n_anchors // BLOCK_ROWS))

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = rows.withColumn("g", dealt(g)).withColumn("a", every(a))
    right = anchors.withColumn("a", dealt(a)).withColumn("g", every(g))
    right = right.select(*(F.col(c).alias(f"anchor_{c}") for c in right.columns))  # both sides stem from one table

    def run(rows_table: pa.Table, anchor_table: pa.Table) -> pa.Table:
        anchor_table = anchor_table.rename_columns([c.removeprefix("anchor_") for c in anchor_table.column_names])
        parts = []
        if rows_table.num_rows and anchor_table.num_rows:
            block = Block(rows_table)
            turn = rotation(block.v.shape[1])
            for at in range(0, anchor_table.num_rows, ANCHORS_AT_ONCE):
                some = anchor_table.slice(at, ANCHORS_AT_ONCE).combine_chunks()
                v = matrix(some.column("v"), some.num_rows)
                norm = some.column("norm").to_numpy()
                low, high = intervals(v, norm, block, turn)
                for i, anchor in enumerate(some.drop_columns(["v", "code"]).to_pylist()):
                    parts += search(block, anchor, v[i], low[i], high[i])
        columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * len(names)
        return pa.table(dict(zip(names, columns)))

    names = [c.split()[0] for c in schema.split(", ")]
    return left.groupBy("g", "a").cogroup(right.groupBy("anchor_g", "anchor_a")).applyInArrow(run, schema)


def nearest_of_label(k: int):
    """The k best rows of the anchor's label, itself left out."""

    def search(block: Block, anchor: dict, v, low, high) -> Iterator[tuple[np.ndarray, ...]]:
        may = np.flatnonzero((block.label == anchor["label"]) & (block.id != anchor["id"]))
        may = may[high[may] >= kth_largest(low[may], k)]
        scores = block.scores(may, v, anchor["norm"])
        top = best(block.id[may], scores, k)
        yield np.full(len(top), anchor["id"]), block.id[may[top]], scores[top]

    return search


def best_in_bands(k: int, low_percent: int, high_percent: int):
    """For each positive the k best rows of other labels with scores between two shares of the positive's."""

    def search(block: Block, anchor: dict, v, low, high) -> Iterator[tuple[np.ndarray, ...]]:
        other = np.flatnonzero(block.label != anchor["label"])
        low, high = low[other], high[other]
        for positive in anchor["positives"]:
            score = positive["positive_score"]
            first, last = -(-low_percent * score // 100), high_percent * score // 100
            if first > last:
                continue
            sure = (low >= first) & (high <= last)
            least = max(first, kth_largest(low[sure], k))
            may = other[(high >= least) & (low <= last)]
            scores = block.scores(may, v, anchor["norm"])
            inside = (scores >= first) & (scores <= last)
            may, scores = may[inside], scores[inside]
            top = best(block.id[may], scores, k)
            whole = [np.full(len(top), x, np.int64) for x in (anchor["id"], positive["positive_id"], score)]
            yield *whole, block.id[may[top]], scores[top]

    return search


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    scale: int = 256,
) -> DataFrame:
    """Hard negatives of every anchor (``is_anchor`` speaks of ``id``) and each of its positives, best first.

    Scores are inner products of floor(scale * component). An anchor's
    positives are its best other rows of the same label; negatives have another
    label and a score from ``low_percent`` to ``high_percent`` of the
    positive's, both ends included. Ties go to the smaller id.
    """
    spark = rows.sparkSession
    named = usable(rows, id_col, label_col, vector_col, scale)
    sizes = cut(named).withColumn("dim", F.size("v"))
    common = sizes.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return spark.createDataFrame([], MINED)
    coded = cut(encode(sizes.where(F.col("dim") == common.dim).drop("dim"), common.dim))
    anchors = coded.where(is_anchor)
    n_anchors = anchors.count()
    near = in_blocks(
        coded, anchors, common["count"], n_anchors, nearest_of_label(positives),
        "anchor_id long, positive_id long, positive_score long",
    )
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives)
    of_anchor = cut(
        chosen.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    )
    found = in_blocks(
        coded, anchors.join(of_anchor, "id"), common["count"], n_anchors, best_in_bands(negatives, low_percent, high_percent),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
