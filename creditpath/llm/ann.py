"""Approximate nearest neighbours by cosine: a forest of random-projection trees.

The forest is fitted on a bounded sample: a tree splits the sample's points
by the direction between two random ones, at the median, down to small leaves.
Every vector of the table is routed to its leaf in each tree. A query walks all
trees through one priority queue of open nodes, nearest split first, until the
leaves it has reached hold enough sample points; all vectors of these leaves
are then scored exactly, in double precision. How many are enough is measured
on the sample: points of it are searched for their exact neighbours there, so
that clustered vectors need few leaves and unstructured ones many.

Equal vectors are indexed once, with the few smallest ids that any answer may
need, so that a frequent vector isn't a large leaf. Leaves are scored in blocks
of bounded size.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditpath.llm.common import Shared, cut

TREES = 8
#: The forest is fitted on at most this many distinct vectors, the first by a hash, and this many numbers.
SAMPLE_VECTORS = 1 << 15
SAMPLE_NUMBERS = 1 << 24
#: A tree splits its points until none of its leaves holds more than one in LEAVES, whatever the sample's size.
LEAVES = 128
#: A query opens leaves until they hold so many of the sample's points, counted in every tree, that this share of
#: the nearest of FIT_QUERIES sample points was reached, and SEARCH_MORE more.
REACHED = 0.97
FIT_QUERIES = 256
SEARCH_MORE = 128
#: Vectors or queries of one block, and pairs whose products are held at once.
BLOCK_ROWS = 4_096
PAIRS_AT_ONCE = 1 << 14
#: Of a query's length: more than what rounding may move a score by.
MARGIN = 1e-9
SEED = 7


@dataclass
class Tree:
    """Inner nodes with a direction and a threshold; a child is a node, or a leaf as its complement."""

    normal: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    leaf_points: list[int]

    def route(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row."""
        node = np.zeros(len(x), np.int64) if len(self.child) else np.full(len(x), -1)
        open_ = np.flatnonzero(node >= 0)
        while len(open_):
            at = node[open_]
            side = np.einsum("ij,ij->i", x[open_], self.normal[at]) > self.threshold[at]
            node[open_] = self.child[at, side.astype(np.int64)]
            open_ = open_[node[open_] >= 0]
        return ~node


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def grow(x: np.ndarray, rng: np.random.Generator) -> Tree:
    """A tree over the sample's unit vectors."""
    most = -(-len(x) // LEAVES)
    normal, threshold, child, leaves = [], [], [], []
    open_: list[tuple[np.ndarray, int, int]] = [(np.arange(len(x)), -1, 0)]
    while open_:
        rows, parent, side = open_.pop()
        name = None
        if len(rows) > most:
            for _ in range(4):
                a, b = x[rng.choice(rows, 2, replace=False)]
                way = a - b
                if not np.any(way):
                    continue
                way = way / np.linalg.norm(way)
                along = x[rows] @ way
                middle = float(np.median(along))
                right = along > middle
                if 0 < right.sum() < len(rows):
                    name = len(normal)
                    normal.append(way)
                    threshold.append(middle)
                    child.append([0, 0])
                    open_ += [(rows[~right], name, 0), (rows[right], name, 1)]
                    break
        if name is None:
            name = ~len(leaves)
            leaves.append(len(rows))
        if parent >= 0:
            child[parent][side] = name
    dim = x.shape[1]
    return Tree(
        np.array(normal).reshape(-1, dim), np.array(threshold), np.array(child, np.int64).reshape(-1, 2), leaves
    )


def open_leaves(query: np.ndarray, forest: list[Tree], points: float) -> list[tuple[int, int]]:
    """(tree, leaf) in the order in which one queue over all trees reaches them."""
    queue = [(0.0, t, 0 if len(tree.child) else -1) for t, tree in enumerate(forest)]
    out, seen = [], 0
    while queue and seen < points:
        far, t, node = heapq.heappop(queue)
        tree = forest[t]
        while node >= 0:
            margin = float(tree.normal[node] @ query) - float(tree.threshold[node])
            side = int(margin > 0)
            heapq.heappush(queue, (max(far, abs(margin)), t, int(tree.child[node, 1 - side])))
            node = int(tree.child[node, side])
        out.append((t, ~node))
        seen += tree.leaf_points[~node]
    return out


def budget(x: np.ndarray, forest: list[Tree], k: int) -> int:
    """Sample points that leaves must hold for REACHED of the k nearest of some sample points to be among them."""
    leaf_of = [tree.route(x) for tree in forest]
    k = min(k, len(x) - 1)
    needed = []
    for q in range(min(len(x), FIT_QUERIES) if k else 0):  # rows stand in the order of a hash
        score = x @ x[q]
        score[q] = -np.inf
        near = np.argpartition(-score, k - 1)[:k]
        seen, reached = 0, np.full(k, -1)
        for t, leaf in open_leaves(x[q], forest, np.inf):
            reached[(reached < 0) & (leaf_of[t][near] == leaf)] = seen + 1
            if (reached >= 0).all():
                break
            seen += forest[t].leaf_points[leaf]
        needed.append(reached)
    return int(np.quantile(np.concatenate(needed), REACHED)) + SEARCH_MORE if needed else SEARCH_MORE


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and v of the vectors that take part: of the most frequent length, finite and not zero."""
    v = F.col(vector_col).cast("array<double>")
    fine = ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.exists(v, lambda c: c != 0)
    rows = vectors.where(F.col(id_col).isNotNull() & fine).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (size["n"] if size else 0))


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """v and its smallest ids, ``ids`` of them at most; frequent vectors are thinned before the shuffle."""
    first = Window.partitionBy("v").orderBy("id")
    few = rows.distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= ids)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def fit(vectors: DataFrame, k: int) -> tuple[list[Tree], int]:
    """The forest and how many points a search has to reach, from a bounded sample of the distinct vectors."""
    head = vectors.select(F.size("v").alias("n")).first()
    if head is None:
        return [], 0
    rows = max(1, min(SAMPLE_VECTORS, SAMPLE_NUMBERS // head["n"]))
    sample = vectors.select("v", F.xxhash64("v").alias("h")).orderBy("h", "v").limit(rows).select("v").toArrow()
    x = unit(np.array(sample.column("v").combine_chunks().flatten().to_numpy()).reshape(-1, head["n"]))
    rng = np.random.default_rng(SEED)
    forest = [grow(x, rng) for _ in range(TREES)]
    return forest, budget(x, forest, k)


def best_of_each(a: np.ndarray, b: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of a, row of b and cosine of the k best rows of b for each of a; equal ones by the smaller ``first``.

    A product of matrices picks all rows that may be among the k best, with a
    margin for its rounding, so that no tie is cut before the exact scores.
    """
    a_norm, b_norm = np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1))
    rough = (a @ b.T) / b_norm
    k = min(k, len(b))
    least = np.partition(rough, len(b) - k, axis=1)[:, len(b) - k] - MARGIN * a_norm
    row, column = np.nonzero(rough >= least[:, None])
    exact = np.empty(len(row))
    for at in range(0, len(row), PAIRS_AT_ONCE):
        i, j = row[at : at + PAIRS_AT_ONCE], column[at : at + PAIRS_AT_ONCE]
        # the same sum for a pair in whichever tree it meets
        exact[at : at + PAIRS_AT_ONCE] = (a[i] * b[j]).sum(1) / (a_norm[i] * b_norm[j])
    order = np.lexsort((first[column], -exact, row))
    row, column, exact = row[order], column[order], exact[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k], exact[place < k]


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _place(forest, rows: DataFrame, kept: str, schema: str, points: int | None) -> DataFrame:
    """Rows with every leaf they are in, or, for queries, every leaf they open."""

    def run(batches):
        trees = forest.value
        for batch in batches:
            x = unit(_matrix(batch.column("v")))
            if points is None:
                of = np.tile(np.arange(len(x)), len(trees))
                tree = np.repeat(np.arange(len(trees)), len(x))
                leaf = np.concatenate([t.route(x) for t in trees]) if trees else np.zeros(0, np.int64)
            else:
                found = [(i, t, leaf) for i, q in enumerate(x) for t, leaf in open_leaves(q, trees, points)]
                of, tree, leaf = np.array(found, np.int64).reshape(-1, 3).T
            take = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree.astype(np.int32)), pa.array(leaf.astype(np.int32)), batch.column(kept).take(take), batch.column("v").take(take)],
                names=["tree", "leaf", kept, "v"],
            )

    return rows.select(kept, "v").mapInArrow(run, f"tree int, leaf int, {schema}, v array<double>")


def _blocks(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias(name))


def search(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank from 1, vec_id and score of each query's k nearest vectors found.

    Null, zero and non-finite vectors take no part, nor those of another length
    than most. A query's own id is never its answer, also where rows repeat it.
    Between equal scores the smaller id is first. With fewer candidates all
    that were reached are returned; an empty table gives no rows.
    """
    rows = cut(usable(vectors, id_col, vector_col))
    distinct = cut(distinct_vectors(rows, k + 1))
    trees, points = fit(distinct, k)
    forest = Shared(vectors.sparkSession, trees)
    queries = rows.where(is_query(F.col("id"))).distinct()

    placed = _place(forest, distinct, "ids", "ids array<long>", None)
    asked = cut(_place(forest, queries, "id", "id long", points))
    leaves = _blocks(placed, "n_v").join(_blocks(asked, "n_q"), ["tree", "leaf"])  # a row per leaf of the forest
    key = ["tree", "leaf", "v_block", "q_block"]
    some = F.broadcast(leaves)  # at most TREES * 2 * LEAVES rows or so, of three numbers
    left = placed.join(some, ["tree", "leaf"]).select(
        "tree", "leaf", F.pmod(F.xxhash64("v"), F.col("n_v")).cast("int").alias("v_block"),
        F.explode(F.sequence(F.lit(0), F.col("n_q") - 1)).alias("q_block"), "ids", "v",
    )
    right = asked.join(some, ["tree", "leaf"]).select(
        "tree", "leaf", F.explode(F.sequence(F.lit(0), F.col("n_v") - 1)).alias("v_block"),
        F.pmod(F.xxhash64("id"), F.col("n_q")).cast("int").alias("q_block"), "id", "v",
    )

    def score(v: pa.Table, q: pa.Table) -> pa.Table:
        names = ["query_id", "ids", "score"]
        if not v.num_rows or not q.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.list_(pa.int64())), pa.array([], pa.float64())], names=names)
        a, b = _matrix(q.column("v").combine_chunks()), _matrix(v.column("v").combine_chunks())
        ids = v.column("ids").combine_chunks()
        row, column, exact = best_of_each(a, b, pa.compute.list_element(ids, 0).to_numpy(), k + 1)
        return pa.table([q.column("id").take(pa.array(row)), ids.take(pa.array(column)), pa.array(exact)], names=names)

    met = (
        left.groupBy(*key)
        .cogroup(right.groupBy(*key))
        .applyInArrow(score, "query_id long, ids array<long>, score double")
    )
    pairs = (
        met.groupBy("query_id", "ids")
        .agg(F.max("score").alias("score"))
        .select("query_id", F.explode("ids").alias("vec_id"), "score")
        .where(F.col("vec_id") != F.col("query_id"))
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
