"""Neighbours, positions and ranks inside groups, balanced also when some groups are huge.

``Window.partitionBy(group).orderBy(...)`` sends every row of a group to one
task. :func:`ordered_scan` gives the answers of ``lag``/``lead``,
``row_number`` and ``dense_rank`` over such a window, all in the JVM:

1. one pass with a frequent-items sketch finds the hot groups, those with more
   rows than a partition should have: at most as many as there are partitions.
   Without any, the answer is the plain window's;
2. rows of hot groups get a bucket, their place among cut points of the whole
   order key, drawn from a sample of these rows; so a group with a third of
   the rows is cut into about a third of the buckets, also where its rows all
   have one value in the first order column. All other rows have bucket 0;
3. windows run over (group, bucket), the only shuffle of the rows;
4. the edges of hot groups are patched from a summary with one row per hot
   group and bucket, which also carries counts across buckets.

Cut points decide where rows are worked on, never the answers. Order keys
should be total (add a unique tie-breaker such as an event id); with ties on
the whole key the neighbour among tied rows is arbitrary, as for a window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import default_partitions

BUCKET = "_cp_bucket"
_SEQ, _DENSE, _LAST = "_cp_seq", "_cp_dense", "_cp_last"
#: Rows drawn for each cut point.
DRAWN = 32
#: Rows of the summary up to which it is broadcast.
BROADCAST_EDGES = 100_000


def hot_groups(df: DataFrame, group: Sequence[str], buckets: int) -> tuple[list[int], int, int]:
    """Hashes of the groups with over 1/buckets of the rows (or nearly), how many rows they hold, and all rows."""
    if buckets < 2:
        return [], 0, 0
    tracked = min(max(10_000, 16 * buckets), 1_000_000)  # counts are right to some fifth of a bucket
    sketch = F.call_function("approx_top_k", F.xxhash64(*group), F.lit(min(2 * buckets, tracked)), F.lit(tracked))
    found, n = df.select(sketch, F.count(F.lit(1))).first()
    hot = [r for r in found or [] if r["count"] * buckets > n]
    return [r["item"] for r in hot], min(n, sum(r["count"] for r in hot)), n


def is_hot(group: Sequence[str], hot: list[int]) -> Column:
    return F.xxhash64(*group).isin(hot)


def quantile_cuts(rows: DataFrame, order: Sequence[str], buckets: int, n: float) -> dict[int, Column]:
    """Ascending order keys that cut the ``n`` rows into about ``buckets`` equal parts, by their (first) place in 1 .. buckets - 1."""
    if buckets < 2:
        return {}
    types = dict(rows.dtypes)
    keys = rows.select(*order)
    drawn = keys.sample(min(1.0, buckets * DRAWN / max(n, 1)), seed=7) if n > buckets * DRAWN else keys
    # as text, which every type below gives back exactly and without the driver's time zone
    text = [(F.base64(c) if types[c] == "binary" else F.col(c).cast("string")).alias(f"_{i}") for i, c in enumerate(order)]
    sample = drawn.orderBy(*order).select(*text).collect()  # about DRAWN rows for each bucket
    first: dict[tuple, int] = {}
    for k in range(1, buckets if sample else 0):
        first.setdefault(tuple(sample[k * len(sample) // buckets]), k)
    return {
        k: F.struct(*[(F.unbase64(F.lit(v)) if types[c] == "binary" else F.lit(v).cast(types[c])).alias(c) for c, v in zip(order, key)])
        for key, k in first.items()
    }


def cut_points(rows: DataFrame, order: Sequence[str], buckets: int, n: float) -> list[Column]:
    """At most ``buckets - 1`` ascending order keys that cut the ``n`` rows into about equal parts."""
    return list(quantile_cuts(rows, order, buckets, n).values())


def bucket_of(value: Column, bounds: list[Column], places: Sequence[int] | None = None) -> Column:
    """Number of bounds that are not above the value, by halving; or, with ``places``, the place of the last of these, else 0."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low if places is None or low == 0 else places[low - 1])
        middle = (low + high) // 2
        return F.when(value >= bounds[middle], between(middle + 1, high)).otherwise(between(low, middle))

    return between(0, len(bounds))


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_cp_{c}"]) for c in names])


def ordered_scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str] = (),
    *,
    last_valid: Sequence[str] = (),
    seq_col: str | None = None,
    dense_rank_col: str | None = None,
    rank_value: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """``df`` plus, inside each group in the given order:

    ``prev_c`` and ``next_c`` for each of ``carry``; ``prev_c`` for each of
    ``last_valid``, the last value before the row that isn't NULL; the position
    from 1 as ``seq_col``; the dense rank by ``rank_value``, the first order
    column, as ``dense_rank_col``. NULL group values form a group.
    """
    group, order = list(group), list(order)
    if dense_rank_col and rank_value != order[0]:
        raise ValueError("ranks are taken over the first order column")
    buckets = num_partitions or default_partitions(df.sparkSession)
    hot, held, n = hot_groups(df, group, buckets)
    bounds, key, keys = [], F.struct(*order), group
    rows = df
    if hot:
        cold = ~is_hot(group, hot)
        bounds = cut_points(df.where(~cold), order, math.ceil(buckets * held / n), held)
    if bounds:
        keys = [*group, BUCKET]
        rows = df.withColumn(BUCKET, F.when(cold, 0).otherwise(bucket_of(key, bounds)))
    inside = Window.partitionBy(*keys).orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    added = {
        **{f"prev_{c}": F.lag(c).over(inside) for c in carry},
        **{f"next_{c}": F.lead(c).over(inside) for c in carry},
        **{f"prev_{c}": F.last(c, ignorenulls=True).over(before) for c in last_valid},
    }
    if seq_col or (bounds and carry):
        added[_SEQ] = F.row_number().over(inside).cast("long")
    if bounds and carry:
        added[_LAST] = F.lead(F.lit(False), 1, True).over(inside)
    if dense_rank_col:
        added[_DENSE] = F.dense_rank().over(Window.partitionBy(*keys).orderBy(order[0])).cast("long")
    rows = rows.withColumns(added)
    if not bounds:
        return _finished(rows, df.columns, carry, last_valid, seq_col, dense_rank_col)

    parts = rows.where(~cold).groupBy(*[F.col(c).alias(f"_cp_{c}") for c in keys]).agg(
        F.count(F.lit(1)).alias("_cp_n"),
        *([F.max(_DENSE).alias("_cp_d"), F.min_by(order[0], key).alias("_cp_low"), F.max_by(order[0], key).alias("_cp_high")] if dense_rank_col else []),
        *[F.min_by(c, key).alias(f"_cp_first_{c}") for c in carry],
        *[F.max_by(c, key).alias(f"_cp_last_{c}") for c in carry],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), key)).alias(f"_cp_valid_{c}") for c in last_valid],
    )
    whole = Window.partitionBy(*[f"_cp_{c}" for c in group])
    across = whole.orderBy(f"_cp_{BUCKET}")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    so_far = across.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if dense_rank_col:
        # a value on both sides of a cut has one rank
        first = F.row_number().over(across) == 1
        shared = F.col("_cp_low").eqNullSafe(F.lag("_cp_high").over(across)) & ~first
        parts = parts.withColumn("_cp_shared", F.when(shared, 1).otherwise(0))
    edges = parts.select(
        *[f"_cp_{c}" for c in keys],
        F.count(F.lit(1)).over(whole).alias("_cp_spans"),
        F.sum("_cp_n").over(earlier).alias("_cp_before"),
        *([(F.coalesce(F.sum("_cp_d").over(earlier), F.lit(0)) - F.sum("_cp_shared").over(so_far)).alias("_cp_ranks")] if dense_rank_col else []),
        *[F.lag(f"_cp_last_{c}").over(across).alias(f"_cp_prev_{c}") for c in carry],
        *[F.lead(f"_cp_first_{c}").over(across).alias(f"_cp_next_{c}") for c in carry],
        *[F.last(f"_cp_valid_{c}", ignorenulls=True).over(earlier).alias(f"_cp_before_{c}") for c in last_valid],
    ).where("_cp_spans > 1")
    if len(hot) * (len(bounds) + 1) <= BROADCAST_EDGES:
        edges = F.broadcast(edges)
    met = rows.join(edges, _same(rows, edges, keys), "left")
    patched = {
        **{f"prev_{c}": F.when(F.col(_SEQ) == 1, F.col(f"_cp_prev_{c}")).otherwise(F.col(f"prev_{c}")) for c in carry},
        **{f"next_{c}": F.when(F.col(_LAST), F.col(f"_cp_next_{c}")).otherwise(F.col(f"next_{c}")) for c in carry},
        **{f"prev_{c}": F.coalesce(f"prev_{c}", f"_cp_before_{c}") for c in last_valid},
    }
    if seq_col:
        patched[_SEQ] = F.col(_SEQ) + F.coalesce("_cp_before", F.lit(0))
    if dense_rank_col:
        patched[_DENSE] = F.col(_DENSE) + F.coalesce("_cp_ranks", F.lit(0))
    return _finished(met.withColumns(patched), df.columns, carry, last_valid, seq_col, dense_rank_col)


def _finished(rows, own, carry, last_valid, seq_col, dense_rank_col) -> DataFrame:
    return rows.select(
        *own,
        *[f"prev_{c}" for c in carry],
        *[f"next_{c}" for c in carry],
        *[f"prev_{c}" for c in last_valid],
        *([F.col(_SEQ).alias(seq_col)] if seq_col else []),
        *([F.col(_DENSE).alias(dense_rank_col)] if dense_rank_col else []),
    )
