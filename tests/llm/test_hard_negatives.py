"""Hard negatives against brute force, and the intervals of scores against the scores."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from creditpath.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, id string, v string, code long, rank int, anchor_id string"


def table(spark, rows):
    return spark.createDataFrame([(i, l, x, "a", "b", 1, 2, "c") for i, l, x in rows], SCHEMA)


def brute(rows, modulus=10):
    good = [(i, l, [int(np.floor(256 * np.float64(np.float32(c)))) for c in x]) for i, l, x in rows
            if i is not None and l is not None and x is not None and len(x) and all(c is not None and np.isfinite(c) for c in x)]
    sizes = [len(x) for _, _, x in good]
    dim = max(set(sizes), key=lambda n: (sizes.count(n), n))
    of = {}
    for i, l, x in good:
        of[i] = min(of.get(i, (l, x)), (l, x))
    of = {i: r for i, r in of.items() if len(r[1]) == dim}
    out = []
    for i, (l, x) in of.items():
        if i % modulus:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), j, m) for j, (m, y) in of.items() if j != i)
        for p, j, _ in [s for s in scored if s[2] == l][:5]:
            band = [(-s, k) for s, k, m in scored if m != l and 30 * -p <= 100 * -s <= 90 * -p]
            out += [(i, j, n + 1, k, -p, s) for n, (s, k) in enumerate(band[:10])]
    return sorted(out)


@pytest.mark.parametrize("dim", [3, 64, 70])
def test_against_brute_force(spark, dim):
    rng = np.random.default_rng(dim)
    centres = rng.normal(size=(4, dim))
    rows = [(i, i % 4, (centres[i % 3] + rng.normal(size=dim)).tolist()) for i in range(200)]
    rows += [(200 + i, i % 4, rows[7][2]) for i in range(20)]  # ties
    rows += [(300 + i, i % 4, [2.0 * c for c in rows[7][2]]) for i in range(10)] + [(400, 1, [0.0] * dim)]
    got = H.mine(table(spark, rows).repartition(3), F.col("id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(1)
    rows = [(i, i % 2, rng.normal(size=4).tolist()) for i in range(40)]
    rows += [(50, 0, None), (51, 0, [1.0, None, 1.0, 1.0]), (52, 0, [1.0, float("nan"), 1.0, 1.0]), (53, 1, [float("inf")] * 4),
             (54, None, [1.0] * 4), (None, 1, [1.0] * 4), (55, 1, [1.0] * 5), (56, 1, []), (57, 1, [1e30] * 4), (60, 0, [0.0] * 4)]
    rows += rows[:3] + [(4, 1, rows[5][2])]
    kept = [r for r in rows if r[0] not in (55, 57)]
    assert sorted(map(tuple, H.mine(table(spark, rows), F.col("id") % 10 == 0).collect())) == brute(kept)
    assert H.mine(table(spark, []), F.col("id") % 10 == 0).collect() == []
    assert H.mine(table(spark, [(10, 1, [1.0])]), F.col("id") % 10 == 0).collect() == []


def test_products_near_the_limit_of_long(spark):
    x = float(2**21)
    rows = [(0, 0, [x, x]), (1, 0, [x, x * 0.75]), (2, 1, [x * 0.5, x * 0.5]), (3, 1, [x * 0.5, x * 0.5 + 1])]
    assert sorted(map(tuple, H.mine(table(spark, rows), F.col("id") % 10 == 0).collect())) == brute(rows)


def test_intervals_hold_every_score_and_leave_rows_out():
    rng = np.random.default_rng(3)
    centre = rng.integers(-3000, 3000, 64)
    v = np.concatenate([centre + rng.integers(-300, 300, (250, 64)), -centre + rng.integers(-300, 300, (250, 64))])
    turn = H.rotation(64)
    norm = np.linalg.norm(v, axis=1)
    turned = v / norm[:, None] @ turn
    rows = pa.table({
        "id": np.arange(500), "label": np.zeros(500, np.int32), "v": H.lists(v),
        "code": H.lists(H.packed_bits(turned > 0).view(np.int64)), "align": np.abs(turned).sum(axis=1) / 8, "norm": norm,
    })
    low, high = H.intervals(v[:50], norm[:50], H.Block(rows), turn)
    scores = v[:50] @ v.T
    assert (low <= scores).all() and (scores <= high).all()
    # rows on the other side can't be among the best and aren't scored
    assert all((high[i, 250:] < H.kth_largest(low[i], 5)).all() for i in range(50))
