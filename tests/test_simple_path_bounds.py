"""Bounds of the simple-path probability: equal at floor 0, around the value above it, and for many channels."""

import numpy as np
import pytest

from conftest import SF0001
from creditpath.operators import markov as M
from creditpath.plans.attribution import AttributionPlan

EDGES = "start_state string, end_state string, transition_probability double"


def random_matrix(spark, n, seed):
    rng = np.random.default_rng(seed)
    states = [f"c{i:02}" for i in range(n)]
    edges = []
    for a in ["Start", *states]:
        p = rng.dirichlet(np.ones(n + 2))
        edges += [(a, b, float(q)) for b, q in zip([*states, "Conversion", "Null"], p)]
    return spark.createDataFrame(edges, EDGES)


def bounds(matrix, floor):
    return {r.removed_channel: (r.lower_bound, r.upper_bound) for r in M.simple_path_bounds(matrix, floor).collect()}


def plain(matrix, removed):
    after = {}
    for r in matrix.collect():
        after.setdefault(r.start_state, []).append((r.end_state, r.transition_probability))

    def walk(state, seen):
        total = 0.0
        for end, p in after.get(state, ()):
            if end == "Conversion":
                total += p
            elif end not in ("Null", removed) and end not in seen:
                total += p * walk(end, seen | {end})
        return total

    return walk("Start", {"Start"})


def test_floor_zero_is_the_probability(spark):
    matrix = random_matrix(spark, 5, 1)
    got = bounds(matrix, 0.0)
    for removed in (None, *(f"c{i:02}" for i in range(5))):
        assert got[removed] == (pytest.approx(plain(matrix, removed), abs=1e-12),) * 2
    events = AttributionPlan.from_events(spark, SF0001).matrix.checkpoint()
    exact = {r.removed_channel: r.conversion_probability for r in M.simple_path_probability(events).collect()}
    assert {k: lo for k, (lo, _) in bounds(events, 0.0).items()} == pytest.approx(exact, abs=1e-12)


def test_bounds_close_in_on_the_probability(spark):
    matrix = random_matrix(spark, 6, 2)
    exact = plain(matrix, None)
    widths = []
    for floor in (0.05, 0.005, 0.0005):
        low, high = bounds(matrix, floor)[None]
        assert low <= exact + 1e-12 and exact <= high + 1e-12
        widths.append(high - low)
    assert widths[0] > widths[1] > widths[2]


def test_many_channels(spark):
    """24 channels that lead to each other and on: too many visited sets to follow them all."""
    n = 24
    edges = [("Start", f"c{i:02}", 1 / n) for i in range(n)]
    for i in range(n):
        near = [(i * 7 + k) % n for k in (1, 5, 11)]
        edges += [(f"c{i:02}", f"c{j:02}", 0.15) for j in near] + [(f"c{i:02}", "Conversion", 0.25), (f"c{i:02}", "Null", 0.30)]
    got = bounds(spark.createDataFrame(edges, EDGES), 1e-4)
    assert len(got) == n + 1 and all(0 <= lo <= hi <= 1 and hi - lo < 0.05 for lo, hi in got.values())


def test_floor_is_a_probability(spark):
    with pytest.raises(ValueError):
        M.simple_path_bounds(random_matrix(spark, 2, 3), -1.0)
