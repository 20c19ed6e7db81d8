"""The absorbing chain against exact fractions, slowly mixing graphs, and the panel form against the local one."""

from fractions import Fraction

import numpy as np
import pytest

from creditpath.operators import absorbing as A
from creditpath.operators import markov as M

EDGES = "start_state string, end_state string, transition_probability double"


def probabilities(spark, edges):
    rows = M.absorbing_probability(spark.createDataFrame(edges, EDGES)).collect()
    return {r.removed_channel: r.conversion_probability for r in rows}


def exact(edges):
    """State reduction in fractions, for every scenario; proportions of the given doubles."""
    names = sorted({a for a, _, _ in edges} - {"Start", "Conversion", "Null"})
    out = {}
    for removed in [None, *names]:
        rows = {}
        for a, b, p in edges:
            if a not in (removed, "Conversion", "Null"):
                b = b if b in ("Start", "Conversion") or b in names and b != removed else "Null"
                row = rows.setdefault(a, {})
                row[b] = row.get(b, 0) + Fraction(p)
        for k in names:
            row = rows.pop(k, {})
            row.pop(k, None)
            total = sum(row.values())
            for other in rows.values():
                w = other.pop(k, 0)
                for end, p in (row.items() if total else [("Null", 1)]):
                    other[end] = other.get(end, 0) + (w * p / total if total else w)
        row = rows.get("Start", {})
        row.pop("Start", None)
        total = sum(row.values())
        out[removed] = float(row.get("Conversion", 0) / total) if total else 0.0
    return out


def random_graph(seed, n):
    rng = np.random.default_rng(seed)
    states = [f"c{i:03}" for i in range(n)]
    edges = []
    for a in ["Start", *states]:
        ends = rng.choice([*states, "Conversion", "Null"], size=min(n, 4), replace=False)
        p = rng.random(len(ends)) * 10.0 ** rng.integers(-9, 1, len(ends))
        edges += [(a, str(b), float(q)) for b, q in zip(ends, p / p.sum())]
    return edges


def close(got, expected):
    assert got.keys() == expected.keys()
    for k, p in expected.items():
        assert 0 <= got[k] <= 1 and abs(got[k] - p) <= 1e-12 * max(p, 1e-300), (k, got[k], p)


SLOW = {
    "self-loop": ([("Start", "A", 1.0), ("A", "A", 0.9999999), ("A", "Conversion", 1e-7)], 1.0),
    "cycle with a leak": ([("Start", "A", 1.0), ("A", "B", 0.999999), ("A", "Conversion", 1e-6), ("B", "A", 1.0)], 1.0),
    "two leaks": ([("Start", "A", 1.0), ("A", "B", 1 - 3e-13), ("A", "Conversion", 1e-13), ("A", "Null", 2e-13), ("B", "A", 1.0)], 1 / 3),
    "dead end": ([("Start", "A", 0.5), ("Start", "Conversion", 0.5), ("A", "B", 1.0), ("B", "A", 1.0)], 0.5),
}


@pytest.mark.parametrize("name", SLOW)
def test_slowly_mixing(spark, name):
    edges, full = SLOW[name]
    got = probabilities(spark, edges)
    assert abs(got[None] - full) < 1e-12
    close(got, exact(edges))


@pytest.mark.parametrize("seed", [1, 2])
def test_panels_and_local_chains(spark, monkeypatch, seed):
    edges = random_graph(seed, 37)
    expected = exact(edges)
    close(probabilities(spark, edges), expected)
    monkeypatch.setattr(A, "LOCAL_STATES", 12)
    monkeypatch.setattr(A, "PANEL", 5)
    monkeypatch.setattr(A, "STEP", 2)
    close(probabilities(spark, edges), expected)


def test_odd_graphs(spark):
    assert probabilities(spark, []) == {}
    assert probabilities(spark, [("Start", "Conversion", 0.25), ("Start", "Null", 0.75)]) == {None: 0.25}
    # an end that no edge leaves, an edge back to Start, repeated edges, edges out of an end
    edges = [("Start", "A", 0.5), ("Start", "A", 0.3), ("Start", "gone", 0.2), ("A", "Start", 0.5), ("A", "Conversion", 0.5),
             ("Conversion", "A", 1.0)]
    close(probabilities(spark, edges), exact(edges))
    assert probabilities(spark, [("A", "Conversion", 1.0)]) == {None: 0.0, "A": 0.0}
