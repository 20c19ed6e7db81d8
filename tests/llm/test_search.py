"""Nearest neighbours and near duplicates against all pairs."""

import random
from collections import defaultdict

import numpy as np
import pytest
from docs_fixture import make_docs  # noqa: F401

from creditpath.llm import ann, near_dups
from creditpath.llm.components import components


def test_recall_and_scores(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = ann.search(vectors, lambda i: i % 50 == 0).collect()
    rows = vectors.collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], float)
    norm = np.sqrt((x * x).sum(1))
    place = {v: k for k, v in enumerate(ids)}
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found[r.query_id].append(r)
        a, b = x[place[r.query_id]], x[place[r.vec_id]]
        assert r.score == pytest.approx(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b), abs=1e-12)
    hit = total = 0
    for q in ids[ids % 50 == 0]:
        score = x @ x[place[q]] / norm / norm[place[q]]
        score[place[q]] = -9
        best = set(ids[np.argsort(-score)[:5]].tolist())
        hit += len(best & {r.vec_id for r in found[q]})
        total += 5
        assert [r["rank"] for r in found[q]] == [1, 2, 3, 4, 5]
    assert hit / total >= 0.9


@pytest.mark.parametrize("n", [9, 100, 500, 1_000, 2_000, 3_750, 4_500, 6_000, 8_000, 20_000])
def test_recall_at_every_size(n):
    x = ann.unit(np.random.default_rng(n).normal(size=(n, 64)))
    rng = np.random.default_rng(ann.SEED)
    forest = [ann.grow(x, rng) for _ in range(ann.TREES)]
    leaf_of = [tree.route(x) for tree in forest]
    points = ann.budget(x, forest, 5)
    hit = total = 0
    for q in range(0, n, max(1, n // 100)):
        score = x @ x[q]
        score[q] = -9
        reached = np.zeros(n, bool)
        for t, leaf in ann.open_leaves(x[q], forest, points):
            reached |= leaf_of[t] == leaf
        hit += reached[np.argsort(-score)[:5]].sum()
        total += 5
    assert hit / total >= 0.94


@pytest.mark.parametrize("n", [4_000, 8_000])
def test_recall_of_larger_tables(spark, n):
    x = np.random.default_rng(n).normal(size=(n, 64))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = defaultdict(set)
    for r in ann.search(vectors, lambda i: i % 50 == 0).collect():
        found[r.query_id].add(r.vec_id)
    x = ann.unit(x)
    hit = 0
    for q in range(0, n, 50):
        score = x @ x[q]
        score[q] = -9
        hit += len(found[q] & set(np.argsort(-score)[:5].tolist()))
    assert hit / (5 * (n // 50)) >= 0.94


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(64, 64))[rng.integers(0, 64, n)] * 3 + rng.normal(size=(n, 64))


def test_clustered_vectors_need_a_falling_share():
    shares = []
    for n in (500, 4_000, 16_000):
        x = ann.unit(clustered(n, 1))
        rng = np.random.default_rng(ann.SEED)
        forest = [ann.grow(x, rng) for _ in range(ann.TREES)]
        leaf_of = [tree.route(x) for tree in forest]
        points = ann.budget(x, forest, 5)
        hit = scored = 0
        for q in range(0, n, n // 100):
            score = x @ x[q]
            score[q] = -9
            reached = np.zeros(n, bool)
            for t, leaf in ann.open_leaves(x[q], forest, points):
                reached |= leaf_of[t] == leaf
            hit += reached[np.argsort(-score)[:5]].mean()
            scored += reached.mean()
        assert hit / len(range(0, n, n // 100)) >= 0.94
        shares.append(scored / len(range(0, n, n // 100)))
    assert shares[2] < 0.2 and shares[2] < shares[1] < shares[0]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ties_among_scaled_vectors(spark, seed):
    """Vectors of one direction and different lengths: the smallest ids win, in whichever blocks they are."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=16)
    x = rng.normal(size=(1_500, 16))
    same = rng.choice(1_500, 400, replace=False)
    x[same] = base * 2.0 ** rng.integers(-20, 20, 400)[:, None]
    query = int(same[0])
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(vectors, lambda i: i == query).orderBy("rank").collect()
    assert [r.vec_id for r in got] == sorted(set(same.tolist()) - {query})[:5]


def test_best_of_each_keeps_ties():
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(20, 8)), np.repeat(rng.normal(size=(40, 8)), 3, axis=0) * 2.0 ** rng.integers(-5, 5, 120)[:, None]
    first = rng.permutation(120)
    row, column, score = ann.best_of_each(a, b, first, 7)
    for i in range(20):
        exact = (a[i] * b).sum(1) / (np.sqrt((a[i] * a[i]).sum()) * np.sqrt((b * b).sum(1)))
        assert column[row == i].tolist() == np.lexsort((first, -exact))[:7].tolist()


def test_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (10, []), (None, [1.0, 1.0]), (0, [1.0, 0.0]), (50, [-1.0, 0.0]),
    ]
    vectors = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<float>, id string")
    got = ann.search(vectors, lambda i: i % 50 == 0).collect()
    answers = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        answers[r.query_id].append((r.vec_id, round(r.score, 9)))
    assert answers[0] == [(1, 1.0), (2, 1.0), (3, 0.0), (50, -1.0)]
    assert answers[50] == [(3, 0.0), (0, -1.0), (1, -1.0), (2, -1.0)]
    assert ann.search(vectors.limit(0), lambda i: i % 50 == 0).count() == 0


def test_frequent_vector_answers_with_smallest_ids(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(1000 + i, [float(i), 1.0, 0.0]) for i in range(20)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.search(vectors, lambda i: i == 2).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [0, 1, 3, 4, 5]


def test_random_components(spark):
    random.seed(8)
    for n, m in ((30, 20), (60, 90), (200, 150)):
        edges = [(random.randrange(n), random.randrange(n)) for _ in range(m)]
        group = list(range(n))
        for a, b in edges:
            x, y = group[a], group[b]
            group = [min(x, y) if g in (x, y) else g for g in group]
        got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {i: group[i] for a, b in edges if a != b for i in (a, b)}


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 9), (10, 11), (12, 11), (5, 6), (6, 7), (7, 8)] + [(20 + i, 21 + i) for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 9)} == {1}
    assert got[12] == got[10] == 10 and {got[i] for i in range(20, 61)} == {20}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_groups(rows):
    sets = []
    for _, t in rows:
        w = near_words(t)
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    n = len(rows)
    links, group = [0] * n, list(range(n))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                group[find(i)] = find(j)
    least = defaultdict(list)
    for i in range(n):
        least[find(i)].append(rows[i][0])
    return [(min((x for x in least[find(i)] if x is not None), default=None), links[i]) for i in range(n)]


def near_words(t):
    return [w for w in "".join(" " if c in " \t\n\x0b\f\r" else c for c in t or "").split(" ") if w]


def _texts():
    random.seed(6)
    vocabulary = [f"w{i}" for i in range(3_000)]
    rows = []
    for g in range(40):
        base = random.choices(vocabulary, k=random.choice([12, 60, 400]))
        rows.append((len(rows), " ".join(base)))
        for _ in range(random.randint(0, 5)):
            copy = list(base)
            for _ in range(random.randint(0, max(1, len(base) // 60))):
                copy[random.randrange(len(copy))] = random.choice(vocabulary)
            rows.append((len(rows), random.choice([" ", "\n", "  "]).join(copy)))
    shared = " ".join(random.choices(vocabulary, k=80))
    rows += [(len(rows) + k, shared + " " + " ".join(random.choices(vocabulary, k=60))) for k in range(60)]
    n = len(rows)
    rows += [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "a b"), (n + 4, "a  b"), (n + 5, "b a"), (n + 6, "x y z w v"), (3, rows[3][1]), (None, rows[0][1])]
    return rows


@pytest.mark.parametrize("bucket", [512, 4])
def test_near_duplicates_match_all_pairs(make_docs, monkeypatch, bucket):
    monkeypatch.setattr(near_dups, "BUCKET_SETS", bucket)  # few sets: deeper levels and blocks are used
    monkeypatch.setattr(near_dups, "BLOCK_SETS", 3 if bucket == 4 else 256)
    rows = _texts()
    got = near_dups.near_duplicates(make_docs(rows)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, str(r))
    want = sorted(((i, c if t and near_words(t) else i, n) for (i, t), (c, n) in zip(rows, plain_groups(rows))), key=key)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=key) == want


def test_near_copies_without_ids(make_docs):
    random.seed(11)
    base = random.choices([f"w{i}" for i in range(3_000)], k=200)
    near = [" ".join([*base[:i], "new", *base[i + 1 :]]) for i in (0, 199)]
    far = " ".join(reversed(base))
    rows = [(None, " ".join(base)), (None, near[0]), (None, near[0]), (None, near[1]), (None, far), (7, "other text"), (None, None)]
    got = near_dups.near_duplicates(make_docs(rows)).collect()
    key = lambda r: str(r)
    want = [(None, None, 1, 3), (None, None, 2, 3), (None, None, 2, 3), (None, None, 1, 3), (None, None, 1, 0), (7, 7, 1, 0), (None, None, 1, 0)]
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    # a named set that only nameless ones link to another keeps its class
    chain = ["base", *(f"c{k}" for k in range(40))]
    bridge = [base[:], base[:], base[:]]
    for k in range(3):
        for j in range(k):
            bridge[k][199 - 3 * j] = chain[j]
    rows = [(5, " ".join(bridge[0])), (None, " ".join(bridge[1])), (9, " ".join(bridge[2]))]
    assert {(r.doc_id, r.class_id, r.n_links) for r in near_dups.near_duplicates(make_docs(rows)).collect()} == {
        (5, 5, 2), (None, 5, 2), (9, 5, 2)
    }


def test_no_documents(make_docs):
    assert near_dups.near_duplicates(make_docs([])).count() == 0
    assert [tuple(r) for r in near_dups.near_duplicates(make_docs([(5, None)])).collect()] == [(5, 5, 1, 0)]


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(3)
    for size in (40, 600):
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        shared = int(size * 0.9)
        other = np.concatenate([base[:shared], rng.integers(0, 1 << 63, size - shared, dtype=np.uint64)])
        both = near_dups.sketches(np.concatenate([np.sort(base), np.sort(other)]), np.array([size, size])).view(np.uint64)
        differ = near_dups._differ(both[0], both[1])
        expected = (1 - shared / (2 * size - shared)) / 2 * near_dups.SKETCH_BITS
        assert abs(differ - expected) < 25
