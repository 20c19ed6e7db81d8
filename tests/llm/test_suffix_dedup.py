"""Two-stage suffix sorting against sorted slices, and removal of repeats against a set of all strings."""

import hashlib

import numpy as np
import pytest
from docs_fixture import make_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from creditpath.llm import suffix_dedup as S
from creditpath.llm.suffix_sort import Segments, common_prefixes, suffix_array

LAST = (1 << 63) - 1


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=50) | st.text("ab\0", max_size=60).map(str.encode), min_size=1, max_size=6), st.sampled_from([8, 20, 100]))
def test_suffixes_in_order(parts, depth):
    segments = Segments(np.frombuffer(b"".join(parts), np.uint8), [len(p) for p in parts])
    order = suffix_array(segments, depth)
    of = {int(b) + j: p[j:][:depth] for p, b in zip(parts, segments.begin) for j in range(len(p))}
    told = [of[i] for i in order.tolist()]
    assert sorted(order.tolist()) == sorted(of) and told == sorted(told)
    shared = [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(told, told[1:])]
    assert common_prefixes(segments, order, depth).tolist() == shared


def brute(rows, length):
    seen, found = set(), {}
    for i, text in sorted({(LAST if i is None else i, t or "") for i, t in rows}, key=lambda r: r[0]):
        b = text.encode()
        step = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                step[p] += 1
                step[p + length] -= 1
            seen.add(b[p : p + length])
        gone = np.cumsum(step[:-1]) > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        n_spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        found[i, text] = (len(b), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest())
    return [(i, *found[LAST if i is None else i, t or ""]) for i, t in rows]


def mixed_rows(seed):
    rng = np.random.default_rng(seed)
    base = " ".join(rng.choice([f"w{i}é" for i in range(40)], 400))
    rows = []
    for i in range(50):
        rows.append(
            (
                i,
                (
                    base[rng.integers(0, 200) : rng.integers(300, 1200)],
                    "ab" * int(rng.integers(0, 300)),
                    base[:200] + str(i) + base[200:400] + "\x00" * int(rng.integers(0, 200)),
                    ["", None][i % 2],
                    "x" * int(rng.integers(90, 400)) + base[100:350],
                )[i % 5],
            )
        )
    return rows + rows[:5] + [(None, base[50:500])]


def by_id(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("length, hot", [(100, S.HOT), (100, 3), (40, S.HOT), (40, 3)])
def test_against_all_strings(make_docs, length, hot):
    """Copies, runs of one byte, zero bytes, null and repeated rows; with ``hot`` low, hot anchors stand apart."""
    rows = mixed_rows(length + hot)
    docs = make_docs(rows).repartition(5)
    assert by_id(S.digest(S.remove_repeats(docs, length, hot=hot)).collect()) == by_id(brute(rows, length))


def test_pieces_of_long_texts_and_many_slices(make_docs, monkeypatch):
    monkeypatch.setattr(S, "SLICE_BYTES", 700)
    monkeypatch.setattr(S, "SORT_BYTES", 500)
    rows = [(i, t and t * 3) for i, t in mixed_rows(9)]
    data = [(t or "").encode() for _, t in rows]
    cutter = S.Cutter(100, np.zeros(0, np.uint64))
    ends = np.cumsum([len(b) for b in data])
    row, start, count = (np.concatenate(x) for x in list(zip(*cutter.segments(np.frombuffer(b"".join(data), np.uint8), ends)))[2:])
    covered = sorted((int(r), int(s) + k) for r, s, n in zip(row, start, count) for k in range(int(n)))
    assert covered == [(r, p) for r, b in enumerate(data) for p in range(len(b) - 99)]
    late = S.later_strings(*segments_of(data, row, start, count), 100)
    places = {(int(o), p) for o, a, b in zip(late[0], late[2], late[3]) for p in range(int(a), int(b) + 1)}
    seen, expected = set(), set()
    for r, b in enumerate(data):
        for p in range(len(b) - 99):
            expected |= {(r, p)} if b[p : p + 100] in seen else set()
            seen.add(b[p : p + 100])
    assert places == expected


def segments_of(data, row, start, count):
    parts = [data[r][s : s + n + 99] for r, s, n in zip(row.tolist(), start.tolist(), count.tolist())]
    return np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts]), row, row * 0, start


def test_general_output(make_docs):
    a = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(80))
    got = {r.doc_id: r for r in S.remove_repeats(make_docs([(1, a), (2, "new " + a + " end"), (3, "short")])).collect()}
    assert got[1].spans == [] and got[1].kept.decode() == a
    assert [tuple(s) for s in got[2].spans] == [(4, 4 + len(a))] and got[2].kept == b"new  end"
    assert got[3].kept == b"short"


def test_ids_that_repeat_and_empty_table(make_docs):
    a, b = "p" * 60 + "q" * 60, "p" * 60 + "q" * 60 + "!"
    got = S.digest(S.remove_repeats(make_docs([(1, a), (1, b), (1, a)]))).collect()
    # of two texts with one id the one with the smaller hash comes first; equal rows are one document
    assert sorted(r.n_removed for r in got) in ([0, 0, 120], [0, 120, 120])
    assert S.remove_repeats(make_docs([])).collect() == []
