"""Two-stage suffix sorting of many byte segments at once, and common prefixes of neighbours.

A suffix is of the ascending kind if it is smaller than its successor (the
suffix one byte on), else of the descending kind. Only ascending suffixes are
sorted by their bytes. Descending ones are induced: the buckets of first bytes
are scanned from the smallest on, and the predecessor of each suffix met, if
descending, is the next of its own bucket. A segment's end counts as smaller
than every byte.

Suffixes are told apart by their first ``depth`` bytes only; those that agree
there stand next to each other in any order.
"""

from __future__ import annotations

import numpy as np

END = -1


class Segments:
    """Byte segments in one array, each followed by END.

    ``begin`` is the position where each begins, ``left`` the bytes from a
    position to its segment's end, ``word`` the next eight bytes of a position
    as one integer that orders like them, with zeros past the segment's end.
    """

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        sizes = np.asarray(sizes, np.int64)
        self.begin = np.cumsum(sizes + 1) - (sizes + 1)
        self.ends = self.begin + sizes
        n = len(flat) + len(sizes)
        self.text = np.full(n, END, np.int16)
        inside = np.ones(n, bool)
        inside[self.ends] = False
        self.text[inside] = flat
        self.left = np.repeat(self.ends, sizes + 1) - np.arange(n)
        byte = np.zeros(n + 8, np.uint8)
        byte[:n][inside] = flat
        self.word = np.zeros(n, np.uint64)
        for k in range(8):
            part = byte[k : k + n].astype(np.uint64)
            part[self.left <= k] = 0
            self.word |= part << np.uint64(8 * (7 - k))


def ascending(text: np.ndarray) -> np.ndarray:
    """Flags suffixes that are smaller than their successors; an END is of neither kind."""
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    # the step that ends each run of equal bytes decides for the whole run
    at = np.repeat(differs, np.diff(differs, prepend=-1))
    up = np.zeros(n, bool)
    up[: len(at)] = text[at + 1] > text[at]
    up[text == END] = False
    return up


def direct_sort(at: np.ndarray, word: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes ``at`` in order of their first ``depth`` bytes; only ties go on to the next round.

    A round sorts by one integer: the number of the group of equal suffixes,
    and as many further bytes as fit below it.
    """
    order = at[np.argsort(word[at])]
    key = word[order]
    same = key[1:] == key[:-1]
    open_ = _in_ties(same)
    k = 8
    while len(open_) and k < depth:
        group = np.cumsum(np.concatenate([[0], ~same[open_[1:] - 1]]))
        rows = order[open_]
        size = (64 - int(group[-1]).bit_length()) // 8
        more = word[np.minimum(rows + k, len(word) - 1)] >> np.uint64(64 - 8 * size)
        more[left[rows] <= k] = 0
        key = group.astype(np.uint64) << np.uint64(8 * size) | more
        by = np.argsort(key)
        order[open_] = rows[by]
        key = key[by]
        same[open_[1:] - 1] = key[1:] == key[:-1]
        open_ = _in_ties(same)
        k += size
    # a segment that ends is smaller than one that goes on with zero bytes
    group = np.cumsum(np.concatenate([[0], ~same[open_[1:] - 1]])) if len(open_) else open_
    rows = order[open_]
    order[open_] = rows[np.lexsort((np.minimum(left[rows], depth), group))]
    return order


def _in_ties(same: np.ndarray) -> np.ndarray:
    """Places that equal the one before or after; ``same`` tells of each place but the first if it equals the one before."""
    return np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))


def suffix_array(segments: Segments, depth: int) -> np.ndarray:
    """All suffixes (ENDs left out) in order of their first ``depth`` bytes."""
    text = segments.text
    if not len(text):
        return np.zeros(0, np.int64)
    up = ascending(text)
    direct = direct_sort(np.flatnonzero(up), segments.word, segments.left, depth)
    first = text[direct]
    cut = np.searchsorted(first, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]

    def hand_on(found: np.ndarray, above: int) -> None:
        """Puts descending predecessors that start with a byte over ``above`` behind those waiting in their buckets."""
        before = found[found > 0] - 1
        byte = text[before]
        use = (byte > above) & ~up[before]
        before, byte = before[use], byte[use]
        if not len(before):
            return
        by = np.argsort(byte, kind="stable")
        before, byte = before[by], byte[by]
        edge = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1], [True]]))
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            waiting[byte[a]].append(before[a:b])

    hand_on(segments.ends, END)
    out = []
    for c in range(256):
        parts = waiting[c]
        # inside a bucket: runs of its own byte, one byte longer in each round
        newest = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        parts = []
        while len(newest):
            parts.append(newest)
            before = newest[newest > 0] - 1
            newest = before[(text[before] == c) & ~up[before]]
        bucket = np.concatenate([*parts, direct[cut[c] : cut[c + 1]]])
        waiting[c] = []
        if len(bucket):
            hand_on(bucket, c)
            out.append(bucket)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_prefixes(segments: Segments, order: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix of the order but the first, the bytes it shares with the one before, ``depth`` at most."""
    word, left = segments.word, segments.left
    a, b = order[:-1], order[1:]
    most = np.minimum(np.minimum(left[a], left[b]), depth)
    out = np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    for k in range(0, depth, 8):
        open_ = open_[most[open_] > k]
        if not len(open_):
            break
        apart = word[a[open_] + k] ^ word[b[open_] + k]
        same = apart == 0
        out[open_[same]] = k + 8
        # leading equal bytes of a word that differs
        differ = open_[~same]
        high = apart[~same]
        equal = np.zeros(len(differ), np.int64)
        for i in range(1, 8):
            equal += high < np.uint64(1) << np.uint64(64 - 8 * i)
        out[differ] = k + equal
        open_ = open_[same]
    return np.minimum(out, most)
