"""Byte n-grams as integers: counting them in a task, and looking model values up by them.

Both the counter and the cache are tables with one slot per hash of a gram.
The counter keeps grams that lose their slot aside, so its counts are exact;
the cache evaluates a gram anew when another holds its slot.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

HASH = np.uint64(0x9E3779B97F4A7C15)
#: Grams kept aside before they are added up.
ASIDE = 1 << 19


def windows(data: np.ndarray, size: int) -> np.ndarray:
    """At every byte the integer of the last ``size`` bytes, the newest lowest; zeros stand before the first."""
    out = data.astype(np.int64)
    shifted = out
    for k in range(1, size):
        older = np.zeros_like(out)
        older[k:] = shifted[:-k] if k < len(out) else 0
        out = out | older << 8 * k
    return out


def _slots(grams: np.ndarray, bits: int) -> np.ndarray:
    return ((grams.astype(np.uint64) * HASH) >> np.uint64(64 - bits)).astype(np.int64)


class Counter:
    """Exact counts of the grams of one task."""

    def __init__(self, bits: int = 20):
        self.bits = bits
        self.gram = np.full(1 << bits, -1, np.int64)
        self.count = np.zeros(1 << bits, np.int64)
        self.aside: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_aside = 0

    def add(self, grams: np.ndarray) -> None:
        at = _slots(grams, self.bits)
        hit = self.gram[at] == grams
        self.count += np.bincount(at[hit], minlength=len(self.count))
        rest, n = np.unique(grams[~hit], return_counts=True)
        if not len(rest):
            return
        at = _slots(rest, self.bits)
        free = np.flatnonzero(self.gram[at] < 0)
        _, first = np.unique(at[free], return_index=True)
        put = free[first]
        self.gram[at[put]] = rest[put]
        self.count[at[put]] = n[put]
        left = np.ones(len(rest), bool)
        left[put] = False
        if left.any():
            self.aside.append((rest[left], n[left]))
            self.n_aside += int(left.sum())
            if self.n_aside > ASIDE:
                self.aside = [_added_up(self.aside)]
                self.n_aside = len(self.aside[0][0]) // 2  # grows with what stays distinct

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        used = self.gram >= 0
        return _added_up([*self.aside, (self.gram[used], self.count[used])])


def _added_up(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams = np.concatenate([g for g, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    gram, which = np.unique(grams, return_inverse=True)
    return gram, np.bincount(which, counts, len(gram)).astype(np.int64)


class Cache:
    """Values of grams, evaluated once while they hold their slot."""

    def __init__(self, evaluate: Callable[[np.ndarray], np.ndarray], width: int, bits: int = 20):
        self.evaluate, self.bits = evaluate, bits
        self.gram = np.full(1 << bits, -1, np.int64)
        self.value = np.zeros((1 << bits, width), np.float32)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        at = _slots(grams, self.bits)
        out = self.value[at]
        miss = np.flatnonzero(self.gram[at] != grams)
        if len(miss):
            new, which = np.unique(grams[miss], return_inverse=True)
            value = self.evaluate(new).astype(np.float32)
            out[miss] = value[which]
            slot = _slots(new, self.bits)
            self.gram[slot], self.value[slot] = new, value
            # of grams with one slot the last stays, in both columns alike
        return out
