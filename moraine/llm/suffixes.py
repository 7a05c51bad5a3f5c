"""Suffix order of many short byte strings at once, and what precedes or follows each suffix in it."""

from __future__ import annotations

import numpy as np


def smaller_neighbours(sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(previous, next): for each place in suffix order, the nearest places whose suffix starts at a smaller position; -1 and len(sa) where none."""

    def previous(a: np.ndarray) -> np.ndarray:
        at = np.arange(-1, len(a) - 1)
        todo = np.flatnonzero((at >= 0) & (a[at] > a))
        while len(todo):  # what is skipped is larger than the one it is skipped from, so jumps may use unfinished links
            at[todo] = at[at[todo]]
            todo = todo[(at[todo] >= 0) & (a[at[todo]] > a[todo])]
        return at

    return previous(sa), len(sa) - 1 - previous(sa[::-1])[::-1]


def order_to(data: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, same): starts in suffix order to a depth of ``size`` bytes, ties by position; same[r] tells that places r-1 and r agree in all of them.

    Prefix doubling from 8 bytes on; only positions whose rank is still shared are ranked again. Starts must leave ``size``
    bytes of data behind them, and size must be 16 at least.
    """
    n = len(data)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = data
    word = np.zeros(n, np.uint64)
    for i in range(8):
        word = word << np.uint64(8) | padded[i : i + n]
    rank = np.unique(word, return_inverse=True)[1].astype(np.int64)
    h, live = 8, np.arange(n)
    while 2 * h <= size:
        again = live[live + h < n]
        shared = np.bincount(rank)[rank[again]] > 1
        again = again[shared]
        if not len(again):
            break
        pair = rank[again] * (n + 1) + rank[again + h]
        values, new = np.unique(pair, return_inverse=True)
        # ranks within one old rank follow each other, after all untouched ranks of smaller ones
        firsts = values // (n + 1)
        size_of = np.bincount(firsts, minlength=rank.max() + 1)
        untouched = np.ones(rank.max() + 1, np.int64)
        room = np.where(size_of > 0, size_of + 1, untouched)  # one more for positions too near the end
        base = np.r_[0, np.cumsum(room)[:-1]]
        inside = np.arange(len(values)) - np.r_[0, np.cumsum(size_of)][firsts]
        fresh = base[rank]
        fresh[again] = base[firsts[new]] + 1 + inside[new]
        rank = np.unique(fresh, return_inverse=True)[1].astype(np.int64)
        live, h = again, 2 * h
    if not len(starts):
        return starts, np.zeros(0, bool)
    a, b = rank[starts], rank[starts + size - h]
    order = np.lexsort((starts, b, a))
    a, b = a[order], b[order]
    return starts[order], np.r_[False, (a[1:] == a[:-1]) & (b[1:] == b[:-1])]


def factors(data: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(earlier, later): whether the longest previous, and the longest next, factor of each start has ``size`` bytes or more.

    These are the entries of the longest-previous-factor array compared with ``size``, which is all that a cut needs. Both come from the nearest smaller positions in suffix order: a start has an earlier match of that length if such a
    neighbour lies in its run of equal prefixes, and it gives the neighbour a later one.
    """
    order, same = order_to(data, starts, size)
    if not len(order):
        return np.zeros(0, bool), np.zeros(0, bool)
    run = np.cumsum(~same)
    before, after = smaller_neighbours(order)
    n = len(order)
    earlier = ((before >= 0) & (run[np.maximum(before, 0)] == run)) | ((after < n) & (run[np.minimum(after, n - 1)] == run))
    back_before, back_after = smaller_neighbours(-order)  # larger positions
    later = ((back_before >= 0) & (run[np.maximum(back_before, 0)] == run)) | ((back_after < n) & (run[np.minimum(back_after, n - 1)] == run))
    at = np.searchsorted(starts, order)
    e, l = np.zeros(n, bool), np.zeros(n, bool)
    e[at], l[at] = earlier, later
    return e, l
