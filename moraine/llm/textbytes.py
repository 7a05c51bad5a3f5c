"""Vectorised work on batches of texts as one byte array: offsets, words, hashes."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * MIX2
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): all texts of a string column as UTF-8 one after another; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64, n + 1, column.offset * 8)
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the 0..n-1 and its inverse's powers, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 18)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for key, base in (("up", BASE), ("down", inverse)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _powers[key] = np.multiply.accumulate(out)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums of (byte + 1) * BASE**i before each place; two of them give any substring's number.

    Such a number is quick to have for every place, but texts can be made whose numbers agree (Thue-Morse words). So it may
    choose where things meet, and never says that they are equal: span_hash() does.
    """
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=out[1:])
    return out


LONG = 1024


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the substrings start..end: 8 bytes after 8 bytes through a bijection; of more than LONG bytes, BLAKE2b."""
    size = (end - start).astype(np.int64)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    word = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded.data, strides=(1,))  # the 8 bytes from each place on
    out = mix(size.astype(np.uint64) * MIX2 + MIX1)
    for i in np.flatnonzero(size > LONG):
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    live, at = np.flatnonzero((size > 0) & (size <= LONG)), 0
    while len(live):
        left = size[live] - at
        part = word[start[live] + at]
        short = left < 8
        part = np.where(short, part & ((np.uint64(1) << (np.where(short, left, 0).astype(np.uint64) * np.uint64(8))) - np.uint64(1)), part)
        out[live] = mix((out[live] ^ part) * MIX1 + MIX2)
        live, at = live[left > 8], at + 8
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): words as runs of bytes with gap[byte] False, never across texts; first[d] is the number of text d's first word."""
    inside = ~gap[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    edges = offsets[1:-1]
    before[edges[edges < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    last = edges[(edges > 0) & (edges <= len(data))] - 1
    after[last] = False
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def give_back() -> None:
    """Freed memory to the system: Python workers are reused and idle ones stay, so what they keep adds up."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(run, rows: int = 500):
    """run over slices of batches, so that what it holds follows some rows only, with memory given back after a task."""

    def out(batches):
        try:
            yield from run(b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows))
        finally:
            give_back()

    return out


def lean_group(work):
    """work on a group's table, with memory given back after it."""

    def out(tab):
        try:
            return work(tab)
        finally:
            give_back()

    return out
