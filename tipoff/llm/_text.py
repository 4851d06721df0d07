"""Vectorised words and hashes over Arrow text columns; every function works on whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
MASK = (1 << 64) - 1


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finaliser that spreads 64-bit values (splitmix64)."""
    x = x + U64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & MASK)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def byte_table(seed: int, fold_case: bool = False) -> np.ndarray:
    """A random odd-or-even 64-bit value for each byte; A-Z take the values of a-z if fold_case."""
    t = mix(np.arange(256, dtype=U64), seed + 1)
    if fold_case:
        t[65:91] = t[97:123]
    return t


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64."""
    out = np.full(max(n, 1), base & MASK, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) for runs of rows of about max_bytes; null texts are empty; a longer text comes alone."""
    col = batch.column(column)
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        col, kind = col.cast(pa.string()), np.int32
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if n == 0:
        return
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], kind, n + 1, col.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + max_bytes, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def word_bounds(data: np.ndarray, offs: np.ndarray, member: np.ndarray = ~SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (exclusive) and row of each word: a maximal run of member bytes (others than space and 09-0D) inside one text."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = member[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:n]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | edge[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(offs, s, "right") - 1


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray, table: np.ndarray, base: int) -> np.ndarray:
    """A mixed polynomial 64-bit hash of each word's bytes."""
    if len(s) == 0:
        return np.zeros(0, U64)
    ln = e - s
    first = np.cumsum(ln) - ln
    idx = np.arange(int(ln.sum())) - np.repeat(first, ln)
    raw = table[data[np.repeat(s, ln) + idx]] * powers(base, int(ln.max()))[idx]
    return mix(np.add.reduceat(raw, first) + ln.astype(U64))


def ngrams(h: np.ndarray, n: int, mult: int, seed: int = 0) -> np.ndarray:
    """Order-sensitive 64-bit hash of each n consecutive values; callers mask windows that cross texts."""
    if len(h) < n:
        return np.zeros(0, U64)
    out = np.zeros(len(h) - n + 1, U64)
    m = U64(mult)
    for j in range(n):
        out *= m
        out += h[j : len(h) - n + 1 + j]
    return mix(out, seed)


def row_slices(rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Offsets of each row's stretch in a sorted array of row numbers."""
    return np.searchsorted(rows, np.arange(n_rows + 1))


def merge_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans as maximal disjoint ones (touching spans join)."""
    if len(start) == 0:
        return start, end
    o = np.argsort(start, kind="stable")
    s, e = start[o], np.maximum.accumulate(end[o])
    new = np.r_[True, s[1:] > e[:-1]]
    return s[new], e[np.r_[np.flatnonzero(new)[1:] - 1, len(e) - 1]]
