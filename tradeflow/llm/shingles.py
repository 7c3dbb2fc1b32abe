"""Hashes of words and word windows of many texts at once (numpy on Arrow's own buffers)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import BLANKS

#: Texts are hashed in blocks of about so many bytes, so memory follows one block or one text.
BLOCK_BYTES = 1 << 21

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS.encode())] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit with even odds."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from the upper 53 bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, row starts inside them) of consecutive texts; nulls are empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        yield first, last, raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def words_of(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a block in order, and for each row the index of its first word (and the end).

    A word's hash sums a random number for each byte times a power for its place: prefix
    sums over the block and one multiplication give those of all words.
    """
    n_rows = len(starts) - 1
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(n_rows + 1, np.int64)
    solid = ~_BLANK[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[starts] = True
    begins = np.flatnonzero(solid & (edge[:-1] | np.r_[True, ~solid[:-1]]))
    ends = np.flatnonzero(solid & (edge[1:] | np.r_[~solid[1:], True])) + 1
    with np.errstate(over="ignore"):
        longest = int((ends - begins).max()) if len(begins) else 0
        total = np.zeros(len(begins), np.uint64)
        if longest <= 64:  # place by place: rarely many places
            power, alive = 1, np.arange(len(begins))
            for k in range(longest):
                alive = alive[begins[alive] + k < ends[alive]]
                total[alive] += _BYTE[raw[begins[alive] + k]] * np.uint64(power)
                power = power * _BASE & (1 << 64) - 1
        else:
            powers = np.cumprod(np.r_[np.uint64(1), np.full(longest - 1, _BASE, np.uint64)], dtype=np.uint64)
            for i in range(0, len(begins), 4096):  # few words at a time, as each may be long
                b, e = begins[i : i + 4096], ends[i : i + 4096]
                lengths = e - b
                place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                terms = _BYTE[raw[np.repeat(b, lengths) + place]] * powers[place]
                total[i : i + 4096] = np.add.reduceat(terms, np.cumsum(lengths) - lengths)
        hashes = mix(total + (ends - begins).astype(np.uint64) * _STEP)
    return hashes, np.searchsorted(begins, starts).astype(np.int64)


def windows_of(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive word hashes (also across rows: mask those)."""
    count = max(0, len(words) - n + 1)
    with np.errstate(over="ignore"):
        total = np.full(count, seed * 0x9E3779B97F4A7C15 + n & (1 << 64) - 1, np.uint64)
        for k in range(n):
            total = (total + words[k : k + count]) * np.uint64(0xDA942042E4DD58B5)
            total ^= total >> np.uint64(29)
        return mix(total)


def window_rows(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, first word) of each window of ``n`` words that lies inside one row, in order."""
    counts = np.maximum(0, np.diff(first) - n + 1)
    rows = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return rows, first[rows] + inside


__all__ = ["blocks", "words_of", "windows_of", "window_rows", "mix", "uniform"]
