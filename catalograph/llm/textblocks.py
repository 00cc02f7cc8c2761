"""Words, lines and hashes of many texts at once, on their UTF-8 bytes.

A run of texts is one byte array with row offsets (``support.slices``). All
functions are whole-array numpy; none loops over rows or words.
"""

from __future__ import annotations

import functools

import numpy as np

# The bytes between words, space and \x09 to \x0D.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (splitmix64 finish)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def numbers(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)) * np.uint64(_BASE))


@functools.cache
def _space() -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(SPACES)] = True
    return table


@functools.cache
def _byte_values(lower: bool) -> np.ndarray:
    table = numbers(11, 256)
    if lower:
        table[65:91] = table[97:123]
    return table


_CHUNK = 1 << 18


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """base**k and its inverse modulo 2**64 for k up to ``_CHUNK``."""
    tables = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        table = np.ones(2 * _CHUNK, np.uint64)
        step, done = base, 1
        while done < len(table):
            table[done:2 * done] = table[:done] * np.uint64(step)
            step, done = step * step & _MASK, done * 2
        tables.append(table)
    return tables[0], tables[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each byte span; equal bytes give equal hashes wherever they stand.

    ``starts`` and ``ends`` both ascend. Sums of bytes times powers run over the data in
    chunks; only their values at the spans' ends are kept.
    """
    (up, down), values = _powers(), _byte_values(lower)
    out, shift = np.zeros(len(starts), np.uint64), np.empty(len(starts), np.uint64)
    carry, scale = np.uint64(0), 1
    for begin in range(0, len(data) + 1, _CHUNK):
        part = data[begin:begin + _CHUNK]
        total = np.empty(len(part) + 1, np.uint64)
        total[0] = carry
        np.cumsum(values[part] * up[:len(part)], out=total[1:])
        total[1:] *= np.uint64(scale)
        total[1:] += carry
        a, b = np.searchsorted(starts, (begin, begin + _CHUNK))
        out[a:b] -= total[starts[a:b] - begin]
        shift[a:b] = down[starts[a:b] - begin] * np.uint64(pow(scale, -1, 1 << 64))
        a, b = np.searchsorted(ends, (begin, begin + _CHUNK))
        out[a:b] += total[ends[a:b] - begin]
        carry, scale = total[-1], scale * pow(_BASE, _CHUNK, 1 << 64) & _MASK
    return mix(out * shift + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row offsets into them) of all words."""
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    word = ~_space()[data]
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row of each) of all lines; only \\n separates."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([offsets[1:], breaks])
    rows = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((starts, rows))
    return starts[order], np.sort(ends), rows[order]


def windows(hashes: np.ndarray, offsets: np.ndarray, width: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every run of ``width`` words inside one row."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    odd = numbers(seed, width) | np.uint64(1)
    total = np.zeros(count, np.uint64)
    for j in range(width):
        total += hashes[j:j + count] * odd[j]
    ends = np.repeat(offsets[1:], np.diff(offsets))
    first = np.flatnonzero(np.arange(count) + width <= ends[:count])
    return mix(total[first]), first


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each row's span."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def row_of(offsets: np.ndarray) -> np.ndarray:
    """The row of every item."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def in_row(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hashes made distinct between rows."""
    return mix(hashes ^ mix(rows.astype(np.uint64) + np.uint64(1)))
