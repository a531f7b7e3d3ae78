"""Texts of an Arrow batch as numpy arrays: words, their hashes, runs of words.

Everything here works on the UTF-8 bytes of many texts at once. Memory is bounded by
``CHUNK`` bytes of text at a time, whatever the size of a batch or of a single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null is empty."""
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the hash base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, CHUNK + 4096)
        factors = np.ones((2, size), np.uint64)
        factors[0, 1:], factors[1, 1:] = _BASE, _BASE_INVERSE
        _powers[:] = np.cumprod(factors, axis=1)
    return _powers[0], _powers[1]


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Position-weighted prefix sums; ``span_hashes`` turns them into hashes of spans."""
    power, _ = powers(len(codes))
    sums = np.empty(len(codes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[: len(codes)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans ``[start, end)``: equal spans anywhere have equal hashes."""
    _, inverse = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def cuts(offsets: np.ndarray, separator: np.ndarray, size: int) -> list[int]:
    """Places to cut the bytes at, about every CHUNK, never within a word."""
    places, at = [0], 0
    while size - at > CHUNK:
        target = at + CHUNK
        row = int(np.searchsorted(offsets, target, "right")) - 1
        if offsets[row] > at:
            at = int(offsets[row])
        else:
            found = target
            while found < size and not separator[found]:
                found += 1
            end = int(offsets[row + 1])
            at = min(found, end)
        places.append(at)
    places.append(size)
    return places


class Words:
    """The words of many texts: hash, first byte and end of each; first word of each text."""

    def __init__(self, hashes, starts, ends, first):
        self.hashes, self.starts, self.ends, self.first = hashes, starts, ends, first


def words(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray, codes: np.ndarray) -> Words:
    """Words are runs of bytes flagged in ``letters``; ``codes`` folds bytes for hashing."""
    inside = letters[data] if len(data) else np.zeros(0, bool)
    places = cuts(offsets, ~inside, len(data))
    hashes, starts, ends = [], [], []
    for lo, hi in zip(places, places[1:]):
        flag = inside[lo:hi]
        if not len(flag):
            continue
        begin = flag.copy()
        begin[1:] &= ~flag[:-1]
        borders = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi)] - lo
        begin[borders] |= flag[borders]
        last = flag.copy()
        last[:-1] &= ~flag[1:] | begin[1:]
        s, e = np.flatnonzero(begin), np.flatnonzero(last) + 1
        sums = prefix_hashes(codes[data[lo:hi]])
        hashes.append(span_hashes(sums, s, e))
        starts.append(s + lo)
        ends.append(e + lo)
    if not starts:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64))
    starts, ends = np.concatenate(starts), np.concatenate(ends)
    return Words(np.concatenate(hashes), starts, ends, np.searchsorted(starts, offsets))


def _flags(*spans: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for lo, hi in spans:
        table[lo : hi + 1] = True
    return table


# Bytes of words between white space, and of words of letters, digits and non-ASCII.
BETWEEN_SPACES = ~_flags((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = _flags((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
# A-Z folded to a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


_FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of ``width`` consecutive values, one for each start."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n] * _FACTORS[0]
    for k in range(1, width):
        total = total + hashes[k : k + n] * _FACTORS[k]
    return mix(total)


def shingle_sets(found: Words, width: int) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct hashes of its runs of ``width`` words.

    A shorter text has its whole sequence as the one member, a text without words none.
    """
    # Runs that cross texts are computed with the others and not looked at.
    all_runs = runs(found.hashes, width)
    for lo, hi in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        n = hi - lo
        if n >= width:
            yield np.unique(all_runs[lo : hi - width + 1])
        elif n:
            yield mix(runs(found.hashes[lo:hi], n) + np.uint64(n))
        else:
            yield np.zeros(0, np.uint64)
