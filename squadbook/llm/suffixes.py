"""Suffix arrays by two-stage sorting, and the common prefixes of neighbours."""

from __future__ import annotations

import numpy as np


def two_stage(text: bytes, depth: int) -> np.ndarray:
    """All suffixes of ``text`` in the order of their first ``depth`` bytes.

    Only suffixes that are smaller than their successor are sorted by comparison. The others
    follow: in a scan from the smallest suffix on, the suffix one byte longer than the one at
    hand takes the next place at the head of its first byte's bucket, if it is larger than
    its successor.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(text, np.uint8)
    # A run of equal bytes is as large or small as its last byte against what follows it.
    last = np.append(np.flatnonzero(codes[1:] != codes[:-1]), n - 1)
    follows = np.append(codes[last[:-1] + 1], 0).astype(np.int64)
    smaller_run = codes[last] < follows
    smaller_run[-1] = False  # the end is smaller than any byte
    smaller = np.repeat(smaller_run, np.diff(last, prepend=-1))
    direct = sorted(np.flatnonzero(smaller).tolist(), key=lambda p: text[p : p + depth])
    ends = np.cumsum(np.bincount(codes, minlength=256))
    heads = np.concatenate(([0], ends[:-1])).tolist()
    order = np.full(n, -1, np.int64)
    direct = np.array(direct, np.int64)
    first = codes[direct]
    counts = np.bincount(first, minlength=256)
    within = np.arange(len(direct)) - np.repeat(np.cumsum(counts) - counts, counts)
    order[(ends - counts)[first] + within] = direct
    places, larger = order.tolist(), (~smaller).tolist()
    places[heads[text[n - 1]]] = n - 1
    heads[text[n - 1]] += 1
    for at in range(n):
        p = places[at] - 1
        if p >= 0 and larger[p]:
            c = text[p]
            places[heads[c]] = p
            heads[c] += 1
    return np.array(places, np.int64)


def common_prefixes(text: bytes, order: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix but the first, how many of its first ``depth`` bytes agree with the one before.

    Eight bytes are compared at a time; pairs that differ are settled and left out.
    """
    if len(order) < 2:
        return np.zeros(0, np.int64)
    padded = np.frombuffer(text + bytes(depth + 16), np.uint8)
    size = len(text) + depth + 8
    words = np.zeros(size, np.uint64)
    for k in range(8):
        words |= padded[k : k + size].astype(np.uint64) << np.uint64(8 * k)
    common = np.full(len(order) - 1, depth, np.int64)
    open_ = np.arange(len(common))
    for at in range(0, depth, 8):
        differ = words[order[open_] + at] ^ words[order[open_ + 1] + at]
        settled = differ != 0
        if settled.any():
            low = differ[settled]
            low &= ~low + np.uint64(1)
            zeros = np.log2(low.astype(np.float64)).astype(np.int64) // 8
            common[open_[settled]] = np.minimum(at + zeros, depth)
            open_ = open_[~settled]
        if not len(open_):
            break
    return common


def repeated_starts(pieces: list[bytes], depth: int) -> list[np.ndarray]:
    """Of each piece, the places whose ``depth`` bytes start anywhere else in the pieces."""
    text = b"".join(pieces)
    sizes = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(pieces)), sizes)
    order = two_stage(text, depth)
    # Places too near the end of their piece start no string of that length.
    order = order[order + depth <= ends[owner[order]]]
    same = common_prefixes(text, order, depth) >= depth
    repeated = np.zeros(len(text), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    return [np.flatnonzero(repeated[lo:hi]) for lo, hi in zip((ends - sizes).tolist(), ends.tolist())]
