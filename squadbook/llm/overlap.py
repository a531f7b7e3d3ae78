"""Similarity of documents by shared word runs: sketches, candidates and T-occurrence search."""

from __future__ import annotations

import heapq
from itertools import groupby

import numpy as np

# Short lists with up to so many members in all are merged with a heap, longer ones by sorting.
HEAP_MEMBERS = 512
# Cost of a probe against a step of the merge, in the choice of how many lists are long.
_MU = 0.0085


def required(n: int, m: int, percent: int) -> int:
    """Least overlap of sets of these sizes with ``percent`` of their union in common."""
    return -(-percent * (n + m) // (100 + percent))


def sketch(tokens: np.ndarray) -> bytes:
    """How many members fall into each of some hash ranges, about four on average.

    The sum of the lesser counts bounds an overlap from above. A count that does not fit a
    byte (which takes members that are no hashes) leaves the sketch empty: no bound.
    """
    bits = max(5, (max(len(tokens), 1) // 4).bit_length())
    counts = np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def _folded(sketches: list[np.ndarray], size: int) -> np.ndarray:
    rows = [s if len(s) == size else s.reshape(size, -1).sum(axis=1) for s in sketches]
    return np.stack(rows).astype(np.uint16)


def candidate_links(sizes: np.ndarray, sketches: list[bytes], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that sizes and sketches allow to be similar."""
    order = np.argsort(sizes, kind="stable")
    n = sizes[order].astype(np.int64)
    parts = [np.frombuffer(sketches[i], np.uint8) for i in order.tolist()]
    lengths = np.array([len(p) for p in parts])
    label = np.arange(len(order))
    edges = []
    reach = np.searchsorted(n * percent, n * 100, "right")
    matrices: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for size in sorted({len(p) for p in parts if len(p)}):
        # Sizes grow with the sets, and similar sets are at most one step of the size apart.
        fits = np.flatnonzero((lengths == size) | (lengths == 2 * size))
        matrices[size] = fits, _folded([parts[i] for i in fits.tolist()], size)
    for i in range(len(order) - 1):
        others = np.arange(i + 1, int(reach[i]))
        if not len(others) or (label[others] == label[i]).all():
            continue
        if lengths[i]:
            fits, matrix = matrices[int(lengths[i])]
            lo, hi = np.searchsorted(fits, (i + 1, int(reach[i])))
            own = matrix[np.searchsorted(fits, i)]
            bound = np.minimum(matrix[lo:hi], own).sum(axis=1, dtype=np.int64)
            near = fits[lo:hi]
            near = near[bound * (100 + percent) >= percent * (n[near] + n[i])]
            unknown = others[lengths[others] == 0]
            others = np.concatenate([near, unknown]) if len(unknown) else near
        found, first = np.unique(label[others], return_index=True)
        for lab, at in zip(found.tolist(), first.tolist()):
            if lab != label[i]:
                edges.append((int(order[i]), int(order[others[at]])))
                label[label == lab] = label[i]
    return edges


class InvertedLists:
    """Sets of a block as inverted lists, and the T-occurrence search over them (DivideSkip)."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        _, number, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        self.members = owners[np.argsort(number, kind="stable")]
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts
        cuts = np.cumsum(self.sizes)[:-1]
        # Members that only one set has cannot be shared.
        self.lists = [x[counts[x] > 1] for x in np.split(number, cuts)]

    def drop(self, gone: np.ndarray) -> None:
        """Take the flagged sets out of all lists."""
        stays = ~gone[self.members]
        before = np.concatenate(([0], np.cumsum(stays)))
        self.starts, self.ends = before[self.starts], before[self.ends]
        self.members = self.members[stays]

    def similar(self, probe: int, gone: np.ndarray) -> np.ndarray:
        """Sets not ``gone`` that are similar to the probe's."""
        n = int(self.sizes[probe])
        least = -(-self.percent * n // 100)
        lists = self.lists[probe]
        lengths = self.ends[lists] - self.starts[lists]
        lists, lengths = lists[lengths > 0], lengths[lengths > 0]
        if len(lists) < max(1, least):
            return np.zeros(0, np.int64)
        order = np.argsort(-lengths, kind="stable")
        lists, lengths = lists[order], lengths[order]
        longest = max(2, int(lengths[0]))
        n_long = min(least - 1, int(least / (_MU * np.log2(longest) + 1)))
        long, short = lists[:n_long], lists[n_long:]
        found, shared = self._merge(short, int(lengths[n_long:].sum()))
        keep = (shared >= least - n_long) & ~gone[found] & (found != probe)
        found, shared = found[keep], shared[keep]
        found_n = self.sizes[found]
        need = -(-self.percent * (found_n + n) // (100 + self.percent))
        left = len(long)
        for number in long.tolist():
            # A list is probed for those that can still reach their overlap.
            open_ = shared + left >= need
            if not open_.all():
                found, shared, need = found[open_], shared[open_], need[open_]
            if not len(found):
                break
            members = self.members[self.starts[number] : self.ends[number]]
            place = np.searchsorted(members, found)
            place[place == len(members)] = 0
            shared = shared + (members[place] == found)
            left -= 1
        return found[shared >= need]

    def _merge(self, lists: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
        """Members of these lists and in how many each is."""
        runs = [self.members[self.starts[x] : self.ends[x]] for x in lists.tolist()]
        if total <= HEAP_MEMBERS:
            merged = [(k, sum(1 for _ in g)) for k, g in groupby(heapq.merge(*(r.tolist() for r in runs)))]
            both = np.array(merged, np.int64).reshape(-1, 2)
            return both[:, 0], both[:, 1]
        return np.unique(np.concatenate(runs), return_counts=True)


def similar_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the similar pairs of a block.

    Components are searched from one of their sets on: what a probe finds is taken out of
    the lists and probed later, so a component of copies costs its size, not its square.
    """
    index = InvertedLists(sets, percent)
    gone = np.zeros(len(sets), bool)
    edges, left_in = [], 0
    for seed in np.argsort(-index.sizes, kind="stable").tolist():
        if gone[seed]:
            continue
        gone[seed] = True
        queue = [seed]
        while queue:
            probe = queue.pop()
            found = index.similar(probe, gone)
            gone[found] = True
            edges += [(probe, x) for x in found.tolist()]
            queue += found.tolist()
            left_in += 1 + len(found)
            if left_in * 2 > len(sets) - int(gone.sum()) + left_in:
                index.drop(gone)
                left_in = 0
    return edges
