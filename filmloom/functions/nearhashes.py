"""Near pairs among 64-bit hashes, as a kernel over sorted runs of candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Runs of up to so many hashes are compared pair by pair.
LEAF = 1024


def bands(bits: list[int], distance: int) -> list[int]:
    """Masks that share the bits out over distance + 1 bands: hashes within the distance agree on one of them at least."""
    n = distance + 1
    edges = [len(bits) * i // n for i in range(n + 1)]
    return [sum(1 << b for b in bits[x:y]) for x, y in zip(edges, edges[1:], strict=False)]


def _lengths(run: np.ndarray) -> np.ndarray:
    start = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    return np.diff(np.r_[start, len(run)])


def _pairs_in(lengths: np.ndarray) -> int:
    return int((lengths * (lengths - 1) // 2).sum())


def near(run: np.ndarray, h: np.ndarray, distance: int, agreed: int, earlier: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of the same run within the distance, without those that agree on one of the masks ``earlier``.

    ``run`` is sorted.  The hashes of a run are distinct and agree on the bits of ``agreed``.  Long runs are dealt
    again into bands of their other bits, as often as that saves comparisons; a pair counts in the
    first of the bands it agrees on.
    """
    if not len(run):
        return
    lengths = _lengths(run)
    after = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(run)) - 1  # rows that follow in the run
    long = np.flatnonzero(np.repeat(lengths > LEAF, lengths))
    free = [b for b in range(64) if not agreed >> b & 1]
    if len(long) and len(free) > distance:
        masks = bands(free, distance)
        dealt, cost = [], 0
        for m in masks:
            key = h[long] & np.uint64(m)
            order = np.lexsort((key, run[long]))
            own, key = run[long][order], key[order]
            label = np.cumsum(np.r_[True, (own[1:] != own[:-1]) | (key[1:] != key[:-1])])
            cost += _pairs_in(_lengths(label))
            dealt.append((order, label))
        if 2 * cost < _pairs_in(lengths[lengths > LEAF]):
            for k, (order, label) in enumerate(dealt):
                at = long[order]
                for i, j in near(label, h[at], distance, agreed | masks[k], earlier + masks[:k]):
                    yield at[i], at[j]
            after[long] = 0
    step, i = 1, np.flatnonzero(after > 0)
    while len(i):
        x = h[i] ^ h[i + step]
        hit = np.flatnonzero(np.bitwise_count(x) <= distance)
        for m in earlier:
            hit = hit[(x[hit] & np.uint64(m)) != 0]
        if len(hit):
            yield i[hit], i[hit] + step
        step += 1
        i = i[after[i] >= step]


def in_bands(group: np.ndarray, band: np.ndarray, h: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within the distance among rows that were dealt to the bands of all 64 bits, sorted by group, band and value; each pair once."""
    masks = bands(list(range(64)), distance)
    for k, m in enumerate(masks):
        at = np.flatnonzero(band == k)
        key = h[at] & np.uint64(m)
        run = np.cumsum(np.r_[True, (group[at][1:] != group[at][:-1]) | (key[1:] != key[:-1])][: len(at)])
        for i, j in near(run, h[at], distance, m, masks[:k]):
            yield at[i], at[j]


def ends_of_runs(group: np.ndarray, band: np.ndarray, h: np.ndarray, distance: int) -> np.ndarray:
    """Positions at which another (group, band, value) begins."""
    masks = np.array(bands(list(range(64)), distance), np.uint64)
    key = h & masks[band]
    return np.flatnonzero((group[1:] != group[:-1]) | (band[1:] != band[:-1]) | (key[1:] != key[:-1])) + 1
