"""Vectorised word and character kernels over batches of whole texts.

A batch of texts is laid out as one array of code points.  Words, their
64-bit hashes and the hashes of word n-grams come out of a handful of NumPy
passes, so a Python worker spends nanoseconds per character instead of
creating one object per word.  Chunks are cut by the number of characters,
never inside a text, so memory is bounded by the chunk size (or by the longest
single text).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np

#: Odd multiplier of the polynomial hash and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = 0x20000
CHUNK_CHARS = 1_000_000


class Words(NamedTuple):
    """Words of a chunk: hash, index of the text, first and past-the-end character."""

    hash: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray


@lru_cache(maxsize=4)
def char_tables(marks: bool, digits: bool) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case mapping and word-character flags by code point."""
    lower = np.arange(_TABLE + 1, dtype=np.uint32)
    word = np.zeros(_TABLE + 1, dtype=bool)
    for i in range(_TABLE):
        c = chr(i)
        kind = unicodedata.category(c)
        word[i] = kind[0] == "L" or (digits and kind[0] == "N") or (marks and kind[0] == "M")
        if kind in ("Lu", "Lt"):
            lower[i] = ord(c.lower()[0])
    word[_TABLE] = True  # beyond the table only rare ideographs and symbols remain
    return lower, word


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.full(n, _BASE, np.uint64)
        down = np.full(n, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n`` of each."""
    size = max(CHUNK_CHARS * 5 // 4, 1 << (n - 1).bit_length())
    return _powers(size)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, so that all bits depend on all bits."""
    with np.errstate(over="ignore"):
        h = h.astype(np.uint64, copy=True)
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
    return h


def chunks(texts: Iterable[str | None], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``limit`` characters with the index of the first; null counts as empty."""
    run: list[str] = []
    first = size = 0
    for i, t in enumerate(texts):
        t = t if isinstance(t, str) else ""
        if run and size + len(t) > limit:
            yield first, run
            run, first, size = [], i, 0
        run.append(t)
        size += len(t) + 1
    if run:
        yield first, run


def codepoints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a line feed, and the start of each text (and the end)."""
    cp = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return cp, starts


def words(cp: np.ndarray, starts: np.ndarray, *, marks: bool = True, digits: bool = True) -> Words:
    """Words (maximal runs of word characters, lower case) with their hashes."""
    lower, is_word = char_tables(marks, digits)
    at = np.minimum(cp, _TABLE)
    w = is_word[at]
    edge = np.diff(w.astype(np.int8), prepend=np.int8(0))
    s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    low = np.where(at < _TABLE, lower[at], cp)
    h = spans(low, s, e)
    return Words(mix(h), np.searchsorted(starts, s, side="right") - 1, s, e)


def spans(values: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[s:e] for each pair of positions."""
    up, down = powers(len(values) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=total[1:])
        return (total[e] - total[s]) * down[s]


def ngrams(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``n`` words inside one text, and the index of its first word."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :])
    with np.errstate(over="ignore"):
        acc = np.zeros(len(first), np.uint64)
        for k in range(n):
            acc = acc * np.uint64(_BASE) + h[first + k]
    return mix(acc), first


def repeated_word_share(texts: list[str], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Share of words lying in a run of ``n`` words that began earlier in the same text, and the word count.

    Words are runs of letters (with combining marks) in lower case; the first
    occurrence of a run does not count.
    """
    cp, starts = codepoints(texts)
    w = words(cp, starts, digits=False)
    count = np.bincount(w.doc, minlength=len(texts))
    g, first = ngrams(w.hash, w.doc, n)
    covered = np.zeros(len(w.hash) + 1, np.int32)
    if len(g):
        order = np.lexsort((first, g, w.doc[first]))
        same = np.zeros(len(g), bool)
        same[1:] = (g[order][1:] == g[order][:-1]) & (w.doc[first][order][1:] == w.doc[first][order][:-1])
        at = first[order[same]]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + n, -1)
    hit = np.cumsum(covered)[:-1] > 0
    repeated = np.bincount(w.doc[hit], minlength=len(texts))
    return np.divide(repeated, count, out=np.zeros(len(texts)), where=count > 0), count
