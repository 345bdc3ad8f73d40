"""Problem 9: passages of evaluation texts inside a corpus."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.functions import wordkernel as K
from filmloom.sources.tables import table

#: Consecutive words that make a passage.
PASSAGE_WORDS = 12
#: Characters of a q-gram, and edits of characters that a region may hold within a passage.
Q, EDITS = 8, 2
#: Width of a diagonal band; bands overlap by half.
BAND = 32
#: Words of a piece: longer items are indexed in pieces that overlap by a passage, so that no piece is long.
PIECE_WORDS = 256
#: Shared q-grams that are looked at together; more of them are taken in slices of items, then of text.
HITS = 1_000_000
#: Characters of evaluation text in one index; more of it is taken in blocks, so that what goes to the executors is bounded.
BLOCK_CHARS = 4_000_000
_BITS = 22
_TAG = re.compile(r"<!--.*?-->|</?[A-Za-z][^<>]*>", re.S)


def plain(text: str) -> str:
    """Text without tags, with entities resolved and characters composed."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub("", text)
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text


class Stream(NamedTuple):
    """Word characters of texts without anything between them."""

    chars: np.ndarray  # lower-case code points
    opens: np.ndarray  # the character begins a word
    closes: np.ndarray  # the character ends a word
    label: np.ndarray  # the character belongs to a label at the start of a line
    starts: np.ndarray  # where each text begins (and the end)
    numbered: np.ndarray  # texts with numbers at the start of a line


def stream(texts: list[str], numbers: bool = False) -> Stream:
    """Word characters of all texts, with or without the numbers at the start of a line (time codes, list numbers).

    Blanks, punctuation and invisible characters vanish, and so do hyphens at a
    line end.  Invisible characters inside a word do not end it.
    """
    cp, starts = K.codepoints(texts)
    lower, is_word = K.char_tables(True, True)
    at = np.minimum(cp, len(is_word) - 1)
    w = is_word[at]
    pos = np.flatnonzero(w)
    if not len(pos):
        none = np.zeros(0, bool)
        return Stream(np.zeros(0, np.uint32), none, none, none, np.zeros(len(starts), np.int64), np.zeros(0, np.int64))
    c = cp[pos]
    opens = np.ones(len(pos), bool)
    opens[1:] = np.diff(pos) > 1
    # Words that a soft or line-end hyphen or an invisible character splits go on.
    joins = np.cumsum(_joiners()[at])
    gap = np.flatnonzero(opens)[1:]
    gap = gap[joins[pos[gap]] > joins[pos[gap - 1]]]
    text_of = np.searchsorted(starts, pos[gap], side="right"), np.searchsorted(starts, pos[gap - 1], side="right")
    for i in gap[text_of[0] == text_of[1]]:
        if _JOINS.fullmatch(cp[pos[i - 1] + 1 : pos[i]].tobytes().decode("utf-32-le", "replace")):
            opens[i] = False
    digit = (c >= 0x30) & (c <= 0x39)
    first = np.flatnonzero(opens)
    size = np.diff(np.append(first, len(pos)))
    numeric = np.add.reduceat(digit.astype(np.int64), first) == size
    line = np.cumsum(cp == 0x0A)[pos[first]]
    fresh = np.ones(len(first), bool)
    fresh[1:] = line[1:] != line[:-1]
    prefix = numeric & fresh
    for _ in range(4):  # 00:00:12,500
        more = np.zeros(len(first), bool)
        more[1:] = prefix[:-1] & numeric[1:] & ~fresh[1:]
        prefix |= more
    behind = cp[np.append(pos[first[1:] - 1], pos[-1]) + 1]  # every text is followed by a line feed
    label = prefix | (fresh & np.isin(behind, [ord(x) for x in ":.)]>|"]))
    closes = np.ones(len(pos), bool)
    closes[:-1] = opens[1:]
    label = np.repeat(label, size)
    numbered = np.unique(np.searchsorted(starts, pos[first[prefix]], side="right") - 1)
    if not numbers:
        keep = ~np.repeat(prefix, size)
        pos, opens, closes, label = pos[keep], opens[keep], closes[keep], label[keep]
    a = at[pos]
    return Stream(np.where(a < len(lower) - 1, lower[a], cp[pos]), opens, closes, label, np.searchsorted(pos, starts), numbered)


#: What may stand inside a word: invisible characters, and a hyphen at a line end with what begins the next line.
_JOINS = re.compile(r"[\u00ad\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff]+|[\u00ad\u200b\u200c\u200d\u2060\ufeff]*[-\u2010\u2011\u00ad][\u00ad\u200b\u200c\u200d\u2060\ufeff \t]*\r?\n[ \t>*•\-]*")


@lru_cache(maxsize=1)
def _joiners() -> np.ndarray:
    """Flags of the characters without which _JOINS matches nothing."""
    out = np.zeros(len(K.char_tables(True, True)[1]), bool)
    for a, b in ((0x2D, 0x2D), (0xAD, 0xAD), (0x200B, 0x2011), (0x202A, 0x202E), (0x2060, 0x2064), (0xFEFF, 0xFEFF)):
        out[a : b + 1] = True
    return out


class Piece(NamedTuple):
    """A stretch of an evaluation text: its characters, where its words begin and end, and the passages in it."""

    chars: np.ndarray
    first: np.ndarray
    last: np.ndarray
    begin: np.ndarray  # of each passage
    grams: np.ndarray  # past the last q-gram of each passage
    need: np.ndarray  # q-grams that it shares with a region in which it stands


class LeakIndex:
    """Q-grams of evaluation texts, to be looked up for whole corpora.

    Every text is cut into pieces that overlap by a passage; equal pieces are
    held once, whatever number of items has them.  ``edits`` is the budget of a
    region; with ``exact`` the words of the passage themselves must be whole.
    """

    def __init__(self, items: list[tuple[int, str]], words: int = PASSAGE_WORDS, edits: int = EDITS, exact: bool = True):
        self.words, self.edits, self.exact = words, edits, exact
        place: dict[tuple[bytes, bytes], int] = {}
        self.pieces: list[Piece] = []
        owners: list[set[int]] = []
        texts = [plain(t) for _, t in items]
        s = stream(texts)
        # A number at the start of a line may belong to the passage: such texts are read both ways.
        readings = [(s, np.arange(len(items))), (stream([texts[k] for k in s.numbered], numbers=True), s.numbered)]
        for own, which in readings:
            for k, a, b in zip(which.tolist(), own.starts[:-1].tolist(), own.starts[1:].tolist(), strict=True):
                first = np.flatnonzero(own.opens[a:b])
                last = np.append(first[1:], b - a)
                for w in range(0, max(1, len(first) - words + 1), PIECE_WORDS - words + 1):
                    f, e = first[w : w + PIECE_WORDS], last[w : w + PIECE_WORDS]
                    if len(f) < words:
                        continue
                    chars = own.chars[a + f[0] : a + e[-1]]
                    n = place.setdefault((chars.tobytes(), (f - f[0]).tobytes()), len(place))
                    if n == len(self.pieces):
                        begin, size = f[: len(f) - words + 1] - f[0], e[words - 1 :] - f[: len(f) - words + 1]
                        # A passage of L characters with e edits shares at least L - q + 1 - e q of its q-grams.
                        self.pieces.append(Piece(chars, f - f[0], e - f[0], begin, begin + np.maximum(0, size - Q + 1), np.maximum(1, size - Q + 1 - edits * Q)))
                        owners.append(set())
                    owners[n].add(items[k][0])
        self.owners = [np.array(sorted(o), np.int64) for o in owners]
        self.need = np.array([int(p.need.min()) for p in self.pieces], np.int64)
        self.size = np.array([len(p.chars) for p in self.pieces], np.int64)
        chars = np.concatenate([p.chars for p in self.pieces]) if self.pieces else np.zeros(0, np.uint32)
        bounds = np.concatenate(([0], np.cumsum(self.size))).astype(np.int64)
        h, at = self._grams(chars, bounds)
        piece = np.searchsorted(bounds, at, side="right") - 1
        # Words of all pieces in a row, by their place in the vocabulary.
        self.word_at = np.concatenate(([0], np.cumsum([len(p.first) for p in self.pieces]))).astype(np.int64)
        begin, end = (np.concatenate([getattr(p, x) + b for p, b in zip(self.pieces, bounds[:-1], strict=True)] or [bounds[:0]]) for x in ("first", "last"))
        self.vocabulary, self.word = np.unique(K.mix(K.spans(chars, begin, end)), return_inverse=True)
        self.hashes, rank = np.unique(h, return_inverse=True)
        key = rank * len(self.pieces) + piece
        order = np.argsort(key, kind="stable")
        self.key, self.at = key[order], (at - bounds[piece])[order].astype(np.int32)
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.hashes >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    @staticmethod
    def _grams(chars: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and position of each q-gram inside one text."""
        n = len(chars) - Q + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.arange(n)
        h = K.spans(chars, at, at + Q)
        whole = np.ones(n, bool)
        for b in starts[1:-1]:
            whole[max(0, b - Q + 1) : b] = False
        return K.mix(h[whole]), at[whole]

    def find(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(index of text, identifier of item) of every text that contains a passage of an item."""
        s = stream(texts)
        found = {(d, p) for d, p in self._search(s)}
        if len(s.numbered):
            found |= {(int(s.numbered[d]), p) for d, p in self._search(stream([texts[k] for k in s.numbered], numbers=True))}
        pairs = sorted({(d, i) for d, p in found for i in self.owners[p].tolist()})
        out = np.array(pairs, np.int64).reshape(-1, 2)
        return out[:, 0], out[:, 1]

    def _search(self, s: Stream) -> set[tuple[int, int]]:
        """(text, piece) of the verified regions."""
        h, at = self._grams(s.chars, s.starts)
        near = np.flatnonzero(self.seen[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
        h, at = h[near], at[near]
        rank = np.minimum(np.searchsorted(self.hashes, h), max(0, len(self.hashes) - 1))
        known = np.flatnonzero(self.hashes[rank] == h) if len(self.hashes) else np.zeros(0, np.int64)
        found: set[tuple[int, int]] = set()
        if not len(known):
            return found
        tried, said = set(), self._said(s)
        for doc, piece, low, high, held in self._regions(s, said, rank[known], at[known], 0, len(self.pieces)):
            # Both rows of bands may hold the same region.
            region = (doc, piece, low, high, len(held))
            if (doc, piece) in found or region in tried:
                continue
            tried.add(region)
            if len(begins := self._passages(piece, held)) and self._aligned(s, doc, piece, low, high, begins):
                found.add((doc, piece))
        return found

    def _said(self, s: Stream) -> np.ndarray:
        """text * words of the vocabulary + word, sorted, for every word of the vocabulary that a text has."""
        first = np.flatnonzero(s.opens)
        h = K.mix(K.spans(s.chars, first, np.append(first[1:], len(s.chars))))
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == h
        return np.unique((np.searchsorted(s.starts, first[known], side="right") - 1) * len(self.vocabulary) + at[known])

    def _spoken(self, said: np.ndarray, doc: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether a text has all words of some passage of the piece."""
        number = self.word_at[piece + 1] - self.word_at[piece]
        first = np.cumsum(number) - number
        flat = np.repeat(self.word_at[piece] - first, number) + np.arange(int(number.sum()))
        key = np.repeat(doc, number) * len(self.vocabulary) + self.word[flat]
        total = np.concatenate(([0], np.cumsum(said[np.minimum(np.searchsorted(said, key), len(said) - 1)] == key))) if len(said) else np.zeros(len(key) + 1, np.int64)
        whole = np.append(total[self.words :] - total[: -self.words] == self.words, np.zeros(self.words - 1, bool))
        # The last words of a piece begin no passage of it.
        inside = np.arange(len(key)) - np.repeat(first, number) <= np.repeat(number, number) - self.words
        return np.logical_or.reduceat(whole & inside, first)

    def _passages(self, piece: int, held: np.ndarray) -> np.ndarray:
        """Words of the piece at which a passage begins that shares enough q-grams with a region to stand in it."""
        p = self.pieces[piece]
        there = np.zeros(len(p.chars) + 1, np.int64)
        there[held + 1] = 1
        total = np.cumsum(there)
        return np.flatnonzero(total[p.grams] - total[p.begin] >= p.need)

    def _regions(self, s: Stream, said: np.ndarray, rank: np.ndarray, at: np.ndarray, a: int, b: int) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
        """Regions whose shared q-grams meet the edit budget: (text, piece, least and greatest diagonal, places of the shared q-grams in the piece).

        Only pieces a to b - 1 are looked at, and no more than about HITS shared q-grams at a time.
        """
        n = len(self.pieces)
        lo, hi = np.searchsorted(self.key, rank * n + a), np.searchsorted(self.key, rank * n + b)
        many = hi - lo
        total = int(many.sum())
        if not total:
            return
        if total > HITS:
            some = many > 0
            rank, at = rank[some], at[some]
            if b - a > 1:
                yield from self._regions(s, said, rank, at, a, (a + b) // 2)
                yield from self._regions(s, said, rank, at, (a + b) // 2, b)
                return
            # One piece: halves of the text that overlap by as much as a region of it can span.
            span = int(self.size[a]) + BAND
            middle = int(at[len(at) // 2])
            if int(at[-1] - at[0]) > 4 * span:
                first, rest = at < middle + span, at >= middle
                if first.sum() < len(at) and rest.sum() < len(at):
                    yield from self._regions(s, said, rank[first], at[first], a, b)
                    yield from self._regions(s, said, rank[rest], at[rest], a, b)
                    return
        doc_of = np.searchsorted(s.starts, at, side="right") - 1
        doc = np.repeat(doc_of, many)
        which = np.repeat(lo - np.cumsum(many) + many, many) + np.arange(total)
        piece = self.key[which] % n
        # A text that shares too few q-grams with a piece altogether has no such region, nor, if words must be whole, one that lacks a word of every passage.
        pair = (doc - doc_of[0]) * (b - a) + (piece - a)
        if int(pair.max()) < 4 * total + 1_000_000:
            number = np.bincount(pair)
            pairs = np.flatnonzero(number)
            keep, number = np.zeros(len(number), bool), number[pairs]
            of = pair
        else:
            pairs, of, number = np.unique(pair, return_inverse=True, return_counts=True)
            keep = np.zeros(len(pairs), bool)
        d, p = pairs // (b - a) + doc_of[0], pairs % (b - a) + a
        good = np.flatnonzero(number >= self.need[p])
        if self.exact and len(good):
            good = good[self._spoken(said, d[good], p[good])]
        keep[pairs[good] if of is pair else good] = True
        some = np.flatnonzero(keep[of])
        if not len(some):
            return
        doc, piece, here = doc[some], piece[some], np.repeat(at, many)[some]
        held = self.at[which[some]]
        diagonal = here - s.starts[doc] - held
        # Votes of text positions per band, in both rows of overlapping bands.
        for shift in (0, BAND // 2):
            band = (diagonal + shift) // BAND
            near = np.flatnonzero(_votes(doc, piece, band, here) >= self.need[piece])
            if not len(near):
                continue
            order = near[np.lexsort((band[near], piece[near], doc[near]))]
            d, p, g, x, y = doc[order], piece[order], band[order], held[order], diagonal[order]
            new = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (p[1:] != p[:-1]) | (g[1:] != g[:-1]))))
            yield from zip(d[new].tolist(), p[new].tolist(), np.minimum.reduceat(y, new).tolist(), np.maximum.reduceat(y, new).tolist(), np.split(x, new[1:]), strict=True)

    def _aligned(self, s: Stream, doc: int, piece: int, low: int, high: int, begins: np.ndarray) -> bool:
        """Banded alignment of a region, diagonals low to high: whether a passage of the piece stands in it within the edit budget.

        For every passage that the filter left and every diagonal of the band the furthest character that
        0, 1, ... edits (a character put in, left out or replaced) can reach is followed along the
        runs of equal characters; a passage is there if that is the end of its last word.
        With ``exact`` the words must then be whole and consecutive: see _whole.
        """
        e, words, p = self.edits, self.words, self.pieces[piece]
        start, end = int(s.starts[doc]), int(s.starts[doc + 1])
        # Only the words of passages that the filter left.
        w0, w1 = int(begins[0]), int(begins[-1]) + words
        first, last = p.first[w0:w1], p.last[w0:w1]
        base, m = int(first[0]), int(last[-1] - first[0])
        # Characters between two edits that are too few for a q-gram lie within the budget of diagonals with one.
        diagonals = np.arange(low - e, high + e + 1)
        text = diagonals[:, None] + np.arange(base, base + m)[None, :] + start
        inside = (text >= start) & (text < end)
        same = inside & (s.chars[np.where(inside, text, 0)] == p.chars[base : base + m])
        # Where the run of equal characters from each place ends.
        stop = np.full((len(diagonals), m + 1), m)
        stop[:, :m] = np.where(same, m, np.arange(m))
        run = np.minimum.accumulate(stop[:, ::-1], axis=1)[:, ::-1]
        f, goal = p.first[begins] - base, p.last[begins + words - 1] - base
        # reach[shift + e, diagonal, passage] after so many edits; -m - 1 where the band ends.
        off = -m - 1
        row = np.arange(len(diagonals))[None, :] + np.arange(-e, e + 1)[:, None]
        valid = ((row >= 0) & (row < len(diagonals)))[:, :, None]
        row = np.clip(row, 0, len(diagonals) - 1)[:, :, None]
        reach = np.full((2 * e + 1, len(diagonals), len(f)), off)
        reach[e] = best = run[:, f]
        for _ in range(e):
            to = reach + 1  # replaced
            to[1:] = np.maximum(to[1:], reach[:-1])  # put into the text
            to[:-1] = np.maximum(to[:-1], reach[1:] + 1)  # left out of the text
            reach = np.where(valid & (to >= 0), run[row, np.clip(to, 0, m)], off)
            best = np.maximum(best, reach.max(axis=0))
        if not (best >= goal).any():
            return False
        return not self.exact or self._whole(s, run, text, inside, first - base, last - base)

    def _whole(self, s: Stream, run: np.ndarray, text: np.ndarray, inside: np.ndarray, first: np.ndarray, last: np.ndarray) -> bool:
        """Whether enough consecutive words of the piece stand whole in the text one after another.

        The edits left to them are labels at the start of a line that the alignment steps over.
        """
        words, e = self.words, self.edits
        begin, end = text[:, first], text[:, last - 1]
        ok = (run[:, first] >= last) & inside[:, first] & inside[:, last - 1]
        ok &= s.opens[np.where(inside[:, first], begin, 0)] & s.closes[np.where(inside[:, last - 1], end, 0)]
        total = np.concatenate((np.zeros((len(ok), 1), np.int64), np.cumsum(ok, axis=1)), axis=1)
        if (total[:, words:] - total[:, :-words] == words).any():
            return True
        used = np.concatenate(([0], np.cumsum(s.label)))
        lo, hi = max(0, int(text.min())), min(len(s.chars), int(text.max()) + 1)
        if not e or used[hi] == used[lo]:
            return False
        count = np.zeros((e + 1, len(ok)), np.int64)  # words so far, by characters stepped over and diagonal
        for w in range(len(first)):
            fresh = np.zeros_like(count)
            here = np.where(inside[:, first[w]], begin[:, w], 0)
            for g in range(e + 1):
                before = count[g].copy()
                for k in range(1, g + 1):
                    back = np.maximum(here - k, 0)
                    over = (used[here] - used[back] == k) & s.opens[np.minimum(back, len(s.opens) - 1)] & (here >= k)
                    before[k:] = np.maximum(before[k:], np.where(over[k:], count[g - k][:-k], 0))
                fresh[g] = np.where(ok[:, w], before + 1, 0)
            count = fresh
            if (count >= words).any():
                return True
        return False


def _votes(doc: np.ndarray, item: np.ndarray, band: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each hit the number of distinct text positions among the hits of its (text, item, band)."""
    if not len(doc):
        return np.zeros(0, np.int64)
    low = int(band.min())
    key = (doc * (int(item.max()) + 1) + item) * (int(band.max()) - low + 1) + (band - low)
    order = np.argsort(key, kind="stable")  # the hits come in the order of their text positions
    k, p = key[order], at[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    group = np.cumsum(new) - 1
    distinct = new.copy()
    distinct[1:] |= p[1:] != p[:-1]
    out = np.empty(len(k), np.int64)
    out[order] = np.bincount(group[distinct])[group]
    return out


def blocks(items: DataFrame, item: str, text: str, chars: int = BLOCK_CHARS, *, edits: int = EDITS, exact: bool = True) -> Iterator[LeakIndex]:
    """Indexes over the evaluation texts, each of at most about ``chars`` characters (or one text)."""
    run: list[tuple[int, str]] = []
    size = 0
    for r in items.select(item, text).dropna().toLocalIterator():
        if run and size + len(r[1]) > chars:
            yield LeakIndex(run, edits=edits, exact=exact)
            run, size = [], 0
        run.append((r[0], r[1]))
        size += len(r[1])
    yield LeakIndex(run, edits=edits, exact=exact)


def leaks(documents: DataFrame, doc: str, text: str, items: DataFrame, item: str, item_text: str, *, edits: int = EDITS, exact: bool = True) -> DataFrame:
    """(doc, item) for every document that contains at least PASSAGE_WORDS consecutive words of an item.

    The documents are read once per block of evaluation texts and never
    shuffled.  Each shared q-gram of characters (blanks and punctuation left out)
    votes for two overlapping bands of diagonals; bands with too few shared
    q-grams to hold a passage within the budget of ``edits`` characters are dropped, and the
    rest is verified by an alignment inside the band with that budget.  With
    ``exact`` the aligned words must then be whole and consecutive, and the budget is left to
    labels at the start of a line (``A:``, ``2.``); without it a passage
    counts with any edits within the budget.  A passage that stands in several items counts for each.

    Case, punctuation, blanks, line breaks, invisible characters, tags and
    entities do not matter; numbers at a line start (time codes) are read both as part of the
    text and as none.  Documents or items with null
    text, or null identifier, give no row; an item of fewer words than a passage is
    contained in nothing; repeated identifiers give one row; empty tables give
    an empty result.
    """
    kinds = dict(documents.dtypes)[doc], dict(items.dtypes)[item]
    source = documents.select(F.col(doc).alias("d"), F.col(text).alias("t")).dropna()

    def search(index: LeakIndex) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for first, texts in K.chunks(plain(t) for t in b.column(1).to_pylist()):
                    d, i = index.find(texts)
                    if len(d):
                        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(first + d)), pa.array(i)], names=["d", "i"])

        return source.mapInArrow(run, f"d {kinds[0]}, i bigint")

    found = reduce(DataFrame.unionByName, [search(x) for x in blocks(items, item, item_text, edits=edits, exact=exact)])
    return found.distinct().select(F.col("d").alias(doc), F.col("i").cast(kinds[1]).alias(item))


def p9_found(spark, folder: str) -> DataFrame:
    """Documents with the evaluation items they contain."""
    return leaks(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "text")


def p9_items(spark, folder: str) -> DataFrame:
    """Each leaked item with the number of documents that hold it."""
    return p9_found(spark, folder).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"))


QUERIES = {"p9_found": p9_found, "p9_items": p9_items}
