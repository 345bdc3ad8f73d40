"""Problem 1: texts cut off before their end."""

from __future__ import annotations

import ast
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.functions import wordkernel as K
from filmloom.operators.snapshot import current_rows
from filmloom.session import materialise
from filmloom.sources.tables import table

#: Near-copies: words of a shingle, similarity of heads of equal length, and bands of minima (recall 0.995 at that similarity).
SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 10, 4


def _lengths(ratio: float = 1.2, most: int = 1 << 40) -> np.ndarray:
    """Numbers of words of the heads that are compared, each at most a fifth (or one word) more than the one before."""
    out = [SHINGLE]
    while out[-1] < most:
        out.append(max(out[-1] + 1, int(out[-1] * ratio)))
    return np.array(out)


HEADS = _lengths()
#: Open texts and partners of a band that meet in one block.
ASKED, PARTNERS = 512, 1024
#: Longest run of closing words whose terminality is looked up, and occurrences it needs.
CLOSING, SEEN = 5, 3
#: Share of a closing's occurrences that must end a sentence: a cut seldom falls exactly behind words that can end one.
TERMINAL = 0.05
#: Share of the occurrences of some words that must go on with just these and a mark of omission, for the mark to be style.
STYLE = 0.5
#: Slots of a filter that tells which n-grams and bands anybody asks for, by the number of those: 64 for each, within these powers of two (4 MB at most).
_SLOTS = (20, 25)

_FENCE = re.compile(r"^```\w*\s*")
_MARK = re.compile(r"""(?:…|\.{2,}|\[\s*(?:…|\.{2,})\s*\]|�+)[\s"”’»')\]]*$""")
_END = re.compile(r"[.!?।॥][\s)\]}\"”’»']*$")
_SOFT = re.compile(r"[;)\]}\"”’»']\s*$")
# Abbreviations whose point ends no sentence.
_ABBREVIATED = re.compile(r"(?:^|[\s(])(?:Dr|Mr|Mrs|Ms|St|Prof|Sr|Jr|Col|Capt|vs|e\.g|i\.e|[A-Z])\.\s*$")
_CLAUSE = re.compile(r"[,:–—\-(\[“‘«]\s*$")
_SENTENCE = re.compile(r"[.!?।॥]")
_QUOTES = {('"', '"'), ("“", "”"), ("«", "»"), ("‘", "’")}
CUT, WHOLE, SOFT = "cut", "whole", "soft"


def _open_structure(s: str) -> bool:
    """Whether a JSON text ends inside a string, an array or an object."""
    depth, inside, skip = 0, False, False
    for c in s:
        if skip:
            skip = False
        elif inside:
            skip, inside = c == "\\", c != '"'
        elif c == '"':
            inside = True
        elif c in "{[":
            depth += 1
        elif c in "}]":
            depth -= 1
            if depth <= 0:
                return False
    return inside or depth > 0


def _leaves(x: object) -> Iterator[str]:
    if isinstance(x, str):
        yield x
    elif isinstance(x, dict):
        for v in x.values():
            yield from _leaves(v)
    elif isinstance(x, list):
        for v in x:
            yield from _leaves(v)


#: The last member is a key without a value, a part of a key, a part of a literal, or a mark of omission.
_STOPPED = re.compile(r"""(?:[{,]\s*"(?:[^"\\]|\\.)*"\s*(?::\s*(?:…|\.{2,}|t|tr|tru|f|fa|fal|fals|n|nu|nul|-|-?\d+\.)?\s*)?|,\s*(?:…|\.{2,})\s*)\}[\s}\]]*(?:```\s*)?$""")
#: Behind the end of a string: a member or an item may follow, or the structure ends.
_CLOSES = re.compile(r'''"(?=\s*(?:[}\]]|:|,?\s*"(?:[^"\\]|\\.)*"\s*:|,\s*(?:["{\[\d-]|true|false|null)|,?\s*$))''')
_OPENS = re.compile(r'(?<=[:,{\[])\s*"')


def _strings(body: str) -> list[str]:
    """Strings of JSON that does not parse, without its keys; quotation marks inside a string do not end it."""
    out, at = [], 0
    while begin := _OPENS.search(body, at):
        end = _CLOSES.search(body, begin.end())
        if not end:
            break
        if not body[end.end() :].lstrip().startswith(":"):
            out.append(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), body[begin.end() : end.start()]))
        at = end.end()
    return out


def prose(value: str, depth: int = 0) -> list[str] | None:
    """Texts in running words that a value holds; None where its JSON structure ends too early."""
    s = value.strip()
    fenced = s.startswith("```")
    if fenced:
        s = _FENCE.sub("", s)
    at = 0 if s[:1] in "{[" and s[:1] else s.find('{"') if fenced or '{"' in s else -1
    if at < 0 or not s:
        return [value] if s else []
    body = s[at:]
    try:
        found, _ = json.JSONDecoder(strict=False).raw_decode(body)
    except (ValueError, RecursionError):
        if _open_structure(body) or _STOPPED.search(body):
            return None
        try:
            found = ast.literal_eval(body)
        except (ValueError, SyntaxError, RecursionError, MemoryError):
            # Not JSON at all, but prose that begins with a bracket, where it holds no string.
            found = _strings(body) if '"' in body else [value]
    out: list[str] = []
    for leaf in _leaves(found):
        inner = prose(leaf, depth + 1) if depth < 4 else [leaf]
        if inner is None:
            return None
        # Short values are names, not sentences.
        out += [t for t in inner if len(t.split()) > 5 or _SENTENCE.search(t)]
    return out


def _is_list(t: str) -> bool:
    """A list of tags: short items between commas and no sentence."""
    items = t.split(",")
    return len(items) >= 3 and not _SENTENCE.search(t) and all(0 < len(i.split()) <= 3 for i in items)


def ending(text: str) -> tuple[str | None, str]:
    """How a text ends, and the text without a mark of omission.

    CUT; WHOLE; None where its closing words or a near-copy decide; SOFT where it is whole unless a near-copy goes on: behind a
    quotation, a bracket, a semicolon or an abbreviation.
    """
    t = text.strip()
    if len(t) > 1 and (t[0], t[-1]) in _QUOTES and not set(t[1:-1]) & {t[0], t[-1]}:
        t = t[1:-1].strip()  # a text that stands in quotation marks as a whole
    stub = _MARK.sub("", t)
    marked = len(stub) < len(t)
    if marked:
        if t[len(stub) :].startswith("�") and stub and stub[-1].isalnum():
            return CUT, stub
        stub = stub.rstrip()
    if not stub:
        return WHOLE, stub
    if _END.search(stub):
        return SOFT if not marked and _ABBREVIATED.search(stub) else WHOLE, stub
    if _SOFT.search(stub):
        return WHOLE if marked else SOFT, stub
    if _is_list(stub):
        return WHOLE, stub
    if _CLAUSE.search(stub):
        return CUT, stub
    return None, stub


def text_id(stub: str, more: str = "") -> bytes:
    """128 bits that stand for a text in joins."""
    return blake2b(stub.encode("utf-8", "surrogatepass"), digest_size=16, key=more.encode()).digest()


def _inspect(values: list[str | None]) -> tuple[list[bool | None], list[list[dict]]]:
    """For each value whether it is cut for sure, and the texts whose end is open."""
    cut: list[bool | None] = []
    opened: list[list[dict]] = []
    for v in values:
        mine: list[dict] = []
        texts = [] if v is None else prose(v)
        verdict = texts is None
        for t in texts or []:
            how, stub = ending(t)
            if how == CUT:
                verdict = True
            elif how != WHOLE:
                mine.append({"id": text_id(stub), "text": stub, "marked": how is None and bool(_MARK.search(t)), "soft": how == SOFT})
        cut.append(None if v is None else verdict)
        opened.append([] if verdict else mine)
    return cut, opened


_OPEN = "array<struct<id binary, text string, marked boolean, soft boolean>>"
_OPEN_ARROW = pa.list_(pa.struct([("id", pa.binary()), ("text", pa.string()), ("marked", pa.bool_()), ("soft", pa.bool_())]))


def _inspect_rows(df: DataFrame, fields: list[str], keep: list[str]) -> DataFrame:
    types = dict(df.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in keep] + [f"`{f}__cut` boolean, `{f}__open` {_OPEN}" for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [b.column(i) for i in range(len(keep))]
            for i in range(len(fields)):
                cut, opened = _inspect(b.column(len(keep) + i).to_pylist())
                out += [pa.array(cut, pa.bool_()), pa.array(opened, _OPEN_ARROW)]
            yield pa.RecordBatch.from_arrays(out, names=keep + [x for f in fields for x in (f"{f}__cut", f"{f}__open")])

    return df.select(*keep, *fields).mapInArrow(run, schema)


def _closing_key(h: np.ndarray, n: int) -> np.ndarray:
    return K.mix(h + np.uint64(n * 0x5851F42D))


class _Corpus:
    """Words, sentence ends, n-grams and bands of a run of texts."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.cp, self.starts = K.codepoints(texts)
        self.w = K.words(self.cp, self.starts)
        self.count = np.bincount(self.w.doc, minlength=len(texts))

    def ends(self) -> np.ndarray:
        """Whether a word is the last of its sentence."""
        stop = np.isin(self.cp, [ord(c) for c in ".!?।॥;"])
        total = np.cumsum(stop)
        w = self.w
        after = np.append(w.start[1:], len(self.cp)) - 1
        return total[after] > total[w.end - 1] if len(w.end) else np.zeros(0, bool)

    def last(self) -> np.ndarray:
        """Whether a word is the last of its text."""
        return np.append(self.w.doc[1:] != self.w.doc[:-1], True) if len(self.w.doc) else np.zeros(0, bool)

    def bands(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, words, keys) of every head of a text that has one of the lengths HEADS.

        A copy that was cut is compared with a head of the other text that is as long as
        it is itself, however much is missing.  The minima of a longer head follow from
        those of the shorter one and the shingles between.
        """
        g, first = K.ngrams(self.w.hash, self.w.doc, SHINGLE)
        if not len(g):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, BANDS), np.uint64)
        doc = self.w.doc[first]
        begin = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        words = self.count[doc[begin]]
        levels = np.searchsorted(HEADS, words, side="right")
        # Shingles in stretches from one length to the next, and those behind the longest head.
        owner = np.repeat(np.arange(len(begin)), levels)
        level = np.arange(int(levels.sum())) - np.repeat(np.cumsum(levels) - levels, levels)
        head = HEADS[level]
        at = begin[owner] + np.where(level > 0, HEADS[np.maximum(level - 1, 0)] - SHINGLE + 1, 0)
        rest = HEADS[levels - 1] < words
        edges = np.concatenate((at, begin[rest] + HEADS[levels[rest] - 1] - SHINGLE + 1))
        order = np.argsort(edges, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        place, edges = place[: len(at)], edges[order]
        out = np.zeros((len(at), BANDS), np.uint64)
        deep = [np.flatnonzero(level == k) for k in range(1, int(levels.max()))]
        with np.errstate(over="ignore"):
            for k in range(BANDS * ROWS):
                m = np.minimum.reduceat((g * np.uint64(2 * k * 0x9E3779B1 + 0x85EBCA6B)) ^ (g >> np.uint64(32)), edges)[place]
                for rows in deep:  # the row before is the next shorter head of the same text
                    m[rows] = np.minimum(m[rows], m[rows - 1])
                out[:, k // ROWS] = out[:, k // ROWS] * np.uint64(0x9E3779B97F4A7C15) + m
            out = K.mix(out + (np.arange(BANDS)[None, :] + BANDS * head[:, None]).astype(np.uint64))
        return doc[begin[owner]], head, out

    def stems(self, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the proper beginnings of all words, and how many words have them."""
        _, at, which = np.unique(self.w.hash, return_index=True, return_inverse=True)
        number = np.bincount(which, times[self.w.doc])
        size = (self.w.end - self.w.start)[at]
        n = np.maximum(size - 1, 0)
        word = np.repeat(np.arange(len(at)), n)
        length = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + 1
        lower, _ = K.char_tables(True, True)
        own = np.minimum(self.cp, len(lower) - 1)
        low = np.where(own < len(lower) - 1, lower[own], self.cp)
        begin = self.w.start[at][word]
        return _closing_key(K.mix(K.spans(low, begin, begin + length)), 0), number[word]


def _signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64).view(np.int64)


def _describe(open_texts: DataFrame) -> DataFrame:
    """(id, text, marked, soft, keys, words, bands) of texts with an open end.

    ``keys`` holds the hashes of the last 1 to CLOSING words, those of the
    1 to CLOSING - 1 words before the last one, and that of the last word as the beginning
    of a longer one; 0 where there are fewer words.  ``bands`` are those of its longest head without the last word, of which
    a part may be missing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in K.chunks(b.column(1).to_pylist()):
                c = _Corpus(texts)
                keys = np.zeros((len(texts), 2 * CLOSING), np.uint64)
                final = np.flatnonzero(c.last())
                keys[c.w.doc[final], -1] = _closing_key(c.w.hash[final], 0)
                for n in range(1, CLOSING + 1):
                    at = final[c.count[c.w.doc[final]] >= n]
                    g, begin = K.ngrams(c.w.hash, c.w.doc, n)
                    place = np.searchsorted(begin, at - n + 1)
                    keys[c.w.doc[at], n - 1] = _closing_key(g[place], n)
                    if n < CLOSING:
                        at = final[c.count[c.w.doc[final]] > n]
                        keys[c.w.doc[at], CLOSING + n - 1] = _closing_key(g[np.searchsorted(begin, at - n)], n)
                bands: list[list[int]] = [[] for _ in texts]
                for d, head, row in zip(*c.bands(), strict=True):
                    if head < c.count[d]:
                        bands[d] = _signed(row).tolist()
                part = b.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), part.column(3), pa.array(_signed(keys).tolist(), pa.list_(pa.int64())), pa.array(c.count), pa.array(bands, pa.list_(pa.int64()))], names=["id", "text", "marked", "soft", "keys", "words", "bands"])

    return open_texts.mapInArrow(run, "id binary, text string, marked boolean, soft boolean, keys array<bigint>, words bigint, bands array<bigint>")


class _Filter(NamedTuple):
    """Flags by the leading and by the trailing bits of hashes; a hash is known if it has both."""

    bits: int
    flags: tuple[np.ndarray, np.ndarray]

    def __call__(self, h: np.ndarray) -> np.ndarray:
        slots = (h >> np.uint64(64 - self.bits)).astype(np.int64), (h & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        first, second = ((f[s >> 3] >> (s & 7).astype(np.uint8)) & 1 for f, s in zip(self.flags, slots, strict=True))
        return (first & second).astype(bool)


def _filter_of(hashes: DataFrame, column: str) -> _Filter:
    """Filter of the hashes: at most 2**25 / 64 rows for each half of it come to the driver."""
    n = hashes.count()
    bits = min(max(_SLOTS[0], (64 * n).bit_length()), _SLOTS[1])
    flags = []
    for slot in (F.shiftrightunsigned(column, 64 - bits), F.col(column).bitwiseAND(F.lit((1 << bits) - 1))):
        rows = hashes.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(s & 63 as int)))").alias("m")).toPandas()
        out = np.zeros(1 << (bits - 6), np.uint64)
        out[rows["at"].to_numpy(np.int64)] = rows["m"].to_numpy(np.int64).view(np.uint64)
        flags.append(out.view(np.uint8))
    return _Filter(bits, (flags[0], flags[1]))


def _survey(df: DataFrame, fields: list[str], grams: _Filter, bands: _Filter) -> DataFrame:
    """What the corpus of all values knows about the open ends.

    Rows with ``text`` null: partial counts of an n-gram that somebody asks for,
    followed by a word (``goes``), by the end of a sentence (``ends``) or by
    a mark of omission at the end of the text (``marked``), over all occurrences; ``goes`` of the
    beginning of a word counts the words that go on.  Other rows: the head of a text
    that falls into a band of an open one, as far as the two can be aligned, with those of its bands that are asked for, and
    ``ends``: 1 where the text is whole and ends there, 0 where it goes on, -1 where it ends there and may have been cut.
    """
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast((grams, bands))  # at most 2 x 8 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want, near = shared.value
        for b in batches:
            place: dict[str, str] = {}
            often: Counter[str] = Counter()
            for i in range(len(fields)):
                for v, n in Counter(b.column(i).to_pylist()).items():
                    for t in (prose(v) if v else None) or []:
                        how, stub = ending(t)
                        place[stub] = how if how in (WHOLE, SOFT) else "marked" if how is None and _MARK.search(t) else "open"
                        often[stub] += n
            met: set[bytes] = set()
            for first, texts in K.chunks(place):
                state = np.array(list(place.values())[first : first + len(texts)])
                times = np.array([often[t] for t in texts], float)
                c = _Corpus(texts)
                last, ends = c.last(), c.ends()
                kind = np.where(ends, 1, 0)
                kind[last] = np.select([np.isin(state[c.w.doc[last]], (WHOLE, SOFT)), state[c.w.doc[last]] == "marked"], [1, 2], 3)
                key, number = c.stems(times)
                asked = want(key)
                keys, kinds, numbers = [key[asked]], [np.zeros(int(asked.sum()), np.int64)], [number[asked]]
                for n in range(1, CLOSING + 1):
                    g, begin = K.ngrams(c.w.hash, c.w.doc, n)
                    g = _closing_key(g, n)
                    asked = want(g)
                    keys.append(g[asked])
                    kinds.append(kind[begin[asked] + n - 1])
                    numbers.append(times[c.w.doc[begin[asked]]])
                key, of, number = np.concatenate(keys), np.concatenate(kinds), np.concatenate(numbers)
                distinct, which = np.unique(key, return_inverse=True)
                sums = [np.bincount(which[of == k], number[of == k], len(distinct)).astype(np.int64) for k in range(3)]
                none = [None] * len(distinct)
                yield _batch(none, _signed(distinct), sums, none, none)
                doc, head, rows = c.bands()
                hit = near(rows)
                out: list[tuple[bytes, str, int, list[int]]] = []
                begins = np.append(np.searchsorted(c.w.doc, np.arange(len(texts))), len(c.w.doc))
                for r in np.flatnonzero(hit.any(axis=1)).tolist():
                    d, n = int(doc[r]), int(begins[doc[r]] + _reach(int(head[r])))
                    # As far as a word behind all that an open text with this head can be aligned with.
                    text = texts[d] if n >= begins[d + 1] else texts[d][: int(c.w.end[n] - c.starts[d])]
                    how = 0 if n < begins[d + 1] else 1 if state[d] == WHOLE else -1
                    i = text_id(text, f"{int(head[r])} {how}")
                    if i not in met:
                        met.add(i)
                        out.append((i, text, how, _signed(rows[r][hit[r]]).tolist()))
                if out:
                    ids, own, how, bands = (list(x) for x in zip(*out, strict=True))
                    zero = np.zeros(len(out), np.int64)
                    yield _batch(ids, zero, [zero, np.array(how, np.int64), zero], own, bands)

    return df.select(*fields).mapInArrow(run, "id binary, key bigint, goes bigint, ends bigint, marked bigint, text string, bands array<bigint>")


def _reach(head: int) -> int:
    """Words of a text with which the longest open text of this head can be aligned."""
    longest = int(HEADS[np.searchsorted(HEADS, head) + 1])
    return longest + longest // 4 + 2


def _batch(ids: list, key: np.ndarray, sums: list[np.ndarray], text: list, bands: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(key), *[pa.array(s) for s in sums], pa.array(text, pa.string()), pa.array(bands, pa.list_(pa.int64()))], names=["id", "key", "goes", "ends", "marked", "text", "bands"])


_WORD = re.compile(r"[^\W_]+(?:[ऀ-ःऺ-ॏ॑-ॗॢॣ̀-ͯ]+[^\W_]*)*")


class _Parsed(NamedTuple):
    words: list[str]
    spots: list[tuple[int, int]]


@lru_cache(maxsize=4096)
def _parsed(text: str) -> _Parsed:
    found = list(_WORD.finditer(text))
    return _Parsed([m.group().lower() for m in found], [m.span() for m in found])


@lru_cache(maxsize=4096)
def _shingles(text: str, words: int) -> frozenset[tuple[str, ...]]:
    w = _parsed(text).words[:words]
    return frozenset(tuple(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1))


def _compare(short: str, long: str, ends: int, soft: bool = False) -> tuple[float, float, bool] | None:
    """How much of ``short`` stands in ``long``, their similarity, and whether both end at the same place; None where ``long`` is no near-copy that tells.

    Compared are ``short`` without its last word and the head of ``long`` with as many words.  The
    words are aligned by the closing run of the short text: where that
    stands in the other one nearest to the same place, the next word tells.
    ``ends`` tells about the end of ``long`` (see _survey).  Behind a ``soft`` end the long text must go on in the same sentence.
    """
    a, x = _parsed(short)
    b, y = _parsed(long)
    n = len(a) - 1
    if n < SHINGLE or len(b) < n:
        return None
    mine, other = _shingles(short, n), _shingles(long, n)
    both = len(mine & other)
    union = len(mine) + len(other) - both
    if both < SIMILARITY * union:
        return None
    held = both / len(mine), both / union
    for drop in (0, 1):  # the last word may be a part of one
        tail = a[len(a) - drop - 3 : len(a) - drop]
        # All three words, or the last one and one of the others where one differs.
        alike = [(sum(u == v for u, v in zip(b[i : i + 3], tail, strict=True)), i) for i in range(len(b) - 2) if b[i + 2] == tail[2]]
        most = max((k for k, _ in alike), default=0)
        at = [i for k, i in alike if k == most and (k == 3 or k == 2 and abs(i - (len(a) - drop - 3)) <= n // 4)]
        if not at:
            continue
        i = min(at, key=lambda i: abs(i - (len(a) - drop - 3))) + 3
        if drop:
            return (*held, False) if not soft and i < len(b) and b[i].startswith(a[-1]) and b[i] != a[-1] else None
        if i == len(b):
            return (*held, True) if ends > 0 else None
        mark, between = short[x[-1][1] :].strip(), long[y[i - 1][1] : y[i][0]]
        if not soft:
            return (*held, re.search(r"[.!?।॥;]", between) is not None)
        # The same mark stands there, and no sentence ends: a small letter follows, or the point belongs to an abbreviation.
        goes = between.startswith(mark) and not _SENTENCE.search(between[len(mark) :]) and (mark.startswith(".") or long[y[i][0]].islower())
        return (*held, False) if goes else None
    return None


def align(short: str, long: str, ends: int = 1) -> str | None:
    """Whether ``short`` is a verified near-copy of ``long`` that ends early (CUT) or where it ends too (WHOLE); None where it is neither."""
    told = _compare(short, long, ends)
    return None if told is None else WHOLE if told[2] else CUT


def _verify(bands: DataFrame, members: DataFrame) -> DataFrame:
    """(id, verdict) of the open texts that have a near-copy: what the one that holds most of the text tells, of equals one that ends where the text does.

    ``bands``: (id, text, soft, bands, key); ``members``: (id, text, ends, bands), one row a head.  Every open text of a band
    meets every member of it; a band with many of either is dealt into blocks, each meeting each on its own.
    """
    members = members.withColumn("key", F.explode("bands"))
    count = lambda rows, block, name: rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(name))
    blocks = materialise(count(bands, ASKED, "asks").join(count(members, PARTNERS, "parts"), "key"))
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["key", "ask", "part", "side", "id", "text", "flag", "bands"]
    asked = bands.withColumn("flag", F.col("soft").cast("bigint")).join(blocks, "key").withColumns({"side": F.lit(0), "ask": mine("asks"), "part": every("parts")})
    partners = members.withColumn("flag", F.col("ends")).join(blocks, "key").withColumns({"side": F.lit(1), "part": mine("parts"), "ask": every("asks")})
    met = asked.select(*columns).unionByName(partners.select(*columns)).repartition("key", "ask", "part").sortWithinPartitions("key", "ask", "part", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = None
        waiting: list[tuple[bytes, str, bool, list[int]]] = []
        for b in batches:
            best: dict[bytes, tuple[float, float, bool]] = {}
            for key, ask, part, side, i, text, flag, own in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if group != (key, ask, part):
                    group, waiting = (key, ask, part), []
                if side == 0:
                    waiting.append((i, text, bool(flag), own))
                    continue
                mine = set(own)
                for j, short, soft, other in waiting:
                    # A pair is compared in the first band it shares.
                    if next(x for x in other if x in mine) == key and (told := _compare(short, text, flag, soft)):
                        best[j] = max(best.get(j, told), told)
            yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.binary()), *[pa.array([t[k] for t in best.values()], kind) for k, kind in enumerate((pa.float64(), pa.float64(), pa.bool_()))]], names=["id", "held", "alike", "both"])

    told = met.mapInArrow(run, "id binary, held double, alike double, both boolean")
    return told.groupBy("id").agg(F.max(F.struct("held", "alike", "both")).alias("m")).select("id", F.when(F.col("m.both"), WHOLE).otherwise(CUT).alias("verdict"))


def _judge(open_texts: DataFrame, corpus: DataFrame, fields: list[str], closings: bool) -> DataFrame:
    """(id) of the open texts that were cut."""
    # Copies of a text count once; the id stands for the text.
    described = materialise(_describe(open_texts.groupBy("id").agg(F.max("text").alias("text"), F.max("marked").alias("marked"), F.max("soft").alias("soft"))))
    keys = described.where("not soft").select("id", "marked", F.posexplode("keys").alias("slot", "key")).where("key <> 0")
    bands = described.select("id", "text", "soft", "bands", F.explode("bands").alias("key"))
    seen = materialise(_survey(corpus, fields, _filter_of(keys, "key"), _filter_of(bands, "key")))

    # Near-copies: every distinct head of a band meets all open texts of it.
    members = seen.where("text is not null").groupBy("id").agg(F.max(F.struct("text", "ends", "bands")).alias("m")).select("id", "m.*")
    aligned = _verify(bands, members)
    if not closings:
        return aligned.where(F.col("verdict") == CUT).select("id")

    # Terminality of the closing words, for texts without a near-copy that tells.
    counts = seen.where("text is null").groupBy("key").agg(F.sum("goes").alias("goes"), F.sum("ends").alias("ends"), F.sum("marked").alias("marks"))
    found = keys.join(counts, "key").groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("slot", F.struct("goes", "ends", "marks")))).alias("k"))
    pick = None
    for n in range(1, CLOSING + 1):
        c = F.col("k")[F.lit(n - 1)]
        number = c["goes"] + c["ends"]
        share = F.when(number >= SEEN, c["ends"] / number)
        pick = share if pick is None else F.coalesce(share, pick)
    # A last word that is hardly known is the beginning of another one, or a rare word that tells nothing.
    part = F.coalesce(F.col("k")[F.lit(2 * CLOSING - 1)]["goes"] > 0, F.lit(False))
    # An omission mark after words that mostly go on with just these and the mark is style.
    style = F.lit(False)
    for n in range(2, CLOSING + 1):
        closing, before = F.col("k")[F.lit(n - 1)], F.col("k")[F.lit(CLOSING + n - 2)]
        style = style | F.coalesce((closing["marks"] >= SEEN) & (closing["marks"] >= STYLE * (before["goes"] + before["ends"])), F.lit(False))
    style = F.col("marked") & style
    judged = described.select("id", "marked", "soft").join(found, "id", "left").join(aligned, "id", "left")
    told = F.coalesce(F.col("verdict") == CUT, F.lit(False))
    cut = F.when(F.col("soft"), told).when(style, False).when(F.col("verdict").isNotNull(), told).otherwise(F.coalesce(pick < TERMINAL, part))
    return judged.where(cut).select("id")


def truncated(df: DataFrame, fields: list[str], key: str, version: str, *, closings: bool = True) -> DataFrame:
    """(key, field) of every current value that was cut off before its end.

    A value is cut if its JSON ends inside the structure, or if a text in it
    ends with a comma, with half a character, or within a sentence or word: a verified
    near-copy goes on where it stops (min-hash banding over five-word shingles of heads of equal length,
    so that any part may be missing; similarity 0.8), or, without such a copy, its closing words seldom end a
    sentence anywhere in the corpus, or its last word is hardly known but for longer words that begin with it.
    ``closings=False`` leaves the closing words out, and finds by structure and near-copies alone.

    Values that are null, empty, ``{}`` or without words, lists of tags, and
    texts that end in a terminal mark are whole; so are those that end in a quotation, a bracket, a semicolon or an
    abbreviation, unless a near-copy goes on in the same sentence; so
    are texts whose closing words usually end sentences, with or without a full stop or
    dots, and those whose last word is unknown.  The corpus of closing words is every occurrence in every value of every state; rows with
    a null key are part of it but give no result; an empty table gives an
    empty result.
    """
    rows = materialise(_inspect_rows(df, fields, [key, version]))
    columns = {x: F.col(x) for f in fields for x in (f"{f}__cut", f"{f}__open")}
    now = current_rows(rows, columns, key, version)
    now = now.select(key, F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}__cut").alias("cut"), F.col(f"{f}__open").alias("open")) for f in fields])))
    opened = now.where(~F.coalesce("cut", F.lit(False))).select(key, "field", F.inline("open"))
    opened = materialise(opened)
    late = opened.join(_judge(opened.select("id", "text", "marked", "soft"), df, fields, closings), "id", "left_semi")
    return now.where("cut").select(key, "field").unionByName(late.select(key, "field")).distinct()


FIELDS = ["generated_caption", "caption_struct"]


def p1_found(spark, folder: str) -> DataFrame:
    """Current values that were cut."""
    return truncated(table(spark, folder, "clips"), FIELDS, "clip_id", "processed_at")


def p1_rates(spark, folder: str) -> DataFrame:
    """How often each source type truncates: values, cut values and their share by field."""
    from filmloom.llm.cutoffs import source_types
    from filmloom.operators.snapshot import clean

    clips = table(spark, folder, "clips")
    held = [F.when(F.length(F.trim(f)) > 2, F.lit(f)) for f in FIELDS]
    now = current_rows(clips, {"video_id": clean(F.col("video_id")), "fields": F.filter(F.array(*held), lambda x: x.isNotNull())})
    kinds = source_types(spark, folder)
    values = now.select("clip_id", "video_id", F.explode("fields").alias("field"))
    cut = p1_found(spark, folder).withColumn("cut", F.lit(1))
    return (
        values.join(kinds, "video_id", "left")
        .join(cut, ["clip_id", "field"], "left")
        .groupBy("source_type", "field")
        .agg(F.count(F.lit(1)).alias("values"), F.count("cut").alias("cut"), F.round(F.count("cut") / F.count(F.lit(1)), 4).alias("share"))
    )


QUERIES = {"p1_found": p1_found, "p1_rates": p1_rates}
