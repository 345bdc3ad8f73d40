"""Problem 8: filling containers of fixed capacity with texts."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.functions import wordkernel as K
from filmloom.session import materialise
from filmloom.sources.tables import table

CAPACITY = 2048
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The split pattern that belongs to the vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Items that one task packs; bounds its memory and the number of containers left open.
ITEMS_PER_TASK = 200_000
_LETTER, _DIGIT, _BLANK, _OTHER, _EDGE = range(5)
_TABLE = 0x20000
_KNOWN_PIECES = 1_000_000


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    import unicodedata

    kinds = np.full(_TABLE + 1, _OTHER, np.int8)
    for i in range(_TABLE):
        kind = unicodedata.category(chr(i))[0]
        kinds[i] = _LETTER if kind == "L" else _DIGIT if kind == "N" else _OTHER
    for a, b in ((9, 13), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        kinds[a : b + 1] = _BLANK
    return kinds


def pieces(cp: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end position of every piece that PATTERN cuts the texts into.

    ``cp`` and ``starts`` are as from wordkernel.codepoints; the line feed after
    each text belongs to no piece.
    """
    big = np.minimum(cp, _TABLE)
    kind = _classes()[big].astype(np.int8)
    for i in np.flatnonzero(big == _TABLE):  # rare characters beyond the table
        kind[i] = _LETTER if chr(cp[i]).isalpha() else _DIGIT if chr(cp[i]).isnumeric() else _OTHER
    kind[starts[1:] - 1] = _EDGE
    change = np.ones(len(kind), bool)
    change[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _EDGE)
    s = np.flatnonzero(change)
    e = np.append(s[1:], len(kind))
    k = kind[s]
    begin = np.zeros(len(kind) + 1, bool)
    begin[s] = True
    last = e - 1
    after = np.append(k[1:], _EDGE)
    inner = (k == _BLANK) & (after != _EDGE)
    begin[last[inner]] = True  # the last blank before something else stands alone ...
    joins = inner & (cp[last] == 0x20)
    begin[e[joins]] = False  # ... or, being a space, leads the piece that follows
    # An apostrophe at the start of a piece with one of the endings right after it.
    q = np.flatnonzero((k == _OTHER) & (e - s == 1) & (cp[s] == 0x27) & begin[s] & (after == _LETTER))
    if len(q):
        one, two = cp[e[q]], cp[np.minimum(e[q] + 1, len(cp) - 1)]
        long_enough = np.append(e[1:] - s[1:], 0)[q] >= 2
        short = np.isin(one, [ord(c) for c in "stmd"])
        pair = long_enough & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
        width = np.where(short, 1, np.where(pair, 2, 0))
        q, width = q[width > 0], width[width > 0]
        begin[e[q]] = False
        begin[e[q] + width] = True
    begin[starts[1:] - 1] = True  # the edge itself, dropped below
    at = np.flatnonzero(begin[:-1])
    end = np.append(at[1:], len(kind))
    real = kind[at] != _EDGE
    return at[real], end[real]


@lru_cache(maxsize=4)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class TokenCounter:
    """Exact token counts of whole texts; each distinct piece is encoded once while it is remembered."""

    def __init__(self, vocabulary: str = VOCABULARY):
        self.encoding = _encoding(vocabulary)
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def count(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        for first, run in K.chunks(texts):
            cp, starts = K.codepoints(run)
            s, e = pieces(cp, starts)
            if not len(s):
                continue
            h, where, which = np.unique(K.mix(K.spans(cp, s, e) ^ ((e - s).astype(np.uint64) << np.uint64(40))), return_index=True, return_inverse=True)
            place = np.searchsorted(self.hashes, h)
            known = (place < len(self.hashes)) & (self.hashes[np.minimum(place, len(self.hashes) - 1)] == h) if len(self.hashes) else np.zeros(len(h), bool)
            new = np.flatnonzero(~known)
            if len(new):
                strings = [cp[a:b].tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "replace").decode() for a, b in zip(s[where[new]], e[where[new]], strict=True)]
                sizes = np.array([len(self.encoding.encode_ordinary(t)) for t in strings], np.int64)
                if len(self.hashes) > _KNOWN_PIECES:
                    self._forget()
                    known[:] = False
                merged = np.concatenate([self.hashes, h[new]])
                order = np.argsort(merged)
                per = np.zeros(len(h), np.int64)
                per[new] = sizes
                if known.any():
                    per[known] = self.sizes[place[known]]
                elif len(new) < len(h):  # forgotten just now: encode the rest of this chunk again
                    old = np.setdiff1d(np.arange(len(h)), new)
                    per[old] = [len(self.encoding.encode_ordinary(cp[s[where[i]] : e[where[i]]].tobytes().decode("utf-32-le", "replace"))) for i in old]
                self.hashes, self.sizes = merged[order], np.concatenate([self.sizes, sizes])[order]
            else:
                per = self.sizes[place]
            doc = np.searchsorted(starts, s, side="right") - 1
            out[first : first + len(run)] = np.bincount(doc, weights=per[which], minlength=len(run)).astype(np.int64)
        return out


def token_counts(df: DataFrame, item: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(item, n_tokens) of every row, over whole texts; null counts as empty."""
    kind = dict(df.dtypes)[item]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(vocabulary)
        for b in batches:
            sizes = counter.count([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes)], names=[item, "n_tokens"])

    return df.select(item, text).mapInArrow(run, f"`{item}` {kind}, n_tokens bigint")


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container of each item, numbered from 0; every size is from 1 to ``capacity``.

    Each item goes into the open container (or a new one) for which the sum of
    the squared numbers of open containers per gap becomes smallest; among
    equals into the one with the smallest gap.
    """
    count = np.zeros(capacity + 1, np.int64)
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    out, opened = np.zeros(len(sizes), np.int64), 0
    big = np.iinfo(np.int64).max
    fresh = capacity
    for i, s in enumerate(sizes.tolist()):
        # From gap g to gap g - s: the change of the sum of squares is 2 (count[g - s] - count[g] + 1); a full container counts nothing.
        change = count[: capacity + 1 - s] - count[s:] + 1
        change *= 2
        change[0] -= 2 * count[0] + 1  # gap g == s closes the container
        change[count[s:] == 0] = big
        change[fresh - s] = 2 * count[fresh - s] + 1 if s < capacity else 0
        g = int(change.argmin()) + s
        if g == capacity:
            b, opened = opened, opened + 1
        else:
            b = bins[g].pop()
            count[g] -= 1
        if g > s:
            bins[g - s].append(b)
            count[g - s] += 1
        out[i] = b
    return out


def pack(items: DataFrame, item: str, size: str, capacity: int = CAPACITY, *, per_task: int = ITEMS_PER_TASK) -> DataFrame:
    """Containers of the items: (container, item, part, parts, size).

    An item larger than the capacity is split into full containers and a rest;
    all others stay whole.  The items are spread at random over tasks of about
    ``per_task`` items, of equal mixture, and each task packs its own by the
    sum of squares, so the space lost to containers left open at the end does
    not grow with the data.  ``container`` is unique over all tasks.

    Defined cases: items with null or non-positive size need no container and
    give no row; a null identifier is an identifier like any other; repeated
    rows are packed each; an empty table gives an empty result.
    """
    kind = dict(items.dtypes)[item]
    sized = items.select(F.col(item).alias("i"), F.col(size).cast("bigint").alias("n")).where("n > 0")
    parts = F.ceil(F.col("n") / capacity)
    part = F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")
    cut = sized.select("i", "n", parts.alias("parts"), part)
    cut = cut.withColumn("size", F.least(F.lit(capacity), F.col("n") - F.col("part") * capacity))
    tasks = max(1, -(-items.count() // per_task))
    task = F.pmod(F.xxhash64("i", "part"), F.lit(tasks)).cast("int")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "i", "part"], kind="stable") if len(group) else group
        own = sum_of_squares(group["size"].to_numpy(), capacity)
        return pd.DataFrame({"container": group["task"].astype(str) + "-" + pd.Series(own, index=group.index).astype(str), "i": group["i"], "part": group["part"], "parts": group["parts"], "size": group["size"]})

    spread = cut.select(task.alias("task"), F.xxhash64(F.lit("order"), "i", "part").alias("key"), "i", "part", "parts", "size")
    packed = spread.groupBy("task").applyInPandas(run, f"container string, i {kind}, part bigint, parts bigint, size bigint")
    return packed.withColumnRenamed("i", item)


def _containers(spark, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").where("doc_id is not null and length(trim(text)) > 0")
    return pack(materialise(token_counts(documents, "doc_id", "text")), "doc_id", "n_tokens")


def p8_containers(spark, folder: str) -> DataFrame:
    """Every document (or part of one) with its container."""
    return _containers(spark, folder).withColumnRenamed("size", "n_tokens")


def p8_found(spark, folder: str) -> DataFrame:
    """Documents that had to be split."""
    return _containers(spark, folder).where("parts > 1").select("doc_id").distinct()


QUERIES = {"p8_found": p8_found, "p8_containers": p8_containers}
