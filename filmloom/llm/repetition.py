"""Problem 5: repetition inside a single document."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.functions import wordkernel as K
from filmloom.operators.snapshot import current_rows
from filmloom.sources.tables import table

RUN = 5
LIMIT = 0.4
#: Values on which cost and selectivity of the rules are estimated; they decide the order of the rules, never a result.
SAMPLE_VALUES = 1000


class _Chunk:
    """Words of a run of texts, made when a rule first asks for them."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self._words: K.Words | None = None

    @property
    def words(self) -> K.Words:
        if self._words is None:
            self._words = K.words(*K.codepoints(self.texts), digits=False)
        return self._words

    def counts(self) -> np.ndarray:
        return np.bincount(self.words.doc, minlength=len(self.texts))

    def keep(self, alive: np.ndarray) -> None:
        """Go on with the texts at these positions only."""
        self.texts = [self.texts[i] for i in alive]
        if (w := self._words) is not None:
            new = np.full(len(w.doc) and int(w.doc.max()) + 1 or 0, -1, np.int64)
            alive = alive[alive < len(new)]
            new[alive] = np.arange(len(alive))
            at = new[w.doc] >= 0
            self._words = K.Words(w.hash[at], new[w.doc[at]], w.start[at], w.end[at])


def _distinct(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    if not len(h):
        return np.zeros(n, np.int64)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return np.bincount(doc[new], minlength=n)


def _too_short(c: _Chunk) -> np.ndarray:
    """Fewer characters than RUN + 1 one-letter words need."""
    return np.array([len(t) < 2 * RUN + 1 for t in c.texts], bool)


def _few_words(c: _Chunk) -> np.ndarray:
    """No run can begin twice in RUN words or fewer."""
    return c.counts() <= RUN


def _varied_words(c: _Chunk) -> np.ndarray:
    """The first occurrence of a word never lies in a repeated run, so the share is at most 1 - distinct / words."""
    n = c.counts()
    return n - _distinct(c.words.hash, c.words.doc, len(c.texts)) < LIMIT * n


def _varied_pairs(c: _Chunk) -> np.ndarray:
    """A stretch of L >= RUN repeated words holds L - 1 repeated pairs, so at most RUN / (RUN - 1) words per repeated pair."""
    g, first = K.ngrams(c.words.hash, c.words.doc, 2)
    n, doc = c.counts(), c.words.doc[first]
    again = np.bincount(doc, minlength=len(c.texts)) - _distinct(g, doc, len(c.texts))
    return again * RUN < LIMIT * n * (RUN - 1)


#: Each rule proves of some values that their repeated share is below the limit. It never rejects a value at or above it.
RULES: dict[str, Callable[[_Chunk], np.ndarray]] = {"too_short": _too_short, "few_words": _few_words, "varied_words": _varied_words, "varied_pairs": _varied_pairs}


def rule_order(values: list[str]) -> list[str]:
    """The rules by rejections per second on a sample, the most effective first; those that cost more than they save are left out."""
    values = [v for v in values if isinstance(v, str)]
    if not values:
        return list(RULES)
    K.powers(K.CHUNK_CHARS)
    left, order, chunk = dict(RULES), [], values
    while left and chunk:
        rate = {}
        for name, rule in left.items():
            began = time.perf_counter()
            rejected = rule(_Chunk(chunk))
            rate[name] = (rejected.mean() / max(time.perf_counter() - began, 1e-9), rejected)
        best = max(rate, key=lambda k: rate[k][0])
        if not rate[best][0]:
            break
        order.append(best)
        chunk = [t for t, out in zip(chunk, rate[best][1], strict=True) if not out]
        del left[best]
    return order or list(RULES)


def over_limit(texts: list[str], order: list[str]) -> np.ndarray:
    """Repeated share of each text that may reach the limit, 0 of those that a rule rejected."""
    share = np.zeros(len(texts))
    for first, run in K.chunks(texts):
        chunk, alive = _Chunk(run), np.arange(len(run))
        for name in order:
            if not len(alive):
                break
            stay = np.flatnonzero(~RULES[name](chunk))
            if len(stay) < len(alive):
                alive = alive[stay]
                chunk.keep(stay)
        if len(alive):
            share[first + alive] = K.repeated_word_share(chunk.texts, RUN)[0]
    return share


def _column(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _measure(batches: Iterator[pa.RecordBatch], fields: list[str], rest: list[str], score: Callable[[list[str]], list[np.ndarray]], names: list[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        columns = [_column(b, f) for f in fields]
        place: dict[str, int] = {}
        for c in columns:  # a text that stands in several fields or rows of the batch is measured once
            for t in c:
                if t is not None:
                    place.setdefault(t, len(place))
        found = score(list(place))
        out = [b.column(b.schema.get_field_index(r)) for r in rest]
        for c in columns:
            at = [None if t is None else place[t] for t in c]
            out += [pa.array([None if i is None else float(v[i]) for i in at], pa.float64()) for v in found]
        yield pa.RecordBatch.from_arrays(out, names=rest + [f"{f}__{n}" for f in fields for n in names])


def flag_repetition(df: DataFrame, fields: list[str], keep: list[str], sample: list[str]) -> DataFrame:
    """Add ``<field>__repeated``: the share of words in repeated runs where it may reach LIMIT, else 0; null for null.

    A cascade of rules with exact bounds rejects values early; ``sample`` holds
    values on which cost and selectivity of the rules are estimated.
    """
    order = rule_order(sample)
    types = dict(df.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in keep] + [f"`{f}__repeated` double" for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _measure(batches, fields, keep, lambda t: [over_limit(t, order)], ["repeated"])

    return df.select(*keep, *fields).mapInArrow(run, schema)


def _split_share(texts: list[str], pattern: str) -> np.ndarray:
    """Share of characters in pieces (sentences or paragraphs, blanks and case aside) that stood earlier in the same text."""
    out, cut = np.zeros(len(texts)), re.compile(pattern)
    for i, t in enumerate(texts):
        seen, again, total = set(), 0, 0
        for p in cut.split(t):
            if p := " ".join(p.split()).lower():
                total += len(p)
                again += len(p) if p in seen else 0
                seen.add(p)
        out[i] = again / total if total else 0.0
    return out


def measure_repetition(df: DataFrame, fields: list[str], keep: list[str]) -> DataFrame:
    """Add the repeated shares of each value: ``<field>__words``, ``<field>__sentences``, ``<field>__paragraphs``.

    Words: those in runs of five words that began earlier in the value (lower
    case, runs of letters and their marks); sentences and paragraphs: characters
    in ones that occurred before.  Null gives null; a value without words gives 0.
    """
    types = dict(df.dtypes)
    parts = ["words", "sentences", "paragraphs"]
    schema = ", ".join([f"`{k}` {types[k]}" for k in keep] + [f"`{f}__{p}` double" for f in fields for p in parts])

    def score(texts: list[str]) -> list[np.ndarray]:
        words = [K.repeated_word_share(run, RUN)[0] for _, run in K.chunks(texts)]
        return [np.concatenate(words) if words else np.zeros(0), _split_share(texts, r"(?<=[.!?।])\s+"), _split_share(texts, r"\n\s*\n")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _measure(batches, fields, keep, score, parts)

    return df.select(*keep, *fields).mapInArrow(run, schema)


FIELDS = ["caption", "generated_caption"]
_KEYS = ["clip_id", "processed_at"]


def p5_found(spark, folder: str) -> DataFrame:
    """Current values of which at least LIMIT of the words lie in repeated runs."""
    clips = table(spark, folder, "clips")
    sample = [x for r in clips.select(*FIELDS).limit(SAMPLE_VALUES // len(FIELDS)).collect() for x in r]
    flagged = flag_repetition(clips.where("clip_id is not null"), FIELDS, _KEYS, sample)
    now = current_rows(flagged, {f: F.col(f"{f}__repeated") for f in FIELDS})
    hits = F.filter(F.array(*[F.when(F.col(f) >= LIMIT, F.lit(f)) for f in FIELDS]), lambda x: x.isNotNull())
    return now.select("clip_id", F.explode(hits).alias("field"))


def p5_shares(spark, folder: str) -> DataFrame:
    """Repeated shares of every current value."""
    measured = measure_repetition(table(spark, folder, "clips").where("clip_id is not null"), FIELDS, _KEYS)
    parts = ["words", "sentences", "paragraphs"]
    now = current_rows(measured, {f"{f}__{p}": F.col(f"{f}__{p}") for f in FIELDS for p in parts})
    rows = F.array(*[F.struct(F.lit(f).alias("field"), *[F.col(f"{f}__{p}").alias(p) for p in parts]) for f in FIELDS])
    return now.select("clip_id", F.inline(rows)).where("words is not null")


QUERIES = {"p5_found": p5_found, "p5_shares": p5_shares}
