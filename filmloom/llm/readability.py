"""Problem 10: reading level of each document."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.functions import wordkernel as K
from filmloom.session import materialise
from filmloom.sources.tables import table

LEVELS = ["easy", "middle", "advanced"]
#: Characters up to which a labelled document is taken for the fit; None: every labelled document is, whole.
TRAIN_CHARS: int | None = None
#: Words whose surprisal is averaged to one value of a document's distribution.
WINDOW = 16
#: Share of another level's counts that may have come to a level by wrong labels, and is taken off its own.
NOISE = 0.2
#: Most bits per word by which a model may be more surprised by a window than the best one.
EXCESS = 3.0
#: Quantiles of that distribution and their weights, least at its ends.
QUANTILES = {0.1: 0.1, 0.3: 0.2, 0.5: 0.4, 0.7: 0.2, 0.9: 0.1}
#: Order of the n-gram models.
ORDER = 3
#: A grade from here on counts as the next level.
HALF = 0.5
#: Ranges that a bit of difficulty is cut into, each of which is pooled by itself before all are.
RANGES = 64
#: Columns by which runs of words are told apart, and those with their counts by level.
RUN = ["fold", *[f"g{n}" for n in range(1, ORDER + 1)], *[f"c{n}" for n in range(2, ORDER + 1)]]
COUNTS = [f"n_{x}" for x in LEVELS]


class Text(NamedTuple):
    """Words of texts that are written in Latin letters, and the word counts of each text."""

    grams: list[np.ndarray]  # hash of the run of 1, 2, 3 words that ends here; 0 where the text has fewer before
    doc: np.ndarray
    latin: np.ndarray
    words: np.ndarray


def read(texts: list[str]) -> Text:
    """Latin words in order, with those of other scripts left out; numbers are no words."""
    cp, starts = K.codepoints(texts)
    w = K.words(cp, starts, digits=False)
    total = np.bincount(w.doc, minlength=len(texts))
    own = cp[w.start] < 0x250
    h, doc = w.hash[own], w.doc[own]
    grams = [h]
    for n in range(2, ORDER + 1):
        g = np.zeros(len(h), np.uint64)
        runs, first = K.ngrams(h, doc, n)
        g[first + n - 1] = runs
        grams.append(g)
    return Text(grams, doc, np.bincount(doc, minlength=len(texts)), total)


class Runs(NamedTuple):
    """Distinct runs of words and how often each occurs."""

    grams: list[np.ndarray]  # as in Text
    contexts: list[np.ndarray]  # from order 2 on: hash of the same run without its last word; 0 where there is no such run
    count: np.ndarray  # by run and level


def survey(text: Text, fold: np.ndarray, level: np.ndarray) -> list[np.ndarray]:
    """Columns RUN and COUNTS of the distinct runs of texts; a row without any run counts the texts of a fold."""
    columns = [fold[text.doc].astype(np.uint64), *text.grams]
    for shorter, g in zip(text.grams, text.grams[1:]):
        before = np.zeros(len(g), np.uint64)
        before[1:] = shorter[:-1]
        columns.append(np.where(g != 0, before, np.uint64(0)))
    key = columns[0]
    for c in columns[1:]:
        key = K.mix(key) ^ c
    order = np.argsort(key)
    columns, of = [c[order] for c in columns], level[text.doc][order]
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    run = np.cumsum(new) - 1
    there = np.unique(fold)
    columns = [np.append(c[new], there if k == 0 else np.zeros(len(there), np.uint64)).astype(np.int64) for k, c in enumerate(columns)]
    counts = [np.append(np.bincount(run[of == k], minlength=int(new.sum())), [np.sum((fold == f) & (level == k)) for f in there]).astype(np.int64) for k in range(len(LEVELS))]
    return columns + counts


def gathered(counted: DataFrame) -> tuple[Runs, np.ndarray]:
    """Runs and their folds from columns RUN and COUNTS, in the same order for any layout of the rows."""
    got = counted.toArrow()
    order = np.lexsort([got.column(c).to_numpy() for c in RUN])
    columns = {c: got.column(c).to_numpy()[order] for c in RUN + COUNTS}
    grams, contexts = ([columns[c].view(np.uint64) for c in RUN if c[0] == kind] for kind in "gc")
    return Runs(grams, contexts, np.stack([columns[c] for c in COUNTS], 1)), columns["fold"]


class Lookup:
    """Rows of a table by 64-bit key, found with a few gathers; keys that collide go to the next layer."""

    def __init__(self, keys: np.ndarray, bits: int = 18):
        self.keys, self.layers = keys, []
        bits = max(bits, len(keys).bit_length() + 1)
        left = np.arange(len(keys))
        shift = 64 - bits
        while len(left):
            slot = (K.mix(keys[left] + np.uint64(len(self.layers))) >> np.uint64(shift)).astype(np.int64)
            layer = np.full(1 << bits, -1, np.int32)
            layer[slot] = left
            self.layers.append((layer, shift))
            left = left[layer[slot] != left]

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        out = np.full(len(h), -1, np.int32)
        if not len(self.keys):
            return out
        todo = np.arange(len(h))
        for k, (layer, shift) in enumerate(self.layers):
            row = layer[(K.mix(h[todo] + np.uint64(k)) >> np.uint64(shift)).astype(np.int64)]
            hit = (row >= 0) & (self.keys[row] == h[todo])
            out[todo[hit]] = row[hit]
            todo = todo[~hit & (row >= 0)]
            if not len(todo):
                break
        return out


class Models:
    """Interpolated n-gram models, one per level, over a common vocabulary.

    Runs of words of a wrongly labelled text are as predictable in the wrong model as in
    the right one; so the counts of a level are lessened by the share NOISE of the other levels' counts.
    """

    def __init__(self, runs: Runs, levels: Iterable[int]):
        there = sorted(levels)
        self.easiest, self.hardest = (there[0], there[-1]) if there else (0, 0)
        self.keys: list[np.ndarray] = []
        self.share: list[np.ndarray] = []  # by order: relative frequency of the last word after the ones before, by level
        for n, g in enumerate(runs.grams):
            there = g != 0 if n else np.ones(len(g), bool)
            keys, which = np.unique(g[there], return_inverse=True)
            count = np.stack([np.bincount(which, c, len(keys)) for c in runs.count[there].T], 1)
            count = np.maximum(count - NOISE * (count.sum(1, keepdims=True) - count), 0)
            if not n:
                before = np.broadcast_to(count.sum(0), count.shape)
            else:
                # The number of times the shorter run was followed by any word, at each longer run.
                one = np.zeros(len(keys), np.int64)
                shorter, run = np.unique(runs.contexts[n - 1][there], return_inverse=True)
                one[which] = run
                before = np.stack([np.bincount(one, count[:, k], len(shorter)) for k in range(len(LEVELS))], 1)[one]
            self.keys.append(keys)
            self.share.append(np.divide(count, before, out=np.zeros_like(count), where=before > 0).astype(np.float32))
        self.vocabulary = len(self.keys[0]) + 1
        self.weight = np.full((len(LEVELS), ORDER + 1), 1 / (ORDER + 1))  # of the uniform part and the orders
        self._lookups: list[Lookup] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_lookups": None}  # built again where it is used

    def parts(self, grams: list[np.ndarray]) -> np.ndarray:
        """Probability of the last word of each run by order (0: uniform) and level."""
        if self._lookups is None:
            self._lookups = [Lookup(k) for k in self.keys]
        out = np.empty((ORDER + 1, len(grams[0]), len(LEVELS)), np.float32)
        out[0] = 1 / self.vocabulary
        for n, (find, share, g) in enumerate(zip(self._lookups, self.share, grams, strict=True)):
            row = find(g)
            out[n + 1] = 0
            seen = np.flatnonzero(row >= 0)
            out[n + 1][seen] = share[row[seen]]
        return out

    def interpolate(self, runs: Runs, rounds: int = 20) -> None:
        """Weights of the orders by expectation maximisation on all words of texts that the counts have not seen."""
        p = self.parts(runs.grams)
        for k in range(len(LEVELS)):
            there = runs.count[:, k] > 0
            own, times = p[:, there, k].astype(float), runs.count[there, k]
            if not len(times):
                continue
            w = self.weight[k]
            for _ in range(rounds):
                each = w[:, None] * own
                w = np.maximum((each / each.sum(0)) @ times / times.sum(), 1e-4)
                w /= w.sum()
            self.weight[k] = w

    def surprisal(self, text: Text) -> np.ndarray:
        """Bits of each word under each level's model."""
        return -np.log2(np.einsum("kn,nwk->wk", self.weight.astype(np.float32), self.parts(text.grams)))


def difficulty(models: Models, text: Text) -> np.ndarray:
    """Difficulty of each text in bits per word; NaN without Latin words.

    A text is hard where the model of the easiest level is more surprised than that of the
    hardest one.  The difference of the two mean surprisals in every
    window of the whole text makes a distribution; the weighted mean of its quantiles
    stands for the text, so that a few odd windows hardly move it.  Surprisal beyond
    that of the best model counts up to EXCESS bits: how far words lie beyond all that a
    model has seen tells nothing.
    """
    out = np.full(len(text.words), np.nan)
    if not len(text.doc):
        return out
    bits = models.surprisal(text)
    offset = np.cumsum(text.latin) - text.latin
    inside = np.arange(len(text.doc)) - offset[text.doc]
    size = np.maximum(1, text.latin // WINDOW)  # a short rest joins the last window
    window = np.minimum(inside // WINDOW, size[text.doc] - 1)
    first = np.flatnonzero((window != np.roll(window, 1)) | (text.doc != np.roll(text.doc, 1)) | (np.arange(len(window)) == 0))
    width = np.diff(np.append(first, len(window)))
    mean = np.add.reduceat(bits, first, axis=0) / width[:, None]
    excess = np.minimum(mean - mean.min(1, keepdims=True), EXCESS)
    value = excess[:, models.easiest] - excess[:, models.hardest]
    owner = text.doc[first]
    order = np.lexsort((value, owner))
    value, width, owner = value[order], width[order], owner[order]
    weight = np.cumsum(width)
    begins = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    base = weight[begins] - width[begins]
    out[owner[begins]] = sum(w * value[np.searchsorted(weight, base + text.latin[owner[begins]] * q, side="left")] for q, w in QUANTILES.items())
    return out


def pool(blocks: Iterable) -> list[list]:
    """Pooled adjacent violators of blocks (sum, count, first, last) in order; pooling parts of the row before changes nothing."""
    out: list[list] = []
    for block in blocks:
        out.append(list(block))
        while len(out) > 1 and out[-2][0] * out[-1][1] >= out[-1][0] * out[-2][1]:
            total, n, _, last = out.pop()
            out[-1] = [out[-1][0] + total, out[-1][1] + n, out[-1][2], last]
    return out


def ordered(x: np.ndarray, y: np.ndarray) -> list[tuple]:
    """A block of all that share a value, by x: met one by one, their order would have a part in what is pooled."""
    at, which = np.unique(x, return_inverse=True)
    return list(zip(np.bincount(which, y).tolist(), np.bincount(which).tolist(), at.tolist(), at.tolist(), strict=True))


def knots(blocks: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """Knots and values of the pooled blocks."""
    return np.array([z for b in blocks for z in b[2:]]), np.array([b[0] / b[1] for b in blocks for _ in range(2)])


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares nondecreasing fit by pooling adjacent violators: knots and values."""
    return knots(pool(ordered(x, y)))


def folds(texts: list[str | None]) -> np.ndarray:
    """Half of each text, the same for all its copies."""
    return np.array([crc32((t or "").encode("utf-8", "surrogatepass")) & 1 for t in texts], np.int64)


class Scale:
    """Models and the monotone map from difficulty to level.

    Two of each are fitted, on either half of the labelled texts.  A text is
    graded by those of the other half, so that no label of it (nor of its
    copies) has a part in its grade, right or wrong.  Where the halves don't hold
    the same levels, all texts stand for either.
    """

    def __init__(self, runs: Runs, fold: np.ndarray):
        texts = runs.grams[0] == 0  # rows that count texts
        levels = [set(np.flatnonzero(runs.count[texts & (fold == f)].sum(0)).tolist()) for f in (0, 1)]
        self.halved = levels[0] == levels[1]
        half = [~texts & ((fold == f) | (not self.halved)) for f in (0, 1)]
        parts = [Runs([g[h] for g in runs.grams], [c[h] for c in runs.contexts], runs.count[h]) for h in half]
        self.models = [Models(own, levels[0] | levels[1]) for own in parts]
        for models, other in zip(self.models, parts[::-1], strict=True):
            models.interpolate(other)
        self.maps = [(np.zeros(0), np.zeros(0))] * 2

    def measured(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(which map it belongs to, difficulty by the models of the other half) of each text."""
        fold, x = folds(texts), np.full(len(texts), np.nan)
        for f in (0, 1):
            at = np.flatnonzero(fold == f)
            x[at] = difficulty(self.models[1 - f], read([texts[i] for i in at]))
        return 1 - fold if self.halved else np.zeros_like(fold), x

    def calibrate(self, blocks: list[tuple]) -> None:
        """Maps from blocks (map, sum, count, first, last) of all labelled texts, pooled in part."""
        for f in (0, 1):
            of = f if self.halved else 0
            self.maps[f] = knots(pool(b[1:] for b in sorted(blocks, key=lambda b: b[3]) if b[0] == of))

    def grade(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(grade from 0 to 2, share of words in Latin letters) of each text; NaN where there is nothing to grade."""
        graded, share, fold = np.full(len(texts), np.nan), np.zeros(len(texts)), folds(texts)
        for f in (0, 1):
            at = np.flatnonzero(fold == f)
            text = read([texts[i] for i in at])
            x = difficulty(self.models[1 - f], text)
            steps = self.maps[1 - f]
            if len(steps[0]):
                graded[at] = np.where(np.isnan(x), np.nan, np.interp(x, *steps))
            share[at] = np.divide(text.latin, text.words, out=np.zeros(len(at)), where=text.words > 0)
        return graded, share


def rated(labels: DataFrame, doc: str, label: str) -> DataFrame:
    """(d, level) of every labelled document: the median of its raters, rounded down; what is no level doesn't count."""
    number = F.array_position(F.array(*[F.lit(x) for x in LEVELS]), F.lower(F.trim(label))) - 1
    votes = labels.select(F.col(doc).alias("d"), number.alias("v")).where("v >= 0")
    return votes.groupBy("d").agg(F.floor(F.percentile("v", F.lit(0.5))).cast("int").alias("level"))


def fit(documents: DataFrame, doc: str, text: str, labels: DataFrame, label_doc: str, label: str) -> Scale:
    """Fit models and scale on all labelled documents, each whole.

    A document's level is the median of its raters' labels (case and outer
    blanks aside; other values and nulls don't count), rounded down.  Texts stay
    with the executors: distinct runs of words with their counts come to the
    driver, and blocks of the pooled difficulties.
    """
    level = rated(labels, label_doc, label)
    rows = documents.select(F.col(doc).alias("d"), F.col(text).alias("t")).where("t is not null" if TRAIN_CHARS is None else F.length("t") <= TRAIN_CHARS)
    labelled = materialise(rows.join(level, "d").select("t", "level"))  # read twice

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            levels = b.column(1).to_numpy()
            for first, texts in K.chunks(b.column(0).to_pylist()):
                columns = survey(read(texts), folds(texts), levels[first : first + len(texts)])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=RUN + COUNTS)

    counted = labelled.mapInArrow(count, ", ".join(f"{c} bigint" for c in RUN + COUNTS))
    scale = Scale(*gathered(counted.groupBy(*RUN).agg(*[F.sum(c).alias(c) for c in COUNTS])))
    shared = documents.sparkSession.sparkContext.broadcast(scale)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [shared.value.measured(texts) for _, texts in K.chunks(b.column(0).to_pylist())]
            if parts:
                which, x = (np.concatenate(p) for p in zip(*parts, strict=True))
                known = ~np.isnan(x)
                yield pa.RecordBatch.from_arrays([pa.array(which[known]), pa.array(x[known]), b.column(1).filter(pa.array(known))], names=["map", "x", "level"])

    def pooled(group: pa.Table) -> pa.Table:
        blocks = pool(ordered(group.column("x").to_numpy(), group.column("level").to_numpy()))
        return pa.table([pa.array([group.column("map")[0].as_py()] * len(blocks), pa.int64()), *map(pa.array, zip(*blocks, strict=True))], names=["map", "total", "n", "lo", "hi"])

    difficulties = labelled.mapInArrow(measure, "map bigint, x double, level int")
    blocks = difficulties.groupBy("map", F.floor(F.col("x") * RANGES).alias("range")).applyInArrow(pooled, "map bigint, total double, n bigint, lo double, hi double")
    scale.calibrate([tuple(b) for b in blocks.collect()])
    shared.unpersist()
    return scale


def grades(documents: DataFrame, doc: str, text: str, scale: Scale) -> DataFrame:
    """(doc, grade, english) of every row: grade from 0 (easy) to 2 (advanced), and the share of words in Latin letters.

    Whole texts are graded in one pass without shuffle.  Null and blank texts,
    and those without Latin words, have a null grade; copies are graded each.
    """
    kind = dict(documents.dtypes)[doc]
    shared = documents.sparkSession.sparkContext.broadcast(scale)  # the distinct runs of words of the labelled texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [shared.value.grade(texts) for _, texts in K.chunks(b.column(1).to_pylist())]
            grade = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0)
            share = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(grade, mask=np.isnan(grade)), pa.array(share)], names=[doc, "grade", "english"])

    return documents.select(doc, text).mapInArrow(run, f"`{doc}` {kind}, grade double, english double")


def p10_levels(spark, folder: str) -> DataFrame:
    """Grade and level of every document that is mainly in English."""
    documents = table(spark, folder, "documents")
    scale = fit(documents, "doc_id", "text", table(spark, folder, "reading_labels"), "doc_id", "reading_level")
    at = F.element_at(F.array(*[F.lit(x) for x in LEVELS]), F.floor(F.col("grade") + HALF).cast("int") + 1)
    return grades(documents, "doc_id", "text", scale).where("grade is not null and english > 0.5").select("doc_id", "grade", at.alias("level"))


def p10_agreement(spark, folder: str) -> DataFrame:
    """How the levels of labelled documents compare with their ratings, which have no part in them: (level, rated, n)."""
    labels = rated(table(spark, folder, "reading_labels"), "doc_id", "reading_level").select(F.col("d").alias("doc_id"), F.col("level").alias("at"))
    name = F.element_at(F.array(*[F.lit(x) for x in LEVELS]), F.col("at") + 1)
    return p10_levels(spark, folder).join(labels, "doc_id").groupBy("level", name.alias("rated")).agg(F.count(F.lit(1)).alias("n"))


def p10_found(spark, folder: str) -> DataFrame:
    """Documents at the highest level."""
    return p10_levels(spark, folder).where(F.col("level") == LEVELS[-1]).select("doc_id")


QUERIES = {"p10_found": p10_found, "p10_levels": p10_levels, "p10_agreement": p10_agreement}
