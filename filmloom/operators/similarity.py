"""Vectors against labelled vectors: assignment, centroids, consensus, boxes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filmloom.functions.geometry import iou
from filmloom.functions.rounding import rounded
from filmloom.functions.vectors import dot, unit

#: Labelled vectors that are held in memory at once.
BLOCK_ROWS = 20_000


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Unit mean of the unit vectors of each label: (label, vector, n). Sums are reduced per position on the map side."""
    ok = df.where(F.col(label).isNotNull() & (F.size(vector) > 0)).select(F.col(label).alias("l"), unit(F.col(vector)).alias("u"))
    parts = ok.select("l", F.posexplode("u").alias("k", "x")).groupBy("l", "k").agg(F.avg("x").alias("m"), F.count("x").alias("n"))
    mean = parts.groupBy("l").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "m"))), lambda p: p["m"]).alias("m"), F.max("n").alias("n"))
    return mean.select(F.col("l").alias(label), unit(F.col("m")).alias(vector), "n")


def consensus(df: DataFrame, label: str, item: str, vector: str, *, least: float = 0.35, least_items: int = 5) -> DataFrame:
    """How well each vector fits its label: (label, item, ``mean_similarity``, ``is_consensus``, ``keep``).

    The mean cosine similarity with all vectors of the label, itself included,
    equals the product with the mean of the unit vectors, so no pairs are made.  The
    best one (least item among equals) is the consensus; those at least ``least``
    similar to the mean stay.  Labels with fewer than ``least_items`` items are skipped.
    """
    ok = df.where(F.col(label).isNotNull() & (F.size(vector) > 0)).select(F.col(label).alias("l"), F.col(item).alias("i"), unit(F.col(vector)).alias("u"))
    parts = ok.select("l", F.posexplode("u").alias("k", "x")).groupBy("l", "k").agg(F.avg("x").alias("m"), F.count("x").alias("n"))
    mean = parts.groupBy("l").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "m"))), lambda p: p["m"]).alias("m"), F.max("n").alias("n")).where(F.col("n") >= least_items)
    scored = ok.join(mean, "l").select("l", "i", rounded(dot(F.col("u"), F.col("m")), 6).alias("s"))
    best = scored.groupBy("l").agg(F.max(F.struct("s", (-F.col("i")).alias("o"), "i")).alias("b")).select("l", F.col("b.i").alias("c"))
    return scored.join(best, "l").select(F.col("l").alias(label), F.col("i").alias(item), F.col("s").alias("mean_similarity"), (F.col("i") == F.col("c")).alias("is_consensus"), (F.col("s") >= least).alias("keep"))


def assign(
    items: DataFrame,
    item: str,
    vector: str,
    labels: DataFrame,
    label: str,
    label_vector: str,
    *,
    least: float = 0.35,
    least_margin: float = 0.0,
    item_class: str | None = None,
    label_class: str | None = None,
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """The most similar label of each item: (item, ``label``, ``similarity``, ``margin``).

    Cosine similarity; ``margin`` is the lead over the second compatible label,
    or the whole similarity where there is no second one.  Below ``least``
    or ``least_margin`` the label is null.  With classes, a label is compatible if
    either class is null or both are equal.

    The labels are taken in blocks of ``block`` rows, a bounded matrix each; the
    items pass by once per block and the blocks' best two are merged.
    """
    kinds = dict(items.dtypes)[item], dict(labels.dtypes)[label]
    source = items.where(F.size(vector) > 0).select(F.col(item).alias("i"), F.col(vector).cast("array<double>").alias("v"), (F.col(item_class).cast("string") if item_class else F.lit(None).cast("string")).alias("c"))
    named = labels.where(F.size(label_vector) > 0).select(F.col(label).alias("l"), F.col(label_vector).cast("array<double>").alias("v"), (F.col(label_class).cast("string") if label_class else F.lit(None).cast("string")).alias("c"))

    def against(rows: list) -> DataFrame:
        rows = sorted(rows, key=lambda r: r["l"])
        names = [r["l"] for r in rows]
        m = np.array([r["v"] for r in rows], float)
        m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
        classes = np.array([r["c"] or "" for r in rows])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                x = np.array(b.column(1).to_pylist(), float)
                x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                s = x @ m.T
                own = np.array([c or "" for c in b.column(2).to_pylist()])
                s[(own[:, None] != classes) & (own[:, None] != "") & (classes != "")] = -np.inf
                top = s.argmax(1)
                first = s[np.arange(len(s)), top]
                s[np.arange(len(s)), top] = -np.inf
                second = s.max(1) if s.shape[1] > 1 else np.full(len(s), -np.inf)
                none = lambda v: pa.array(v, mask=~np.isfinite(v))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([names[t] for t in top]).cast(pa.string()), none(first), none(second)], names=["i", "l", "s1", "s2"])

        return source.mapInArrow(run, f"i {kinds[0]}, l string, s1 double, s2 double")

    parts = []
    rows = named.limit(block + 1).collect()
    if len(rows) > block:  # more than one block: one after the other
        rows = []
        for r in named.toLocalIterator():
            rows.append(r)
            if len(rows) == block:
                parts.append(against(rows))
                rows = []
    if rows:
        parts.append(against(rows))
    if not parts:
        none = source.select("i", F.lit(None).cast("string").alias("l"), F.lit(None).cast("double").alias("s1"), F.lit(None).cast("double").alias("s2"))
        parts = [none]
    found = reduce(DataFrame.unionByName, parts)
    if len(parts) > 1:
        best = found.groupBy("i").agg(F.max_by(F.struct("l", "s1"), "s1").alias("b"), F.sort_array(F.flatten(F.collect_list(F.array("s1", "s2"))), asc=False).alias("all"))
        found = best.select("i", F.col("b.l").alias("l"), F.col("b.s1").alias("s1"), F.try_element_at("all", F.lit(2)).alias("s2"))
    s1, margin = rounded("s1", 4), rounded(F.col("s1") - F.coalesce("s2", F.lit(0.0)), 4)
    sure = (s1 >= least) & (margin >= least_margin)
    return found.select(F.col("i").alias(item), F.when(sure, F.col("l")).cast(kinds[1]).alias("label"), s1.alias("similarity"), margin.alias("margin"))


def match_boxes(left: DataFrame, right: DataFrame, key: list[str], left_id: str, right_id: str, box: str, *, zero: bool = False) -> DataFrame:
    """For each left box the right box of the same frame with the greatest overlap: (key, left id, right id, ``iou``).

    Equal overlaps go to the least right id.  Without ``zero`` boxes must overlap.  A frame holds few
    boxes, so the join on the frame stays small per key.
    """
    r = right.select(*key, F.col(right_id).alias("__r"), F.col(box).alias("__b"))
    both = left.select(*key, F.col(left_id).alias("__l"), F.col(box).alias("__a")).join(r, key)
    scored = both.select(*key, "__l", "__r", iou(F.col("__a"), F.col("__b")).alias("__s")).where(F.col("__s") >= 0 if zero else F.col("__s") > 0)
    w = Window.partitionBy(*key, "__l").orderBy(F.col("__s").desc(), F.col("__r"))
    best = scored.withColumn("__n", F.row_number().over(w)).where("__n = 1")
    return best.select(*key, F.col("__l").alias(left_id), F.col("__r").alias(right_id), rounded("__s", 6).alias("iou"))
