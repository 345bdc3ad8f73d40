"""Exact and near duplicates by perceptual hash."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmloom.functions.hashing import hamming
from filmloom.functions.nearhashes import bands, ends_of_runs, in_bands
from filmloom.session import materialise

#: Rows that the kernel of near pairs gathers before it works on them.
BATCH = 1 << 18
#: Arcs that one task decides in order: of two numbers each.
AT_ONCE = 1 << 20


def _near(hashes: DataFrame, distance: int) -> DataFrame:
    """(a, b, ha, hb) of rows (g, id, h) of the same g within the distance, a < b; each pair once.

    A hash goes once to each of distance + 1 bands of its bits: pairs within the distance agree on one of
    them at least, and count in the first.  The kernel reads sorted candidates and holds little more than
    the largest set of hashes of a group that agree on a band, which it deals further.
    """
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("bigint") for m in bands(list(range(64)), distance)])
    dealt = hashes.select("g", "id", "h", F.explode(F.sequence(F.lit(0), F.lit(distance))).alias("k")).withColumn("v", F.col("h").bitwiseAND(F.element_at(masks, F.col("k") + 1)))
    dealt = dealt.repartition("g", "k", "v").sortWithinPartitions("g", "k", "v").drop("v")

    def found(group: np.ndarray, i: np.ndarray, h: np.ndarray, band: np.ndarray) -> Iterator[pa.RecordBatch]:
        u = h.view(np.uint64)
        held, n = [], 0
        for x, y in chain(in_bands(group, band, u, distance), [(np.empty(0, np.int64),) * 2]):
            held.append((x, y))
            n += len(x)
            if n and (n > BATCH or not len(x)):
                x, y = (np.concatenate(c) for c in zip(*held, strict=True))
                x, y = np.where(i[x] < i[y], x, y), np.where(i[x] < i[y], y, x)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (i[x], i[y], h[x], h[y])], names=["a", "b", "ha", "hb"])
                held, n = [], 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        most = BATCH
        for b in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in b.columns])
            if sum(len(c[0]) for c in held) < most:
                continue
            group, i, h, band = (np.concatenate(c) for c in zip(*held, strict=True))
            held = [[group, i, h, band]]
            ends = ends_of_runs(group, band, h.view(np.uint64), distance)
            if len(ends):  # the last run may go on
                yield from found(*(c[: ends[-1]] for c in held[0]))
                held = [[c[ends[-1] :] for c in held[0]]]
            most = BATCH + 2 * len(held[0][0])
        if held:
            yield from found(*(np.concatenate(c) for c in zip(*held, strict=True)))

    return dealt.mapInArrow(run, "a bigint, b bigint, ha bigint, hb bigint")


def _numbered(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Rows with a number ``id`` that grows in ``order``, and one of their group ``g``; written once, so that numbers stay."""
    if group:
        kinds = df.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)]).distinct().withColumn("g", F.monotonically_increasing_id())
        on = [F.col(c).eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate(group)]
        df = df.join(kinds, reduce(Column.__and__, on)).select(*df.columns, "g")
    else:
        df = df.withColumn("g", F.lit(0).cast("bigint"))
    return materialise(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id()))


def near_pairs(hashes: DataFrame, group: list[str], bits: str, distance: int) -> DataFrame:
    """Pairs of different hashes of a group within a Hamming distance: (group, a, b, distance) with a < b.

    Copies of a hash count once, so a hot hash meets nobody more often than
    any other; what is equal needs no pair.  Every pair within the distance is found.  Null
    hashes take no part; a null group is a group.
    """
    one = _numbered(hashes.select(*group, F.col(bits).alias("h")).where("h is not null").distinct(), group, ["h"])
    pairs = _near(one.select("g", "id", "h"), distance).select(F.col("a").alias("id"), F.least("ha", "hb").alias("a"), F.greatest("ha", "hb").alias("b"))
    if group:
        pairs = pairs.join(one.select("id", *group), "id")
    return pairs.select(*group, "a", "b", hamming(F.col("a"), F.col("b")).alias("distance"))


def first_seen(df: DataFrame, group: list[str], key: str, order: list[str], item: str) -> DataFrame:
    """Add ``first_item``: the item of the first row with the same key in the group; null where the key is null."""
    firsts = df.where(F.col(key).isNotNull()).groupBy(*group, F.col(key).alias("__k")).agg(F.min_by(item, F.struct(*order)).alias("first_item"))
    firsts = firsts.withColumnsRenamed({g: f"__f{i}" for i, g in enumerate(group)})
    on = F.col(key) == F.col("__k")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"__f{i}"))
    return df.join(firsts, on, "left").select(*df.columns, "first_item")


def _dropped(arcs: DataFrame) -> DataFrame:
    """The numbers that greedy removal drops; arcs: (i, n) of a number and an earlier one near it, written already.

    In rounds: a number that no arc leads back from is kept, and drops what is near; arcs of what is dropped are
    left out.  When no more than AT_ONCE arcs are left, one task goes through them in their order.
    """
    gone = []
    while True:
        if arcs.count() <= AT_ONCE:
            gone.append(arcs.repartition(1).sortWithinPartitions("i").mapInArrow(_in_order, "i bigint"))
            break
        later = arcs.select(F.col("i").alias("n")).distinct()
        out = materialise(arcs.join(later, "n", "left_anti").select("i").distinct())
        gone.append(out)
        arcs = materialise(arcs.join(out, "i", "left_anti").join(out.withColumnRenamed("i", "n"), "n", "left_anti").select("i", "n"))
    return reduce(DataFrame.unionByName, gone)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    dropped: set[int] = set()
    for b in batches:
        for i, n in zip(b.column("i").to_pylist(), b.column("n").to_pylist(), strict=True):
            if n not in dropped:
                dropped.add(i)
    yield pa.RecordBatch.from_arrays([pa.array(sorted(dropped), pa.int64())], names=["i"])


def greedy_keep(df: DataFrame, group: list[str], item: str, bits: str, order: list[str], distance: int, *, score_only: bool = False) -> DataFrame:
    """Greedy near-duplicate removal: (group, item, keep, dup_of, reason), one row per item.

    In the order of ``order`` a row is kept unless an earlier kept row of its
    group lies within the distance; ``dup_of`` is the first row with an equal
    hash, else the earliest kept row within the distance.  Rows without a hash are kept.
    ``score_only`` records ``dup_of`` and the reason but keeps every row.

    Hashes are numbered in their order and decided side by side, in rounds; only
    pairs take part in these.  A null group is a group.
    """
    rows = df.select(*group, F.col(item).alias("__i"), F.col(bits).alias("__h"), F.struct(*order).alias("__o"))
    firsts = rows.where("__h is not null").groupBy(*group, "__h").agg(F.min(F.struct("__o", "__i")).alias("__f"))
    reps = _numbered(firsts, group, ["__f", "__h"])
    arcs = materialise(_near(reps.select("g", "id", F.col("__h").alias("h")), distance).select(F.col("b").alias("i"), F.col("a").alias("n")))
    gone = materialise(_dropped(arcs))
    by = arcs.join(gone.withColumnRenamed("i", "n"), "n", "left_anti").groupBy(F.col("i").alias("id")).agg(F.min("n").alias("__n"))
    named = by.join(reps.select(F.col("id").alias("__n"), F.col("__f.__i").alias("__by")), "__n").select("id", "__by")
    known = reps.join(named, "id", "left").select(*[F.col(c).alias(f"__g{k}") for k, c in enumerate(group)], F.col("__h").alias("__k"), F.col("__f.__i").alias("__first"), "__by")
    on = F.col("__h") == F.col("__k")
    for k, c in enumerate(group):
        on = on & F.col(c).eqNullSafe(F.col(f"__g{k}"))
    joined = rows.join(known, on, "left")
    dup = F.when(F.col("__i") != F.col("__first"), F.col("__first")).otherwise(F.col("__by"))
    kept = F.col("__h").isNull() | dup.isNull()
    return joined.select(*group, F.col("__i").alias(item), (F.lit(True) if score_only else kept).alias("keep"), F.when(~kept, dup).alias("dup_of"), F.when(~kept, "duplicate").alias("reason"))


def distinct_content(df: DataFrame, content: str, order: list[str]) -> DataFrame:
    """The first row of every byte-exact content, told apart by 256 bits of it; of rows that are equal in ``order``, one.

    The digests and the order find the first rows; contents are not shuffled for that.  Null is a content like any other.
    """
    digest = F.coalesce(F.sha2(content, 256), F.lit(""))
    first = df.groupBy(digest.alias("__k")).agg(F.min(F.struct(*order)).alias("__o"))
    keyed = df.withColumns({"__d": digest, "__p": F.struct(*order)})
    return keyed.join(first, (F.col("__d") == F.col("__k")) & F.col("__p").eqNullSafe(F.col("__o")), "left_semi").dropDuplicates(["__d"]).drop("__d", "__p")


def ordered_union(*arrays: Column) -> Column:
    """Distinct values of several arrays in the order of their first occurrence; null arrays are empty."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.filter(F.flatten(F.array(*[F.coalesce(a, empty) for a in arrays])), lambda x: x.isNotNull()))


def best_faces(df: DataFrame, key: list[str], actor: str, similarity: str, position: str) -> DataFrame:
    """The most similar face of each actor, the first one among equals; faces of nobody are left out."""
    w = Window.partitionBy(*key, actor).orderBy(F.col(similarity).desc(), F.col(position))
    named = df.where(F.col(actor).isNotNull() & (F.lower(actor) != "unknown") & (F.trim(actor) != ""))
    return named.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
