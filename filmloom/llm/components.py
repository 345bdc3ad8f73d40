"""Problem 3: one group identifier for everything that pairwise matches tie together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.operators.snapshot import current_rows
from filmloom.session import materialise
from filmloom.sources.tables import table


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


#: Hops after which each further one is followed by a round of propagation, so that long chains end in a logarithmic number of hops.
FAR = 8
#: Identifiers get a letter in front here, so that what stands for all found vertices comes before any of them.
_FOUND, _ID = "a", "b"


def _peel(edges: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """All vertices of the component of the vertex with the highest degree, by breadth-first joins from it, and the edges of the others.

    The search ends when no vertex is new.  What lies far from the start comes nearer by rounds of
    propagation over the edges that remain, in which one least vertex stands for all that was found; they tie the
    same vertices together, and are steps towards the labels of the other components too.
    """
    arcs = _both_ways(edges)
    hub = arcs.groupBy("a").count().agg(F.max(F.struct("count", "a")).alias("m")).first()["m"]
    if hub is None:
        return None, edges
    one = edges.sparkSession.range(1)
    seen = frontier = one.select(F.lit(hub["a"]).alias("a"))
    start = one.select(F.lit(_FOUND).alias("a"))
    hops = 0
    while True:
        reached = arcs.join(frontier, "a", "left_semi").select(F.col("b").alias("a")).where(F.col("a") != _FOUND).distinct()
        frontier = materialise(reached.join(seen, "a", "left_anti"))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
        hops += 1
        if hops >= FAR:
            found = F.lit(True).alias("found")
            ends = edges.join(seen.select("a", found), "a", "left").withColumnRenamed("found", "in_a").join(seen.select(F.col("a").alias("b"), found), "b", "left")
            ends = ends.where("in_a is null or found is null")
            end = lambda c, there: F.when(F.col(there), F.lit(_FOUND)).otherwise(F.col(c))
            edges = _round(ends.select(F.least(end("a", "in_a"), end("b", "found")).alias("a"), F.greatest(end("a", "in_a"), end("b", "found")).alias("b")).distinct())
            arcs, frontier = _both_ways(edges), start
    least = seen.agg(F.min("a").alias("m")).first()["m"]
    return seen.select(F.col("a").alias("id"), F.lit(least).alias("root")), edges.where(F.col("a") != _FOUND).join(seen, "a", "left_anti")


def _round(edges: DataFrame) -> DataFrame:
    """Every vertex hands the minimum of its neighbourhood to its larger neighbours, then to its smaller ones."""
    arcs = _both_ways(edges)
    low = arcs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    large = arcs.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where("a <> b").distinct()  # now a > b
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    joined = large.join(low, "a")
    small = joined.select(F.col("b").alias("x"), "m").unionByName(joined.select(F.col("a").alias("x"), "m"))
    return materialise(small.where("x <> m").select(F.col("m").alias("a"), F.col("x").alias("b")).distinct())


def _propagate(edges: DataFrame) -> DataFrame:
    """(id, root) of every vertex by minimum propagation.

    The edges become stars around the component's minimum after a number of rounds
    that is logarithmic in the length of a chain; stars stay as they are.
    """
    state = None
    while True:
        edges = _round(edges)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("b").alias("id"), F.col("a").alias("root")).unionByName(edges.select(F.col("a").alias("id"), F.col("a").alias("root")).distinct())


def consolidate(pairs: DataFrame, left: str, right: str, *, id_name: str = "id", group_name: str = "group_id") -> DataFrame:
    """One row per identifier that occurs in a pair, with the least identifier of its connected group.

    The giant component is peeled off by frontier joins from the vertex of
    highest degree and anti-joined away; minimum propagation labels the rest.
    Identifiers are compared in byte order.  Rows with a null end and pairs of
    an identifier with itself tie nothing and give no row; repeated and
    reversed pairs count once; an empty table gives an empty result.
    """
    a, b = (F.concat(F.lit(_ID), F.col(c).cast("string")) for c in (left, right))
    edges = pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where(a.isNotNull() & b.isNotNull()).where("a <> b").distinct()
    edges = materialise(edges)
    giant, rest = _peel(edges)
    labels = _propagate(rest)
    labels = labels if giant is None else giant.unionByName(labels)
    own = lambda c: F.expr(f"substring({c}, 2)")
    return labels.select(own("id").alias(id_name), own("root").alias(group_name))


def clip_pairs(spark, folder: str, most: int = 8) -> DataFrame:
    """Ties between clips: the cleaned ``dup_of`` of current rows, and near matches."""
    dup = current_rows(table(spark, folder, "clips"), {"b": F.lower(F.trim("dup_of"))}).where("b <> ''")
    near = table(spark, folder, "clip_matches").where(F.col("hamming_distance") <= most)
    return dup.select(F.col("clip_id").alias("a"), "b").unionByName(near.select(F.col("clip_a").alias("a"), F.col("clip_b").alias("b")))


def p3_found(spark, folder: str) -> DataFrame:
    """Every tied clip with the identifier of its group."""
    return consolidate(clip_pairs(spark, folder), "a", "b", id_name="clip_id")


QUERIES = {"p3_found": p3_found}
