"""Scenes, clips and other time intervals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmloom.operators.positions import positions


def _islands(df: DataFrame, part: list[str], start: str, end: str, gap: float, touching: bool) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    reach = before + F.lit(gap)
    new = before.isNull() | ((F.col(start) > reach) if touching else (F.col(start) >= reach))
    island = F.sum(F.when(new, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1
    return df.withColumn("island", island).groupBy(*part, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.sum("n").alias("n"))


def merge_intervals(df: DataFrame, group: list[str], start: str, end: str, gap: float = 0.0, *, touching: bool = False, span: float = 3600.0) -> DataFrame:
    """Intervals of a group joined where they overlap (or lie within ``gap``): (group, island, start, end, n).

    An interval goes on when its start lies before the greatest end so far plus
    the gap; ``touching`` includes a start exactly there.  Intervals are first
    joined within stretches of ``span``, so a group of any size spreads over many
    tasks and only the joined ones meet in one.  Intervals with a null end point,
    or that end before they start, are left out; a null group is a group.
    """
    ok = df.where(F.col(start).isNotNull() & (F.col(end) >= F.col(start))).select(*group, F.col(start), F.col(end), F.lit(1).cast("bigint").alias("n"))
    near = _islands(ok.withColumn("__span", F.floor(F.col(start) / span)), [*group, "__span"], start, end, gap, touching).drop("__span", "island")
    return _islands(near, group, start, end, gap, touching)


def gaps(df: DataFrame, group: list[str], start: str, end: str, least: float = 0.5, total: str | None = None) -> DataFrame:
    """Stretches of more than ``least`` that no interval of the group covers: (group, start, end).

    With ``total``, a column with the length of the group's whole span, the head and the tail count too.
    """
    w = Window.partitionBy(*group).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.where(F.col(start).isNotNull() & (F.col(end) >= F.col(start)))
    inner = rows.select(*group, (F.coalesce(before, F.lit(0.0)) if total else before).alias("__a"), F.col(start).alias("__b"))
    if total:
        inner = inner.unionByName(rows.groupBy(*group).agg(F.max(end).alias("__a"), F.max(total).alias("__b")))
    return inner.where(F.col("__b") - F.col("__a") > least).withColumnsRenamed({"__a": start, "__b": end})


def scenes_from_cuts(df: DataFrame, group: list[str], cut: str, duration: str, least: float = 0.5) -> DataFrame:
    """Scenes between cuts, from 0 to the duration: (group, scene_id from 0, start, end); those under ``least`` are dropped and the rest renumbered.

    Each edge meets the next by its position, so a group of any size spreads over many tasks.  A null group is a group.
    """
    same = lambda a, b: reduce(Column.__and__, [a[g].eqNullSafe(b[f"__g{i}"]) for i, g in enumerate(group)], F.lit(True))
    names = [F.col(g).alias(f"__g{i}") for i, g in enumerate(group)]
    whole = df.groupBy(*group).agg(F.max(duration).alias("__d")).where("__d > 0")
    length = whole.select(*names, "__d")
    cuts = df.select(*group, F.col(cut).alias("start")).where("start > 0").distinct()
    inside = cuts.join(length, same(cuts, length)).where("start < __d").select(*group, "start")
    edges = inside.unionByName(whole.select(*group, F.explode(F.array(F.lit(0.0), "__d")).alias("start")))
    at = positions(edges, group, [F.col("start")], name="__p")
    after = at.select(*names, (F.col("__p") - 1).alias("__q"), F.col("start").alias("end"))
    scenes = at.join(after, (at["__p"] == after["__q"]) & same(at, after)).where(F.col("end") - F.col("start") >= least)
    numbered = positions(scenes.select(*group, "start", "end"), group, [F.col("start")], name="scene_id")
    return numbered.select(*group, (F.col("scene_id") - 1).cast("int").alias("scene_id"), "start", "end")


def tile(df: DataFrame, group: list[str], start: str, end: str, length: float, *, most: int | None = None) -> DataFrame:
    """Clips of fixed length in each interval, the rest dropped: adds ``clip_start``, ``clip_end`` and ``clip_index``.

    The index counts through all intervals of the group in order of their start;
    ``most`` caps the clips of a group.  Only the numbers of clips are summed over
    the group, before any clip is made.
    """
    # Half a thousandth against the noise of binary fractions.
    n = F.floor((F.col(end) - F.col(start)) / length + 5e-4).cast("int")
    counted = df.where(F.col(start).isNotNull()).withColumn("__n", F.greatest(n, F.lit(0))).where("__n > 0")
    w = Window.partitionBy(*group).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    base = counted.withColumn("__base", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    out = base.withColumn("__k", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    at = F.col(start) + F.col("__k") * length
    out = out.withColumns({"clip_start": F.round(at, 3), "clip_end": F.round(at + length, 3), "clip_index": F.col("__base") + F.col("__k")})
    return (out.where(F.col("clip_index") < most) if most is not None else out).drop("__n", "__base", "__k")


def chunks(df: DataFrame, duration: str, length: float, overlap: float) -> DataFrame:
    """Overlapping stretches that cover a duration: adds ``chunk``, ``chunk_start``, ``chunk_end``."""
    n = F.greatest(F.ceil(F.col(duration) / length).cast("int"), F.lit(1))
    out = df.where(F.col(duration) > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0), n - 1)))
    return out.withColumns(
        {
            "chunk_start": F.greatest(F.col("chunk") * length - overlap, F.lit(0.0)),
            "chunk_end": F.least((F.col("chunk") + 1) * length + overlap, F.col(duration)),
        }
    )


def even_split(df: DataFrame, keyframes: str, duration: str, parts: int) -> DataFrame:
    """Boundaries at every n-th keyframe, or evenly spread where there are too few: adds ``boundaries``."""
    k = F.array_sort(F.array_distinct(F.coalesce(F.col(keyframes), F.array().cast("array<double>"))))
    step = F.greatest(F.floor(F.size(k) / parts).cast("int"), F.lit(1))
    chosen = F.transform(F.sequence(F.lit(1), F.lit(parts - 1)), lambda i: F.element_at(k, F.least(i * step + 1, F.size(k))))
    even = F.transform(F.sequence(F.lit(1), F.lit(parts - 1)), lambda i: F.col(duration) * i / parts)
    return df.withColumn("boundaries", F.when(F.size(k) >= parts, chosen).otherwise(even))


def sample_times(start, end, step: float = 0.5):
    """Times from the start every half second before the end, and the last millisecond where that gives fewer than two."""
    n = F.floor((end - start - 1e-9) / step).cast("int")
    t = F.when(n >= 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: F.round(start + i * step, 3)))
    return F.when(F.size(t) < 2, F.concat(t, F.array(F.round(end - 0.001, 3)))).otherwise(t)
