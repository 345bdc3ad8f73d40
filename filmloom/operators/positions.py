"""Exact positions within groups, without one task per group.

A window over a hot group sorts all its rows in one task.  Here the rows are
range-partitioned over (group, order), so a group of any size spreads over as
many tasks as it needs; the positions come from the number of rows of the
group in the partitions before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmloom.session import materialise


def positions(df: DataFrame, group: list[str], order: list[Column], *, name: str = "position", total: str | None = None) -> DataFrame:
    """Add the 1-based position of each row in its group by ``order``, and optionally the group's size.

    ``order`` should end in a unique column; rows that are equal in all of it
    get distinct positions in an unspecified order.  The sorted rows are written
    once to the checkpoint folder, as both the counts and the result read them.
    A table of (partition, group) counts, of at most partitions + groups rows,
    carries the offsets; its rows per group are bounded by the partitions.
    Null is a group of its own.  An empty table gives an empty result.
    """
    keys = [F.col(f"`{g}`") for g in group]
    placed = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = materialise(placed.withColumn("__at_row", F.monotonically_increasing_id()))
    part = F.shiftright("__at_row", 33)
    held = placed.groupBy(part.alias("__part"), *keys).agg(F.count(F.lit(1)).alias("__held"), F.min("__at_row").alias("__first"))
    w = Window.partitionBy(*[F.col(f"`{g}`") for g in group])
    before = F.sum("__held").over(w.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    held = held.withColumn("__offset", F.coalesce(before, F.lit(0)) - F.col("__first") + 1)
    if total:
        held = held.withColumn(total, F.sum("__held").over(w))
    held = held.drop("__held", "__first").withColumnsRenamed({g: f"__g{i}" for i, g in enumerate(group)})
    on = F.col("__part") == part
    for i, g in enumerate(group):
        on = on & F.col(f"`{g}`").eqNullSafe(F.col(f"__g{i}"))
    kept = [F.col(f"`{c}`") for c in df.columns]
    out = placed.join(held, on, "left").select(*kept, (F.col("__at_row") + F.col("__offset")).alias(name), *([F.col(total)] if total else []))
    return out


def cumulative(df: DataFrame, group: list[str], order: list[Column], weight: str, *, name: str = "below", total: str = "size") -> DataFrame:
    """Add the sum of ``weight`` over the rows of the group that come before, and over the whole group.

    Works like :func:`positions`; the running sum inside one part of a group is
    a window over (partition, group), which never holds more than one range
    partition.
    """
    keys = [F.col(f"`{g}`") for g in group]
    placed = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = materialise(placed.withColumn("__at_row", F.monotonically_increasing_id())).withColumn("__part", F.shiftright("__at_row", 33))
    held = placed.groupBy("__part", *keys).agg(F.sum(weight).alias("__w"))
    w = Window.partitionBy(*keys)
    before = F.sum("__w").over(w.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    held = held.select(F.col("__part").alias("__p"), *[k.alias(f"__g{i}") for i, k in enumerate(keys)], F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__w").over(w).alias(total))
    inside = F.sum(weight).over(Window.partitionBy("__part", *keys).orderBy("__at_row").rowsBetween(Window.unboundedPreceding, -1))
    on = F.col("__part") == F.col("__p")
    for i, k in enumerate(keys):
        on = on & k.eqNullSafe(F.col(f"__g{i}"))
    out = placed.withColumn("__inside", F.coalesce(inside, F.lit(0))).join(held, on, "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__before") + F.col("__inside")).alias(name), total)
