"""Current rows of a table of states, and the cleaning of its labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean(c: Column, *, upper: bool = False) -> Column:
    """A label without outer blanks, spaces and hyphens as underscores, in lower (or upper) case."""
    c = F.translate(F.trim(c), " -", "__")
    return F.upper(c) if upper else F.lower(c)


def current_rows(df: DataFrame, columns: dict[str, Column], key: str = "clip_id", version: str = "processed_at") -> DataFrame:
    """One row per key: the state with the greatest version.

    ``columns`` maps result names to expressions over ``df``; they are computed
    before the shuffle, so that only they travel, and are reduced on the map
    side.  Rows without a key are no states and give no row.  A null version is
    older than any other; among states of equal version the greatest values
    (in the order of ``columns``) win, so the result never depends on the order
    of rows.
    """
    state = F.struct(F.col(version).alias("v"), *[c.alias(f"c{i}") for i, c in enumerate(columns.values())])
    newest = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max(state).alias("s"))
    return newest.select(F.col("k").alias(key), *[F.col(f"s.c{i}").alias(n) for i, n in enumerate(columns)])


def stands(keep: str = "keep", reject: str = "reject") -> Column:
    """True for a clip that is not dropped: keep is not false (null counts as true), reject is not true."""
    return F.coalesce(F.col(keep), F.lit(True)) & ~F.coalesce(F.col(reject), F.lit(False))


def number(c: Column) -> Column:
    """A score, or null where it is null or NaN."""
    return F.when(~F.isnan(c), c)
