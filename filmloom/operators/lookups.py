"""Dictionary-like joins: defaults, chained keys, skips, merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_lookup(df: DataFrame, keys: list[Column], table: DataFrame, key: str, value: str, default: object, name: str) -> DataFrame:
    """Add ``name``: the table's value at the first of several keys that it has, else the default.

    Entries listed twice count once, with their greatest value.  Left joins; Spark broadcasts the table if it is small.
    """
    once = table.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__k")).agg(F.max(value).alias("__v"))
    out, found = df, []
    for i, k in enumerate(keys):
        side = once.select(F.col("__k").alias(f"__k{i}"), F.col("__v").alias(f"__v{i}"))
        out = out.join(side, k == F.col(f"__k{i}"), "left").drop(f"__k{i}")
        found.append(F.col(f"__v{i}"))
    return out.withColumn(name, F.coalesce(*found, F.lit(default))).drop(*[f"__v{i}" for i in range(len(keys))])


def with_defaults(df: DataFrame, results: DataFrame, on: str, defaults: dict[str, object]) -> DataFrame:
    """Worker results joined to their records, with a default where a record has none."""
    side = results.groupBy(on).agg(*[F.max(c).alias(c) for c in defaults])
    return df.drop(*defaults).join(side, on, "left").withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def by_name(df: DataFrame, name: str, table: DataFrame, key: str) -> DataFrame:
    """Entries that a name means: the equal one, else one that is equal without case and blanks (the least of several)."""
    loose = lambda c: F.lower(F.replace(c, F.lit(" "), F.lit("")))
    entries = table.select(F.col(key).alias("found")).where("found is not null").distinct()
    exact = df.join(entries.withColumnRenamed("found", "__e"), F.col(name) == F.col("__e"), "left")
    near = entries.groupBy(loose(F.col("found")).alias("__l")).agg(F.min("found").alias("__n"))
    return exact.join(near, loose(F.col(name)) == F.col("__l"), "left").withColumn("found", F.coalesce("__e", "__n")).drop("__e", "__l", "__n")


def without_done(df: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """Records that have no finished output yet."""
    return df.join(done.select(*on), on, "left_anti")


def pending(df: DataFrame, status: Column, step: str) -> DataFrame:
    """Records whose status map doesn't mark the step as done."""
    return df.where(~F.coalesce(F.try_element_at(status, F.lit(step)), F.lit(False)))


def upsert(old: DataFrame, new: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Full outer merge of wide rows: a new value above 0 replaces the old one, keys of either side stay; ``total`` sums the values."""
    n = new.select(key, *[F.col(v).alias(f"__{v}") for v in values])
    merged = old.select(key, *values).join(n, key, "full")
    picked = [F.coalesce(F.when(F.col(f"__{v}") > 0, F.col(f"__{v}")), F.col(v), F.lit(0.0)).alias(v) for v in values]
    out = merged.select(key, *picked)
    return out.withColumn("total", sum((F.col(v) for v in values), F.lit(0.0)))


def in_priority(df: DataFrame, key: str, places: list[tuple[str, DataFrame]], path: str) -> DataFrame:
    """Add ``place`` and ``path`` of the first place, in order of priority, that has the key."""
    all_ = None
    for i, (name, t) in enumerate(places):
        side = t.select(F.col(key), F.struct(F.lit(i).alias("rank"), F.lit(name).alias("place"), F.col(path).alias("path")).alias("__p"))
        all_ = side if all_ is None else all_.unionByName(side)
    first = all_.groupBy(key).agg(F.min("__p").alias("__p"))
    return df.join(first, key, "left").select(*df.columns, F.col("__p.place").alias("place"), F.col("__p.path").alias("path"))


def ids_and_missing(df: DataFrame, key: str, wanted: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with the wanted ids, and the wanted ids without a row."""
    ids = df.sparkSession.createDataFrame([(w,) for w in dict.fromkeys(wanted)], f"{key} string")
    return df.join(F.broadcast(ids), key, "left_semi"), ids.join(df.select(key), key, "left_anti")  # as many ids as the caller wrote
