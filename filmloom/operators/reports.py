"""Counts, distributions and statistics of scored records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmloom.functions.rounding import rounded
from filmloom.operators.positions import positions


def value_counts(df: DataFrame, column: str, *, nulls: bool = True) -> DataFrame:
    """(column, n); null is a value of its own, or left out."""
    return (df if nulls else df.where(F.col(column).isNotNull())).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def cross_tab(df: DataFrame, rows: str, columns: str, values: list[str]) -> DataFrame:
    """Counts by two labels, one column per value, 0 where there are none. Naming the values saves a pass over the data."""
    return df.groupBy(rows).pivot(columns, values).count().na.fill(0, values)


def statistics(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """Per column: n, mean, sample deviation, least, greatest and median of the values that are neither null nor NaN."""
    rows = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in columns])
    long = df.select(F.inline(rows)).where("v is not null and not isnan(v)")
    r = lambda x: rounded(x, digits)
    out = long.groupBy("metric").agg(F.count("v").alias("n"), r(F.avg("v")).alias("mean"), r(F.stddev_samp("v")).alias("std"), r(F.min("v")).alias("min"), r(F.max("v")).alias("max"))
    # Exact medians from positions, so that no task holds all values of a column.
    return out.join(group_percentiles(long, ["metric"], "v", {"median": 0.5}).select("metric", r("median").alias("median")), "metric")


def group_percentiles(df: DataFrame, group: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Linearly interpolated percentiles per group, exact for groups of any size: (group, n, one column per share).

    The values are ranked over all partitions, and only the two rows around
    each share meet per group.  Null and NaN values take no part.
    """
    v = F.col(value).cast("double")
    at = positions(df.select(*group, v.alias("__v")).where("__v is not null and not isnan(__v)"), group, [F.col("__v")], total="n")
    aggs = []
    for name, s in shares.items():
        rank = (F.col("n") - 1) * s + 1
        low, high = F.floor(rank), F.floor(rank) + 1
        weight = F.when(F.col("position") == low, 1 - (rank - low)).when(F.col("position") == high, rank - low)
        aggs.append(F.sum(weight * F.col("__v")).alias(name))
    return at.groupBy(*group).agg(F.max("n").alias("n"), *aggs)


def clamped_bounds(df: DataFrame, group: list[str], value: str, *, low: float = 0.1, high: float = 0.9, floor: float = 0.05, ceiling: float = 0.95) -> DataFrame:
    """Lower and upper bound of a score per source: percentiles kept within fixed limits (4 digits)."""
    p = group_percentiles(df, group, value, {"__l": low, "__h": high})
    return p.select(*group, "n", rounded(F.greatest("__l", F.lit(floor)), 4).alias("lower"), rounded(F.least("__h", F.lit(ceiling)), 4).alias("upper"))


def histogram(df: DataFrame, metrics: list[str], keep: Column) -> DataFrame:
    """Five equal bins from 0 to 1 per metric, for all rows and the kept ones: (metric, scope, bin, n, mean).

    What lies outside, below 0 too, counts in the last bin; null and NaN do not count.
    """
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])
    scopes = F.explode(F.when(keep, F.array(F.lit("all"), F.lit("kept"))).otherwise(F.array(F.lit("all")))).alias("scope")
    long = df.select(scopes, rows.alias("r")).select("scope", F.inline("r")).where("v is not null and not isnan(v)")
    bin_ = F.when((F.col("v") >= 0) & (F.col("v") < 0.8), F.floor(F.col("v") * 5)).otherwise(4).cast("int")
    return long.groupBy("metric", "scope", bin_.alias("bin")).agg(F.count("v").alias("n"), rounded(F.avg("v"), 4).alias("mean"))


def nested_statistics(df: DataFrame, group: str, gate: str, score: str) -> DataFrame:
    """Per group: count, a map of the counts by gate, and the mean score."""
    per = df.groupBy(group, gate).agg(F.count(F.lit(1)).alias("n"), F.sum(score).alias("s"), F.count(score).alias("k"))
    counts = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce(F.col(gate), F.lit("")), "n"))))
    return per.groupBy(group).agg(F.sum("n").alias("count"), counts.alias("gate_counts"), rounded(F.sum("s") / F.sum("k"), 4).alias("mean_score"))


def clip_summary(df: DataFrame, keep: Column, reject: Column) -> DataFrame:
    """One row of counts, durations and score statistics of the kept clips."""
    kept = keep & ~reject
    score = F.when(kept & ~F.isnan("final_score"), F.col("final_score"))
    zero = F.lit(0.0)
    return df.agg(
        F.count(F.lit(1)).alias("clips"),
        F.count_if(keep).alias("kept"),
        F.count_if(~keep).alias("not_kept"),
        F.count_if(reject).alias("rejected"),
        F.count_if(~keep & (F.col("s2_reject_reason") == "duplicate")).alias("duplicates"),
        F.count_if(F.upper(F.trim("verdict")) == "FINAL").alias("final"),
        rounded(F.coalesce(F.min(score), zero), 4).alias("least_score"),
        rounded(F.coalesce(F.max(score), zero), 4).alias("greatest_score"),
        rounded(F.coalesce(F.avg(score), zero), 4).alias("mean_score"),
        rounded(F.coalesce(F.sum(F.when(kept, F.col("duration"))), zero), 2).alias("kept_seconds"),
    )


def funnel(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """(stage, n) of the rows that pass every condition up to the stage, in one pass."""
    passed, counts = F.lit(True), []
    for name, c in stages.items():
        passed = passed & F.coalesce(c, F.lit(False))
        counts.append(F.count_if(passed).alias(name))
    row = df.agg(*counts)
    return row.select(F.inline(F.array(*[F.struct(F.lit(i).alias("step"), F.lit(n).alias("stage"), F.col(n).alias("n")) for i, n in enumerate(stages)])))


def runtime_table(df: DataFrame, movie: str, step: str, seconds: str, steps: list[str]) -> DataFrame:
    """Wide table of runtimes with a total: one row per movie, 0 for steps that did not run."""
    wide = df.groupBy(movie).pivot(step, steps).agg(rounded(F.sum(seconds), 2)).na.fill(0.0, steps)
    return wide.withColumn("total", rounded(reduce(lambda a, b: a + b, [F.col(s) for s in steps]), 2))


def top(df: DataFrame, score: Column, order: list[Column], n: int, name: str = "place") -> DataFrame:
    """The first ``n`` rows by score, then by ``order``, with their place: a bounded heap per task, then one merge."""
    best = df.withColumn("__s", score).orderBy(F.col("__s").desc_nulls_last(), *order).limit(n)
    w = Window.orderBy(F.col("__s").desc_nulls_last(), *order)
    return best.withColumn(name, F.row_number().over(w)).drop("__s")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by a seeded hash of their key: the same ones for any partitioning."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(n)


def paged(df: DataFrame, order: list[Column], size: int, page: int) -> DataFrame:
    """One page of the ordered rows; only the rows up to its end are held."""
    w = Window.orderBy(*order)
    head = df.orderBy(*order).limit(size * (page + 1))
    return head.withColumn("__n", F.row_number().over(w)).where(F.col("__n") > size * page).drop("__n")


def batches(df: DataFrame, group: list[str], order: list[Column], size: int, *, name: str = "batch") -> DataFrame:
    """Number the rows in order and cut them into batches of ``size``: adds ``ordinal`` and the batch from 0."""
    return positions(df, group, order, name="ordinal").withColumn(name, F.floor((F.col("ordinal") - 1) / size))


def spread(df: DataFrame, order: list[Column], workers: int, *, contiguous: bool = False) -> DataFrame:
    """Assign the ordered rows to workers in turn, or in stretches of ceil(n / workers): adds ``worker``."""
    at = positions(df, [], order, name="ordinal", total="__n")
    turn = F.pmod(F.col("ordinal") - 1, F.lit(workers))
    stretch = F.floor((F.col("ordinal") - 1) / F.ceil(F.col("__n") / workers))
    return at.withColumn("worker", (stretch if contiguous else turn).cast("int")).drop("__n")


def latest_run(runs: DataFrame, prefix: str, name: str) -> DataFrame:
    """The run directory with the greatest name of each prefix."""
    return runs.groupBy(prefix).agg(F.max(name).alias(name))


def name_hits(df: DataFrame, names: str, caption: str) -> DataFrame:
    """(name, tagged, named): how many clips have an actor, and how many of their captions say the name."""
    each = df.select(F.explode(F.array_distinct(names)).alias("name"), F.coalesce(F.col(caption), F.lit("")).alias("c"))
    hit = F.contains(F.lower("c"), F.lower("name"))
    return each.where("name is not null and trim(name) <> ''").groupBy("name").agg(F.count(F.lit(1)).alias("tagged"), F.count_if(hit).alias("named"))
