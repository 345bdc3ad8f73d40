"""Problem 2: a sample whose category shares match given targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmloom.operators.positions import positions
from filmloom.operators.snapshot import clean, current_rows
from filmloom.session import materialise
from filmloom.sources.tables import table


def _uniform(seed: int) -> float:
    """A number in (0, 1) that depends on the seed alone."""
    x = (seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64
    x = ((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9) % 2**64
    return ((x >> 12) + 0.5) / 2**52


def proportional_sample(
    pool: DataFrame,
    targets: DataFrame,
    category: list[str],
    *,
    item: str,
    share: str = "target_permille",
    floor: str = "min_clips",
    fraction: tuple[int, int] = (1, 10),
    seed: int = 17,
) -> tuple[DataFrame, DataFrame]:
    """Systematic unequal-probability sample and the report of its categories.

    With size = floor(pool * fraction), a category asks for
    max(floor, ceil(share * size / 1000)) items.  Each of its items has the
    inclusion probability min(pool of category, share * size / 1000) over the pool of the
    category.  Items lie in random order (a seeded hash of the identifier)
    inside the sorted categories; their probabilities are summed over all
    partitions, and the items at which the sum passes u, u + 1, u + 2, ... for
    one random start u are drawn.  Categories that end below what they ask for
    are then repaired with their next items in the same random order.

    Returns (sample, report).  The sample has the columns of ``pool`` plus
    ``drawn_by`` ('crossing' or 'repair'); the report has one row per target:
    category, ``size``, ``available``, ``wanted``, ``drawn``, ``met``.

    Defined cases: items whose category or identifier is null are outside the
    pool's categories but those with an identifier null are never drawn; a
    category without target is in the pool and is never drawn; a target without
    items has ``available`` 0; null share or floor count as 0; of targets listed
    twice the largest share and floor hold; an empty pool gives size 0.
    """
    cols = pool.columns
    known = pool.dropna(subset=category)
    goal = targets.groupBy(*category).agg(F.coalesce(F.max(share), F.lit(0)).cast("bigint").alias("__share"), F.coalesce(F.max(floor), F.lit(0)).cast("bigint").alias("__floor")).dropna(subset=category)
    ids = materialise(known.select(*category, F.col(item).alias("__id"), F.struct(*cols).alias("__row")))
    counts = ids.groupBy(*category).agg(F.count(F.lit(1)).alias("__here"), F.count("__id").alias("available"))
    size = counts.agg(F.coalesce(F.floor(F.sum("__here") * fraction[0] / fraction[1]), F.lit(0)).cast("bigint").alias("size"))
    plan = goal.join(counts.drop("__here"), category, "left").crossJoin(F.broadcast(size)).na.fill(0, ["available"])  # size is one row
    wanted = F.greatest(F.col("__floor"), F.ceil(F.col("__share") * F.col("size") / 1000))
    mass = F.least(F.col("available").cast("double"), F.col("__share") * F.col("size") / 1000)
    # One row per target: the running sum over the sorted categories is a window over the table of targets alone.
    sums = Window.orderBy(*category).rowsBetween(Window.unboundedPreceding, -1)
    plan = plan.withColumn("wanted", wanted).withColumn("__mass", mass).withColumn("__base", F.coalesce(F.sum("__mass").over(sums), F.lit(0.0)))
    start = F.lit(_uniform(seed))
    passed = lambda at: F.floor(at - start)
    crossings = passed(F.col("__base") + F.col("__mass")) - passed(F.col("__base"))
    plan = materialise(plan.withColumn("__short", F.greatest(F.lit(0), F.least(F.col("wanted"), F.col("available")) - crossings)))
    ranked = positions(
        ids.where("__id is not null").join(plan.select(*category), category, "left_semi").withColumn("__random", F.xxhash64(F.lit(seed), F.col("__id"))),
        category,
        [F.col("__random"), F.col("__id")],
        name="__rank",
    )
    at = ranked.join(plan.select(*category, "available", "__base", "__mass", "__short"), category)

    def total(rank: Column) -> Column:
        whole = F.col("__base") + F.col("__mass")  # exact at the end of the category, as the next one starts there
        return F.when(rank >= F.col("available"), whole).otherwise(F.col("__base") + F.col("__mass") * rank / F.col("available"))

    rank = F.col("__rank")
    drawn = passed(total(rank)) > passed(total(rank - 1))
    spare = rank - (passed(total(rank)) - passed(F.col("__base")))
    sample = at.where(drawn | (spare <= F.col("__short"))).select(*category, F.col("__row"), F.when(drawn, "crossing").otherwise("repair").alias("drawn_by"))
    got = sample.groupBy(*category).agg(F.count(F.lit(1)).alias("drawn"))
    report = plan.join(got, category, "left").na.fill(0, ["drawn"]).select(*category, "size", "available", "wanted", "drawn", (F.col("drawn") >= F.col("wanted")).alias("met"))
    return sample.select("__row.*", "drawn_by"), report


def _clip_mix(spark, folder):
    clips = current_rows(table(spark, folder, "clips"), {"bucket": clean(F.col("bucket")), "verdict": clean(F.col("verdict"), upper=True)})
    return proportional_sample(clips, table(spark, folder, "mix_targets"), ["bucket", "verdict"], item="clip_id")


def p2_found(spark, folder: str) -> DataFrame:
    """Targets of which the drawn sample falls short."""
    return _clip_mix(spark, folder)[1].where("not met").select("bucket", "verdict")


def p2_sample(spark, folder: str) -> DataFrame:
    """The drawn clips."""
    return _clip_mix(spark, folder)[0]


def p2_report(spark, folder: str) -> DataFrame:
    """What each target asked for and got."""
    return _clip_mix(spark, folder)[1]


QUERIES = {"p2_found": p2_found, "p2_sample": p2_sample, "p2_report": p2_report}
