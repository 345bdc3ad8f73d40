"""What the queries share: current clips, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.operators.snapshot import clean, current_rows
from filmloom.sources.tables import table


def clips(spark, folder: str, *columns: str, **more: Column) -> DataFrame:
    """Current clips with some columns; video_id is cleaned."""
    picked = {c: F.col(c) for c in columns} | more
    if "video_id" in picked:
        picked["video_id"] = clean(F.col("video_id"))
    return current_rows(table(spark, folder, "clips"), picked)


def source_types(spark, folder: str) -> DataFrame:
    """(movie, source_type) of every listed movie."""
    kind = clean(F.col("source_type"))
    rows = table(spark, folder, "movie_registry").select(clean(F.col("video_id")).alias("movie"), F.when(kind != "", kind).otherwise(F.lit("youtube")).alias("k"), "registered_at")
    return rows.dropna(subset=["movie"]).groupBy("movie").agg(F.max(F.struct("registered_at", "k")).alias("m")).select("movie", F.col("m.k").alias("source_type"))


#: Common table expressions of the same.
CUR = """
cur AS (
  SELECT * REPLACE (lower(replace(replace(trim(video_id), ' ', '_'), '-', '_')) AS video_id) FROM clips WHERE clip_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY processed_at DESC NULLS LAST) = 1
)"""
REG = """
reg AS (
  SELECT lower(replace(replace(trim(video_id), ' ', '_'), '-', '_')) AS movie,
         arg_max(coalesce(nullif(lower(replace(replace(trim(source_type), ' ', '_'), '-', '_')), ''), 'youtube'), registered_at) AS source_type
  FROM movie_registry WHERE video_id IS NOT NULL GROUP BY 1
)"""


def r(x: str, digits: int = 4) -> str:
    """Rounding as in functions.rounding."""
    return f"round(({x}) + sign({x}) * 1e-9, {digits})"


def nn(x: str) -> str:
    """Null for NaN."""
    return f"CASE WHEN isnan({x}) THEN NULL ELSE {x} END"


def md5_mod(x: str, n: int) -> str:
    """The md5 digest as a number modulo n, folded by 16 bits."""
    acc = "0::BIGINT"
    for i in range(8):
        acc = f"(({acc}) * 65536 + ('0x' || substr(md5({x}), {1 + 4 * i}, 4))::BIGINT) % {n}"
    return f"({acc})"
