"""Ordered stages over the clip table, and their configuration."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.functions import scoring as S
from filmloom.functions.captions import strip_openers, with_captions
from filmloom.operators.dedup import greedy_keep
from filmloom.operators.reports import clamped_bounds


@dataclass(frozen=True)
class Config:
    """Settings of a run; plans read it and nothing changes it."""

    dedup_distance: int = 8
    score_only: bool = False
    motion_low: float = 0.1
    motion_high: float = 0.9
    motion_floor: float = 0.05
    motion_ceiling: float = 0.95
    dover_least: float = 0.60
    discard_below: float = 0.10
    review_below: float = 0.18
    verdicts: tuple[str, ...] = ("FINAL",)
    survivors_only: bool = False
    extra: dict = field(default_factory=dict)

    @classmethod
    def of(cls, *layers: dict) -> Config:
        """Settings from layers, later ones first; keys that are no settings are dropped."""
        known = {f.name for f in fields(cls)}
        return replace(cls(), **{k: v for layer in layers for k, v in layer.items() if k in known})


Stage = Callable[[DataFrame, Config], DataFrame]


def deduplicate(df: DataFrame, cfg: Config) -> DataFrame:
    """Near duplicates within each movie: keep, dup_of and the reason."""
    found = greedy_keep(df, ["video_id"], "clip_id", "bits", ["timestamp_start", "clip_id"], cfg.dedup_distance, score_only=cfg.score_only)
    side = found.select(F.col("clip_id").alias("__i"), F.col("keep").alias("__k"), F.col("dup_of").alias("__d"), F.col("reason").alias("__r"))
    joined = df.drop("dup_of").join(side, F.col("clip_id") == F.col("__i"), "left")
    return joined.withColumns({"keep": S.keeps(F.col("keep")) & F.coalesce("__k", F.lit(True)), "dup_of": F.col("__d"), "s2_reject_reason": F.col("__r")}).drop("__i", "__k", "__d", "__r")


def motion_gate(df: DataFrame, cfg: Config) -> DataFrame:
    """Clips outside the motion bounds of their movie; the first reason stays."""
    basis = df.where(S.keeps(F.col("keep"))) if cfg.survivors_only else df
    bounds = clamped_bounds(basis, ["video_id"], "motion_score", low=cfg.motion_low, high=cfg.motion_high, floor=cfg.motion_floor, ceiling=cfg.motion_ceiling)
    side = bounds.select(F.col("video_id").alias("__v"), "lower", "upper")
    reason = S.motion_reason(F.col("motion_score"), F.col("lower"), F.col("upper"))
    joined = df.join(side, F.col("video_id").eqNullSafe(F.col("__v")), "left").withColumn("__r", reason)
    out = joined.withColumns({"motion_pass": F.col("__r").isNull(), "s2_reject_reason": S.first_reason(F.col("s2_reject_reason"), F.col("__r"))})
    return (out if cfg.score_only else out.withColumn("keep", S.keeps(F.col("keep")) & F.col("__r").isNull())).drop("__v", "lower", "upper", "__r")


def quality_gate(df: DataFrame, cfg: Config) -> DataFrame:
    """Clips below the technical quality; the first reason stays."""
    reason = S.quality_reason(F.col("dover_score"), cfg.dover_least)
    out = df.withColumns({"s2_reject_reason": S.first_reason(F.col("s2_reject_reason"), reason), "dover_passed": F.col("motion_pass") & reason.isNull()})
    return out if cfg.score_only else out.withColumn("keep", S.keeps(F.col("keep")) & reason.isNull())


def classify(df: DataFrame, cfg: Config) -> DataFrame:
    return df.withColumns({"bucket": S.clip_bucket(F.col("bucket")), "route": S.route(F.col("bucket"))})


def caption(df: DataFrame, cfg: Config) -> DataFrame:
    out = with_captions(df, "caption", "generated_caption", "caption_struct", prose="__prose")
    return out.withColumn("caption", strip_openers(F.col("__prose"))).drop("__prose")


def score(df: DataFrame, cfg: Config) -> DataFrame:
    c = F.col
    return df.withColumn("final_score", S.clip_final_score(S.known(c("clip_score")), S.known(c("dover_score")), F.lit(None).cast("double"), c("motion_score"), c("bucket_confidence"), c("caption"), c("keep")))


def gate(df: DataFrame, cfg: Config) -> DataFrame:
    return df.withColumn("verdict", S.clip_gate(F.col("final_score"), F.col("keep"), F.col("reject"), cfg.discard_below, cfg.review_below))


#: Stages by name, in the order they run.
STAGES: dict[str, Stage] = {"dedup": deduplicate, "motion": motion_gate, "quality": quality_gate, "classify": classify, "caption": caption, "score": score, "gate": gate}

#: Older names of stages.
ALIASES = {"dedup_intra": "dedup", "dedup_cross": "dedup", "s2": "dedup", "s5": "classify", "s8": "caption", "s9": "score", "s10": "gate"}


def chosen(first: str | None = None, last: str | None = None, stages: dict[str, Stage] = STAGES) -> list[str]:
    """Names of the stages from one to another."""
    names = list(stages)
    at = lambda n, default: names.index(ALIASES.get(n, n)) if n else default
    return names[at(first, 0) : at(last, len(names) - 1) + 1]


def run(df: DataFrame, cfg: Config, *, first: str | None = None, last: str | None = None, force: bool = False, stages: dict[str, Stage] = STAGES) -> DataFrame:
    """One lazy plan through the chosen stages; with ``processing_status`` those that are done for every clip are skipped.

    Each stage marks itself done in the status map.
    """
    status = F.coalesce(F.col("processing_status"), F.create_map().cast("map<string, boolean>")) if "processing_status" in df.columns else F.create_map().cast("map<string, boolean>")
    out = df.withColumn("processing_status", status)
    names = chosen(first, last, stages)
    if not force and "processing_status" in df.columns:
        flags = out.agg(*[F.every(F.coalesce(F.try_element_at("processing_status", F.lit(n)), F.lit(False))).alias(n) for n in names]).first()
        names = [n for n in names if not flags[n]]
    for n in names:
        out = mark(stages[n](out, cfg), F.lit(n))
    return out


def mark(df: DataFrame, step: Column) -> DataFrame:
    """Mark a step done in the status map."""
    rest = F.map_filter("processing_status", lambda k, _: k != step)
    return df.withColumn("processing_status", F.map_concat(rest, F.create_map(step, F.lit(True))))
