"""Score fusion, gates and label rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from filmloom.functions import vocabulary as V
from filmloom.functions.hashing import md5_mod
from filmloom.functions.rounding import rounded


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """The number within limits; null stays null, which least and greatest would skip."""
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def known(c: Column) -> Column:
    """The number, or null where it is NaN: NaN must pass no threshold, while Spark orders it above all numbers."""
    return F.when(~F.isnan(c), c)


def keeps(keep: Column) -> Column:
    """Keep flag with its default."""
    return F.coalesce(keep, F.lit(True))


def rejected(reject: Column) -> Column:
    return F.coalesce(reject, F.lit(False))


def lookup(c: Column, table: dict[str, str], default: Column) -> Column:
    """Value of a small constant table, folded into the plan as a map literal."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, c), default)


# Fusion


def combined_score(clip: Column, icr: Column, aod: Column, nouns: Column, weights: tuple[float, float, float] = (0.55, 0.0, 0.45), least_nouns: int = 5) -> Column:
    """Weighted CLIP, coverage and adjective scores; captions with few nouns count less in the last two.

    ``weights`` has no default that all callers share: (0.55, 0, 0.45) is that of the pipeline, (0.40, 0.35, 0.25) that of the stand-alone scorer.
    """
    c, i, a = weights
    damp = F.least(nouns / F.lit(least_nouns), F.lit(1.0))
    return rounded(F.lit(c) * clip + F.lit(i) * icr * damp + F.lit(a) * F.when(aod > 1, F.lit(1.0)).otherwise(aod) * damp, 4)


def adjective_category(word: Column) -> Column:
    """color, size, texture, material or other."""
    w = F.lower(word)
    out = None
    for name, words in V.ADJECTIVES.items():
        out = F.when(w.isin(words), name) if out is None else out.when(w.isin(words), name)
    return out.otherwise("other")


def noun_coverage(labels: Column, nouns: Column) -> Column:
    """Share of the nouns that match a detected label, as a part of it or the other way round; 0 without nouns."""
    low = F.transform(labels, F.lower)
    text = F.array_join(low, " ")
    hit = F.filter(nouns, lambda n: F.contains(text, n) | F.exists(low, lambda x: F.contains(n, x)))
    return F.when(F.size(nouns) > 0, rounded(F.least(F.size(hit) / F.size(nouns), F.lit(1.0)), 4)).otherwise(F.lit(0.0))


def motion_fusion(first: Column, second: Column, weights: tuple[float, float] = (0.7, 0.3)) -> Column:
    """Weighted mean of two motion scores, 4 digits; 0 for weights that don't add up to more than 0."""
    a, b = weights
    return rounded((a * F.coalesce(first, F.lit(0.0)) + b * F.coalesce(second, F.lit(0.0))) / (a + b), 4) if a + b > 0 else F.lit(0.0)


def flow_score(raw: Column, scale: float = 8.0) -> Column:
    return clamp(raw / scale)


def clip_final_score(clip: Column, dover: Column, aesthetic: Column, motion: Column, bucket: Column, caption: Column, keep: Column) -> Column:
    """Fused quality of a clip; 0 where it isn't kept."""
    zero = F.lit(0.0)
    present = F.when(F.length(F.trim(F.coalesce(caption, F.lit("")))) > 0, 1.0).otherwise(0.0)
    score = 0.25 * F.coalesce(clip, zero) + 0.30 * clamp(F.coalesce(dover, aesthetic, zero)) + 0.20 * clamp(F.coalesce(motion, zero)) + 0.15 * clamp(F.coalesce(bucket, zero)) + 0.10 * present
    return F.when(keeps(keep), rounded(score, 4)).otherwise(zero)


def first_final_score(clip: Column, icr: Column, aod: Column, weights: tuple[float, float, float] = (0.35, 0.40, 0.25)) -> Column:
    """Fused quality in the older form of the clip pipeline."""
    c, i, a = weights
    return rounded(F.lit(c) * clip + F.lit(i) * icr + F.lit(a) * aod, 4)


# Deterministic stand-ins for model scores


def standin_clip(text: Column) -> Column:
    return 0.55 + md5_mod(text, 40) / 100


def standin_dover(path: Column) -> Column:
    """Struct (aesthetic, technical, overall)."""
    base = F.conv(F.substring(F.md5(path), 1, 8), 16, 10).cast("bigint")
    aesthetic, technical = 0.45 + (base % 35) / 100, 0.50 + (F.shiftright(base, 8) % 30) / 100
    return F.struct(aesthetic.alias("aesthetic"), technical.alias("technical"), (0.7 * aesthetic + 0.3 * technical).alias("overall"))


def standin_icr(bucket: Column, confidence: Column, reject: Column) -> Column:
    base = 0.5 + md5_mod(F.coalesce(bucket, F.lit("")), 35) / 100
    return F.when(rejected(reject), 0.1).otherwise(F.least(F.lit(1.0), base + F.coalesce(confidence, F.lit(0.0)) * 0.2))


def standin_aod(clip_id: Column) -> Column:
    return 0.45 + md5_mod(clip_id, 40) / 100


# Logo scores


def logo_score(std: Column, edges: Column, laplacian: Column, std_range: tuple[float, float] = (18, 90), least_edges: float = 0.10, least_laplacian: float = 80) -> Column:
    """How much a corner patch looks like a logo, from 0 to 1; smooth bright blobs and flat patches have 0."""
    low, high = std_range
    sharp = (std >= low) & (std <= high) & (edges >= least_edges) & (laplacian >= least_laplacian) & ~((std > 55) & (edges < 0.12))
    part = 0.35 * F.least(F.lit(1.0), (std - low) / max(1.0, high - low))
    part += 0.40 * F.least(F.lit(1.0), edges / max(least_edges, 0.01))
    part += 0.25 * F.least(F.lit(1.0), laplacian / max(least_laplacian, 1.0))
    return F.when(sharp, rounded(part, 4)).otherwise(F.lit(0.0))


def logo_decision(corners: Column, template_corner: Column, template: float = 0.55, heuristic: float = 0.5) -> Column:
    """Struct (present, corner, method, score) from an array of (corner, heuristic, template_match).

    With a learned template its corner decides; failing that any corner on
    which template and heuristic agree strongly.  Without one the best heuristic decides.
    """
    own = F.try_element_at(F.filter(corners, lambda c: c["corner"] == template_corner), F.lit(1))
    strong = F.try_element_at(F.filter(corners, lambda c: (c["template_match"] >= template + 0.08) & (c["heuristic"] >= 0.35)), F.lit(1))
    best = F.aggregate(corners, F.try_element_at(corners, F.lit(1)), lambda a, c: F.when(c["heuristic"] > a["heuristic"], c).otherwise(a))

    def say(present: Column | bool, corner: Column, method: str, score: Column) -> Column:
        return F.struct(F.lit(present).alias("present"), corner.cast("string").alias("corner"), F.lit(method).alias("method"), rounded(score, 4).alias("score"))

    learned = (
        F.when((own["template_match"] >= template) & (own["heuristic"] >= 0.25), say(True, own["corner"], "template", own["template_match"]))
        .when(strong.isNotNull(), say(True, strong["corner"], "template_fallback", strong["template_match"]))
        .otherwise(say(False, F.lit(None), "rejected", best["heuristic"]))
    )
    plain = F.when(best["heuristic"] >= heuristic, say(True, best["corner"], "heuristic", best["heuristic"])).otherwise(say(False, F.lit(None), "rejected", best["heuristic"]))
    return F.when(template_corner.isNotNull(), learned).otherwise(plain)


# Gates


def image_gate(score: Column, final: float = 0.25, review: float = 0.15) -> Column:
    """final, review or discard; NaN and null are discarded."""
    s = known(score)
    return F.when(s >= final, "final").when(s >= review, "review").otherwise("discard")


def clip_gate(score: Column, keep: Column, reject: Column, discard: float = 0.10, review: float = 0.18) -> Column:
    """FINAL, REVIEW or DISCARD; a null or NaN score counts as 0."""
    s = F.coalesce(known(score), F.lit(0.0))
    return F.when(~keeps(keep) | rejected(reject) | (s < discard), "DISCARD").when(s < review, "REVIEW").otherwise("FINAL")


def motion_reason(score: Column, lower: Column, upper: Column) -> Column:
    """static below the lower bound, excessive_motion above the upper one, else null."""
    s = known(score)
    return F.when(s < lower, "static").when(s > upper, "excessive_motion")


def first_reason(*reasons: Column) -> Column:
    """The reason that was found first stays."""
    return F.coalesce(*reasons)


def quality_reason(dover: Column, least: float = 0.60) -> Column:
    return F.when(F.coalesce(known(dover), F.lit(0.0)) < least, "low_quality")


def actor_status(names: Column, similarity: Column, margin: Column, least_similarity: float = 0.50, least_margin: float = 0.10) -> Column:
    """no_match, tagged or low_confidence."""
    zero = F.lit(0.0)
    sure = (F.coalesce(similarity, zero) >= least_similarity) & (F.coalesce(margin, zero) >= least_margin)
    return F.when(F.coalesce(F.size(names), F.lit(0)) <= 0, "no_match").when(sure, "tagged").otherwise("low_confidence")


def verify_score(score: Column, passing: int = 4) -> Column:
    """Struct (score, norm, passed): the score within 1 to 5, on a scale from 0 to 1, and whether it passes; null fails."""
    s = clamp(score, 1, 5)
    return F.struct(s.cast("int").alias("score"), rounded((s - 1) / 4, 3).alias("norm"), F.coalesce(s >= passing, F.lit(False)).alias("passed"))


def clip_bucket(raw: Column) -> Column:
    """A raw label as one of the clip buckets."""
    key = F.lower(F.trim(raw))
    return F.when(key.isin(V.CLIP_BUCKETS), key).otherwise(lookup(key, V.CLIP_ALIASES, F.lit(V.CLIP_BUCKETS[0])))


def image_bucket(raw: Column) -> Column:
    """A raw label as one of the image buckets."""
    return F.when(raw.isin(V.IMAGE_BUCKETS), raw).otherwise(lookup(raw, V.IMAGE_ALIASES, F.lit(V.IMAGE_BUCKETS[0])))


def route(raw: Column) -> Column:
    """people or other, by bucket."""
    return F.when(clip_bucket(raw).isin(V.PEOPLE_BUCKETS), "people").otherwise("other")


def band_removed(keep: Column, crop: Column) -> Column:
    """Whether a kept clip has a crop box; null for the others."""
    return F.when(keeps(keep), F.length(F.coalesce(crop, F.lit(""))) > 0)


def without_text(keep: Column, reject: Column, reason: Column, has_text: Column, drop: bool = True) -> Column:
    """Struct (keep, reject, reason): a clip with text on screen is refused where that is asked for."""
    out = F.coalesce(has_text, F.lit(False)) & F.lit(drop)
    return F.struct((keeps(keep) & ~out).alias("keep"), (rejected(reject) | out).alias("reject"), F.when(out, "has_text").otherwise(reason).alias("reason"))


def wants_caption(keep: Column, reject: Column, every: bool = True) -> Column:
    """Whether a clip gets a caption: every one, or only those that stand."""
    return F.lit(True) if every else keeps(keep) & ~rejected(reject)


def accepted_portrait(refused: Column, category: Column) -> Column:
    """Images of people that were accepted; one without a decision was not."""
    return ~F.coalesce(refused, F.lit(True)) & (F.coalesce(category, F.lit("")) == "people_portraits")


def actor_step(keep: Column, reject: Column, route_: Column) -> Column:
    """Why a clip is not searched for actors: skipped, not_applicable, or null where it is."""
    return F.when(~keeps(keep) | rejected(reject), "skipped").when(F.coalesce(route_, F.lit("")) != "people", "not_applicable")


def caption_actors(status: Column, names: Column) -> Column:
    """Names that may go into a caption: those of clips that are surely tagged."""
    return F.when(status == "tagged", F.coalesce(names, F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))


def verify_outcome(keep: Column, reject: Column, verdict: Column, caption: Column, there: Column, allowed: tuple[str, ...] = ("FINAL",)) -> Column:
    """What a check of the caption comes to before it runs: no_target, no_caption, no_clip or check."""
    target = keeps(keep) & ~rejected(reject) & F.coalesce(verdict.isin(list(allowed)), F.lit(False))
    empty = F.length(F.trim(F.coalesce(caption, F.lit("")))) == 0
    return F.when(~target, "no_target").when(empty, "no_caption").when(~F.coalesce(there, F.lit(False)), "no_clip").otherwise("check")


def caption_choice(caption: Column, description: Column, source: Column, bucket: Column, name: Column, markers: tuple[str, ...], permille: int = 150) -> Column:
    """Struct (caption, caption_source): for a fixed share of the files of marked sources their own description is taken."""
    marked = F.lit(False)
    for m in markers:
        marked = marked | F.contains(F.lower(F.coalesce(source, F.lit(""))), F.lit(m)) | F.contains(F.lower(F.coalesce(bucket, F.lit(""))), F.lit(m))
    own = marked & (md5_mod(name, 1000) < permille) & (F.trim(F.coalesce(description, F.lit(""))) != "")
    return F.struct(F.when(own, description).otherwise(caption).alias("caption"), F.when(own, "original").otherwise("model").alias("caption_source"))


def image_flags(sharp: Column, face: Column, saturation: Column, local: Column, brightness: Column, contrast: Column, text: Column) -> Column:
    """Array of the quality flags that hold, in fixed order."""
    zero = F.lit(0.0)
    g, f = F.coalesce(sharp, zero), F.coalesce(face, zero)
    rules = [
        ((g < 25) & (f < 18)) | ((saturation < 60) & (local < 11)),
        brightness < 40,
        brightness > 245,
        contrast < 12,
        (text > 0.45) & (g < 500),
    ]
    return F.filter(F.array(*[F.when(r, F.lit(n)) for n, r in zip(V.QUALITY_FLAGS, rules, strict=True)]), lambda x: x.isNotNull())


def joined_reasons(flags: Column) -> Column:
    """Reasons in one text, and none where nothing holds."""
    return F.array_join(flags, "|")


def watermark_status(detected: Column, boxes: Column, cleaned: Column, still_there: Column) -> Column:
    """State of a frame in the removal of visible logos.

    clean: nothing found; pending_inpaint: found, and not treated (or no box large enough); cleaned; rejected_yolo_verify: still found after treatment.
    """
    treated = F.coalesce(cleaned, F.lit(False)) & (F.coalesce(F.size(boxes), F.lit(0)) > 0)
    return F.when(~F.coalesce(detected, F.lit(False)), "clean").when(~treated, "pending_inpaint").when(F.coalesce(still_there, F.lit(False)), "rejected_yolo_verify").otherwise("cleaned")
