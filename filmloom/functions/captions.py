"""Model-written JSON and captions, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.functions import vocabulary as V
from filmloom.functions.rounding import rounded
from filmloom.functions.scoring import clip_bucket

# Openers that speak about the clip instead of its content, tried in this order.
OPENERS = [
    r"^In the video clip,?\s*",
    r"^In this (video )?clip,?\s*",
    r"^The video clip (shows|depicts|features)\s*",
    r"^This video clip (shows|depicts|features)\s*",
    r"^The clip (shows|depicts|features)\s*",
    r"^This clip (shows|depicts|features)\s*",
    r"^The video (shows|depicts|features)\s*",
    r"^This video (shows|depicts|features)\s*",
]


def strip_fences(c: Column) -> Column:
    """Text within a markdown fence, without the fence lines."""
    t = F.trim(c)
    inner = F.regexp_replace(F.regexp_replace(t, r"^```[^\n]*\n?", ""), r"\n[ \t]*```$", "")
    return F.when(t.startswith("```"), F.trim(inner)).otherwise(t)


def repair_json(c: Column) -> Column:
    """The JSON object that a model's answer holds, as text: the answer itself, without fence, or from its first to its last brace; else null."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.trim(c), r"^```(json)?\s*", ""), r"\s*```$", ""))
    widest = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    valid = lambda t: F.when(F.try_parse_json(t).isNotNull() & F.trim(t).startswith("{"), t)
    return F.coalesce(valid(bare), valid(widest))


def single_line_json(c: Column) -> Column:
    """The object an answer holds, on one line; without one, the answer with each run of blanks as one."""
    found = repair_json(c)
    flat = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(c), r"^```(json)?", ""), r"```$", ""), r"\s+", " "))
    return F.coalesce(F.to_json(F.try_parse_json(found)), flat)


def json_text(c: Column, key: str) -> Column:
    """A text member of the object that an answer holds."""
    return F.try_variant_get(F.try_parse_json(repair_json(c)), f"$.{key}", "string")


def rescued_description(c: Column) -> Column:
    """The description of an object that breaks off later; null without one."""
    found = F.regexp_extract(c, r'"short_description"\s*:\s*"([^"]*)"', 1)
    return F.when(found != "", found)


def caption_text(c: Column) -> Column:
    """A caption as plain text: the description of a JSON object (whole or broken off), else the text itself; empty for null."""
    t = F.trim(F.coalesce(c, F.lit("")))
    described = F.coalesce(F.nullif(F.trim(json_text(t, "short_description")), F.lit("")), rescued_description(t))
    return F.when(t.startswith("{") & F.contains(t, F.lit("short_description")), F.coalesce(described, t)).otherwise(t)


def with_captions(df: DataFrame, caption: str, generated: str, struct: str, *, prose: str = "prose", review: str | None = None) -> DataFrame:
    """Add the caption for exports, and the one for reviewers.

    Exports never get a JSON text if any field has prose; reviewers get the
    prose, else the whole object.  The parsed parts are columns of their own
    first, so that no answer is parsed twice.
    """
    parts = df.withColumns({"__c": caption_text(F.col(caption)), "__g": caption_text(F.col(generated)), "__s": repair_json(F.col(struct)), "__o": repair_json(F.col(generated))})
    get = lambda k: F.try_variant_get(F.try_parse_json("__s"), f"$.{k}", "string")
    parts = parts.withColumns({"__d": F.nullif(F.trim(F.coalesce(get("short_description"), F.lit(""))), F.lit("")), "__p": F.coalesce(get("_format") == "prose", F.lit(False))})
    plain = lambda c: F.when((F.col(c) != "") & ~(F.col(c).startswith("{") & F.contains(F.col(c), F.lit("short_description"))), F.col(c))
    out = {prose: F.when(F.col("__p"), F.coalesce("__d", "__c")).otherwise(F.coalesce(plain("__c"), plain("__g"), F.col("__c")))}
    if review:
        broken = F.coalesce(F.contains(struct, F.lit('"_parse_error"')), F.lit(False))
        whole = F.when(~broken & (F.length(F.trim(struct)) > 2), F.to_json(F.try_parse_json("__s")))
        out[review] = F.when(F.col("__p"), F.trim(F.coalesce(F.col("__d"), F.col(caption), F.lit("")))).otherwise(F.coalesce(whole, F.to_json(F.try_parse_json("__o")), F.col("__c")))
    return parts.withColumns(out).drop("__c", "__g", "__s", "__o", "__d", "__p")


def strip_openers(c: Column) -> Column:
    """Caption without the first opener that matches, with a capital first letter."""
    t = F.trim(c)
    out = None
    for p in OPENERS:
        hit = t.rlike("(?i)" + p)
        cut = F.trim(F.regexp_replace(t, "(?i)" + p, ""))
        out = F.when(hit, cut) if out is None else out.when(hit, cut)
    rest = out.otherwise(t)
    return F.concat(F.upper(F.substring(rest, 1, 1)), F.substring(rest, 2, 1 << 30))


def parsed_score(answer: Column) -> Column:
    """Struct (score, explanation): the first line that is or begins with a digit from 1 to 5 gives the score, the rest explains it."""
    lines = F.filter(F.transform(F.split(F.coalesce(answer, F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    form = r"^[1-5](?![0-9])"
    at = F.array_position(F.transform(lines, lambda x: x.rlike(form)), True).cast("int")
    line = F.try_element_at(lines, F.greatest(at, F.lit(1)))
    rest = F.trim(F.regexp_replace(F.substring(line, 2, 1 << 30), r"^[.:)\-\s]+", ""))
    others = F.filter(lines, lambda x, i: i != at - 1)
    told = F.trim(F.concat_ws(" ", F.nullif(rest, F.lit("")), F.array_join(others, " ")))
    return F.when(at > 0, F.struct(F.substring(line, 1, 1).cast("int").alias("score"), told.alias("explanation")))


def classified(answer: Column) -> Column:
    """A classifier's JSON answer as struct (bucket, bucket_confidence, reject, reject_reason, attributes).

    ``keep`` or else ``reject`` decides; a reason only counts with a rejection;
    a confidence that is missing, 0 or no number is 0.5.
    """
    v = F.try_parse_json(repair_json(answer))
    get = lambda k, t="string": F.try_variant_get(v, f"$.{k}", t)
    reject = F.coalesce(~get("keep", "boolean"), get("reject", "boolean"), F.lit(False))
    reason = get("reject_reason")
    reason = F.when(reject & ~F.lower(F.trim(reason)).isin("none", "null", ""), reason)
    confidence = F.coalesce(F.nullif(get("bucket_confidence", "double"), F.lit(0.0)), F.lit(0.5))
    raw = F.coalesce(F.nullif(get("primary_bucket"), F.lit("")), F.nullif(get("bucket"), F.lit("")), F.lit(""))
    attributes = F.map_filter(F.map_from_arrays(F.array(*[F.lit(a) for a in V.ATTRIBUTES]), F.array(*[get(a) for a in V.ATTRIBUTES])), lambda _, x: x.isNotNull())
    return F.struct(clip_bucket(raw).alias("bucket"), rounded(confidence, 4).alias("bucket_confidence"), reject.alias("reject"), reason.alias("reject_reason"), attributes.alias("attributes"))


def caption_prompt(base: Column, names: Column, label: Column, longest: int = 100) -> Column:
    """A bucket's prompt with the identified cast before it and a short known label as a fact after it."""
    cast = F.when(F.coalesce(F.size(names), F.lit(0)) > 0, F.concat(F.lit("Identified cast: "), F.array_join(names, " and "), F.lit(". Use each full name.\n\n")))
    short = F.trim(F.coalesce(label, F.lit("")))
    fact = F.when((short != "") & (F.length(short) <= longest), F.concat(F.lit("\n\nKnown fact: "), short))
    return F.concat(F.coalesce(cast, F.lit("")), base, F.coalesce(fact, F.lit("")))


def replaced(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Literal replacements in order."""
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def first_clean(candidates: Column, bad: Column, repaired: Column) -> Column:
    """The first candidate that isn't marked bad, else the repaired text."""
    pairs = F.arrays_zip(candidates.alias("c"), bad.alias("b"))
    return F.coalesce(F.try_element_at(F.filter(pairs, lambda p: ~p["b"]), F.lit(1))["c"], repaired)


def mentions(names: Column, caption: Column) -> Column:
    """The names that a caption holds, in any case."""
    return F.filter(names, lambda n: F.contains(F.lower(caption), F.lower(n)))
