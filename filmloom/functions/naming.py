"""Names, paths, time codes and other small text forms of records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from filmloom.functions.rounding import rounded


def file_name(path: Column) -> Column:
    """Last component of a path."""
    return F.regexp_extract(path, r"([^/]+)/*$", 1)


def stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def parent_name(path: Column) -> Column:
    """Name of the folder that holds the file; empty where there is none."""
    return F.regexp_extract(path, r"([^/]+)/+[^/]+/*$", 1)


def unique_stem(path: Column) -> Column:
    """``parent__stem``, the key that joins the outputs of all steps."""
    return F.concat(parent_name(path), F.lit("__"), stem(path))


def outside_dupes(path: Column) -> Column:
    """The path has no component whose name ends in ``_dupes``."""
    return ~path.rlike(r"(^|/)[^/]*_dupes(/|$)")


def clip_id(video: Column, index: Column) -> Column:
    """``<video>_<six digits>``."""
    return F.format_string("%s_%06d", video, index.cast("int"))


def slug(c: Column, longest: int | None = 120, empty: str | None = "actor") -> Column:
    """Lower case with one underscore for each run of other characters, none outside."""
    s = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")
    if longest:
        s = F.substring(s, 1, longest)
    return F.when(s == "", F.lit(empty)).otherwise(s) if empty else s


def display_name(c: Column) -> Column:
    """Words of a slug with capital initials."""
    return F.initcap(F.translate(c, "_", " "))


def timecode(seconds: Column) -> Column:
    """``HH:MM:SS.mmm`` of a number of seconds."""
    ms = F.round(seconds * 1000).cast("bigint")
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(ms / 3600000), F.floor(ms / 60000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def seconds(code: Column) -> Column:
    """Seconds of ``HH:MM:SS.mmm``; null where it has another form."""
    p = F.split(code, ":")
    return F.when(code.rlike(r"^\d+:\d{1,2}:\d{1,2}(\.\d+)?$"), p[0].cast("double") * 3600 + p[1].cast("double") * 60 + p[2].cast("double"))


def crop_box(c: Column) -> Column:
    """Struct (w, h, x, y) of a packed crop box ``crop=w:h:x:y``; null where it doesn't have four whole numbers."""
    s = F.regexp_replace(F.trim(c), "^crop=", "")
    p = F.split(s, ":")
    return F.when(s.rlike(r"^\d+:\d+:\d+:\d+$"), F.struct(*[p[i].cast("int").alias(n) for i, n in enumerate("whxy")]))


def local_range(start: Column, end: Column, own: Column, default: float = 0.0) -> Column:
    """Struct (start, end) relative to the segment that a clip was cut from."""
    shift = F.coalesce(own, F.lit(default))
    return F.struct((start - shift).alias("start"), (end - shift).alias("end"))


def frame_offsets(duration: Column, default: float = 5.0) -> Column:
    """Three sample times within a clip: at 20, 50 and 80 % of its length of at least a second."""
    d = F.greatest(F.coalesce(duration, F.lit(default)), F.lit(1.0))
    return F.array(*[rounded(d * x, 3) for x in (0.2, 0.5, 0.8)])


def human_duration(s: Column) -> Column:
    """``1h 02m``, ``3m 05s`` or ``7s``."""
    n = F.floor(F.coalesce(s, F.lit(0.0))).cast("bigint")
    hours, minutes = F.floor(n / 3600), F.floor(n / 60) % 60
    return (
        F.when(n >= 3600, F.format_string("%dh %02dm", hours, minutes))
        .when(n >= 60, F.format_string("%dm %02ds", minutes, n % 60))
        .otherwise(F.format_string("%ds", n))
    )


def escape_html(c: Column) -> Column:
    """Text with the five markup characters as entities."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c
