"""Boxes on frames."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box_pixels(pct: Column, width: Column, height: Column, least: int = 10) -> Column:
    """Pixel box [x1, y1, x2, y2] of one in percent; null where a side is under ``least`` pixels."""
    p = [F.floor(pct[i] / 100 * (width if i % 2 == 0 else height)).cast("int") for i in range(4)]
    return F.when((p[2] - p[0] >= least) & (p[3] - p[1] >= least), F.array(*p))


def area(b: Column) -> Column:
    return F.greatest(b[2] - b[0], F.lit(0)) * F.greatest(b[3] - b[1], F.lit(0))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes [x1, y1, x2, y2]; 0 where neither has an area."""
    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0))
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0))
    union = area(a) + area(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(F.lit(0.0))


def third(centre: Column, low: float, high: float, names: tuple[str, str, str] = ("left", "center", "right")) -> Column:
    """Which part of an axis a relative position from 0 to 1 lies in."""
    return F.when(centre < low, names[0]).when(centre > high, names[2]).otherwise(names[1])


def screen_position(box: Column, width: Column, height: Column) -> Column:
    """One of nine fields of the frame by the centre of the box; the middle one is ``center``."""
    x = third((box[0] + box[2]) / 2 / width, 0.33, 0.66)
    y = third((box[1] + box[3]) / 2 / height, 0.33, 0.66, ("top", "middle", "bottom"))
    return F.when((x == "center") & (y == "middle"), "center").otherwise(F.concat_ws("-", y, x))


def horizontal_position(box: Column, crop: Column, low: float = 0.4, high: float = 0.6, default: int = 1920) -> Column:
    """left, center or right by the box's centre within the cropped width; null without a whole box."""
    width = F.greatest(F.coalesce(F.try_element_at(F.split(crop, ":"), F.lit(1)).try_cast("int") if hasattr(Column, "try_cast") else F.lit(None), F.lit(default)), F.lit(1))
    return F.when(F.size(box) >= 4, third((box[0] + box[2]) / 2 / width, low, high))


def face_labels(faces: Column) -> Column:
    """``Name bbox=[x1, y1, x2, y2]`` of every named face, or ``unknown``."""
    named = F.filter(faces, lambda f: F.coalesce(f["display_name"], F.lit("")) != "")
    text = F.array_join(F.transform(named, lambda f: F.concat(f["display_name"], F.lit(" bbox=["), F.array_join(f["bbox"].cast("array<string>"), ","), F.lit("]"))), ", ")
    return F.when(F.size(named) > 0, text).otherwise("unknown")


def plausible_marks(boxes: Column, width: Column, height: Column, most: float = 0.15) -> Column:
    """Logo boxes that cover no more than a share of the frame."""
    return F.filter(boxes, lambda b: area(b) <= most * width * height)


def corner_box(corner: Column, width: Column, height: Column, w: int = 120, h: int = 50) -> Column:
    """[x, y, w, h] of a patch of fixed size in a corner, no larger than the frame."""
    pw, ph = F.least(F.lit(w), width), F.least(F.lit(h), height)
    x = F.when(corner.endswith("right"), width - pw).otherwise(0)
    y = F.when(corner.startswith("bottom"), height - ph).otherwise(0)
    return F.array(x, y, pw, ph)
