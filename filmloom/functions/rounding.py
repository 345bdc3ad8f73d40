"""Rounding that does not hang on the last bit of a binary fraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(c: Column | str, digits: int = 4) -> Column:
    """Half away from zero; values within 1e-9 of a half count as halves, so sums in another order round alike."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.signum(c) * 1e-9, digits)
