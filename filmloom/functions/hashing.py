"""Hash arithmetic: md5 remainders, 64-bit perceptual hashes, SimHash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def md5_mod(c: Column, n: int) -> Column:
    """The md5 digest of a string, read as a 128-bit number, modulo ``n`` (up to 2**40).

    The digest is folded in eight steps of 16 bits, so nothing overflows.
    """
    digest = F.md5(c)
    acc = F.lit(0).cast("bigint")
    for i in range(8):
        part = F.conv(F.substring(digest, 1 + 4 * i, 4), 16, 10).cast("bigint")
        acc = (acc * 65536 + part) % n
    return acc


def phash_bits(c: Column) -> Column:
    """16 hex digits as a signed 64-bit number; null where the text is no such hash."""
    hexed = F.lower(F.trim(c))
    return F.when(hexed.rlike("^[0-9a-f]{16}$"), F.conv(hexed, 16, -10).cast("bigint"))


def hamming(a: Column, b: Column) -> Column:
    """Number of differing bits of two 64-bit hashes."""
    return F.bit_count(a.bitwiseXOR(b))


def simhash(df: DataFrame, item: str, text: str) -> DataFrame:
    """(item, simhash): 64-bit SimHash over the pairs of neighbouring words of each text, split at blanks.

    Each pair votes with the sign of every bit of the first 64 bits of its md5.
    The votes are summed on the map side, so only one row per item travels.  A
    text of fewer than two words, or null, gives no row.
    """
    words = F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")
    rows = df.select(F.col(item).alias("__i"), words.alias("__w")).where(F.size("__w") > 1)
    pairs = rows.select("__i", F.explode(F.zip_with(F.slice("__w", 1, F.size("__w") - 1), F.slice("__w", 2, F.size("__w") - 1), lambda a, b: F.concat_ws(" ", a, b))).alias("__p"))
    hashed = pairs.select("__i", F.conv(F.substring(F.md5("__p"), 1, 16), 16, -10).cast("bigint").alias("__h"))
    bits = [F.expr(f"sum(shiftrightunsigned(__h, {k}) & 1L)").alias(f"b{k}") for k in range(64)]
    votes = hashed.groupBy("__i").agg(F.count(F.lit(1)).alias("__n"), *bits)
    out = F.expr(" | ".join(f"if(2 * b{k} > __n, shiftleft(1L, {k}), 0L)" for k in range(64)))
    return votes.select(F.col("__i").alias(item), out.alias("simhash"))
