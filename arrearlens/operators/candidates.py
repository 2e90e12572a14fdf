"""Rows whose key may be among those of another frame, found without a shuffle of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the field that tells which keys were seen: at most BITS / 64 rows are broadcast, 16 bytes each.
BITS = 1 << 24


def _place(key: str, bits: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(bits - 1))


def may_be_among(df: DataFrame, seen: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """Rows of `df` whose `key` is in `seen`, and a few more whose hash falls on a bit of one that is.

    Keys are hashed to one bit each of a field of fixed size, which is packed into words and joined
    as a broadcast, so its size is bounded whatever the number of keys; the more keys, the more other
    rows pass. No row of a seen key is lost, so an exact operator may follow. Rows without a key go.
    """
    place = _place(key, bits)
    words = (
        seen.where(F.col(key).isNotNull())
        .select(place.alias("__at"))
        .groupBy(F.expr("__at div 64").alias("__word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(__at % 64 as int)))").alias("__bits"))
    )
    rows = df.where(F.col(key).isNotNull()).withColumn("__at", place)
    on = F.expr("__at div 64 = __word and shiftrightunsigned(__bits, cast(__at % 64 as int)) % 2 <> 0")
    return rows.join(F.broadcast(words), on, "left_semi").drop("__at")
