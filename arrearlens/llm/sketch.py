"""Bit fields of fixed size that say "not in the set" for certain.

A set of any size is told to all tasks in a field of a stated number of bits. What the field lets pass
by chance costs work and is sorted out by exact counts later; nothing that belongs to the set is lost.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 8 MB; at most BITS / 64 rows of two numbers reach the driver, however large the set is.
BITS = 1 << 26


def key_hash(*parts: bytes) -> int:
    """Python's side of xxhash64(parts...): unsigned, each part seeded by the one before."""
    seed = 42
    for part in parts:
        seed = xxhash.xxh64_intdigest(part, seed)
    return seed


def field(positions: DataFrame, position: Column, bits: int = BITS) -> Broadcast:
    """The field with the bits at `position` (a long from 0 to bits - 1) set, sent to all tasks."""
    packed = positions.select(position.alias("at")).groupBy(F.expr("at div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("held"))
    words = np.zeros(bits // 64, np.int64)
    rows = packed.toPandas()
    words[rows["word"].to_numpy(np.int64)] = rows["held"].to_numpy(np.int64)
    return positions.sparkSession.sparkContext.broadcast(words.view(np.uint64))


def remainder(hashed: Column, n: int) -> Column:
    """hash mod n of a signed 64-bit hash read as unsigned, for n a power of two."""
    return hashed.bitwiseAND(F.lit(n - 1))


def held(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the positions are set."""
    at = at.astype(np.uint64)
    return (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
