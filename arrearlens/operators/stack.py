"""Combine differently shaped sources on one key with a single shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_sum(
    keys: Sequence[str],
    frames: Sequence[DataFrame],
    maxes: Sequence[str] = (),
) -> DataFrame:
    """One row per key holding the sum (or max) of every non-key column.

    Replaces a chain of outer joins on the same key: rows are partially aggregated
    before the one exchange, so neither the number of sources nor a hot key adds
    shuffles or grows a task.
    """
    both = stack(frames)
    values = [c for c in both.columns if c not in keys]
    return both.groupBy(*keys).agg(*[(F.max(c) if c in maxes else F.sum(c)).alias(c) for c in values])
