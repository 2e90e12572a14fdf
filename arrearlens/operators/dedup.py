"""One row per key, chosen deterministically."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookup import Keys, as_list, lookup

_RANK = "__rank"


def latest_per_key(
    df: DataFrame,
    key: Keys,
    order: Sequence[str],
    keep: str = "last",
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Keep one row per non-null `key`: the last (or first) by `order`.

    Names in `order` sort descending for `keep="last"` and ascending for "first",
    missing values always last so that a row without a time never wins; an entry with
    its own direction ("name asc") is taken as given. Remaining columns break ties (or
    `ties`, when only some matter), so a rerun picks the same row.

    Spark turns `row_number() = 1` into a rank limit on both sides of the shuffle:
    every map task ships at most one row per key, however hot the key is.
    """
    if keep not in ("last", "first"):
        raise ValueError(f"keep must be 'last' or 'first', not {keep!r}")
    keys = as_list(key)
    if ties is None:
        ties = [c for c in df.columns if c not in keys and c not in order]
    how = "desc" if keep == "last" else "asc"
    sort = [f"{o} {how} nulls last" if " " not in o else o for o in order] + [f"{c} asc nulls last" for c in ties]
    rank = f"row_number() over (partition by {', '.join(keys)} order by {', '.join(sort)})"
    present = " and ".join(f"{k} is not null" for k in keys)
    return df.where(present).withColumn(_RANK, F.expr(rank)).where(f"{_RANK} = 1").drop(_RANK)


def flag_repeated(df: DataFrame, key: str, out: str, population: DataFrame | None = None) -> DataFrame:
    """Add a boolean: does more than one row of `df` share this (non-null) `key`?

    `population` may hold the same rows with fewer columns, to count from.
    Counted by a partially aggregated group-by and looked up, not by a window over
    the whole group, so a key shared by a third of the rows is never gathered.
    """
    counted = df if population is None else population
    repeated = counted.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    flagged = lookup(df, repeated.withColumn(out, F.lit(True)), key, [out])
    return flagged.withColumn(out, F.coalesce(out, F.lit(False)))
