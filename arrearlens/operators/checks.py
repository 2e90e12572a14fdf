"""One pass for many checks.

Each table is scanned once. A row becomes one observation for each check family it matters to: a family,
a key, a value, and what is counted. Two aggregations that can be merged in any order follow, both partial
before their exchange: by (family, key, value), then by (family, key). So however many checks there are,
and whatever their keys, there are two exchanges of observations, and a hot key costs a few rows a task.
A third aggregation leaves one row of counters for each family, and the last brings these few rows together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ratio import count_if
from .stack import stack

#: What an observation may hold besides family and key.
#: value: what a key's rows may differ in; part: which of several values this is; rows, hits: counted; cash:
#: added up; own: the value is the key's own.
_FIELDS = {"value": "string", "rows": "bigint", "hits": "bigint", "cash": "decimal(38,2)", "part": "int", "own": "boolean"}
#: Parts of a key that a family may tell apart.
_PARTS = 4


def observation(family: str, key: Column | None = None, when: Column | None = None, **fields: Column) -> dict[str, Column]:
    """One row's part in a family, column by column; without a family where `when` does not hold."""
    unknown = set(fields) - set(_FIELDS)
    if unknown:
        raise ValueError(f"an observation has no field {sorted(unknown)}")
    name = F.lit(family) if when is None else F.when(when, F.lit(family))
    out = {"family": name, "key": (F.lit(None) if key is None else key).cast("string")}
    return out | {n: fields.get(n, F.lit(None)).cast(kind) for n, kind in _FIELDS.items()}


def observe(df: DataFrame, observations: Sequence[Mapping[str, Column]]) -> DataFrame:
    """All observations of a table, from one scan."""
    values = [c for o in observations for c in o.values()]
    return df.select(F.stack(F.lit(len(observations)), *values).alias(*observations[0])).where("family is not null")


def counters(frames: Sequence[DataFrame]) -> DataFrame:
    """One row for each family: what its keys amount to."""
    per_value = stack(frames).groupBy("family", "key", "value", "part").agg(
        F.sum("rows").alias("rows"), F.sum("hits").alias("hits"), F.sum("cash").alias("cash"), F.max("own").alias("own")
    )
    valued = F.col("value").isNotNull()
    per_key = per_value.groupBy("family", "key").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.sum("hits").alias("hits"),
        F.sum("cash").alias("cash"),
        # One row for each different value of a part by now.
        F.greatest(*[F.count_if(valued & F.col("part").eqNullSafe(F.lit(k))) for k in (None, *range(_PARTS))]).alias("most"),
        F.max("own").alias("known"),
        F.sum(F.when(F.col("own").isNull(), F.col("rows"))).alias("others"),
    )
    keyed, known, several = F.col("key").isNotNull(), F.coalesce("known", F.lit(False)), F.col("rows") > 1
    return per_key.groupBy("family").agg(
        F.sum("rows").alias("rows"),
        F.sum("hits").alias("hits"),
        F.sum("cash").alias("cash"),
        F.sum(count_if(keyed)).alias("keys"),
        F.sum(count_if(keyed & several)).alias("repeated"),
        F.sum(count_if(keyed & several & (F.col("most") > 1))).alias("conflicting"),
        F.sum(count_if(keyed & (F.col("most") > 1))).alias("unstable"),
        F.sum(count_if(known)).alias("known"),
        F.sum(F.when(known, F.col("rows"))).alias("known_rows"),
        F.sum(F.when(known, F.col("others"))).alias("known_others"),
    )


def gathered(frames: Sequence[DataFrame]) -> DataFrame:
    """One row with a map from family to its counters; empty sources give an empty map."""
    per_family = counters(frames)
    names = [c for c in per_family.columns if c != "family"]
    return per_family.agg(F.map_from_entries(F.collect_list(F.struct("family", F.struct(*names)))).alias("found"))


def number(family: str, counter: str) -> Column:
    """A counter of a family, zero where nothing was observed."""
    return F.coalesce(F.col("found")[family][counter], F.lit(0))


def rows_of(one: DataFrame, rows: Sequence[Mapping[str, Column]], present: Sequence[Column | None]) -> DataFrame:
    """The one row of counters as report rows; a row whose condition fails is left out."""
    structs = []
    for row, condition in zip(rows, present, strict=True):
        struct = F.struct(*[c.alias(n) for n, c in row.items()])
        structs.append(struct if condition is None else F.when(condition, struct))
    return one.select(F.explode(F.filter(F.array(*structs), lambda r: r.isNotNull())).alias("r")).select("r.*")
