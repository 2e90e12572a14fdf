"""Business identity over technical ids, and identity over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import day_number
from .dedup import latest_per_key
from .lookup import lookup
from .stack import stack


def canonical_id(df: DataFrame, id_col: str, business_key: str, order: Sequence[str], out: str) -> DataFrame:
    """Add `out`: the id of the latest row sharing the business key.

    Rows without a business key share one canonical id among themselves, as rows of
    one (missing) key. The winner per key is found by rank limit and looked up.
    """
    probe = "__business_key"
    # A leading marker keeps "missing" apart from every real key.
    key = F.when(F.col(business_key).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(business_key)))
    keyed = df.withColumn(probe, key)
    # Rows without an id cannot name anyone.
    candidates = keyed.where(F.col(id_col).isNotNull()).select(
        probe, F.col(id_col).alias(out), *[c for c in df.columns if c not in (probe, out)]
    )
    winner = latest_per_key(candidates, probe, [*order, f"{out} asc nulls last"], ties=())
    return lookup(keyed, winner, probe, [out]).drop(probe)


def effective_dated(
    df: DataFrame, id_col: str, at: str, attributes: Sequence[str], ties: Sequence[str] | None = None
) -> DataFrame:
    """Effective-dated versions: one row per id and time of change, valid [valid_from, valid_to)."""
    dated = df.where(F.col(id_col).isNotNull() & F.col(at).isNotNull()).select(
        id_col, *attributes, F.col(at).alias("valid_from")
    )
    versions = latest_per_key(dated, [id_col, "valid_from"], [], ties=ties)
    w = Window.partitionBy(id_col).orderBy("valid_from")
    return versions.select(id_col, *attributes, "valid_from", F.lead("valid_from").over(w).alias("valid_to"))


def as_of(
    events: DataFrame,
    versions: DataFrame,
    key: str,
    event_at: str,
    version_at: str,
    attributes: Sequence[str],
) -> DataFrame:
    """Attach the attributes known at each event's own time.

    Events are reduced to the distinct (key, day) pairs they need. What was known when
    a day began is the last version of an earlier day, carried forward over one row per
    key and day; the day's own versions travel along in order, and the event's time
    picks among them. So a key holds at most one row per calendar day in the window,
    and the events themselves are only looked up by (key, day).
    """
    wanted = (
        events.where(F.col(key).isNotNull() & F.col(event_at).isNotNull())
        .select(key, day_number(F.col(event_at)).alias("__day"))
        .distinct()
    )
    known = effective_dated(versions, key, version_at, attributes).select(
        key,
        day_number(F.col("valid_from")).alias("__day"),
        F.struct(F.col("valid_from").alias("known_since"), *attributes).alias("__version"),
    )
    # In order of time: known_since comes first in the struct and is unique per key.
    daily = known.groupBy(key, "__day").agg(F.sort_array(F.collect_list("__version")).alias("__today"))
    before = Window.partitionBy(key).orderBy("__day").rangeBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy(key, "__day")
    rows = stack([wanted.withColumn("__wanted", F.lit(True)), daily])
    carried = (
        rows.withColumn("__earlier", F.last(F.element_at("__today", -1), ignorenulls=True).over(before))
        .withColumn("__today", F.first("__today", ignorenulls=True).over(same))
        .where(F.col("__wanted"))
        .select(key, "__day", "__earlier", "__today")
    )
    dated = events.withColumn("__day", day_number(F.col(event_at)))
    met = lookup(dated, carried, [key, "__day"], ["__earlier", "__today"])
    until = F.filter("__today", lambda v: v["known_since"] <= F.col(event_at))
    version = F.coalesce(F.try_element_at(until, F.lit(-1)), F.col("__earlier"))
    names = ["known_since", *attributes]
    return met.withColumn("__version", version).select(*events.columns, *[F.col(f"__version.{n}").alias(n) for n in names])
