"""Stratified experiment assignment and its read-out."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import on_days
from ..functions.ratio import count_if, safe_div
from .calendar import within
from .stack import stack_sum

_STRATUM_JOIN = "|"
# Leading hex digits of the draw: 16^3 slices per stratum.
_SLICE_DIGITS = 3


def stratified_assign(
    accounts: DataFrame,
    strata: Sequence[str],
    seed: str,
    treatment_share: float = 0.5,
    waves: int = 4,
) -> DataFrame:
    """Randomise accounts within strata: exact shares, reproducible from the seed.

    Each account draws md5(seed:account). Its exact rank within the stratum is the
    number of accounts in lower slices of the draw plus its rank inside the slice,
    so a stratum holding a third of all accounts is ranked by thousands of groups
    instead of one. `arm` serves a treatment/holdout test and `wave` a stepped-wedge
    rollout.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("account_id")).cast("binary"))
    # Unambiguous: the separator and the escape are escaped inside labels, and no label escapes to \\N.
    escaped = [F.replace(F.replace(F.col(s).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")) for s in strata]
    stratum = F.concat_ws(_STRATUM_JOIN, *[F.coalesce(e, F.lit("\\N")) for e in escaped])
    drawn = accounts.where(F.col("account_id").isNotNull()).select(
        "account_id", stratum.alias("stratum"), draw.alias("draw")
    )
    drawn = drawn.withColumn("slice", F.substring("draw", 1, _SLICE_DIGITS))
    # At most 16^3 rows per stratum.
    sizes = drawn.groupBy("stratum", "slice").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("stratum")
    below = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "stratum",
        "slice",
        F.coalesce(F.sum("n").over(below), F.lit(0)).alias("offset"),
        F.sum("n").over(whole).alias("stratum_size"),
    )
    inside = Window.partitionBy("stratum", "slice").orderBy("draw", "account_id")
    ranked = drawn.withColumn("within", F.row_number().over(inside)).join(offsets, ["stratum", "slice"])
    position = (F.col("offset") + F.col("within")).cast("long")
    treated = F.floor(F.col("stratum_size") * F.lit(treatment_share) + F.lit(0.5))
    return ranked.select(
        "account_id",
        "stratum",
        position.alias("position"),
        F.when(position <= treated, "treatment").otherwise("holdout").alias("arm"),
        (F.floor((position - 1) * F.lit(waves) / F.col("stratum_size")) + 1).cast("int").alias("wave"),
    )


def experiment_readout(
    assignment: DataFrame,
    start: date,
    payments: DataFrame,
    complaints: DataFrame,
    contacts: Sequence[tuple[DataFrame, str]],
    horizons: tuple[int, int] = (14, 30),
) -> DataFrame:
    """Outcomes per arm over the horizons from `start`, per eligible account.

    The start is one date, so the windows are plain range filters; on stored layers
    they prune partitions, on lazy ones they stand above the deduplication. Every
    source is added up per account in a single shuffle.
    """
    short, long = horizons

    def until(n: int):
        return start, start + timedelta(days=n)

    one = F.lit(1).cast("long")
    frames = [
        within(payments, "event_at", until(long)).select(
            "account_id",
            F.when(on_days(F.col("event_at"), *until(short)), F.col("amount")).alias("short_cash"),
            F.col("amount").alias("long_cash"),
        ),
        within(complaints, "event_at", until(long)).select("account_id", one.alias("complaints")),
        *[within(df, at, until(long)).select("account_id", one.alias("contacts")) for df, at in contacts],
    ]
    outcome = stack_sum(["account_id"], frames)
    per_arm = (
        assignment.select("account_id", "arm")
        .join(outcome, "account_id", "left")
        .groupBy("arm")
        .agg(
            F.count(F.lit(1)).alias("eligible_accounts"),
            F.sum(count_if(F.col("long_cash") > 0)).alias("payers"),
            F.coalesce(F.sum("short_cash"), F.lit(0)).alias(f"recovery_{short}d"),
            F.coalesce(F.sum("long_cash"), F.lit(0)).alias(f"recovery_{long}d"),
            F.coalesce(F.sum("complaints"), F.lit(0)).alias("complaints"),
            F.coalesce(F.sum("contacts"), F.lit(0)).alias("contacts"),
        )
    )
    n = F.col("eligible_accounts")
    return per_arm.select(
        "*",
        safe_div(F.col(f"recovery_{short}d"), n).alias(f"recovery_{short}d_per_account"),
        safe_div(F.col(f"recovery_{long}d"), n).alias(f"recovery_{long}d_per_account"),
        safe_div(F.col("payers"), n).alias("payer_rate"),
        safe_div(F.col(f"recovery_{long}d"), F.col("payers")).alias("recovery_per_payer"),
        safe_div(F.col("complaints"), n).alias("complaints_per_account"),
        safe_div(F.col("contacts"), n).alias("contacts_per_account"),
    )
