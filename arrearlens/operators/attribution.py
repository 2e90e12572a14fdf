"""Recovery around targeting events, without pairing targets and payments.

Payments and targets are first reduced to account-days. An account then holds at
most one payment row and a few target rows per calendar day, so laying both on one
day axis and summing over a day range costs days, not targets times payments, and
an account owning a third of all events is no heavier than its calendar.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import day_number, month_of
from ..functions.codes import CRORE, SENSITIVITY_DAYS
from ..functions.ratio import count_if, safe_div
from .stack import stack


def _account_days(targets: DataFrame, payments: DataFrame, labels: Sequence[str], target_at: str, paid_at: str) -> DataFrame:
    """(account_id, day, *labels, is_target, paid, payments, targets), one exchange for both sources."""
    paid = payments.select(
        "account_id",
        F.col(paid_at).cast("date").alias("day"),
        F.col("amount").alias("paid"),
        F.lit(1).cast("long").alias("payments"),
    )
    marks = targets.select(
        "account_id",
        F.col(target_at).cast("date").alias("day"),
        *labels,
        F.lit(1).cast("long").alias("targets"),
        F.lit(True).alias("is_target"),
    )
    both = stack([marks, paid]).where(F.col("account_id").isNotNull() & F.col("day").isNotNull())
    return both.groupBy("account_id", "day", *labels, "is_target").agg(
        F.sum("paid").alias("paid"), F.sum("payments").alias("payments"), F.sum("targets").alias("targets")
    )


def _day_axis():
    return Window.partitionBy("account_id").orderBy(day_number(F.col("day")))


def window_recovery(
    targets: DataFrame,
    payments: DataFrame,
    days: Sequence[int],
    labels: Sequence[str] = (),
    target_at: str = "target_date",
    paid_at: str = "event_at",
) -> DataFrame:
    """Per distinct (account, target day, labels): cash received from the target day to
    n days later, both ends included, as `r{n}` for each n; null without any payment."""
    axis = _day_axis()
    rows = _account_days(targets, payments, labels, target_at, paid_at)
    sums = [F.sum("paid").over(axis.rangeBetween(0, n)).alias(f"r{n}") for n in days]
    return (
        rows.select("account_id", F.col("day").alias(target_at), *labels, "is_target", "day", *sums)
        .where("is_target")
        .drop("is_target", "day")
    )


def first_targets(targeting: DataFrame) -> DataFrame:
    """First-ever target date per account."""
    return targeting.where(F.col("account_id").isNotNull()).groupBy("account_id").agg(F.min("target_date").alias("first_target_date"))


def window_sensitivity(
    targeting: DataFrame, payments: DataFrame, days: Sequence[int] = SENSITIVITY_DAYS
) -> DataFrame:
    """Recovery within n days of each account's first target, by month of that target."""
    first = first_targets(targeting).withColumnRenamed("first_target_date", "target_date")
    per_account = window_recovery(first, payments, days)
    return per_account.groupBy(month_of(F.col("target_date")).alias("month_start")).agg(
        *[F.sum(f"r{n}").alias(f"r{n}") for n in days]
    ).orderBy("month_start")


def channel_conversion(targeting: DataFrame, payments: DataFrame, days: int = 14) -> DataFrame:
    """Per channel: distinct target records, how many were followed by cash, and how much.

    Targets without an account or a date are records too; no payment can follow them.

    `recovery_per_target` averages over targets followed by a payment (the published
    metric ignores targets without one); `recovery_per_target_all` divides by all.
    """
    hit = window_recovery(targeting, payments, [days], ["recommended_channel"]).withColumnRenamed(f"r{days}", "recovered")
    unmatched = targeting.where("account_id is null or target_date is null")
    hit = stack([hit, unmatched.select("account_id", "target_date", "recommended_channel").distinct()])
    per_channel = hit.groupBy("recommended_channel").agg(
        F.count(F.lit(1)).alias("target_records"),
        F.sum(count_if(F.col("recovered") > 0)).alias("converting_target_records"),
        F.sum("recovered").alias(f"recovery_{days}d"),
        F.count("recovered").alias("__paying"),
    )
    total = F.col(f"recovery_{days}d")
    return per_channel.select(
        "recommended_channel",
        "target_records",
        "converting_target_records",
        total,
        safe_div(total, F.col("__paying")).alias("recovery_per_target"),
        safe_div(F.coalesce(total, F.lit(0)), F.col("target_records")).alias("recovery_per_target_all"),
        safe_div(F.col("converting_target_records"), F.col("target_records")).alias(f"conversion_rate_{days}d"),
    )


def channel_yield(targeting: DataFrame, payments: DataFrame, accounts: DataFrame, days: int = 14) -> DataFrame:
    """Per channel: targeted accounts, cash within `days` after any of the channel's targets
    (each payment once per channel), outstanding of those accounts, and their ratio.

    Targets without an account count neither as accounts nor as exposure.
    """
    axis = _day_axis().rangeBetween(-days, 0)
    rows = _account_days(targeting, payments, ["recommended_channel"], "target_date", "event_at")
    # The set is bounded by the number of channels.
    touched = rows.select("is_target", "paid", F.collect_set("recommended_channel").over(axis).alias("channels"))
    recovery = (
        touched.where("is_target is null")
        .select("paid", F.explode("channels").alias("channel"))
        .groupBy("channel")
        .agg(F.sum("paid").alias("recovery"))
    )
    pairs = (
        targeting.where("account_id is not null and recommended_channel is not null")
        .select("account_id", F.col("recommended_channel").alias("channel"))
        .distinct()
    )
    exposure = (
        pairs.join(accounts.select("account_id", "outstanding_amount"), "account_id", "left")
        .groupBy("channel")
        .agg(F.count(F.lit(1)).alias("accounts"), F.sum("outstanding_amount").alias("exposure"))
    )
    joined = exposure.join(recovery, "channel", "left").withColumn("recovery", F.coalesce("recovery", F.lit(0)))
    return joined.select(
        "channel",
        "accounts",
        "recovery",
        "exposure",
        (F.col("recovery").cast("double") / CRORE).alias("recovery_cr"),
        safe_div(F.col("recovery"), F.col("exposure")).alias(f"yield{days}"),
    )


def touch_kinds(kinds: Mapping[str, tuple[DataFrame, str, int]], payments: DataFrame, paid_at: str = "event_at") -> DataFrame:
    """Payments by how many candidate touches of any kind they had: none, one, or several.

    `kinds` maps a name to (events, time column, days): a touch counts from its day to that many days
    later. All kinds lie on one day axis with the payments, each counted over a range of its own in the
    same sweep. `after_<kind>` counts payments with at least one touch of that kind.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    frames = [
        df.select("account_id", F.col(at).cast("date").alias("day"), *[(one if k == kind else none).alias(k) for k in kinds]) for kind, (df, at, _) in kinds.items()
    ]
    frames.append(payments.select("account_id", F.col(paid_at).cast("date").alias("day"), F.col("amount").alias("paid"), one.alias("payments")))
    both = stack(frames).where(F.col("account_id").isNotNull() & F.col("day").isNotNull())
    days = both.groupBy("account_id", "day").agg(F.sum("paid").alias("paid"), F.sum("payments").alias("payments"), *[F.sum(k).alias(k) for k in kinds])
    axis = _day_axis()
    seen = {k: F.coalesce(F.sum(k).over(axis.rangeBetween(-n, 0)), F.lit(0)).alias(k) for k, (_, _, n) in kinds.items()}
    counted = days.select("paid", "payments", *seen.values()).where("payments is not null")
    n = sum((F.col(k) for k in kinds), F.lit(0))
    return counted.groupBy(F.when(n == 0, "0").when(n == 1, "1").otherwise("many").alias("candidate_touches")).agg(
        F.sum("payments").alias("payments"),
        F.sum("paid").alias("amount"),
        *[F.sum(F.when(F.col(k) > 0, F.col("payments")).otherwise(0)).alias(f"after_{k}") for k in kinds],
    )


def touch_multiplicity(touches: DataFrame, payments: DataFrame, days: int = 14) -> DataFrame:
    """How many payments had no, one, or several candidate touches in the prior `days`."""
    axis = _day_axis().rangeBetween(-days, 0)
    rows = _account_days(touches, payments, [], "target_date", "event_at")
    counted = rows.select("is_target", "paid", "payments", F.coalesce(F.sum("targets").over(axis), F.lit(0)).alias("n"))
    bucket = F.when(F.col("n") == 0, "0").when(F.col("n") == 1, "1").otherwise("many")
    return (
        counted.where("is_target is null")
        .groupBy(bucket.alias("candidate_touches"))
        .agg(F.sum("payments").alias("payments"), F.sum("paid").alias("amount"))
    )
