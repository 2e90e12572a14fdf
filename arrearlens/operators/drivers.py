"""Driver tables, mix decomposition and within-stratum direction checks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import month_end, month_of, months_apart
from ..functions.codes import DPD_EDGES, DPD_LABELS
from ..functions.ratio import band, count_if, safe_div
from .calendar import within
from .dedup import latest_per_key
from .stack import stack


def recovery_by_account(payments: DataFrame, by_month: bool = False) -> DataFrame:
    """Cash per account (and month): the pre-aggregation every driver table starts from."""
    keys = ["account_id", "month_start"] if by_month else ["account_id"]
    return (
        payments.where(F.col("account_id").isNotNull())
        .withColumn("month_start", month_of(F.col("event_at")))
        .groupBy(*keys)
        .agg(F.sum("amount").alias("recovery"))
    )


def dpd_band(column: str = "dpd"):
    return band(F.col(column), DPD_EDGES, DPD_LABELS)


def driver_table(
    payments: DataFrame, attributes: DataFrame, dim: str, top: int | None = 8, labels: Sequence[str] = ()
) -> DataFrame:
    """Recovery, payers and recovery per payer by one account attribute, best first.

    Payments shrink to one row per account before they meet the attributes (unique on
    account_id), so a payer is a row and needs no distinct count. `labels` lists the
    values that appear even without payers. Accounts without the attribute are left out.
    """
    paid = recovery_by_account(payments).join(attributes.select("account_id", dim), "account_id", "inner")
    grouped = (
        paid.where(F.col(dim).isNotNull())
        .groupBy(dim)
        .agg(F.sum("recovery").alias("recovery"), F.count(F.lit(1)).alias("payers"))
    )
    if labels:
        # Empty bands: add a zero row per label and add up again.
        spark = payments.sparkSession
        empty = spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in labels])).alias(dim))
        grouped = (
            stack([grouped, empty])
            .groupBy(dim)
            .agg(F.coalesce(F.sum("recovery"), F.lit(0)).alias("recovery"), F.coalesce(F.sum("payers"), F.lit(0)).alias("payers"))
        )
    out = grouped.withColumn("recovery_per_payer", safe_div(F.col("recovery"), F.col("payers")))
    if top is not None:
        out = out.orderBy(F.desc_nulls_last("recovery_per_payer"), F.asc_nulls_last(dim)).limit(top)
    return out


def modal_value(df: DataFrame, column: str, out: str, account: str = "account_id") -> DataFrame:
    """Most frequent non-null value per account (the smaller value on a tie)."""
    counts = (
        df.where(F.col(account).isNotNull() & F.col(column).isNotNull())
        .groupBy(F.col(account).alias("account_id"), F.col(column).alias(out))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    return latest_per_key(counts, "account_id", ["__n", f"{out} asc"]).drop("__n")


def event_count_band(df: DataFrame, edges: Sequence[int], labels: Sequence[str], out: str) -> DataFrame:
    """Number of events per account, banded."""
    counts = df.where(F.col("account_id").isNotNull()).groupBy("account_id").agg(F.count(F.lit(1)).alias("__n"))
    return counts.select("account_id", band(F.col("__n"), edges, labels).alias(out))


def _stratum_periods(
    payments: DataFrame, attributes: DataFrame, dimensions: Sequence[str], before: date, after: date
) -> DataFrame:
    """Per dimension and stratum: payers and recovery in the two months, as n0/n1 and v0/v1.

    All dimensions share one pass over the payments; an account is a row in each of them.
    """
    inside = within(payments, "event_at", (before, month_end(before)), (after, month_end(after)))
    paid = recovery_by_account(inside, by_month=True).join(
        attributes.select("account_id", *dimensions), "account_id", "inner"
    )
    of = [F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("stratum")) for d in dimensions]
    is0, is1 = F.col("month_start") == F.lit(before), F.col("month_start") == F.lit(after)
    return (
        paid.select("month_start", "recovery", F.inline(F.array(*of)))
        .where(F.col("stratum").isNotNull())
        .groupBy("dimension", "stratum")
        .agg(
            F.sum(count_if(is0)).alias("n0"),
            F.sum(count_if(is1)).alias("n1"),
            F.coalesce(F.sum(F.when(is0, F.col("recovery"))), F.lit(0)).cast("double").alias("v0"),
            F.coalesce(F.sum(F.when(is1, F.col("recovery"))), F.lit(0)).cast("double").alias("v1"),
        )
    )


def _all_strata():
    """Totals over strata: the input is one row per stratum label."""
    return Window.partitionBy("dimension")


def mix_decomposition(
    payments: DataFrame, attributes: DataFrame, stratum: str, before: date, after: date
) -> DataFrame:
    """Split the change in recovery per payer into mix and rate effects per stratum.

    mix = (w1 - w0) * r0 and rate = w1 * (r1 - r0), with w the stratum's share of
    payers and r its recovery per payer; the effects add up to the total change. A
    stratum without payers in a period has rate zero there.
    """
    rows = _stratum_periods(payments, attributes, [stratum], before, after)
    w0 = safe_div(F.col("n0"), F.sum("n0").over(_all_strata()))
    w1 = safe_div(F.col("n1"), F.sum("n1").over(_all_strata()))
    r0 = F.coalesce(safe_div(F.col("v0"), F.col("n0")), F.lit(0.0))
    r1 = F.coalesce(safe_div(F.col("v1"), F.col("n1")), F.lit(0.0))
    return rows.select(
        "stratum",
        F.col("n0").alias("payers_before"),
        F.col("n1").alias("payers_after"),
        w0.alias("share_before"),
        w1.alias("share_after"),
        r0.alias("rate_before"),
        r1.alias("rate_after"),
    ).select(
        "*",
        ((F.col("share_after") - F.col("share_before")) * F.col("rate_before")).alias("mix_effect"),
        (F.col("share_after") * (F.col("rate_after") - F.col("rate_before"))).alias("rate_effect"),
    )


def simpson_check(
    payments: DataFrame, attributes: DataFrame, strata: Sequence[str], before: date, after: date
) -> DataFrame:
    """Per dimension: overall direction of recovery per payer, and how many strata oppose it.

    Only strata with payers in both months have a direction.
    """
    total = {c: F.sum(c).over(_all_strata()) for c in ("v0", "v1", "n0", "n1")}
    rows = _stratum_periods(payments, attributes, strata, before, after).select(
        "dimension",
        F.signum(safe_div(F.col("v1"), F.col("n1")) - safe_div(F.col("v0"), F.col("n0"))).alias("sign"),
        F.signum(safe_div(total["v1"], total["n1"]) - safe_div(total["v0"], total["n0"])).alias("overall"),
    )
    counted = rows.groupBy("dimension", "overall").agg(
        F.count("sign").alias("strata"), F.sum(count_if(F.col("sign") * F.col("overall") < 0)).alias("opposing_strata")
    )
    return counted.select(
        "dimension",
        F.col("overall").cast("int").alias("overall_direction"),
        "strata",
        "opposing_strata",
        safe_div(F.col("opposing_strata"), F.col("strata")).alias("opposing_share"),
    )


# Account age in months at the observed month, right-closed bands.
AGE_EDGES = (-1, 3, 6, 12, 24, None)
AGE_LABELS = ("0-3m", "4-6m", "7-12m", "13-24m", "25m+")


def age_cohort(account_months: DataFrame) -> DataFrame:
    """Account-age band by month: accounts, payers, recovery and the two rates."""
    age = months_apart(F.col("month_start"), F.col("opened_at").cast("date"))
    return (
        account_months.groupBy(band(age, AGE_EDGES, AGE_LABELS).alias("age_band"), "month_start")
        .agg(
            F.count(F.lit(1)).alias("accounts"),
            F.sum(count_if(F.col("recovered_amount") > 0)).alias("payers"),
            F.sum("recovered_amount").alias("recovery"),
        )
        .select(
            "*",
            safe_div(F.col("payers"), F.col("accounts")).alias("payer_rate"),
            safe_div(F.col("recovery"), F.col("accounts")).alias("recovery_per_account"),
        )
    )
