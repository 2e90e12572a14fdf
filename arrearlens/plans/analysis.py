"""Executive analyses over the layers."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_of
from ..functions.codes import CRORE, SUCCESS
from ..functions.ratio import count_if, stable_mean, safe_div
from ..operators.calendar import within
from ..operators.drivers import dpd_band
from ..operators.lookup import lookup
from ..operators.stack import stack, stack_sum


def _recovery_rate():
    """Recovered over outstanding, only where something is outstanding."""
    rate = safe_div(F.col("recovered_amount"), F.col("outstanding_amount"))
    return F.when(F.col("outstanding_amount") > 0, rate)


def two_months(monthly: DataFrame, first: date, second: date) -> DataFrame:
    """Payer count against recovery per payer in two months."""
    picked = monthly.where(F.col("month_start").isin(first, second))
    return picked.select("month_start", "payer_accounts", "recovery_per_payer").orderBy("month_start")


def dedup_impact(staged: DataFrame, ledger: DataFrame) -> DataFrame:
    """Success rows and cash that payment deduplication removes."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col("payment_status") == SUCCESS).agg(
            F.count(F.lit(1)).alias(f"{name}_success_rows"), F.sum("amount").alias(f"{name}_cash")
        )

    both = stack([side(staged, "raw"), side(ledger, "dedup")])
    one = both.agg(*[F.sum(c).alias(c) for c in both.columns])
    return one.select(
        "raw_success_rows",
        "dedup_success_rows",
        (F.coalesce("raw_cash", F.lit(0)) - F.coalesce("dedup_cash", F.lit(0))).alias("cash_removed_by_dedup"),
        (F.col("raw_success_rows") - F.col("dedup_success_rows")).alias("success_rows_removed"),
    )


def selection_bias(enriched: DataFrame) -> DataFrame:
    """Ever-targeted against never-targeted accounts, by month."""
    return (
        enriched.withColumn("__rate", _recovery_rate())
        .groupBy("ever_targeted_flag", "month_start")
        .agg(
            F.count(F.lit(1)).alias("accounts"),
            safe_div(F.sum("recovered_amount"), F.count(F.lit(1))).alias("recovery_per_account"),
            safe_div(F.sum(F.col("payer_flag").cast("long")), F.count(F.lit(1))).alias("payer_rate"),
            stable_mean(F.col("__rate")).alias("recovery_rate_proxy"),
        )
        .orderBy("month_start", "ever_targeted_flag")
    )


def dpd_strata(account_months: DataFrame, banded: bool = False) -> DataFrame:
    """Recovery by month and days past due, raw or banded."""
    stratum = dpd_band().alias("dpd_band") if banded else F.col("dpd")
    return (
        account_months.withColumn("__rate", _recovery_rate())
        .groupBy("month_start", stratum)
        .agg(
            F.count(F.lit(1)).alias("accounts"),
            F.sum("recovered_amount").alias("recovery"),
            stable_mean(F.col("__rate")).alias("recovery_rate"),
        )
        .orderBy("month_start", F.asc_nulls_last("dpd_band" if banded else "dpd"))
    )


def cohort_tenure(enriched: DataFrame, months: int = 5) -> DataFrame:
    """First-target month cohorts over the months 0..n since their first target."""
    inside = F.col("first_target_date").isNotNull() & F.col("months_since_first_target").between(0, months)
    return (
        enriched.where(inside)
        .groupBy(month_of(F.col("first_target_date")).alias("target_cohort_month"), "months_since_first_target")
        .agg(
            F.count(F.lit(1)).alias("accounts"),
            safe_div(F.sum("recovered_amount"), F.count(F.lit(1))).alias("recovery_per_account"),
            safe_div(F.sum(F.col("payer_flag").cast("long")), F.count(F.lit(1))).alias("payer_rate"),
        )
        .orderBy("target_cohort_month", "months_since_first_target")
    )


def denominator_check(account_months: DataFrame) -> DataFrame:
    """Population and payers per month. The population only grows: accounts enter by
    opening date and no source says when one leaves."""
    return (
        account_months.groupBy("month_start")
        .agg(
            F.count(F.lit(1)).alias("n"),
            # No payer at all is unknown, as in an outer join to payers.
            F.sum(F.when(F.col("recovered_amount") > 0, F.lit(1).cast("long"))).alias("paid_accounts"),
        )
        .withColumn("payer_rate", safe_div(F.col("paid_accounts"), F.col("n")))
        .orderBy("month_start")
    )


def call_hour_contact(call_hours: DataFrame) -> DataFrame:
    """Answered share by month and local hour."""
    return (
        call_hours.groupBy("month_start", "local_hour")
        .agg(F.sum("calls").alias("calls"), F.sum("answered_calls").alias("answered"))
        .withColumn("contact_rate", safe_div(F.col("answered"), F.col("calls")))
        .orderBy("month_start", "local_hour")
    )


def agent_tenure(
    calls: DataFrame, identity: DataFrame, agents: DataFrame, account_months: DataFrame, start: date, end: date
) -> DataFrame:
    """Recovery per handled hour by tenure of the employee at the month.

    `agents` is one row per agent id. An account-month's recovery counts once per
    employee who called it, however many calls that took. Tenure is in 30-day months
    since the employee's earliest joining month; months before joining are left out.
    """
    month = month_of(F.col("event_at_utc"))
    handled = (
        lookup(calls, agents, "agent_id", ["employee_code"])
        .where(F.col("employee_code").isNotNull() & month.between(F.lit(start), F.lit(end)))
        .groupBy("employee_code", "account_id", month.alias("month_start"))
        .agg(F.sum(F.col("duration_sec").cast("long")).alias("seconds"))
    )
    cash = account_months.select("account_id", "month_start", "recovered_amount")
    perf = (
        handled.join(cash, ["account_id", "month_start"], "left")
        .groupBy("employee_code", "month_start")
        .agg(F.sum("seconds").alias("seconds"), F.sum("recovered_amount").alias("recovery"))
    )
    joined_at = identity.groupBy("employee_code").agg(F.min("joined_at").alias("joined_at"))
    tenure = F.datediff(F.col("month_start"), month_of(F.col("joined_at"))) / 30.0
    bands = (
        F.when(tenure.isNull(), "unknown")
        .when(tenure < 3, "<3m")
        .when(tenure < 6, "3-6m")
        .when(tenure < 12, "6-12m")
        .otherwise("12m+")
    )
    return (
        perf.join(joined_at, "employee_code")
        .where(tenure.isNull() | (tenure >= 0))
        .groupBy(bands.alias("tenure_band"))
        .agg(F.sum("recovery").alias("recovery"), (F.sum("seconds") / 3600.0).alias("handled_hours"))
        .withColumn("recovery_per_agent_hour", safe_div(F.col("recovery"), F.col("handled_hours")))
        .orderBy("tenure_band")
    )


def vendor_stability(calls: DataFrame, vendors: DataFrame, dispositions: DataFrame) -> DataFrame:
    """Calls and dispositions by vendor and month.

    Dispositions are counted per call first, so a call with several of them is still
    one call, and vendor names join the finished months-by-vendors table.
    """
    per_call = dispositions.where("call_id is not null").groupBy("call_id").agg(F.count(F.lit(1)).alias("d"))
    answered = F.col("call_status") == "ANSWERED"
    grouped = (
        calls.join(per_call, "call_id", "left")
        .groupBy(month_of(F.col("event_at_utc")).alias("month_start"), "vendor_id")
        .agg(
            F.count(F.lit(1)).alias("calls"),
            F.sum(count_if(answered)).alias("answered"),
            F.coalesce(F.sum("d"), F.lit(0)).alias("dispositions"),
            F.coalesce(F.sum(F.when(answered, F.col("d"))), F.lit(0)).alias("answered_dispositions"),
        )
    )
    columns = ["month_start", "vendor_id", "vendor_name", "calls", "answered", "dispositions", "answered_dispositions"]
    named = grouped.join(vendors.select("vendor_id", "vendor_name"), "vendor_id", "left")
    return named.select(*columns).orderBy(F.asc_nulls_last("month_start"), F.asc_nulls_last("vendor_id"))


def targeted_vs_never(
    accounts: DataFrame, targeting: DataFrame, payments: DataFrame, first_day: date, end: date
) -> DataFrame:
    """Accounts, cash and current outstanding of ever- and never-targeted accounts in
    the period [first_day, end)."""
    inside = within(payments, "event_at", (first_day, end - timedelta(days=1)))
    one = F.lit(1)
    per_account = stack_sum(
        ["account_id"],
        [
            accounts.select("account_id", "outstanding_amount", one.alias("known")),
            targeting.select("account_id", one.alias("targeted")),
            inside.select("account_id", "amount"),
        ],
        maxes=["known", "targeted"],
    )
    group = F.when(F.col("targeted") == 1, "ever_targeted").otherwise("never_targeted")
    return (
        per_account.where("known = 1")
        .groupBy(group.alias("group"))
        .agg(
            F.count(F.lit(1)).alias("accounts"),
            F.coalesce(F.sum("amount"), F.lit(0)).alias("__cash"),
            F.sum("outstanding_amount").alias("current_outstanding_proxy"),
        )
        .select(
            "group",
            "accounts",
            (F.col("__cash").cast("double") / CRORE).alias("recovery_cr"),
            "current_outstanding_proxy",
            safe_div(F.col("__cash"), F.col("current_outstanding_proxy")).alias("recovery_yield_proxy"),
        )
    )
