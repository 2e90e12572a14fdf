"""KPI definitions.

Two definitions of some measures exist side by side and keep separate names:
- right-party contact: `rpc_*` from the standard code RPC on answered calls (gold), and
  RPC-like raw codes on answered calls (`ops_monthly`);
- promise-kept rate: kept over all promises (`monthly_metrics`), and kept over resolved
  promises (`ops_monthly`);
- agent hours: answered call time (`monthly_metrics`), and session time (`ops_monthly`).
Cost per recovered unit and a rate against historical opening balances are not defined:
no source carries costs or past balances.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import MICROS_PER_HOUR, clipped_micros, month_label, month_of
from ..functions.codes import ANSWERED, CRORE, INVESTMENT_COST, LIFTS, RESOLVED_PROMISES, RPC_LIKE
from ..functions.ratio import change_pct, count_if, safe_div
from ..operators.attribution import channel_conversion
from ..operators.lookup import lookup
from ..operators.stack import stack_sum

__all__ = ["channel_conversion", "growth", "monthly_kpis", "monthly_metrics", "ops_monthly", "scenarios"]

#: The measures of gold that `monthly_metrics` reads, by themselves or in a flag.
MEASURES = (
    "recovered_amount",
    "calls",
    "answered_calls",
    "answered_seconds",
    "rpc_events",
    "ptp_count",
    "ptp_kept_count",
)


def monthly_metrics(features: DataFrame) -> DataFrame:
    """Seventeen KPIs per month.

    The input is unique on (account, month), so accounts with a property are counted
    by adding up its 0/1 flag; no distinct set is built.
    """
    f = F.col
    sums = features.groupBy("month_start").agg(
        F.sum("recovered_amount").alias("recovery"),
        F.count(F.lit(1)).alias("accounts_in_population"),
        F.sum(f("payer_flag").cast("long")).alias("payer_accounts"),
        F.sum("outstanding_amount").alias("__outstanding"),
        F.sum(f("attempted_flag").cast("long")).alias("attempted_accounts"),
        F.sum(f("contact_flag").cast("long")).alias("contacted_accounts"),
        F.sum(f("rpc_flag").cast("long")).alias("rpc_accounts"),
        F.sum(f("ptp_flag").cast("long")).alias("ptp_accounts"),
        F.sum("ptp_count").alias("__ptp"),
        F.sum("ptp_kept_count").alias("__kept"),
        F.sum("answered_seconds").alias("__seconds"),
    )
    return sums.select(
        "month_start",
        "recovery",
        "accounts_in_population",
        "payer_accounts",
        safe_div(f("recovery"), f("accounts_in_population")).alias("recovery_per_account"),
        safe_div(f("recovery"), f("payer_accounts")).alias("recovery_per_payer"),
        safe_div(f("recovery"), f("__outstanding")).alias("recovery_rate_proxy"),
        "attempted_accounts",
        "contacted_accounts",
        "rpc_accounts",
        "ptp_accounts",
        safe_div(f("contacted_accounts"), f("attempted_accounts")).alias("contact_rate"),
        safe_div(f("rpc_accounts"), f("contacted_accounts")).alias("rpc_rate"),
        safe_div(f("ptp_accounts"), f("contacted_accounts")).alias("ptp_rate"),
        safe_div(f("__kept"), f("__ptp")).alias("ptp_kept_rate"),
        (f("__seconds") / 3600.0).alias("answered_agent_hours"),
        safe_div(f("recovery"), f("__seconds") / 3600.0).alias("recovery_per_answered_agent_hour"),
    )


def monthly_kpis(payments: DataFrame) -> DataFrame:
    """Recovery, payers, payments and their month-on-month changes from the success ledger."""
    monthly = (
        payments.where(F.col("event_at").isNotNull())
        .groupBy(month_of(F.col("event_at")).alias("month_start"))
        .agg(
            F.sum("amount").alias("recovery"),
            F.countDistinct("account_id").alias("payers"),
            F.count("payment_id").alias("payments"),
        )
    )
    monthly = monthly.select(
        month_label(F.col("month_start")).alias("month"),
        "recovery",
        "payers",
        "payments",
        safe_div(F.col("recovery"), F.col("payers")).alias("recovery_per_payer"),
    )
    return with_changes(monthly)


def with_changes(monthly: DataFrame) -> DataFrame:
    """The three month-on-month percentages over a monthly KPI table."""
    for column, out in (
        ("recovery", "mom_cash_pct"),
        ("payers", "mom_payer_pct"),
        ("recovery_per_payer", "mom_rpp_pct"),
    ):
        monthly = change_pct(monthly, column, "month", out)
    return monthly


def _pick(column: str, month_column: str, month) -> Column:
    return F.max(F.when(F.col(month_column) == F.lit(month), F.col(column)))


def growth(monthly: DataFrame, from_month, to_month, columns: Sequence[str], month_column: str) -> DataFrame:
    """Two months side by side with the relative change of each column (one row)."""
    monthly = monthly.where(F.col(month_column).isin(from_month, to_month))
    picked = monthly.agg(
        *[_pick(c, month_column, m).alias(f"{side}_{c}") for c in columns for side, m in (("from", from_month), ("to", to_month))]
    )
    return picked.select(
        "*", *[(safe_div(F.col(f"to_{c}"), F.col(f"from_{c}")) - 1).alias(f"{c}_growth") for c in columns]
    )


def ops_monthly(
    calls: DataFrame, dispositions: DataFrame, promises: DataFrame, sessions: DataFrame, payments: DataFrame
) -> DataFrame:
    """Operations per month of the calls' local time.

    Distinct accounts are counted as rows of an (account, month) aggregate; all five
    sources then meet as a few rows per month. Months without calls are left out.
    """
    answered = F.col("call_status") == ANSWERED
    month = month_of(F.col("event_at_local")).alias("month_start")
    status = calls.select("call_id", "call_status", month)
    by_account = calls.where("account_id is not null").groupBy("account_id", month).agg(F.max(count_if(answered)).alias("a"))
    reach = by_account.groupBy("month_start").agg(F.count(F.lit(1)).alias("attempted"), F.sum("a").alias("answered"))
    rpc = (
        lookup(
            dispositions.where(F.col("disposition_code_raw").isin(*RPC_LIKE)).select("call_id", "account_id"),
            status,
            "call_id",
            ["call_status", "month_start"],
        )
        .where(answered & F.col("account_id").isNotNull())
        .select("account_id", "month_start")
        .distinct()
        .groupBy("month_start")
        .agg(F.count(F.lit(1)).alias("rpc"))
    )
    resolved = promises.groupBy(month_of(F.col("event_at")).alias("month_start")).agg(
        *[F.sum(count_if(F.col("status") == s)).alias(s.lower()) for s in RESOLVED_PROMISES]
    )
    hours = sessions.groupBy(month_of(F.col("login_at")).alias("month_start")).agg(
        F.sum(clipped_micros(F.col("login_at"), F.col("logout_at"))).alias("micros")
    )
    cash = payments.groupBy(month_of(F.col("event_at")).alias("month_start")).agg(F.sum("amount").alias("recovery"))
    f = F.col
    months = stack_sum(["month_start"], [reach, rpc, resolved, hours, cash])
    out = months.where(f("month_start").isNotNull() & f("attempted").isNotNull()).select(
        month_label(f("month_start")).alias("month"),
        "attempted",
        "answered",
        "rpc",
        safe_div(f("answered"), f("attempted")).alias("contact_rate"),
        safe_div(f("rpc"), f("answered")).alias("rpc_rate"),
        safe_div(f("kept"), f("kept") + f("broken") + f("cancelled")).alias("ptp_kept_rate"),
        (f("micros") / MICROS_PER_HOUR).alias("agent_hours"),
        "recovery",
    )
    return out.withColumn("recovery_per_agent_hour", safe_div(f("recovery"), f("agent_hours")))


def scenarios(
    monthly: DataFrame,
    lifts: Sequence[float] = LIFTS,
    cost: float = INVESTMENT_COST,
    complete_before: date | None = None,
    month_column: str = "month_start",
) -> DataFrame:
    """Incremental recovery per lift on the annualised run rate of the complete months."""
    complete = monthly if complete_before is None else monthly.where(F.col(month_column) < F.lit(complete_before))
    base = complete.agg(safe_div(F.sum("recovery"), F.count("recovery")).alias("m")).select(
        (F.col("m") * 12).alias("annualized_baseline")
    )
    annual = F.col("annualized_baseline")
    spend = F.lit(float(cost))
    rows = base.select(F.explode(F.array(*[F.lit(float(x)) for x in lifts])).alias("lift"), annual)
    rows = rows.withColumn("incremental_recovery", F.col("lift") * annual)
    gain = F.col("incremental_recovery")
    return rows.select(
        "lift",
        annual,
        gain,
        spend.alias("investment_cost"),
        (gain / spend).alias("gross_benefit_cost"),
        ((gain - spend) / spend).alias("net_roi"),
        safe_div(spend, annual).alias("break_even_lift"),
    )


def published_scenarios(kpis: DataFrame, lifts: Sequence[float], cost: float, complete_before: str) -> DataFrame:
    """Scenario table as published: ledger run rate, crore column, net ROI in percent."""
    rows = scenarios(kpis, lifts, cost, complete_before, month_column="month")
    return rows.select(
        "lift",
        "incremental_recovery",
        (F.col("incremental_recovery") / CRORE).alias("incremental_recovery_cr"),
        "gross_benefit_cost",
        ((F.col("gross_benefit_cost") - 1) * 100).alias("net_roi_pct"),
    )


def step_check(kpis: DataFrame, before: str, step: str) -> DataFrame:
    """Does a step in recovery last? Every month from the step on, against the step month
    and the month before it; `sustained` is whether no later month fell below the step."""
    whole = Window.partitionBy(F.lit(1))  # one row per month
    at = lambda m: F.max(F.when(F.col("month") == m, F.col("recovery").cast("double"))).over(whole)
    marked = kpis.select("month", F.col("recovery").cast("double").alias("recovery"), at(before).alias("b"), at(step).alias("s"))
    later = F.when(F.col("month") > step, F.col("recovery"))
    return marked.withColumn("lowest", F.min(later).over(whole)).where(F.col("month") >= step).select(
        "month",
        "recovery",
        ((safe_div(F.col("recovery"), F.col("b")) - 1) * 100).alias("vs_before_pct"),
        ((safe_div(F.col("recovery"), F.col("s")) - 1) * 100).alias("vs_step_pct"),
        F.coalesce(F.col("lowest") >= F.col("s"), F.lit(False)).alias("sustained"),
    )
