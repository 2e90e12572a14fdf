"""Features over gold: flags, ratios, targeting cohorts, calling hours, agent workload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import (
    MICROS_PER_HOUR,
    clipped_micros,
    days_in_month,
    micros_between,
    month_of,
    months_apart,
    to_local,
)
from ..functions.codes import ANSWERED
from ..functions.ratio import count_if, flag, safe_div
from ..operators.lookup import lookup

_RATIOS: dict[str, tuple[str, str]] = {
    "ptp_kept_rate": ("ptp_kept_count", "ptp_count"),
    "contact_rate": ("answered_calls", "calls"),
    "rpc_rate": ("rpc_events", "answered_calls"),
    "ptp_rate": ("ptp_count", "answered_calls"),
    "recovery_rate_proxy": ("recovered_amount", "outstanding_amount"),
    "recovery_per_attempt": ("recovered_amount", "attempts"),
}
_POSITIVE = {
    "payer_flag": ("recovered_amount",),
    "attempted_flag": ("calls",),
    "contact_flag": ("answered_calls",),
    "rpc_flag": ("rpc_events",),
    "ptp_flag": ("ptp_count",),
    "targeted_flag": ("target_events",),
    "field_contact_flag": ("field_visits",),
    "digital_engaged_flag": ("whatsapp_engaged", "sms_engaged"),
}


def build_features(gold: DataFrame) -> DataFrame:
    """Gold plus every feature whose measures are present."""
    have = set(gold.columns)
    # Three ratios read this decimal; its double is made once a row.
    double = "__recovered_amount" if "recovered_amount" in have else None
    number = lambda name: F.col(double if name == "recovered_amount" else name)
    out = {"days_in_month": days_in_month(F.col("month_start"))}
    for name, parts in _POSITIVE.items():
        if have.issuperset(parts):
            out[name] = flag(sum((F.col(p) for p in parts[1:]), F.col(parts[0])) > 0)
    for name, (num, den) in _RATIOS.items():
        if {num, den} <= have:
            out[name] = safe_div(number(num), number(den))
    if {"recovered_amount", "answered_seconds"} <= have:
        out["recovery_per_answered_hour"] = safe_div(number("recovered_amount"), F.col("answered_seconds") / 3600.0)
    if double is None:
        return gold.withColumns(out)
    return gold.withColumn(double, F.col("recovered_amount").cast("double")).withColumns(out).drop(double)


def enrich_cohort(features: DataFrame, cohort: DataFrame) -> DataFrame:
    """Add the account's first target date and where each month lies relative to it.

    `months_since_first_target` is a calendar-month difference, negative before it.
    """
    return cohort_flags(features.join(cohort, "account_id", "left"))


def cohort_flags(joined: DataFrame) -> DataFrame:
    """The same where the account's first target date stands in the row already."""
    first = F.col("first_target_date")
    ever = first.isNotNull()
    if "targeted_flag" in joined.columns:
        ever = ever | (F.col("targeted_flag") == 1)
    return joined.withColumns(
        {
            "ever_targeted_flag": flag(ever),
            "post_first_target_flag": flag(F.col("month_start") >= month_of(first)),
            "months_since_first_target": months_apart(F.col("month_start"), first),
        }
    )


def call_hours(calls: DataFrame) -> DataFrame:
    """Calls by account, UTC month and hour of day in the caller's own zone."""
    local = to_local("event_at_utc", "timezone")
    answered = F.col("call_status") == ANSWERED
    return calls.groupBy(
        "account_id",
        month_of(F.col("event_at_utc")).alias("month_start"),
        F.hour(local).alias("local_hour"),
    ).agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum(count_if(answered)).alias("answered_calls"),
        F.sum(F.when(answered, F.col("duration_sec").cast("long"))).alias("answered_seconds"),
    )


def agent_month(sessions: DataFrame, identity: DataFrame) -> DataFrame:
    """Logged hours and sessions by month, employee, canonical agent and channel.

    `identity` holds one row per agent id. `logged_hours` takes sessions as recorded:
    an open session adds zero and a logout before its login subtracts.
    `clipped_hours` floors each session at zero.
    """
    joined = lookup(sessions, identity, "agent_id", ["employee_code", "canonical_agent_id"])
    login, logout = F.col("login_at"), F.col("logout_at")
    return joined.groupBy(
        month_of(login).alias("month_start"), "employee_code", "canonical_agent_id", "channel"
    ).agg(
        (F.sum(micros_between(login, F.coalesce(logout, login))) / MICROS_PER_HOUR).alias("logged_hours"),
        (F.sum(clipped_micros(login, logout)) / MICROS_PER_HOUR).alias("clipped_hours"),
        # The session table is unique on session_id.
        F.count("session_id").alias("sessions"),
    )
