"""Data-quality report: seventeen checks in one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import MICROS_PER_HOUR, micros_between
from ..functions.codes import ANSWERED, CRORE, RPC_LIKE, SUCCESS
from ..functions.ratio import count_if, safe_div
from ..operators import quality
from ..operators.checks import gathered, number, observation, observe, rows_of
from ..operators.stack import stack
from .book import BORROWER_SOURCES, Book

# Wording of the report (issue, detection method, treatment) per check.
WORDING = {
    "payment_ids": (
        "Duplicate payment IDs",
        "group by payment_id",
        "keep latest row per payment_id; SUCCESS only",
    ),
    "references": (
        "Payment-reference collision",
        "group payment_reference by account_id",
        "never use payment_reference as global payment key",
    ),
    "conflict": (
        "Account-borrower conflict: {source}",
        "join on account_id and compare borrower_id",
        "use account_id spine; quarantine conflicting borrower_id",
    ),
    "agents": (
        "Agent ID instability",
        "group agent_id and count distinct identity fields",
        "do not use agent_id alone historically; create effective-dated identity map",
    ),
    "call_ids": (
        "Duplicate call IDs",
        "group by call_id",
        "dedupe call_id; investigate timestamp conflicts",
    ),
    "contradiction": (
        "Disposition/status contradiction",
        "join dispositions to call status",
        "RPC requires ANSWERED call",
    ),
    "late": (
        "Late-arriving events",
        "compare recorded_at with event_at",
        "watermark + replay/backfill",
    ),
    "zones": (
        "Mixed timezones",
        "inspect source timezone fields",
        "normalize to documented reporting timezone; preserve source timezone",
    ),
    "borrowers": (
        "Borrower master overwrite",
        "count distinct borrower attributes by borrower_id",
        "use point-in-time snapshot where available; do not trust current row as historical",
    ),
    "targets": (
        "Repeated account-date targeting",
        "group account_id,target_date",
        "retain as multiple campaign exposures, not duplicate events",
    ),
}

# How the report names the borrower-conflict sources.
SOURCE_LABELS = {"promises_to_pay": "PTP", "whatsapp_events": "WhatsApp", "sms_events": "SMS"}


def _row(check: str, affected: Column, total: Column, impact: Column, source: str = "") -> dict[str, Column]:
    title, method, treatment = WORDING[check]
    return {
        "issue": F.lit(title.format(source=SOURCE_LABELS.get(source, source))),
        "detection_method": F.lit(method),
        "treatment": F.lit(treatment),
        "affected": affected.cast("long"),
        "total": total.cast("long"),
        "pct": safe_div(affected, total) * 100,
        "business_impact": impact,
    }


def _n(c: Column) -> Column:
    return F.format_number(c, 0)


def _pct(affected: Column, total: Column, digits: int) -> Column:
    return F.format_number(F.coalesce(safe_div(affected, total), F.lit(0.0)) * 100, digits)


def reference_collisions(payments: DataFrame) -> DataFrame:
    return quality.unstable_ids(payments, "payment_reference", ["account_id"])


def unstable_agents(agents: DataFrame) -> DataFrame:
    return quality.unstable_ids(agents, "agent_id", ["employee_code", "vendor_id", "team", "agent_name"])


def contradictions(book: Book) -> DataFrame:
    return quality.status_contradictions(
        book.stg("call_dispositions"),
        book.events("calls", "call_status", keep="first"),
        F.col("disposition_code_raw").isin(*RPC_LIKE),
    )


def mixed_zones(book: Book) -> DataFrame:
    """Distinct zones in calls and accounts, one row."""
    calls = quality.distinct_values(book.stg("calls"), "timezone")
    accounts = quality.distinct_values(book.stg("accounts"), "timezone")
    both = stack(
        [
            calls.select(F.col("affected").alias("call_zones"), F.col("total").alias("rows")),
            accounts.select(F.col("affected").alias("account_zones"), F.col("total").alias("rows")),
        ]
    )
    return both.agg(F.sum("call_zones").alias("call_zones"), F.sum("account_zones").alias("account_zones"), F.sum("rows").alias("rows"))


#: Columns by which an agent id must keep its identity.
_IDENTITY = ("employee_code", "vendor_id", "team", "agent_name")


def _own(book: Book, sources: Sequence[str]) -> DataFrame:
    """Each account's own borrower, for every source that is held against it."""
    borrower = _borrower("borrower_id")
    own = [observation(f"conflict {s}", F.col("account_id"), value=borrower, own=F.lit(True)) for s in sources]
    return observe(book.owners(), own)


def _borrower(column: str) -> Column:
    """A missing borrower is a value like any other here."""
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit(""))


def observations(book: Book) -> list[DataFrame]:
    """What each staged table has to say to the checks, from one scan of it.

    What is known only after deduplication is observed there: owners, cash that is kept, dispositions by call."""
    one, c = F.lit(1), F.col

    def conflict(source: str) -> dict[str, Column]:
        return observation(f"conflict {source}", c("account_id"), value=_borrower("borrower_id_raw"), rows=one, when=c("account_id").isNotNull())

    paid = c("payment_status") == SUCCESS
    of_table = {
        "payments": [
            observation("payment", c("payment_id"), rows=one, cash=F.when(paid, c("amount"))),
            observation("reference", c("payment_reference"), value=c("account_id"), rows=one, when=c("payment_reference").isNotNull()),
        ],
        "calls": [
            observation("call", c("call_id"), value=c("event_at_local"), rows=one, when=c("call_id").isNotNull()),
            observation("call zone", c("timezone"), rows=one),
        ],
        "agents": [observation("agent", c("agent_id"), value=c(name), part=F.lit(k), rows=one, when=c("agent_id").isNotNull()) for k, name in enumerate(_IDENTITY)],
        "accounts": [observation("account zone", c("timezone"), rows=one)],
        "account_status_history": [observation("late", rows=one, hits=count_if(micros_between(c("event_at"), c("recorded_at")) > int(24 * MICROS_PER_HOUR)))],
        "borrowers": [observation("borrower", c("borrower_id"), value=c("phone"), rows=one, when=c("borrower_id").isNotNull())],
        "daily_targeting": [
            observation("target", F.to_json(F.struct("account_id", "target_date")), rows=one, when=c("account_id").isNotNull() & c("target_date").isNotNull())
        ],
    }
    for source in BORROWER_SOURCES:
        of_table.setdefault(source, []).append(conflict(source))
    frames = [observe(book.stg(t), found) for t, found in of_table.items()]
    kept = observe(book.payments(), [observation("kept", cash=c("amount"))])
    calls = quality.contradictions_by_call(
        book.stg("call_dispositions"), book.events("calls", "call_status", keep="first"), c("disposition_code_raw").isin(*RPC_LIKE), ANSWERED
    )
    contradicted = observe(calls, [observation("contradiction", rows=c("rows"), hits=c("not_answered") + c("unmatched"))])
    return [*frames, kept, contradicted, _own(book, BORROWER_SOURCES)]


def dq_report(book: Book) -> DataFrame:
    """One row per check: wording, affected and total counts, percentage, impact sentence.

    All checks share one pass (`operators.checks`)."""
    crore = (number("payment", "cash").cast("decimal(38,2)") - number("kept", "cash").cast("decimal(38,2)")).cast("double") / CRORE
    rows, present = [], []

    def add(check: str, affected: Column, total: Column, impact: list, source: str = "", when: Column | None = None) -> None:
        rows.append(_row(check, affected, total, F.concat(*[F.lit(x) if isinstance(x, str) else x for x in impact]), source))
        present.append(when)

    affected, total = number("payment", "repeated"), number("payment", "keys")
    add("payment_ids", affected, total, [_n(affected), " duplicate IDs; ₹", F.format_number(crore, 2), f" Cr duplicate {SUCCESS} value removed"])
    affected = number("reference", "unstable")
    add("references", affected, number("reference", "keys"), [affected.cast("string"), " references span multiple accounts"])
    for source in BORROWER_SOURCES:
        family = f"conflict {source}"
        affected, total = number(family, "known_others"), number(family, "known_rows")
        add("conflict", affected, total, [_n(affected), "/", _n(total), " (", _pct(affected, total, 2), "%)"], source, number(family, "known") > 0)
    affected, total = number("agent", "unstable"), number("agent", "keys")
    add("agents", affected, total, [_n(affected), "/", _n(total), " agent IDs have conflicting identity fields"])
    affected = number("call", "repeated")
    add("call_ids", affected, number("call", "keys"), [_n(affected), " call IDs duplicated; ", number("call", "conflicting").cast("string"), " have conflicting timestamps"])
    affected = number("contradiction", "hits")
    add("contradiction", affected, number("contradiction", "rows"), [_n(affected), " RPC-like dispositions on non-ANSWERED calls"])
    affected, total = number("late", "hits"), number("late", "rows")
    add("late", affected, total, [_pct(affected, total, 1), "% of status-history rows arrive >24h late"])
    calls, accounts = number("call zone", "keys"), number("account zone", "keys")
    add("zones", calls, number("call zone", "rows") + number("account zone", "rows"), ["calls use ", calls.cast("string"), " timezones; accounts use ", accounts.cast("string")])
    affected = number("borrower", "unstable")
    add("borrowers", affected, number("borrower", "keys"), [_n(affected), " borrower IDs have changing phone values"])
    affected = number("target", "repeated")
    add("targets", affected, number("target", "keys"), [affected.cast("string"), " account-date pairs repeat"])
    return rows_of(gathered(observations(book)), rows, present)
