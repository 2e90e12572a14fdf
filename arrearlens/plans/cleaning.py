"""Cleaning: one row per business key, identity repair, conformance, quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import to_utc
from ..functions.codes import ANSWERED, DISPOSITION_GROUPS
from ..functions.conform import map_codes
from ..operators.dedup import flag_repeated, latest_per_key
from ..operators.identity import canonical_id
from ..operators.lookup import attach_account, lookup
from ..operators.stack import stack


@dataclass(frozen=True)
class Rule:
    """How one table keeps one row per key.

    `ties` lists the other columns, the ones that carry measures first. Because ties
    compare in this order, deduplicating only a leading part of it keeps the same
    values as deduplicating whole rows - so a plan that needs four columns reads
    and shuffles four, and still agrees with the stored table.
    """

    key: str
    order: tuple[str, ...]
    ties: tuple[str, ...]


def _rule(key: str, order: str, ties: str) -> Rule:
    return Rule(key, tuple(order.split()), tuple(ties.split()))


RULES: dict[str, Rule] = {
    "accounts": _rule(
        "account_id",
        "schema_version opened_at",
        "borrower_id_raw outstanding_amount dpd risk_segment loan_type status timezone principal_amount",
    ),
    "borrowers": _rule("borrower_id", "updated_at", "state city borrower_name phone email created_at"),
    "calls": _rule(
        "call_id",
        "event_at_local duration_sec",
        "agent_id_raw account_id call_status timezone vendor_id_raw campaign_id direction borrower_id_raw",
    ),
    "call_attempts": _rule(
        "attempt_id",
        "event_at_local attempt_no",
        "account_id call_id agent_id_raw vendor_id_raw attempt_status borrower_id_raw",
    ),
    "call_dispositions": _rule(
        "disposition_id",
        "event_at_local",
        "call_id account_id disposition_code_raw agent_id_raw disposition_version borrower_id_raw",
    ),
    "payments": _rule(
        "payment_id",
        "event_at",
        "payment_status account_id amount payment_reference payment_method provider_id borrower_id_raw",
    ),
    "campaigns": _rule(
        "campaign_id", "start_at", "channel strategy_version campaign_name target_definition end_at"
    ),
    "promises_to_pay": _rule(
        "ptp_id",
        "event_at_local",
        "account_id status promised_amount agent_id_raw promised_date source borrower_id_raw",
    ),
    "whatsapp_events": _rule(
        "whatsapp_event_id",
        "event_at",
        "account_id event_type message_id template_code provider_id borrower_id_raw",
    ),
    "sms_events": _rule(
        "sms_event_id", "event_at", "account_id event_type message_id template_code provider_id borrower_id_raw"
    ),
    "field_visits": _rule(
        "visit_id",
        "event_at",
        "account_id outcome visit_type agent_id_raw latitude longitude scheduled_at borrower_id_raw",
    ),
    "agent_sessions": _rule("session_id", "login_at", "logout_at agent_id channel device_id timezone"),
    "account_status_history": _rule(
        "history_id", "recorded_at event_at", "account_id status changed_by source borrower_id_raw"
    ),
    "complaints": _rule(
        "complaint_id",
        "event_at",
        "account_id complaint_type severity status source resolution_at borrower_id_raw",
    ),
    "vendor_telephony": _rule(
        "vendor_id", "schema_version", "vendor_name timezone status vendor_account_id"
    ),
}

# Clean names that differ from the source's.
CLEAN_NAMES = {"account_status_history": "status_history"}


def clean_name(table: str) -> str:
    return CLEAN_NAMES.get(table, table)


_RENAMES = {
    "agent_id_raw": "agent_id",
    "vendor_id_raw": "vendor_id",
}


def event_time(table: str) -> str:
    """The clean name of the column by which the table's copies are ordered."""
    return "event_at" if table == "promises_to_pay" else RULES[table].order[0]


def _ties(table: str, need: Sequence[str]) -> tuple[str, ...]:
    """The leading part of the tie columns that holds all that is needed."""
    rule = RULES[table]
    if not need:
        return rule.ties
    unknown = set(need) - {rule.key, *rule.order, *rule.ties}
    if unknown:
        raise ValueError(f"{table} has no column {sorted(unknown)}")
    return rule.ties[: max((rule.ties.index(c) for c in need if c in rule.ties), default=-1) + 1]


def dedupe(stg: DataFrame, table: str, need: Sequence[str] = (), keep: str = "last") -> DataFrame:
    """One row per business key; `need` limits the columns carried (empty: all)."""
    rule, ties = RULES[table], _ties(table, need)
    carried = stg.select(rule.key, *rule.order, *ties)
    return latest_per_key(carried, rule.key, rule.order, keep=keep, ties=ties)


def dedupe_together(sources: Mapping[str, tuple[DataFrame, str, Sequence[str]]]) -> tuple[DataFrame, dict[str, dict[str, str]]]:
    """Deduplicate several tables in one exchange, each by its own rule.

    `sources` maps a name to (staged frame, table, needed columns). Columns of equal type
    and direction share a slot where the order in which they decide allows it; a slot that
    a table has no use for is null in all its rows and decides nothing there. Returns the
    rows with `source`, `key` and slots, and for each source the slot of each column.
    """
    slots: list[tuple[str, str, str]] = []  # name, type, direction
    names: dict[str, dict[str, str]] = {}
    for source, (stg, table, need) in sources.items():
        rule, at = RULES[table], 0
        names[source] = {rule.key: "key"}
        for columns, direction in ((rule.order, "desc"), (_ties(table, need), "asc")):
            for column in columns:
                kind = stg.schema[column].dataType.simpleString()
                found = next((k for k in range(at, len(slots)) if slots[k][1:] == (kind, direction)), None)
                if found is None:
                    slots.insert(found := at, (f"s{len(slots)}", kind, direction))
                names[source][column] = slots[found][0]
                at = found + 1
    frames = []
    for source, (stg, table, _) in sources.items():
        of_slot = {s: F.col(c) for c, s in names[source].items()}
        frames.append(
            stg.select(F.lit(source).alias("source"), F.col(RULES[table].key).cast("string").alias("key"), *[of_slot.get(s, F.lit(None)).cast(kind).alias(s) for s, kind, _ in slots])
        )
    order = [f"{s} {direction} nulls last" for s, _, direction in slots]
    # The key leads, so that a sort compares its first bytes and not those of a name that most rows share.
    return latest_per_key(stack(frames).where("key is not null"), ["key", "source"], order, ties=()), names


def _conform(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(_RENAMES)


def clean_accounts(stg: DataFrame, need: Sequence[str] = ()) -> DataFrame:
    """Account dimension: the authority for which borrower an account belongs to."""
    return dedupe(stg, "accounts", need).withColumnRenamed("borrower_id_raw", "borrower_id")


def clean_agent_identity(stg: DataFrame) -> DataFrame:
    """Every agent row with the canonical id of its employee; not deduplicated."""
    return canonical_id(
        stg.where(F.col("agent_id").isNotNull()), "agent_id", "employee_code", ["updated_at"], "canonical_agent_id"
    )


def one_per_agent(identity: DataFrame) -> DataFrame:
    """Latest identity row per technical agent id, so that a lookup cannot fan out."""
    return latest_per_key(identity, "agent_id", ["updated_at"], ties=("employee_code", "canonical_agent_id", "joined_at"))


def clean_events(stg: DataFrame, table: str, need: Sequence[str] = (), keep: str = "last") -> DataFrame:
    """Deduplicated events under their conformed names, before borrower repair."""
    if table == "calls":
        # The UTC time needs the zone; the local time is the sort key and always there.
        asked = [*need, "timezone"] if "event_at_utc" in need else list(need)
        df = dedupe(stg, table, [c for c in asked if c != "event_at_utc"], keep)
        if not need or "event_at_utc" in need:
            df = df.withColumn("event_at_utc", to_utc("event_at_local", "timezone"))
        return _conform(df)
    df = _conform(dedupe(stg, table, need, keep))
    if table == "promises_to_pay":
        df = df.withColumnRenamed("event_at_local", "event_at")
    return df


def with_call_status(dispositions: DataFrame, calls: DataFrame) -> DataFrame:
    """Standard disposition code, and whether the call behind it was answered."""
    joined = lookup(dispositions, calls, "call_id", ["call_status"])
    return joined.withColumns(
        {
            "disposition_code_std": map_codes(F.col("disposition_code_raw"), DISPOSITION_GROUPS),
            "call_answered_flag": F.coalesce(F.upper("call_status") == ANSWERED, F.lit(False)),
        }
    ).drop("call_status")


def clean_payments(stg: DataFrame, accounts: DataFrame) -> DataFrame:
    """Payment ledger: the payment id is the event key, the reference never is one.

    References are counted over the ledger itself: the shuffle by id serves both, the one by reference is narrow.
    """
    ledger = clean_events(stg, "payments")
    flagged = flag_repeated(ledger, "payment_reference", "repeated_reference_flag")
    return attach_account(flagged, accounts)


def enrich_targeting(targeting: DataFrame, accounts: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Every targeting row with its account's borrower and its campaign's channel and strategy.

    Campaigns are cut to one row each, so a repeated campaign cannot multiply targets.
    """
    one = dedupe(campaigns, "campaigns", ["channel", "strategy_version"]).withColumnRenamed(
        "channel", "campaign_channel"
    )
    kept = targeting.where(F.col("target_id").isNotNull())
    return lookup(attach_account(kept, accounts), one, "campaign_id", ["campaign_channel", "strategy_version"])
