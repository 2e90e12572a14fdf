"""The seventeen source tables: raw column, conformed kind, staged name.

One declaration drives the CSV schema, the staging projection and the
cast-failure check, so the three cannot drift apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    raw: str
    kind: str
    staged: str


def _fields(spec: str) -> tuple[Field, ...]:
    """Parse `raw:kind` or `raw:kind>staged`, one per word."""
    out = []
    for word in spec.split():
        left, _, staged = word.partition(">")
        raw, _, kind = left.partition(":")
        out.append(Field(raw, kind, staged or raw))
    return tuple(out)


# Column names of the source tables and how each is conformed.
TABLES: dict[str, tuple[Field, ...]] = {
    "accounts": _fields(
        "account_id:id borrower_id:text>borrower_id_raw loan_type:code principal_amount:money "
        "outstanding_amount:money dpd:int risk_segment:code status:code opened_at:time "
        "timezone:label schema_version:version"
    ),
    "borrowers": _fields(
        "borrower_id:id name:text>borrower_name phone:text email:email city:text state:text "
        "created_at:time updated_at:time"
    ),
    "agents": _fields(
        "agent_id:id employee_code:id agent_name:text vendor_id:id team:text status:code "
        "joined_at:time updated_at:time"
    ),
    "payments": _fields(
        "payment_id:id account_id:id borrower_id:id>borrower_id_raw event_at:time payment_reference:id "
        "amount:money payment_status:code payment_method:code provider_id:id"
    ),
    "calls": _fields(
        "call_id:id account_id:id borrower_id:id>borrower_id_raw event_at:time>event_at_local "
        "agent_id:id>agent_id_raw campaign_id:id direction:code vendor_id:id>vendor_id_raw "
        "call_status:code duration_sec:int0 timezone:label"
    ),
    "call_attempts": _fields(
        "attempt_id:id account_id:id borrower_id:id>borrower_id_raw event_at:time>event_at_local "
        "call_id:id agent_id:id>agent_id_raw attempt_no:int vendor_id:id>vendor_id_raw attempt_status:code"
    ),
    "call_dispositions": _fields(
        "disposition_id:id account_id:id borrower_id:id>borrower_id_raw event_at:time>event_at_local "
        "call_id:id agent_id:id>agent_id_raw disposition_code:code>disposition_code_raw "
        "disposition_version:version"
    ),
    "daily_targeting": _fields(
        "target_id:id account_id:id campaign_id:id target_date:date priority:int "
        "recommended_channel:code status:code"
    ),
    "campaigns": _fields(
        "campaign_id:id campaign_name:text channel:code strategy_version:text start_at:time "
        "target_definition:text end_at:time"
    ),
    "promises_to_pay": _fields(
        "ptp_id:id account_id:id borrower_id:id>borrower_id_raw event_at:time>event_at_local "
        "agent_id:id>agent_id_raw promised_amount:money promised_date:time status:code source:code"
    ),
    "whatsapp_events": _fields(
        "whatsapp_event_id:id account_id:id borrower_id:id>borrower_id_raw event_at:time message_id:id "
        "event_type:code template_code:text provider_id:id"
    ),
    "sms_events": _fields(
        "sms_event_id:id account_id:id borrower_id:id>borrower_id_raw event_at:time message_id:id "
        "event_type:code template_code:text provider_id:id"
    ),
    "field_visits": _fields(
        "visit_id:id account_id:id borrower_id:id>borrower_id_raw event_at:time agent_id:id>agent_id_raw "
        "visit_type:code outcome:code latitude:coordinate longitude:coordinate scheduled_at:time"
    ),
    "agent_sessions": _fields(
        "session_id:id agent_id:id login_at:time channel:code device_id:text timezone:label logout_at:time"
    ),
    "account_status_history": _fields(
        "history_id:id account_id:id borrower_id:id>borrower_id_raw event_at:time status:code "
        "changed_by:text source:code recorded_at:time"
    ),
    "complaints": _fields(
        "complaint_id:id account_id:id borrower_id:id>borrower_id_raw event_at:time complaint_type:code "
        "severity:code status:code source:code resolution_at:time"
    ),
    "vendor_telephony": _fields(
        "vendor_id:id vendor_name:text vendor_account_id:text timezone:label status:code "
        "schema_version:version"
    ),
}


def raw_schema(table: str) -> T.StructType:
    """All-string schema of the raw file; no inference pass over the data."""
    return T.StructType([T.StructField(f.raw, T.StringType()) for f in TABLES[table]])
