"""SQL that computes every registered query independently, for DuckDB.

Each entry is a chain of common table expressions over the supplied tables ending in
the query. Where the library avoids joins, pairs or distinct sets for scale, the SQL
here takes the direct route, so agreement is evidence and not repetition.
"""

from __future__ import annotations

import re

from .frames import RAW_SQL
from .queries import EXPERIMENT_START, SEED

# --- pieces -------------------------------------------------------------------


def _id(c, out=None):
    return f"nullif(trim({c}), '') as {out or c}"


def _code(c, out=None):
    return f"upper(trim({c})) as {out or c}"


def _ver(c):
    return f"lower(trim({c})) as {c}"


def _money(c):
    return f"try_cast({c} as decimal(18,2)) as {c}"


def _ts(c, out=None):
    return f"try_cast({c} as timestamp) as {out or c}"


def _int(c):
    return f"try_cast(round(try_cast({c} as decimal(18,6)), 0) as integer) as {c}"


def _ids(names: str) -> str:
    return ", ".join(_id(n) for n in names.split())


def _latest(source: str, key: str, order: str) -> str:
    return (
        f"select * from {source} where {key} is not null "
        f"qualify row_number() over (partition by {key} order by {order}) = 1"
    )


def _asc(names: str) -> str:
    return ", ".join(f"{n} asc nulls last" for n in names.split())


_BORROWER_RAW = _id("borrower_id", "borrower_id_raw")

CTES: dict[str, str] = {f"raw_{name}": sql for name, sql in RAW_SQL.items()}

# --- staging ------------------------------------------------------------------

CTES |= {
    "stg_accounts": f"""select {_id("account_id")}, {_BORROWER_RAW}, {_code("loan_type")}, {_money("principal_amount")},
        {_money("outstanding_amount")}, {_int("dpd")}, {_code("risk_segment")}, {_code("status")}, {_ts("opened_at")},
        nullif(trim(timezone), '') as timezone, {_ver("schema_version")} from raw_accounts""",
    "stg_borrowers": f"""select {_id("borrower_id")}, {_id("name", "borrower_name")}, {_id("phone")},
        nullif(lower(trim(email)), '') as email, {_ids("city state")}, {_ts("created_at")}, {_ts("updated_at")}
        from raw_borrowers""",
    "stg_agents": f"""select {_ids("agent_id employee_code agent_name vendor_id team")}, {_code("status")},
        {_ts("joined_at")}, {_ts("updated_at")} from raw_agents""",
    "stg_payments": f"""select {_ids("payment_id account_id")}, {_BORROWER_RAW}, {_ts("event_at")}, {_id("payment_reference")},
        {_money("amount")}, {_code("payment_status")}, {_code("payment_method")}, {_id("provider_id")} from raw_payments""",
    "stg_calls": f"""select {_ids("call_id account_id")}, {_BORROWER_RAW}, {_ts("event_at", "event_at_local")},
        {_id("agent_id", "agent_id_raw")}, {_id("campaign_id")}, {_code("direction")}, {_id("vendor_id", "vendor_id_raw")},
        {_code("call_status")}, coalesce(duration_sec, 0) as duration_sec, nullif(trim(timezone), '') as timezone from raw_calls""",
    "stg_call_attempts": f"""select {_ids("attempt_id account_id")}, {_BORROWER_RAW}, {_ts("event_at", "event_at_local")},
        {_id("call_id")}, {_id("agent_id", "agent_id_raw")}, {_int("attempt_no")}, {_id("vendor_id", "vendor_id_raw")},
        {_code("attempt_status")} from raw_call_attempts""",
    "stg_call_dispositions": f"""select {_ids("disposition_id account_id")}, {_BORROWER_RAW},
        {_ts("event_at", "event_at_local")}, {_id("call_id")}, {_id("agent_id", "agent_id_raw")},
        {_code("disposition_code", "disposition_code_raw")}, {_ver("disposition_version")} from raw_call_dispositions""",
    "stg_daily_targeting": f"""select {_ids("target_id account_id campaign_id")}, cast(target_date as date) as target_date,
        {_int("priority")}, {_code("recommended_channel")}, {_code("status")} from raw_daily_targeting""",
    "stg_campaigns": f"""select {_ids("campaign_id campaign_name")}, {_code("channel")}, {_id("strategy_version")},
        {_ts("start_at")}, {_id("target_definition")}, {_ts("end_at")} from raw_campaigns""",
    "stg_promises_to_pay": f"""select {_ids("ptp_id account_id")}, {_BORROWER_RAW}, {_ts("event_at", "event_at_local")},
        {_id("agent_id", "agent_id_raw")}, {_money("promised_amount")}, {_ts("promised_date")}, {_code("status")},
        {_code("source")} from raw_promises_to_pay""",
    "stg_field_visits": f"""select {_ids("visit_id account_id")}, {_BORROWER_RAW}, {_ts("event_at")},
        {_id("agent_id", "agent_id_raw")}, {_code("visit_type")}, {_code("outcome")},
        try_cast(latitude as decimal(9,6)) as latitude, try_cast(longitude as decimal(9,6)) as longitude,
        {_ts("scheduled_at")} from raw_field_visits""",
    "stg_agent_sessions": f"""select {_ids("session_id agent_id")}, {_ts("login_at")}, {_code("channel")}, {_id("device_id")},
        nullif(trim(timezone), '') as timezone, {_ts("logout_at")} from raw_agent_sessions""",
    "stg_account_status_history": f"""select {_ids("history_id account_id")}, {_BORROWER_RAW}, {_ts("event_at")},
        {_code("status")}, {_id("changed_by")}, {_code("source")}, {_ts("recorded_at")} from raw_account_status_history""",
    "stg_complaints": f"""select {_ids("complaint_id account_id")}, {_BORROWER_RAW}, {_ts("event_at")},
        {_code("complaint_type")}, {_code("severity")}, {_code("status")}, {_code("source")}, {_ts("resolution_at")}
        from raw_complaints""",
    "stg_vendor_telephony": f"""select {_ids("vendor_id vendor_name vendor_account_id")}, nullif(trim(timezone), '') as timezone,
        {_code("status")}, {_ver("schema_version")} from raw_vendor_telephony""",
}
for _m in ("whatsapp", "sms"):
    CTES[f"stg_{_m}_events"] = f"""select {_ids(f"{_m}_event_id account_id")}, {_BORROWER_RAW}, {_ts("event_at")},
        {_id("message_id")}, {_code("event_type")}, {_ids("template_code provider_id")} from raw_{_m}_events"""

# --- one row per key, before borrower repair ------------------------------------

_ZONE = (
    "case when timezone in ('Asia/Kolkata', 'UTC', 'Asia/Dubai') then timezone when timezone = 'Singapore' then 'Asia/Singapore' "
    "when timezone = '-03:00' then 'Etc/GMT+3' when timezone = 'PST' then 'America/Los_Angeles' when timezone = 'JST' then 'Asia/Tokyo' "
    "when timezone = '+18:00' then 'UTC' else 'Asia/Kolkata' end"
)
# No named zone is as far from UTC.
_FAR = "case when timezone = '+18:00' then interval '18' hour else interval '0' hour end"
_CALLER = f"(timezone({_ZONE}, timezone('UTC', event_at_utc)) + {_FAR})"
_CALL_TIES = _asc(
    "agent_id_raw account_id call_status timezone vendor_id_raw campaign_id direction borrower_id_raw"
)
_PAY_TIES = _asc(
    "payment_status account_id amount payment_reference payment_method provider_id borrower_id_raw"
)


def _call_columns(source: str) -> str:
    return f"""select call_id, event_at_local, duration_sec, agent_id_raw as agent_id, account_id, call_status, timezone,
        vendor_id_raw as vendor_id, campaign_id, direction, borrower_id_raw,
        timezone('UTC', timezone({_ZONE}, event_at_local)) - {_FAR} as event_at_utc from ({source})"""


CTES |= {
    "one_accounts": "select account_id, schema_version, opened_at, borrower_id_raw as borrower_id, outstanding_amount, dpd, "
    "risk_segment, loan_type, status, timezone, principal_amount from ("
    + _latest(
        "stg_accounts",
        "account_id",
        "schema_version desc nulls last, opened_at desc nulls last, "
        + _asc("borrower_id_raw outstanding_amount dpd risk_segment loan_type status timezone principal_amount"),
    )
    + ")",
    "one_borrowers": _latest(
        "stg_borrowers",
        "borrower_id",
        "updated_at desc nulls last, " + _asc("state city borrower_name phone email created_at"),
    ),
    "one_calls": _call_columns(
        _latest("stg_calls", "call_id", f"event_at_local desc nulls last, duration_sec desc nulls last, {_CALL_TIES}")
    ),
    "first_calls": _call_columns(
        _latest("stg_calls", "call_id", f"event_at_local asc nulls last, duration_sec asc nulls last, {_CALL_TIES}")
    ),
    "one_call_attempts": "select attempt_id, event_at_local, attempt_no, account_id, call_id, agent_id_raw as agent_id, "
    "vendor_id_raw as vendor_id, attempt_status, borrower_id_raw from ("
    + _latest(
        "stg_call_attempts",
        "attempt_id",
        "event_at_local desc nulls last, attempt_no desc nulls last, "
        + _asc("account_id call_id agent_id_raw vendor_id_raw attempt_status borrower_id_raw"),
    )
    + ")",
    "one_call_dispositions": "select disposition_id, event_at_local, call_id, account_id, disposition_code_raw, "
    "agent_id_raw as agent_id, disposition_version, borrower_id_raw from ("
    + _latest(
        "stg_call_dispositions",
        "disposition_id",
        "event_at_local desc nulls last, "
        + _asc("call_id account_id disposition_code_raw agent_id_raw disposition_version borrower_id_raw"),
    )
    + ")",
    "one_payments": _latest("stg_payments", "payment_id", f"event_at desc nulls last, {_PAY_TIES}"),
    "first_payments": _latest("stg_payments", "payment_id", f"event_at asc nulls last, {_PAY_TIES}"),
    "one_promises_to_pay": "select ptp_id, event_at_local as event_at, account_id, status, promised_amount, "
    "agent_id_raw as agent_id, promised_date, source, borrower_id_raw from ("
    + _latest(
        "stg_promises_to_pay",
        "ptp_id",
        "event_at_local desc nulls last, "
        + _asc("account_id status promised_amount agent_id_raw promised_date source borrower_id_raw"),
    )
    + ")",
    "one_field_visits": "select visit_id, event_at, account_id, outcome, visit_type, agent_id_raw as agent_id, latitude, "
    "longitude, scheduled_at, borrower_id_raw from ("
    + _latest(
        "stg_field_visits",
        "visit_id",
        "event_at desc nulls last, "
        + _asc("account_id outcome visit_type agent_id_raw latitude longitude scheduled_at borrower_id_raw"),
    )
    + ")",
    "one_agent_sessions": _latest(
        "stg_agent_sessions",
        "session_id",
        "login_at desc nulls last, " + _asc("logout_at agent_id channel device_id timezone"),
    ),
    "one_status_history": _latest(
        "stg_account_status_history",
        "history_id",
        "recorded_at desc nulls last, event_at desc nulls last, "
        + _asc("account_id status changed_by source borrower_id_raw"),
    ),
    "one_complaints": _latest(
        "stg_complaints",
        "complaint_id",
        "event_at desc nulls last, "
        + _asc("account_id complaint_type severity status source resolution_at borrower_id_raw"),
    ),
    "one_vendors": _latest(
        "stg_vendor_telephony",
        "vendor_id",
        "schema_version desc nulls last, " + _asc("vendor_name timezone status vendor_account_id"),
    ),
    "one_campaigns": _latest(
        "stg_campaigns",
        "campaign_id",
        "start_at desc nulls last, " + _asc("channel strategy_version campaign_name target_definition end_at"),
    ),
    "identity": """select *, first_value(agent_id) over (partition by employee_code
        order by updated_at desc nulls last, agent_id asc nulls last) as canonical_agent_id
        from stg_agents where agent_id is not null""",
    "one_agents": _latest(
        "identity", "agent_id", "updated_at desc nulls last, " + _asc("employee_code canonical_agent_id joined_at")
    ),
    "paid": "select * from one_payments where payment_status = 'SUCCESS'",
    "paid_first": "select * from first_payments where payment_status = 'SUCCESS'",
    "targets": "select * from stg_daily_targeting where target_id is not null",
    "dispositions": """select d.*, case when disposition_code_raw in ('RPC', 'RIGHT_PARTY_CONTACT', 'CONTACTED') then 'RPC'
            when disposition_code_raw in ('PTP', 'PROMISE_TO_PAY') then 'PTP'
            when disposition_code_raw in ('WRONG_NUMBER', 'INVALID') then 'WRONG_PARTY'
            when disposition_code_raw in ('CALLBACK', 'CALL_BACK') then 'CALLBACK' else 'OTHER' end as disposition_code_std,
            coalesce(c.call_status = 'ANSWERED', false) as call_answered_flag
        from one_call_dispositions d left join one_calls c on c.call_id = d.call_id""",
}
for _m in ("whatsapp", "sms"):
    CTES[f"one_{_m}_events"] = _latest(
        f"stg_{_m}_events",
        f"{_m}_event_id",
        "event_at desc nulls last, " + _asc("account_id event_type message_id template_code provider_id borrower_id_raw"),
    )

# --- gold and features ----------------------------------------------------------


def _month(c: str) -> str:
    return f"cast(date_trunc('month', {c}) as date)"


def _div(a: str, b: str) -> str:
    return f"(cast({a} as double) / nullif(cast({b} as double), 0))"


def _fact(select: str, source: str, at: str) -> str:
    return f"select account_id, {_month(at)} as month_start, {select} from {source} group by 1, 2"


CTES |= {
    "months": "select cast(unnest(generate_series(date '1995-01-01', date '2001-12-01', interval '1' month)) as date) as month_start",
    "base": """select account_id, borrower_id, loan_type, principal_amount, outstanding_amount, dpd, risk_segment,
            status as account_status, opened_at, timezone, month_start
        from one_accounts join months on cast(opened_at as date) <= last_day(month_start)""",
    "f_payments": _fact(
        "sum(amount) as recovered_amount, count(*) as success_payment_events, count(distinct payment_id) as success_payment_ids",
        "paid",
        "event_at",
    ),
    "f_attempts": _fact(
        "count(*) as attempts, count(distinct call_id) as attempted_calls", "one_call_attempts", "event_at_local"
    ),
    "f_calls": _fact(
        """count(*) as calls, count(*) filter (call_status = 'ANSWERED') as answered_calls,
        sum(duration_sec) filter (call_status = 'ANSWERED') as answered_seconds, count(distinct campaign_id) as campaigns_touched""",
        "one_calls",
        "event_at_utc",
    ),
    "f_dispositions": _fact(
        """count(*) filter (disposition_code_std = 'RPC' and call_answered_flag) as rpc_events,
        count(*) filter (disposition_code_std = 'PTP' and call_answered_flag) as ptp_events""",
        "dispositions",
        "event_at_local",
    ),
    "f_targets": _fact(
        """count(distinct target_id) as target_events, count(distinct campaign_id) as target_campaigns,
        max(target_date) as last_target_date""",
        "targets",
        "target_date",
    ),
    "f_promises": _fact(
        """count(*) as ptp_count, sum(promised_amount) as promised_amount, count(*) filter (status = 'KEPT') as ptp_kept_count,
        sum(promised_amount) filter (status = 'KEPT') as ptp_kept_amount""",
        "one_promises_to_pay",
        "event_at",
    ),
    "f_whatsapp": _fact(
        "count(*) as whatsapp_events, count(*) filter (event_type in ('DELIVERED', 'READ', 'CLICKED')) as whatsapp_engaged",
        "one_whatsapp_events",
        "event_at",
    ),
    "f_sms": _fact(
        "count(*) as sms_events, count(*) filter (event_type in ('DELIVERED', 'CLICKED')) as sms_engaged",
        "one_sms_events",
        "event_at",
    ),
    "f_visits": _fact(
        "count(*) as field_visits, count(*) filter (outcome = 'PAID') as paid_field_visits", "one_field_visits", "event_at"
    ),
    "f_complaints": _fact("count(*) as complaints", "one_complaints", "event_at"),
}

_MONEY = ("recovered_amount", "promised_amount", "ptp_kept_amount")
_MEASURES = {
    "payments": "recovered_amount success_payment_events success_payment_ids",
    "attempts": "attempts attempted_calls",
    "calls": "calls answered_calls answered_seconds campaigns_touched",
    "dispositions": "rpc_events ptp_events",
    "targets": "target_events target_campaigns last_target_date",
    "promises": "ptp_count promised_amount ptp_kept_count ptp_kept_amount",
    "whatsapp": "whatsapp_events whatsapp_engaged",
    "sms": "sms_events sms_engaged",
    "visits": "field_visits paid_field_visits",
    "complaints": "complaints",
}


def _measure(name: str) -> str:
    if name == "last_target_date":
        return name
    if name in _MONEY:
        return f"cast(coalesce({name}, 0) as double) as {name}"
    return f"cast(coalesce({name}, 0) as bigint) as {name}"


def _gold(*facts: str) -> str:
    measures = ", ".join(_measure(m) for f in facts for m in _MEASURES[f].split())
    joins = " ".join(f"left join f_{f} using (account_id, month_start)" for f in facts)
    return f"""select account_id, borrower_id, loan_type, cast(principal_amount as double) as principal_amount,
        cast(outstanding_amount as double) as outstanding_amount, dpd, risk_segment, account_status, opened_at, timezone,
        month_start, {measures} from base {joins}"""


CTES |= {
    "gold": _gold(*_MEASURES),
    "gold_cash": _gold("payments"),
    "cohort": "select account_id, min(target_date) as first_target_date from targets where account_id is not null group by 1",
    "feat": f"""select *, cast(extract(day from last_day(month_start)) as integer) as days_in_month,
        case when recovered_amount > 0 then 1 else 0 end as payer_flag, case when calls > 0 then 1 else 0 end as attempted_flag,
        case when answered_calls > 0 then 1 else 0 end as contact_flag, case when rpc_events > 0 then 1 else 0 end as rpc_flag,
        case when ptp_count > 0 then 1 else 0 end as ptp_flag, case when target_events > 0 then 1 else 0 end as targeted_flag,
        case when field_visits > 0 then 1 else 0 end as field_contact_flag,
        case when whatsapp_engaged + sms_engaged > 0 then 1 else 0 end as digital_engaged_flag,
        {_div("ptp_kept_count", "ptp_count")} as ptp_kept_rate, {_div("answered_calls", "calls")} as contact_rate,
        {_div("rpc_events", "answered_calls")} as rpc_rate, {_div("ptp_count", "answered_calls")} as ptp_rate,
        {_div("recovered_amount", "outstanding_amount")} as recovery_rate_proxy,
        {_div("recovered_amount", "attempts")} as recovery_per_attempt,
        {_div("recovered_amount", "answered_seconds / 3600.0::double")} as recovery_per_answered_hour from gold""",
    "enriched": """select f.*, first_target_date,
        case when targeted_flag = 1 or first_target_date is not null then 1 else 0 end as ever_targeted_flag,
        case when month_start >= date_trunc('month', first_target_date) then 1 else 0 end as post_first_target_flag,
        cast(date_diff('month', date_trunc('month', first_target_date), month_start) as integer) as months_since_first_target
        from feat f left join cohort using (account_id)""",
    "call_hour": f"""select account_id, {_month("event_at_utc")} as month_start,
        cast(extract(hour from {_CALLER}) as integer) as local_hour, count(*) as calls,
        count(*) filter (call_status = 'ANSWERED') as answered_calls,
        cast(sum(duration_sec) filter (call_status = 'ANSWERED') as bigint) as answered_seconds
        from one_calls group by 1, 2, 3""",
}

# --- metrics ----------------------------------------------------------------------


def _kpis(source: str) -> str:
    return f"""select month, recovery, payers, payments, rpp as recovery_per_payer,
        (recovery / nullif(lag(recovery) over (order by month), 0) - 1) * 100 as mom_cash_pct,
        (cast(payers as double) / nullif(cast(lag(payers) over (order by month) as double), 0) - 1) * 100 as mom_payer_pct,
        (rpp / nullif(lag(rpp) over (order by month), 0) - 1) * 100 as mom_rpp_pct
        from (select *, {_div("recovery", "payers")} as rpp from (
            select strftime(event_at, '%Y-%m') as month, cast(sum(amount) as double) as recovery,
            count(distinct account_id) as payers, count(payment_id) as payments from {source}
            where event_at is not null group by 1))"""


CTES |= {
    "kpis": _kpis("paid"),
    "monthly": f"""select month_start, recovery, accounts_in_population, payer_accounts,
        {_div("recovery", "accounts_in_population")} as recovery_per_account, {_div("recovery", "payer_accounts")} as recovery_per_payer,
        {_div("recovery", "outstanding")} as recovery_rate_proxy, attempted_accounts, contacted_accounts, rpc_accounts, ptp_accounts,
        {_div("contacted_accounts", "attempted_accounts")} as contact_rate, {_div("rpc_accounts", "contacted_accounts")} as rpc_rate,
        {_div("ptp_accounts", "contacted_accounts")} as ptp_rate, {_div("kept", "ptp")} as ptp_kept_rate,
        seconds / 3600.0::double as answered_agent_hours,
        {_div("recovery", "seconds / 3600.0::double")} as recovery_per_answered_agent_hour
        from (select month_start, cast(sum(cast(recovered_amount as decimal(18,2))) as double) as recovery,
            count(distinct account_id) as accounts_in_population,
            count(distinct account_id) filter (payer_flag = 1) as payer_accounts,
            sum(cast(outstanding_amount as decimal(18,2))) as outstanding,
            count(distinct account_id) filter (calls > 0) as attempted_accounts,
            count(distinct account_id) filter (answered_calls > 0) as contacted_accounts,
            count(distinct account_id) filter (rpc_flag = 1) as rpc_accounts,
            count(distinct account_id) filter (ptp_flag = 1) as ptp_accounts,
            sum(ptp_count) as ptp, sum(ptp_kept_count) as kept, cast(sum(answered_seconds) as bigint) as seconds
            from feat group by 1)""",
    "channel_14d": f"""select recommended_channel, count(*) as target_records,
        count(*) filter (recovered > 0) as converting_target_records, cast(sum(recovered) as double) as recovery_14d,
        {_div("sum(recovered)", "count(recovered)")} as recovery_per_target,
        {_div("coalesce(sum(recovered), 0)", "count(*)")} as recovery_per_target_all,
        {_div("count(*) filter (recovered > 0)", "count(*)")} as conversion_rate_14d
        from (select t.account_id, t.target_date, t.recommended_channel, sum(p.amount) as recovered
            from (select distinct account_id, target_date, recommended_channel from targets) t
            left join paid p on p.account_id = t.account_id
                and cast(p.event_at as date) between t.target_date and t.target_date + 14 group by 1, 2, 3)
        group by 1""",
    "attributes": """select a.*, b.state, b.city,
        case when dpd > -1 and dpd <= 7 then '0-7' when dpd > 7 and dpd <= 30 then '8-30' when dpd > 30 and dpd <= 60 then '31-60'
            when dpd > 60 and dpd <= 90 then '61-90' when dpd > 90 and dpd <= 180 then '91-180'
            when dpd > 180 and dpd <= 999 then '181+' when dpd is not null then 'out_of_range' end as dpd_band
        from one_accounts a left join one_borrowers b using (borrower_id)""",
    "scd2": """select agent_id, employee_code, vendor_id, team, agent_name, valid_from,
        lead(valid_from) over (partition by agent_id order by valid_from) as valid_to from (
            select *, updated_at as valid_from from stg_agents
            where agent_id is not null and updated_at is not null
            qualify row_number() over (partition by agent_id, updated_at
                order by employee_code asc nulls last, vendor_id asc nulls last, team asc nulls last,
                agent_name asc nulls last) = 1)""",
    "assigned": f"""select account_id, stratum, position,
        case when position <= floor(n * 0.5::double + 0.5::double) then 'treatment' else 'holdout' end as arm,
        cast(floor(((position - 1) * 4)::double / n) + 1 as integer) as wave
        from (select account_id, stratum, count(*) over (partition by stratum) as n,
            row_number() over (partition by stratum order by md5('{SEED}:' || account_id), account_id) as position
            from (select account_id, concat_ws('|', coalesce(dpd_band, '\\N'), coalesce(risk_segment, '\\N'),
                coalesce(loan_type, '\\N')) as stratum from attributes where account_id is not null))""",
}

_SOURCES = (
    "calls call_attempts call_dispositions payments promises_to_pay field_visits whatsapp_events sms_events".split()
)
CTES["conflicts"] = " union all ".join(
    f"select '{s}' as source, count(*) filter (e.borrower_id_raw is distinct from a.borrower_id) as conflict_rows, "
    f"count(*) as total_rows from stg_{s} e join one_accounts a using (account_id)"
    for s in _SOURCES
)

# --- queries ----------------------------------------------------------------------

ORACLE: dict[str, str] = {}

for _name in CTES:
    if _name.startswith("stg_"):
        ORACLE[_name] = f"select * from {_name}"
ORACLE["stg_accounts"] = (
    "select * replace (cast(principal_amount as double) as principal_amount, cast(outstanding_amount as double) as "
    "outstanding_amount) from stg_accounts"
)
ORACLE["stg_payments"] = "select * replace (cast(amount as double) as amount) from stg_payments"
ORACLE["stg_promises_to_pay"] = (
    "select * replace (cast(promised_amount as double) as promised_amount) from stg_promises_to_pay"
)
ORACLE["stg_field_visits"] = (
    "select * replace (cast(latitude as double) as latitude, cast(longitude as double) as longitude) from stg_field_visits"
)


def _with_borrower(source: str, replace: str = "") -> str:
    return (
        f"select e.* exclude (borrower_id_raw) {replace}, a.borrower_id from {source} e "
        "left join one_accounts a using (account_id)"
    )


for _t in ("calls", "call_attempts", "whatsapp_events", "sms_events", "status_history", "complaints"):
    ORACLE[f"clean_{_t}"] = _with_borrower(f"one_{_t}")
ORACLE |= {
    "clean_accounts": "select * replace (cast(principal_amount as double) as principal_amount, cast(outstanding_amount as "
    "double) as outstanding_amount) from one_accounts",
    "clean_borrowers": "select * from one_borrowers",
    "clean_agent_identity": "select * from identity",
    "clean_agent_sessions": "select * from one_agent_sessions",
    "clean_call_dispositions": _with_borrower("dispositions"),
    "clean_promises_to_pay": _with_borrower(
        "one_promises_to_pay", "replace (cast(e.promised_amount as double) as promised_amount)"
    ),
    "clean_field_visits": _with_borrower(
        "one_field_visits",
        "replace (cast(e.latitude as double) as latitude, cast(e.longitude as double) as longitude)",
    ),
    "clean_payments": """select p.* exclude (borrower_id_raw) replace (cast(p.amount as double) as amount), a.borrower_id,
        payment_reference is not null and count(*) over (partition by payment_reference) > 1 as repeated_reference_flag
        from one_payments p left join one_accounts a using (account_id)""",
    "clean_daily_targeting": """select t.*, a.borrower_id, c.channel as campaign_channel, c.strategy_version from targets t
        left join one_accounts a using (account_id) left join one_campaigns c using (campaign_id)""",
    "clean_dq_account_borrower_conflicts": "select * from conflicts",
    "clean_quarantine_orphans": " union all ".join(
        f"select '{label}' as source, e.{key} as event_id, e.account_id from stg_{t} e "
        "left join one_accounts a using (account_id) where a.account_id is null"
        for label, t, key in (
            ("CALL", "calls", "call_id"),
            ("PAYMENT", "payments", "payment_id"),
            ("ATTEMPT", "call_attempts", "attempt_id"),
        )
    ),
    "vendors_current": "select * from one_vendors",
    "payments_first_kept": "select * replace (cast(amount as double) as amount) from first_payments",
    "calls_first_kept": "select * from first_calls",
}

_TABLES = [n.removeprefix("raw_") for n in CTES if n.startswith("raw_")]
_CASTS = {
    "accounts": "principal_amount:decimal(18,2) outstanding_amount:decimal(18,2) dpd:decimal(18,6) opened_at:timestamp",
    "borrowers": "created_at:timestamp updated_at:timestamp",
    "agents": "joined_at:timestamp updated_at:timestamp",
    "payments": "event_at:timestamp amount:decimal(18,2)",
    "calls": "event_at>event_at_local:timestamp duration_sec:decimal(18,6)",
    "call_attempts": "event_at>event_at_local:timestamp attempt_no:decimal(18,6)",
    "call_dispositions": "event_at>event_at_local:timestamp",
    "daily_targeting": "target_date:date priority:decimal(18,6)",
    "campaigns": "start_at:timestamp end_at:timestamp",
    "promises_to_pay": "event_at>event_at_local:timestamp promised_amount:decimal(18,2) promised_date:timestamp",
    "whatsapp_events": "event_at:timestamp",
    "sms_events": "event_at:timestamp",
    "field_visits": "event_at:timestamp latitude:decimal(9,6) longitude:decimal(9,6) scheduled_at:timestamp",
    "agent_sessions": "login_at:timestamp logout_at:timestamp",
    "account_status_history": "event_at:timestamp recorded_at:timestamp",
    "complaints": "event_at:timestamp resolution_at:timestamp",
}


def _cast_failures() -> str:
    parts = []
    for table, columns in _CASTS.items():
        for item in columns.split():
            names, _, kind = item.partition(":")
            raw, _, staged = names.partition(">")
            parts.append(
                f"""select '{table}' as "table", '{staged or raw}' as "column",
                count(*) filter (trim(cast({raw} as varchar)) <> '' and try_cast({raw} as {kind}) is null) as failed from raw_{table}"""
            )
    return " union all ".join(parts)


def _dup(table: str, key: str) -> str:
    return f"""select count(*) filter (n > 1) as affected, count(*) as total
        from (select {key}, count(*) as n from stg_{table} where {key} is not null group by 1)"""


CTES |= {
    "dup_calls": """select count(*) filter (n > 1) as affected, count(*) as total,
        count(*) filter (n > 1 and times > 1) as conflicting from (select call_id, count(*) as n,
            count(distinct event_at_local) as times from stg_calls where call_id is not null group by 1)""",
    "collisions": """select count(*) filter (n > 1) as affected, count(*) as total from (select payment_reference,
        count(distinct account_id) as n from stg_payments where payment_reference is not null group by 1)""",
    "unstable": """select count(*) filter (greatest(a, b, c, d) > 1) as affected, count(*) as total from (select agent_id,
        count(distinct employee_code) as a, count(distinct vendor_id) as b, count(distinct team) as c,
        count(distinct agent_name) as d from stg_agents where agent_id is not null group by 1)""",
    "contradictions": """select count(*) filter (rpc_like and (c.call_id is null or c.call_status is distinct from 'ANSWERED'))
            as affected,
        count(*) filter (rpc_like and c.call_id is not null and c.call_status is distinct from 'ANSWERED') as not_answered,
        count(*) filter (rpc_like and c.call_id is null) as unmatched, count(*) as total
        from (select call_id, disposition_code_raw in ('PTP', 'PROMISE_TO_PAY', 'PAID', 'CALLBACK') as rpc_like
            from stg_call_dispositions) d left join first_calls c on c.call_id = d.call_id""",
    "late": """select count(*) filter (recorded_at > event_at + interval '24' hour) as affected, count(*) as total
        from stg_account_status_history""",
    "overwritten": """select count(*) filter (n > 1) as affected, count(*) as total from (select borrower_id,
        count(distinct phone) as n from stg_borrowers where borrower_id is not null group by 1)""",
    "repeats": """select count(*) filter (n > 1) as affected, count(*) as total from (select account_id, target_date, count(*) as n
        from stg_daily_targeting where account_id is not null and target_date is not null group by 1, 2)""",
    "impact": """select r.n as raw_success_rows, d.n as dedup_success_rows, cast(r.cash - d.cash as double) as cash_removed_by_dedup,
        r.n - d.n as success_rows_removed
        from (select count(*) as n, coalesce(sum(amount), 0) as cash from stg_payments where payment_status = 'SUCCESS') r,
            (select count(*) as n, coalesce(sum(amount), 0) as cash from paid) d""",
    "zones": """select (select count(distinct timezone) from stg_calls) as call_zones,
        (select count(distinct timezone) from stg_accounts) as account_zones,
        (select count(*) from stg_calls) + (select count(*) from stg_accounts) as rows""",
}

_PCT = _div("affected", "total") + " * 100"


def _report_row(issue: str, method: str, treatment: str, source: str, impact: str) -> str:
    return f"""select {issue} as issue, '{method}' as detection_method, '{treatment}' as treatment, cast(affected as bigint) as affected,
        cast(total as bigint) as total, {_PCT} as pct, {impact} as business_impact from {source}"""


_DQ_REPORT = " union all ".join(
    [
        _report_row(
            "'Duplicate payment IDs'",
            "group by payment_id",
            "keep latest row per payment_id; SUCCESS only",
            f"({_dup('payments', 'payment_id')}), impact",
            "format('{:,}', affected) || ' duplicate IDs; ₹' || format('{:,.2f}', cash_removed_by_dedup / 10000000) || ' Cr duplicate SUCCESS value removed'",
        ),
        _report_row(
            "'Payment-reference collision'",
            "group payment_reference by account_id",
            "never use payment_reference as global payment key",
            "collisions",
            "affected || ' references span multiple accounts'",
        ),
        _report_row(
            "'Account-borrower conflict: ' || case source when 'promises_to_pay' then 'PTP' when 'whatsapp_events' then 'WhatsApp' when 'sms_events' then 'SMS' else source end",
            "join on account_id and compare borrower_id",
            "use account_id spine; quarantine conflicting borrower_id",
            "(select source, conflict_rows as affected, total_rows as total from conflicts)",
            "format('{:,}', affected) || '/' || format('{:,}', total) || ' (' || format('{:,.2f}', coalesce("
            + _PCT
            + ", 0)) || '%)'",
        ),
        _report_row(
            "'Agent ID instability'",
            "group agent_id and count distinct identity fields",
            "do not use agent_id alone historically; create effective-dated identity map",
            "unstable",
            "format('{:,}', affected) || '/' || format('{:,}', total) || ' agent IDs have conflicting identity fields'",
        ),
        _report_row(
            "'Duplicate call IDs'",
            "group by call_id",
            "dedupe call_id; investigate timestamp conflicts",
            "dup_calls",
            "format('{:,}', affected) || ' call IDs duplicated; ' || conflicting || ' have conflicting timestamps'",
        ),
        _report_row(
            "'Disposition/status contradiction'",
            "join dispositions to call status",
            "RPC requires ANSWERED call",
            "contradictions",
            "format('{:,}', affected) || ' RPC-like dispositions on non-ANSWERED calls'",
        ),
        _report_row(
            "'Late-arriving events'",
            "compare recorded_at with event_at",
            "watermark + replay/backfill",
            "late",
            "format('{:,.1f}', coalesce(" + _PCT + ", 0)) || '% of status-history rows arrive >24h late'",
        ),
        _report_row(
            "'Mixed timezones'",
            "inspect source timezone fields",
            "normalize to documented reporting timezone; preserve source timezone",
            "(select *, call_zones as affected, rows as total from zones)",
            "'calls use ' || call_zones || ' timezones; accounts use ' || account_zones",
        ),
        _report_row(
            "'Borrower master overwrite'",
            "count distinct borrower attributes by borrower_id",
            "use point-in-time snapshot where available; do not trust current row as historical",
            "overwritten",
            "format('{:,}', affected) || ' borrower IDs have changing phone values'",
        ),
        _report_row(
            "'Repeated account-date targeting'",
            "group account_id,target_date",
            "retain as multiple campaign exposures, not duplicate events",
            "repeats",
            "affected || ' account-date pairs repeat'",
        ),
    ]
)

_RATE = "case when outstanding_amount > 0 then recovered_amount / outstanding_amount end"


def _mean(rate: str) -> str:
    return f"cast(printf('%.11e', avg({rate})) as double)"


def _dpd_strata(stratum: str, name: str) -> str:
    return f"""select month_start, {stratum} as {name}, count(*) as accounts,
        cast(sum(cast(recovered_amount as decimal(18,2))) as double) as recovery, {_mean("rate")} as recovery_rate
        from (select g.*, dpd_band, {_RATE} as rate from gold_cash g join (select account_id, dpd_band from attributes) using (account_id))
        group by 1, 2"""


def _driver(attributes: str, dim: str) -> str:
    return f"""select {dim}, cast(sum(amount) as double) as recovery, count(distinct account_id) as payers,
        {_div("sum(amount)", "count(distinct account_id)")} as recovery_per_payer
        from paid join {attributes} using (account_id) where {dim} is not null group by 1
        order by recovery_per_payer desc nulls last, {dim} asc limit 8"""


def _modal(source: str, column: str, name: str) -> str:
    return _driver(
        f"""(select account_id, {column} as {name} from {source} where account_id is not null and {column} is not null
        group by 1, 2 qualify row_number() over (partition by account_id order by count(*) desc, {column} asc) = 1)""",
        name,
    )


def _growth(source: str, at: str, lo: str, hi: str, columns: str) -> str:
    names = columns.split()
    picks = ", ".join(
        f"max({c}) filter ({at} = {v}) as {side}_{c}" for c in names for side, v in (("from", lo), ("to", hi))
    )
    rates = ", ".join(f"{_div(f'to_{c}', f'from_{c}')} - 1 as {c}_growth" for c in names)
    return f"select *, {rates} from (select {picks} from {source})"


def _strata(dim: str) -> str:
    return f"""select {dim} as stratum, count(distinct account_id) filter (m = 2) as n0, count(distinct account_id) filter (m = 3) as n1,
        cast(coalesce(sum(amount) filter (m = 2), 0) as double) as v0, cast(coalesce(sum(amount) filter (m = 3), 0) as double) as v1
        from (select account_id, amount, extract(month from event_at) as m from paid
            where cast(event_at as date) between date '1998-02-01' and date '1998-03-31')
        join attributes using (account_id) where {dim} is not null group by 1"""


def _simpson(dim: str) -> str:
    return f"""select '{dim}' as dimension, cast(overall as integer) as overall_direction, count(s) as strata,
        count(*) filter (s * overall < 0) as opposing_strata, {_div("count(*) filter (s * overall < 0)", "count(s)")} as opposing_share
        from (select sign(v1 / nullif(n1, 0) - v0 / nullif(n0, 0)) as s,
            sign(sum(v1) over () / nullif(sum(n1) over (), 0) - sum(v0) over () / nullif(sum(n0) over (), 0)) as overall
            from ({_strata(dim)})) group by overall"""


def _contact_rows(horizon: int) -> str:
    sources = (
        ("one_calls", "event_at_local"),
        ("one_whatsapp_events", "event_at"),
        ("one_sms_events", "event_at"),
        ("one_field_visits", "event_at"),
    )
    return " union all ".join(
        f"select account_id from {t} where cast({at} as date) between date '{EXPERIMENT_START}' and date '{EXPERIMENT_START}' + {horizon}"
        for t, at in sources
    )


ORACLE |= {
    "table_profile": " union all ".join(
        f"""select '{t}' as "table", count(*) as rows from stg_{t}""" for t in _TABLES
    ),
    "cast_failures": _cast_failures(),
    "gold_key_violations": """select count(*) as violations from (select account_id, month_start from gold group by 1, 2
        having count(*) > 1)""",
    "dup_payment_ids": _dup("payments", "payment_id"),
    "dup_call_ids": "select * from dup_calls",
    "reference_collision": "select * from collisions",
    "unstable_agents": "select * from unstable",
    "status_contradiction": "select * from contradictions",
    "late_arrivals": "select * from late",
    "mixed_timezones": "select * from zones",
    "borrower_overwrite": "select * from overwritten",
    "repeated_targeting": "select * from repeats",
    "dq_report": _DQ_REPORT,
    "month_starts": f"""select m.month_start, p.payments from months m left join (select {_month("event_at")} as month_start,
        count(*) as payments from paid group by 1) p using (month_start)""",
    "gold_account_month": "select * from gold",
    "features_account_month": "select * from feat",
    "targeting_cohort": "select * from cohort",
    "features_enriched": "select * from enriched",
    "call_hours": "select * from call_hour",
    "local_call_times": f"""select call_id, event_at_utc, {_CALLER} as event_at_caller
        from one_calls""",
    "agent_month_hours": f"""select {_month("login_at")} as month_start, employee_code, canonical_agent_id, channel,
        cast(sum(date_diff('microsecond', login_at, coalesce(logout_at, login_at))) as bigint) / 3.6e9::double as logged_hours,
        cast(sum(greatest(date_diff('microsecond', login_at, logout_at), 0)) filter (logout_at is not null) as bigint)
            / 3.6e9::double as clipped_hours,
        count(distinct session_id) as sessions
        from one_agent_sessions left join one_agents using (agent_id) group by 1, 2, 3, 4""",
    "monthly_kpis": "select * from kpis",
    "monthly_kpis_first_kept": _kpis("paid_first"),
    "metrics_monthly": "select * from monthly",
    "ops_monthly": f"""select strftime(m.month_start, '%Y-%m') as month, attempted, answered, rpc,
        {_div("answered", "attempted")} as contact_rate, {_div("rpc", "answered")} as rpc_rate,
        {_div("kept", "resolved")} as ptp_kept_rate, hours as agent_hours, recovery,
        {_div("recovery", "hours")} as recovery_per_agent_hour
        from (select {_month("event_at_local")} as month_start, count(distinct account_id) as attempted,
            count(distinct account_id) filter (call_status = 'ANSWERED') as answered from first_calls group by 1) m
        left join (select {_month("c.event_at_local")} as month_start, count(distinct d.account_id) as rpc
            from one_call_dispositions d join first_calls c using (call_id) where c.call_status = 'ANSWERED'
            and d.disposition_code_raw in ('PTP', 'PROMISE_TO_PAY', 'PAID', 'CALLBACK') group by 1) using (month_start)
        left join (select {_month("event_at")} as month_start, count(*) filter (status = 'KEPT') as kept,
            count(*) filter (status in ('KEPT', 'BROKEN', 'CANCELLED')) as resolved from one_promises_to_pay group by 1)
            using (month_start)
        left join (select {_month("login_at")} as month_start, cast(sum(greatest(date_diff('microsecond', login_at, logout_at), 0))
            filter (logout_at is not null) as bigint) / 3.6e9::double as hours from one_agent_sessions group by 1) using (month_start)
        left join (select {_month("event_at")} as month_start, cast(sum(amount) as double) as recovery from paid group by 1)
            using (month_start)""",
    "channel_14d": "select * from channel_14d",
    "channel_conversion_ranked": "select * from channel_14d order by recovery_14d desc nulls last",
    "investment_scenarios": """select lift, base as annualized_baseline, lift * base as incremental_recovery,
        100000000.0::double as investment_cost, lift * base / 100000000.0::double as gross_benefit_cost,
        (lift * base - 100000000.0::double) / 100000000.0::double as net_roi, 100000000.0::double / base as break_even_lift
        from (select cast(sum(cast(recovery as decimal(28,2))) as double) / count(*) * 12 as base from monthly
            where month_start < date '2001-12-01'), (values (0.02::double), (0.05::double), (0.08::double)) x(lift)""",
    "investment_scenarios_ledger": """select lift, lift * base as incremental_recovery,
        lift * base / 10000000 as incremental_recovery_cr, lift * base / 100000000.0::double as gross_benefit_cost,
        (lift * base / 100000000.0::double - 1) * 100 as net_roi_pct
        from (select cast(sum(cast(recovery as decimal(28,2))) as double) / count(*) * 12 as base from kpis where month < '2001-12'),
        (values (0.0::double), (0.02::double), (0.05::double), (0.08::double)) x(lift)""",
    "growth_pivot": _growth("monthly", "month_start", "date '1998-02-01'", "date '1998-03-01'", "recovery"),
    "growth_decomposition": _growth("kpis", "month", "'1998-02'", "'1998-03'", "recovery payers recovery_per_payer"),
    "two_months": """select month_start, payer_accounts, recovery_per_payer from monthly
        where month_start in (date '1998-02-01', date '1998-03-01') order by month_start""",
    "dedup_impact": "select * from impact",
    "attribution_sensitivity": f"""select {_month("f")} as month_start, cast(sum(r1) as double) as r1, cast(sum(r7) as double) as r7,
        cast(sum(r14) as double) as r14, cast(sum(r30) as double) as r30 from (select first_target_date as f, account_id, """
    + ", ".join(
        f"sum(amount) filter (cast(event_at as date) between first_target_date and first_target_date + {n}) as r{n}"
        for n in (1, 7, 14, 30)
    )
    + " from cohort left join paid using (account_id) group by 1, 2) group by 1",
    "selection_bias": f"""select ever_targeted_flag, month_start, count(*) as accounts,
        {_div("sum(cast(recovered_amount as decimal(18,2)))", "count(*)")} as recovery_per_account,
        {_div("sum(payer_flag)", "count(*)")} as payer_rate, {_mean("rate")} as recovery_rate_proxy
        from (select *, {_RATE} as rate from enriched) group by 1, 2""",
    "dpd_strata": _dpd_strata("dpd", "dpd"),
    "dpd_strata_banded": _dpd_strata("dpd_band", "dpd_band"),
    "cohort_tenure": f"""select {_month("first_target_date")} as target_cohort_month, months_since_first_target, count(*) as accounts,
        {_div("sum(cast(recovered_amount as decimal(18,2)))", "count(*)")} as recovery_per_account,
        {_div("sum(payer_flag)", "count(*)")} as payer_rate from enriched
        where first_target_date is not null and months_since_first_target between 0 and 5 group by 1, 2""",
    "denominator_check": f"""select month_start, n, paid_accounts, {_div("paid_accounts", "n")} as payer_rate
        from (select month_start, count(distinct account_id) as n from gold_cash group by 1)
        left join (select month_start, count(distinct account_id) as paid_accounts from gold_cash where recovered_amount > 0 group by 1)
        using (month_start)""",
    "call_hour_contact": f"""select month_start, local_hour, cast(sum(calls) as bigint) as calls,
        cast(sum(answered_calls) as bigint) as answered, {_div("sum(answered_calls)", "sum(calls)")} as contact_rate
        from call_hour group by 1, 2""",
    "agent_tenure": f"""select band as tenure_band, cast(sum(recovery) as double) as recovery,
        cast(sum(seconds) as bigint) / 3600.0::double as handled_hours,
        {_div("sum(recovery)", "(cast(sum(seconds) as bigint) / 3600.0::double)")} as recovery_per_agent_hour from (
        select p.*, case when tenure is null then 'unknown' when tenure < 3 then '<3m' when tenure < 6 then '3-6m'
            when tenure < 12 then '6-12m' else '12m+' end as band from (
            select p.*, (p.month_start - {_month("joined_at")}) / 30.0::double as tenure from (
                select employee_code, month_start, sum(seconds) as seconds,
                    sum(cast(recovered_amount as decimal(18,2))) as recovery from (
                    select a.employee_code, c.account_id, {_month("c.event_at_utc")} as month_start, sum(c.duration_sec) as seconds
                    from one_calls c join one_agents a using (agent_id) where a.employee_code is not null group by 1, 2, 3)
                left join gold_cash using (account_id, month_start)
                where month_start between date '1995-01-01' and date '2001-12-01' group by 1, 2) p
            join (select employee_code, min(joined_at) as joined_at from identity group by 1) using (employee_code)) p
        where tenure is null or tenure >= 0) group by 1""",
    "vendor_stability": f"""select {_month("c.event_at_utc")} as month_start, c.vendor_id, v.vendor_name, count(distinct c.call_id) as calls,
        count(distinct c.call_id) filter (c.call_status = 'ANSWERED') as answered, count(d.disposition_id) as dispositions,
        count(d.disposition_id) filter (d.call_answered_flag) as answered_dispositions
        from one_calls c left join one_vendors v using (vendor_id) left join dispositions d on d.call_id = c.call_id group by 1, 2, 3""",
    "targeted_vs_never": f"""select case when t.account_id is null then 'never_targeted' else 'ever_targeted' end as "group",
        count(*) as accounts, cast(coalesce(sum(cash), 0) as double) / 10000000 as recovery_cr,
        cast(sum(outstanding_amount) as double) as current_outstanding_proxy,
        {_div("coalesce(sum(cash), 0)", "sum(outstanding_amount)")} as recovery_yield_proxy from one_accounts a
        left join cohort t using (account_id) left join (select account_id, sum(amount) as cash from paid
            where event_at >= timestamp '1995-01-01' and event_at < timestamp '2001-12-01' group by 1) p using (account_id)
        group by 1""",
    "channel_yield": f"""select channel, accounts, cast(coalesce(cash, 0) as double) as recovery, cast(exposure as double) as exposure,
        cast(coalesce(cash, 0) as double) / 10000000 as recovery_cr, {_div("coalesce(cash, 0)", "exposure")} as yield14
        from (select recommended_channel as channel, count(account_id) as accounts, sum(outstanding_amount) as exposure
            from (select distinct account_id, recommended_channel from targets) left join one_accounts using (account_id) group by 1)
        left join (select channel, sum(amount) as cash from (select distinct p.payment_id, p.amount, t.recommended_channel as channel
            from paid p join targets t on t.account_id = p.account_id
            and t.target_date between cast(p.event_at as date) - 14 and cast(p.event_at as date)) group by 1) using (channel)""",
    "stored_monthly_kpis": "select * from kpis",
    "source_csv_payments": ORACLE["stg_payments"],
    "source_csv_rejects": """select 8::bigint as fields, count(*) as rejected, count(*) as lines from raw_borrowers where borrower_id like '%7'""",
    "source_table_agents": ORACLE["stg_agents"],
    "source_view_payments": """select payment_status, count(*) as rows, cast(sum(amount) as double) as amount from stg_payments group by 1""",
    "zone_labels": """select timezone as label, count(*) as rows, coalesce(any_value(timezone in (select name from pg_timezone_names())
            or regexp_full_match(timezone, '[+-](0?[0-9]|1[0-7])(:[0-5][0-9])?|[+-]18(:00)?')), false) as resolved from stg_calls group by 1""",
    "touch_multiplicity": """select case n when 0 then '0' when 1 then '1' else 'many' end as candidate_touches, count(*) as payments,
        cast(sum(amount) as double) as amount, count(*) filter (target) as after_target, count(*) filter (call) as after_call,
        count(*) filter (message) as after_message, count(*) filter (visit) as after_visit from (
            select payment_id, any_value(amount) as amount, count(kind) as n, coalesce(bool_or(kind = 'target'), false) as target,
                coalesce(bool_or(kind = 'call'), false) as call, coalesce(bool_or(kind = 'message'), false) as message,
                coalesce(bool_or(kind = 'visit'), false) as visit from paid left join (
                select account_id, target_date as day, 'target' as kind, 14 as days from targets
                union all select account_id, cast(event_at_local as date), 'call', 7 from one_calls
                union all select account_id, cast(event_at as date), 'message', 3 from one_whatsapp_events
                union all select account_id, cast(event_at as date), 'message', 3 from one_sms_events
                union all select account_id, cast(event_at as date), 'visit', 30 from one_field_visits) t
            on t.account_id = paid.account_id and cast(paid.event_at as date) between day and day + days
            where paid.account_id is not null and paid.event_at is not null group by 1) group by 1""",
    "target_multiplicity": """select case n when 0 then '0' when 1 then '1' else 'many' end as candidate_touches,
        count(*) as payments, cast(sum(amount) as double) as amount from (select p.payment_id, p.amount, count(t.target_id) as n
        from paid p left join targets t on t.account_id = p.account_id
            and t.target_date between cast(p.event_at as date) - 14 and cast(p.event_at as date) group by 1, 2) group by 1""",
    "age_cohort": f"""select age_band, month_start, count(*) as accounts, count(*) filter (recovered_amount > 0) as payers,
        cast(sum(cast(recovered_amount as decimal(18,2))) as double) as recovery,
        {_div("count(*) filter (recovered_amount > 0)", "count(*)")} as payer_rate,
        {_div("sum(cast(recovered_amount as decimal(18,2)))", "count(*)")} as recovery_per_account
        from (select *, case when age <= 3 then '0-3m' when age <= 6 then '4-6m' when age <= 12 then '7-12m'
            when age <= 24 then '13-24m' else '25m+' end as age_band from (select *,
            date_diff('month', date_trunc('month', opened_at), cast(month_start as timestamp)) as age from gold_cash)) group by 1, 2""",
    "step_check": """select month, recovery, (recovery / nullif(b, 0) - 1) * 100 as vs_before_pct, (recovery / nullif(s, 0) - 1) * 100 as vs_step_pct,
        coalesce(low >= s, false) as sustained from kpis, (select max(recovery) filter (month = '1998-02') as b,
        max(recovery) filter (month = '1998-03') as s, min(recovery) filter (month > '1998-03') as low from kpis)
        where month >= '1998-03'""",
    "driver_loan_type": _driver("attributes", "loan_type"),
    "driver_risk_segment": _driver("attributes", "risk_segment"),
    "driver_state": _driver("attributes", "state"),
    "driver_dpd_band": f"""select dpd_band, cast(coalesce(recovery, 0) as double) as recovery, coalesce(payers, 0) as payers,
        {_div("recovery", "payers")} as recovery_per_payer from (select dpd_band, sum(amount) as recovery,
            count(distinct account_id) as payers from paid join attributes using (account_id) where dpd_band is not null group by 1)
        full join (select unnest(['0-7', '8-30', '31-60', '61-90', '91-180', '181+']) as dpd_band) using (dpd_band)
        order by recovery_per_payer desc nulls last, dpd_band limit 8""",
    "driver_channel": _modal("targets", "recommended_channel", "channel"),
    "driver_campaign": _modal("one_calls", "campaign_id", "campaign"),
    "driver_vendor": _modal("one_calls", "vendor_id", "vendor"),
    "driver_call_hour": _modal(
        f"""(select account_id, cast(extract(hour from {_CALLER}) as integer) as h
        from one_calls)""",
        "h",
        "call_hour",
    ),
    "driver_attempt_intensity": _driver(
        """(select account_id, case when n <= 2 then '1-2' when n <= 5 then '3-5' when n <= 10 then '6-10' when n <= 20 then '11-20'
        else '21+' end as attempt_intensity from (select account_id, count(*) as n from one_call_attempts group by 1))""",
        "attempt_intensity",
    ),
    "driver_borrower_segment": _driver(
        """(select account_id, case when outstanding_amount <= 0 then 'settled' when outstanding_amount <= 2000 then 'small'
        when outstanding_amount <= 5000 then 'middle' when outstanding_amount is not null then 'large' end as borrower_segment
        from one_accounts)""",
        "borrower_segment",
    ),
    "driver_agent_tenure": _modal(
        """(select account_id, case when m <= -1 then 'out_of_range' when m <= 3 then '0-3m' when m <= 6 then '4-6m' when m <= 12 then '7-12m'
        when m <= 24 then '13-24m' when m is not null then '25m+' end as tenure from (select account_id,
        date_diff('month', date_trunc('month', joined_at), date_trunc('month', event_at_utc)) as m
        from one_calls left join one_agents using (agent_id)))""",
        "tenure",
        "agent_tenure",
    ),
    "mix_decomposition": f"""select stratum, n0 as payers_before, n1 as payers_after, w0 as share_before, w1 as share_after,
        r0 as rate_before, r1 as rate_after, (w1 - w0) * r0 as mix_effect, w1 * (r1 - r0) as rate_effect
        from (select *, {_div("n0", "sum(n0) over ()")} as w0, {_div("n1", "sum(n1) over ()")} as w1,
        coalesce({_div("v0", "n0")}, 0) as r0, coalesce({_div("v1", "n1")}, 0) as r1 from ({_strata("risk_segment")}))""",
    "simpson_check": " union all ".join(_simpson(d) for d in ("loan_type", "risk_segment", "dpd_band")),
    "identity_scd2": "select * from scd2",
    "borrower_asof": """select p.payment_id, p.event_at, a.borrower_id, v.known_since, v.phone, v.state
        from one_payments p left join one_accounts a using (account_id) left join (
            select borrower_id, updated_at as known_since, phone, state,
            lead(updated_at) over (partition by borrower_id order by updated_at) as until
            from stg_borrowers where borrower_id is not null and updated_at is not null) v
        on v.borrower_id = a.borrower_id and p.event_at >= v.known_since and (v.until is null or p.event_at < v.until)""",
    "experiment_assignment": "select * from assigned",
    "experiment_readout": f"""select arm, eligible_accounts, payers, recovery_14d, recovery_30d, complaints, contacts,
        {_div("recovery_14d", "eligible_accounts")} as recovery_14d_per_account,
        {_div("recovery_30d", "eligible_accounts")} as recovery_30d_per_account, {_div("payers", "eligible_accounts")} as payer_rate,
        {_div("recovery_30d", "payers")} as recovery_per_payer, {_div("complaints", "eligible_accounts")} as complaints_per_account,
        {_div("contacts", "eligible_accounts")} as contacts_per_account from (
        select arm, count(*) as eligible_accounts, count(*) filter (c30 > 0) as payers, cast(coalesce(sum(c14), 0) as double) as recovery_14d,
        cast(coalesce(sum(c30), 0) as double) as recovery_30d, cast(coalesce(sum(k), 0) as bigint) as complaints,
        cast(coalesce(sum(n), 0) as bigint) as contacts from assigned
        left join (select account_id, sum(amount) filter (cast(event_at as date) <= date '{EXPERIMENT_START}' + 14) as c14, sum(amount) as c30
            from paid where cast(event_at as date) between date '{EXPERIMENT_START}' and date '{EXPERIMENT_START}' + 30 group by 1)
            using (account_id)
        left join (select account_id, count(*) as k from one_complaints
            where cast(event_at as date) between date '{EXPERIMENT_START}' and date '{EXPERIMENT_START}' + 30 group by 1) using (account_id)
        left join (select account_id, count(*) as n from ({_contact_rows(30)}) group by 1) using (account_id) group by 1)""",
}


def compose(final: str) -> str:
    """Prefix `final` with the common table expressions it needs, in dependency order."""
    needed: dict[str, str] = {}

    def visit(sql: str, path: tuple[str, ...]) -> None:
        for name in dict.fromkeys(re.findall(r"(?:\bfrom|\bjoin|,)\s*\(*\s*([a-z_0-9]+)\b", sql)):
            if name in CTES and name not in needed and name not in path:
                visit(CTES[name], (*path, name))
                needed[name] = CTES[name]

    visit(final, ())
    ctes = ",\n".join(f"{name} as ({sql})" for name, sql in needed.items())
    return f"with {ctes}\n{final}"


def oracle_sql() -> dict[str, str]:
    return {name: compose(sql) for name, sql in ORACLE.items()}
