"""Gold: one row per account and calendar month.

Every fact is declared once, as measures over its events. One or two facts are aggregated by account and
month and joined to the months; more are laid together in slots of equal type:

1. seven event tables that need nothing but one row per key share one deduplication;
2. events are brought together by account, in slots, and added up there by month, fact and the value to be counted
   once, each row updating a few slots instead of all measures;
3. those few rows become measures by account and month, where they lie;
4. accounts, which their own deduplication has already partitioned, meet their busy months by a join without a
   further exchange, and months without events come into being last, by exploding the gaps between busy ones.

Between deduplication and result each event is shuffled once, and wide rows of accounts and their months never. An
account's events meet in one task, which adds them up in passes that may spill. Where no value is to be counted
once, step 2 falls away: events are added up by account and month before each shuffle, and come together by
account last. Money is added in hundredths as whole numbers; as decimals, every row would rewrite every sum of
28 digits.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from decimal import Decimal
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.calendar import month_of
from ..operators.calendar import account_month_base, month_sequence, monthly_measures
from ..operators.stack import stack
from .cleaning import RULES, clean_name, dedupe_together

if TYPE_CHECKING:
    from .book import Book

#: Looks up a column of the fact's events, under whatever name a plan carries it.
Get = Callable[[str], Column]


@dataclass(frozen=True)
class Fact:
    """Events of one kind: where they come from, when they happened, and what is measured.

    `measures` maps a name to its kind (money, number, distinct or latest) and value.
    """

    events: Callable[[Book], DataFrame]
    at: str
    measures: dict[str, tuple[str, Callable[[Get], Column]]]
    where: Callable[[Get], Column] | None = None
    #: Staged table and columns, if one row per key is all that the events need.
    table: str | None = None
    need: tuple[str, ...] = ()


def _one(c: Get) -> Column:
    return F.lit(1).cast("long")


def _if(condition: Callable[[Get], Column], value: Callable[[Get], Column] = _one) -> Callable[[Get], Column]:
    return lambda c: F.when(condition(c), value(c))


def _col(name: str) -> Callable[[Get], Column]:
    return lambda c: c(name)


def _table(table: str, at: str, need: Sequence[str], measures: dict, where: Callable[[Get], Column] | None = None) -> Fact:
    return Fact(lambda book: book.events(table, *need), at, measures, where, table, tuple(need))


def _call_events(book: Book) -> DataFrame:
    return book.events("calls", "account_id", "call_status", "campaign_id", "event_at_utc")


def _is(column: str, *values: str) -> Callable[[Get], Column]:
    return lambda c: c(column).isin(*values)


FACTS: dict[str, Fact] = {
    "payments": _table(
        "payments",
        "event_at",
        ["account_id", "amount", "payment_status"],
        {
            "recovered_amount": ("money", _col("amount")),
            "success_payment_events": ("number", _one),
            # The ledger is unique on payment_id, so counting events counts ids.
            "success_payment_ids": ("number", _if(lambda c: c("payment_id").isNotNull())),
        },
        _is("payment_status", codes.SUCCESS),
    ),
    "attempts": _table(
        "call_attempts",
        "event_at_local",
        ["account_id", "call_id"],
        {"attempts": ("number", _one), "attempted_calls": ("distinct", _col("call_id"))},
    ),
    "calls": Fact(
        _call_events,
        "event_at_utc",
        {
            "calls": ("number", _one),
            "answered_calls": ("number", _if(_is("call_status", codes.ANSWERED))),
            "answered_seconds": ("number", _if(_is("call_status", codes.ANSWERED), _col("duration_sec"))),
            "campaigns_touched": ("distinct", _col("campaign_id")),
        },
    ),
    "dispositions": Fact(
        lambda book: book.dispositions("account_id", "disposition_code_raw", "call_id", calls=_call_events(book)),
        "event_at_local",
        {
            "rpc_events": ("number", _if(_is("disposition_code_std", "RPC"))),
            "ptp_events": ("number", _if(_is("disposition_code_std", "PTP"))),
        },
        # Other codes would add nothing but zeros; without them fewer rows look up their call.
        lambda c: c("call_answered_flag") & c("disposition_code_std").isin("RPC", "PTP"),
    ),
    "targets": Fact(
        lambda book: book.targeting(),
        "target_date",
        {
            "target_events": ("distinct", _col("target_id")),
            "target_campaigns": ("distinct", _col("campaign_id")),
            "last_target_date": ("latest", _col("target_date")),
        },
    ),
    "promises": _table(
        "promises_to_pay",
        "event_at",
        ["account_id", "status", "promised_amount"],
        {
            "ptp_count": ("number", _one),
            "promised_amount": ("money", _col("promised_amount")),
            "ptp_kept_count": ("number", _if(_is("status", codes.KEPT))),
            "ptp_kept_amount": ("money", _if(_is("status", codes.KEPT), _col("promised_amount"))),
        },
    ),
    "whatsapp": _table(
        "whatsapp_events",
        "event_at",
        ["account_id", "event_type"],
        {"whatsapp_events": ("number", _one), "whatsapp_engaged": ("number", _if(_is("event_type", *codes.WHATSAPP_ENGAGED)))},
    ),
    "sms": _table(
        "sms_events",
        "event_at",
        ["account_id", "event_type"],
        {"sms_events": ("number", _one), "sms_engaged": ("number", _if(_is("event_type", *codes.SMS_ENGAGED)))},
    ),
    "visits": _table(
        "field_visits",
        "event_at",
        ["account_id", "outcome"],
        {"field_visits": ("number", _one), "paid_field_visits": ("number", _if(_is("outcome", codes.PAID)))},
    ),
    "complaints": _table("complaints", "event_at", ["account_id"], {"complaints": ("number", _one)}),
}
MONEY = ("recovered_amount", "promised_amount", "ptp_kept_amount")
KEYS = ["account_id", "month_start"]
#: Up to so many facts are joined one by one, which lets Catalyst drop a fact that nobody reads.
JOINED = 2
FIRST_TARGET = "first_target_date"


def filled(measure: str, value: Column) -> Column:
    """Zero where nothing happened; the last target date stays missing."""
    if measure == "last_target_date":
        return value.alias(measure)
    return F.coalesce(value, F.lit(0)).cast("decimal(18,2)" if measure in MONEY else "bigint").alias(measure)


def monthly_fact(book: Book, name: str) -> DataFrame:
    """One fact's measures by account and month."""
    fact = FACTS[name]
    events = fact.events(book)
    if fact.where:
        events = events.where(fact.where(F.col))
    total = {"money": F.sum, "number": F.sum, "distinct": F.countDistinct, "latest": F.max}
    # A second distinct count would triple the rows; campaigns are few enough for a set.
    apart = [m for m, (kind, _) in fact.measures.items() if kind == "distinct"][1:]
    measures = {
        m: F.size(F.collect_set(value(F.col))).cast("long") if m in apart else total[kind](value(F.col))
        for m, (kind, value) in fact.measures.items()
    }
    return monthly_measures(events, F.col(fact.at), measures)


def build_gold(base: DataFrame, facts: Sequence[DataFrame]) -> DataFrame:
    """Join monthly facts, each unique on (account, month), to the months of `base`."""
    joined = base
    for fact in facts:
        joined = joined.join(fact, KEYS, "left")
    measures = [c for fact in facts for c in fact.columns if c not in KEYS]
    return joined.select(*base.columns, *[filled(m, F.col(m)) for m in measures])


# -- facts in common slots ----------------------------------------------------------------------------


def _slots(fact: Fact) -> dict[str, str]:
    """Measure -> slot: money1, money2 ..., number1 ..., latest1, and sub1, sub2 for values counted once."""
    out: dict[str, str] = {}
    for measure, (kind, _) in fact.measures.items():
        place = sum(FACT_SLOT[kind] == s.rstrip("0123456789") for s in out.values()) + 1
        out[measure] = f"{FACT_SLOT[kind]}{place}"
    return out


FACT_SLOT = {"money": "money", "number": "number", "latest": "latest", "distinct": "sub"}
_TYPES = {"money": "bigint", "number": "bigint", "latest": "date", "sub": "string"}
_SLOTS = ("money1", "money2", "number1", "number2", "number3", "latest1", "sub1", "sub2")
_SUMMED = _SLOTS[:5]


def _kind(slot: str) -> str:
    return slot.rstrip("0123456789")


def hundredths(money: Column) -> Column:
    return (money.cast("decimal(18,2)") * 100).cast("bigint")


def as_money(whole: Column) -> Column:
    """The decimal of a whole number of hundredths."""
    return (whole.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def _row(tag: int, fact: Fact, get: Get) -> dict[str, Column]:
    """A fact's event in slots."""
    slots = {slot: fact.measures[m][1](get) for m, slot in _slots(fact).items()}
    slots |= {s: hundredths(c) for s, c in slots.items() if _kind(s) == "money"}
    row = {s: slots.get(s, F.lit(None)).cast(_TYPES[_kind(s)]) for s in _SLOTS}
    return {"account_id": get("account_id"), "month_start": month_of(get(fact.at)), "fact": F.lit(tag)} | row


def asked_facts(facts: Sequence[str] = (), measures: Sequence[str] = ()) -> dict[str, Fact]:
    """The named facts with the named measures (none named: all). Their events stay the same."""
    found = {n: FACTS[n] for n in facts or FACTS}
    if not measures:
        return found
    unknown = set(measures) - {m for f in found.values() for m in f.measures}
    if unknown:
        raise ValueError(f"no fact asked for has {sorted(unknown)}")
    return {n: replace(f, measures={m: v for m, v in f.measures.items() if m in measures}) for n, f in found.items()}


def _together(book: Book, facts: dict[str, Fact], tags: dict[str, int]) -> DataFrame | None:
    """Events of the tables that share one deduplication, in slots."""
    shared = {n: f for n, f in facts.items() if f.table and not book.is_stored("clean", clean_name(f.table))}
    if not shared:
        return None
    once, names = dedupe_together({n: (book.stg(f.table), f.table, f.need) for n, f in shared.items()})

    def get(name: str) -> Get:
        table = facts[name].table
        return lambda column: F.col(names[name][{"event_at": RULES[table].order[0]}.get(column, column)])

    rows = {n: _row(tags[n], f, get(n)) for n, f in shared.items()}
    chosen = {}
    for column in next(iter(rows.values())):
        value = None
        for n, row in rows.items():
            mine = F.col("source") == n
            value = F.when(mine, row[column]) if value is None else value.when(mine, row[column])
        chosen[column] = value
    for n, fact in shared.items():
        if fact.where:
            once = once.where((F.col("source") != n) | fact.where(get(n)))
    return once.select(*[c.alias(k) for k, c in chosen.items()])


def _apart(book: Book, fact: Fact, tag: int) -> DataFrame:
    """Events of a fact that has a deduplication of its own, or none."""
    events = fact.events(book)
    if fact.where:
        events = events.where(fact.where(F.col))
    return events.select(*[c.alias(k) for k, c in _row(tag, fact, F.col).items()])


def _each_value(rows: DataFrame, second: Sequence[int]) -> DataFrame:
    """Rows with the value to be counted once as `sub`. Facts (by tag) with a second such value get one more row
    for it, marked `again` and without numbers."""
    if not second:
        return rows.withColumn("again", F.lit(False)).withColumn("sub", F.col("sub1"))
    both = F.when(F.col("fact").isin(*second), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    once = ~F.col("again")
    numbers = {s: F.when(once, F.col(s)) for s in (*_SUMMED, "latest1")}
    return rows.withColumn("again", F.explode(both)).withColumns(numbers | {"sub": F.when(once, F.col("sub1")).otherwise(F.col("sub2"))})


def busy_months(book: Book, facts: dict[str, Fact], cohort: bool = False) -> DataFrame:
    """(account_id, busy, measures, first_busy, next_busy[, first_target_date]): a row per account and month with events.

    With `cohort` the first target of all is carried along, whatever month it lies in.
    """
    tags = {n: k for k, n in enumerate(facts)}
    together = _together(book, facts, tags)
    held = [n for n, f in facts.items() if together is None or f.table is None or book.is_stored("clean", clean_name(f.table))]
    frames = [_apart(book, facts[n], tags[n]) for n in held]
    if together is not None:
        frames.append(together)
    if cohort and "targets" not in tags:
        tags["targets"] = len(tags)
        frames.append(_apart(book, FACTS["targets"], tags["targets"]).withColumns({s: F.lit(None).cast("string") for s in ("sub1", "sub2")}))
    used = {slot for f in facts.values() for slot in _slots(f).values()}
    rows = stack(frames).where("account_id is not null and month_start is not null")
    target_day = F.when(F.col("fact") == tags.get("targets", -1), F.col("latest1"))
    if "sub1" in used:
        # Rows meet once, by account, as the accounts lie already; all that follows stays there.
        rows = _each_value(rows.repartition("account_id"), [tags[n] for n, f in facts.items() if "sub2" in _slots(f).values()])
        rows = rows.groupBy(*KEYS, "fact", "again", "sub").agg(
            *[F.sum(s).alias(s) for s in _SUMMED], F.max("latest1").alias("latest1"), F.min(target_day).alias("earliest")
        )
    else:
        rows = rows.withColumn("earliest", target_day)

    measures, total = [], {"money": F.sum, "number": F.sum, "latest": F.max, "sub": F.count}
    for name, fact in facts.items():
        for measure, slot in _slots(fact).items():
            mine = F.col("fact") == tags[name]
            if _kind(slot) == "sub":
                mine, value = mine & (F.col("again") == F.lit(slot == "sub2")), F.col("sub")
            else:
                value = F.col(slot)
            measures.append(total[_kind(slot)](F.when(mine, value)).alias(measure))
    per_month = rows.groupBy(*KEYS).agg(*measures, F.min("earliest").alias(FIRST_TARGET)).withColumnRenamed("month_start", "busy")
    if "sub1" not in used:
        # Sums need no value of every row, so they are added up before each shuffle; by account they come together last.
        per_month = per_month.repartition("account_id")
    account = Window.partitionBy("account_id")
    span = {"first_busy": F.lag("busy").over(account.orderBy("busy")).isNull(), "next_busy": F.lead("busy").over(account.orderBy("busy"))}
    if cohort:
        return per_month.withColumns(span | {FIRST_TARGET: F.min(FIRST_TARGET).over(account)})
    return per_month.drop(FIRST_TARGET).withColumns(span)


def spans(book: Book, facts: Sequence[str] = (), cohort: bool = False, measures: Sequence[str] = ()) -> DataFrame:
    """Accounts with each of their busy months, its measures, and the calendar months that the row answers for, for
    `exploded`: from the busy month to the one before the next. An account's first row also answers for all
    months before it; an account without events has one row for its whole calendar."""
    accounts = book.accounts().withColumnRenamed("status", "account_status").drop("schema_version")
    joined = accounts.join(busy_months(book, asked_facts(facts, measures), cohort), "account_id", "left")
    end, opened = F.lit(book.end), month_of(F.col("opened_at"))
    first = F.when(opened <= end, F.greatest(opened, F.lit(book.start)))
    low = F.when(F.coalesce("first_busy", F.lit(True)), first).otherwise(F.greatest(first, "busy"))
    high = F.least(F.add_months("next_busy", -1), end)
    joined = joined.withColumns({"low": low, "high": high}).where("low <= high")
    return joined.withColumn("calendar", month_sequence(F.col("low"), F.col("high"))).drop("low", "high", "first_busy", "next_busy")


def exploded(spanned: DataFrame, facts: Sequence[str] = (), measures: Sequence[str] = ()) -> DataFrame:
    """Gold rows of `spans`: other columns, month_start, measures."""
    asked = [m for f in asked_facts(facts, measures).values() for m in f.measures]
    kept = [c for c in spanned.columns if c not in ("busy", "calendar", *asked)]
    rows = spanned.select(*kept, "busy", *asked, F.explode("calendar").alias("month_start"))
    value = {m: F.when(F.col("month_start") == F.col("busy"), F.col(m)) for m in asked}
    value |= {m: F.when(value[m].isNotNull(), as_money(value[m])) for m in asked if m in MONEY}
    return rows.select(*kept, "month_start", *[filled(m, value[m]) for m in asked])


def account_months(book: Book, facts: Sequence[str] = (), measures: Sequence[str] = ()) -> DataFrame:
    """Gold table with all ten facts and measures, or only the named ones."""
    if 0 < len(facts) <= JOINED:
        accounts = book.accounts().withColumnRenamed("status", "account_status").drop("schema_version")
        base = account_month_base(accounts, book.start, book.end)
        joined = build_gold(base, [monthly_fact(book, f) for f in facts])
        asked = [m for f in asked_facts(facts, measures).values() for m in f.measures]
        return joined.select(*base.columns, *asked)
    return exploded(spans(book, facts, measures=measures), facts, measures)
