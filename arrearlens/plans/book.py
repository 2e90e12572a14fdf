"""A loan book: the lazily built layer frames over one set of raw tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.attribution import first_targets
from ..operators.calendar import month_column, within
from ..operators.candidates import may_be_among
from ..operators.quality import count_conflicts, quarantine_orphans
from ..functions.calendar import month_of
from ..functions.codes import SUCCESS
from ..sources.layers import create_namespaces, current_version, list_stored, list_table, new_version, read_layer, shared_root, stored_tables, switch_version, write_layer
from ..sources.raw import RawReader
from . import cleaning, features, gold, metrics
from .staging import stage

# Tables deduplicated by key and given their account's borrower: source name -> clean name.
EVENT_TABLES = {
    "calls": "calls",
    "call_attempts": "call_attempts",
    "promises_to_pay": "promises_to_pay",
    "whatsapp_events": "whatsapp_events",
    "sms_events": "sms_events",
    "field_visits": "field_visits",
    "account_status_history": "status_history",
    "complaints": "complaints",
}
# Event sources whose own borrower is checked against the account's.
BORROWER_SOURCES = (
    "calls",
    "call_attempts",
    "call_dispositions",
    "payments",
    "promises_to_pay",
    "field_visits",
    "whatsapp_events",
    "sms_events",
)
ORPHAN_SOURCES = {
    "CALL": ("calls", "call_id"),
    "PAYMENT": ("payments", "payment_id"),
    "ATTEMPT": ("call_attempts", "attempt_id"),
}


class Book:
    """Frames are plans, not data: nothing runs until an action.

    With `materialise`, each layer is written and the next one reads it back, so
    shared work runs once, lineage is cut at durable tables, and every later read
    prunes columns at the scan.
    """

    def __init__(self, raw: RawReader, start: date, end: date):
        self.raw = raw
        self.start = start
        self.end = end
        self._staged: dict[str, DataFrame] = {}
        self._stored: dict[tuple[str, str], Callable[[], DataFrame]] = {}

    def _frame(self, layer: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        stored = self._stored.get((layer, name))
        return stored() if stored else build()

    def is_stored(self, layer: str, name: str) -> bool:
        return (layer, name) in self._stored

    # staging

    def stg(self, table: str) -> DataFrame:
        if table not in self._staged:
            self._staged[table] = stage(self.raw(table), table)
        return self._staged[table]

    # dimensions

    def accounts(self, *need: str) -> DataFrame:
        """Account dimension, limited to `need` (staged names) when given."""
        return self._frame("clean", "accounts", lambda: cleaning.clean_accounts(self.stg("accounts"), need))

    def owners(self) -> DataFrame:
        """Which borrower each account belongs to."""
        return self.accounts("borrower_id_raw").select("account_id", "borrower_id")

    def borrowers(self) -> DataFrame:
        return self._frame("clean", "borrowers", lambda: cleaning.dedupe(self.stg("borrowers"), "borrowers"))

    def identity(self) -> DataFrame:
        return self._frame("clean", "agent_identity", lambda: cleaning.clean_agent_identity(self.stg("agents")))

    def vendors(self) -> DataFrame:
        return cleaning.dedupe(self.stg("vendor_telephony"), "vendor_telephony")

    # events

    def events(self, table: str, *need: str, keep: str = "last") -> DataFrame:
        """Deduplicated events without borrower repair, limited to `need` when given."""
        build = lambda: cleaning.clean_events(self.stg(table), table, need, keep)
        return self._frame("clean", EVENT_TABLES.get(table, table), build) if keep == "last" else build()

    def events_between(self, table: str, first: date, last: date, *need: str) -> DataFrame:
        """Deduplicated events within the closed date range, limited to `need`.

        A stored table prunes its months. A raw one is deduplicated by all copies of the ids
        that have any copy in the range: other ids don't reach the shuffle.
        """
        if self.is_stored("clean", cleaning.clean_name(table)):
            return within(self.events(table, *need), cleaning.event_time(table), (first, last))
        rule, stg = cleaning.RULES[table], self.stg(table)
        seen = within(stg.select(rule.key, rule.order[0]), rule.order[0], (first, last))
        copies = may_be_among(stg, seen, rule.key)
        return within(cleaning.clean_events(copies, table, need), cleaning.event_time(table), (first, last))

    def payments_between(self, first: date, last: date) -> DataFrame:
        """Successful ledger payments within the closed date range."""
        paid = self.events_between("payments", first, last, "account_id", "amount", "payment_status")
        return paid.where(F.col("payment_status") == SUCCESS)

    def payments(self, *need: str, keep: str = "last") -> DataFrame:
        """Successful ledger payments."""
        paid = self.events("payments", "account_id", "amount", "payment_status", *need, keep=keep)
        return paid.where(F.col("payment_status") == SUCCESS)

    def dispositions(self, *need: str, calls: DataFrame | None = None) -> DataFrame:
        """Deduplicated dispositions with standard code and answered flag.

        A plan that deduplicates calls anyway passes them as `calls`, so that Spark
        finds the same shuffle twice and runs it once.
        """
        return self._frame(
            "clean",
            "call_dispositions",
            lambda: cleaning.with_call_status(
                cleaning.clean_events(self.stg("call_dispositions"), "call_dispositions", need),
                self.events("calls", "call_status") if calls is None else calls,
            ),
        )

    def targeting(self) -> DataFrame:
        """Targeting rows; repeated account-dates are separate exposures, not duplicates."""
        return self._frame(
            "clean", "daily_targeting", lambda: self.stg("daily_targeting").where(F.col("target_id").isNotNull())
        )

    def clean(self, name: str) -> DataFrame:
        """A full clean table, as it is stored."""
        return self._frame("clean", name, lambda: self._build_clean(name))

    def _build_clean(self, name: str) -> DataFrame:
        sources = {v: k for k, v in EVENT_TABLES.items()}
        if name in sources:
            return cleaning.attach_account(cleaning.clean_events(self.stg(sources[name]), sources[name]), self.owners())
        if name == "accounts":
            return self.accounts()
        if name == "borrowers":
            return self.borrowers()
        if name == "agent_identity":
            return self.identity()
        if name == "agent_sessions":
            return self.events("agent_sessions")
        if name == "payments":
            return cleaning.clean_payments(self.stg("payments"), self.owners())
        if name == "call_dispositions":
            return cleaning.attach_account(self.dispositions(), self.owners())
        if name == "daily_targeting":
            return cleaning.enrich_targeting(self.stg("daily_targeting"), self.owners(), self.stg("campaigns"))
        if name == "dq_account_borrower_conflicts":
            return count_conflicts({s: self.stg(s) for s in BORROWER_SOURCES}, self.owners())
        if name == "quarantine_orphans":
            return quarantine_orphans({k: (self.stg(t), i) for k, (t, i) in ORPHAN_SOURCES.items()}, self.accounts("account_id"))
        raise KeyError(name)

    # gold and features

    def gold(self, *facts: str, measures: Sequence[str] = ()) -> DataFrame:
        return self._frame("gold", "account_month", lambda: gold.account_months(self, facts, measures))

    def features(self, *facts: str, measures: Sequence[str] = ()) -> DataFrame:
        return self._frame("feat", "account_month", lambda: features.build_features(self.gold(*facts, measures=measures)))

    def cohort(self) -> DataFrame:
        return self._frame("feat", "targeting_cohort", lambda: first_targets(self.targeting()))

    def enriched(self, *facts: str) -> DataFrame:
        """Features with the account's first target, which its row carries before it has months."""
        return self._frame("feat", "account_month_enriched", lambda: self._build_enriched(facts))

    def _build_enriched(self, facts: tuple[str, ...]) -> DataFrame:
        rows = gold.exploded(gold.spans(self, facts, cohort=True), facts)
        return features.cohort_flags(features.build_features(rows))

    def call_hours(self) -> DataFrame:
        return self._frame(
            "feat",
            "call_hour",
            lambda: features.call_hours(self.events("calls", "account_id", "call_status", "event_at_utc")),
        )

    def agent_months(self) -> DataFrame:
        return self._frame(
            "feat",
            "agent_month",
            lambda: features.agent_month(
                self.events("agent_sessions", "logout_at", "agent_id", "channel"),
                cleaning.one_per_agent(self.identity()),
            ),
        )

    # metrics

    def monthly(self) -> DataFrame:
        return self._frame(
            "metrics",
            "monthly",
            lambda: metrics.monthly_metrics(
                self.features("payments", "calls", "dispositions", "promises", measures=metrics.MEASURES)
            ),
        )

    def channel_14d(self) -> DataFrame:
        return self._frame(
            "metrics", "channel_14d", lambda: metrics.channel_conversion(self.targeting(), self.payments())
        )

    def investment_scenarios(self) -> DataFrame:
        return self._frame(
            "metrics",
            "investment_scenarios",
            lambda: metrics.scenarios(self.monthly(), complete_before=self.end),
        )


CLEAN_TABLES = (
    "accounts",
    "borrowers",
    "agent_identity",
    "calls",
    "call_attempts",
    "call_dispositions",
    "payments",
    "daily_targeting",
    "promises_to_pay",
    "whatsapp_events",
    "sms_events",
    "field_visits",
    "agent_sessions",
    "status_history",
    "complaints",
    "dq_account_borrower_conflicts",
    "quarantine_orphans",
)


# Event time by whose month a stored clean table is partitioned.
EVENT_TIME = {
    "calls": "event_at_local",
    "call_attempts": "event_at_local",
    "call_dispositions": "event_at_local",
    "payments": "event_at",
    "daily_targeting": "target_date",
    "promises_to_pay": "event_at",
    "whatsapp_events": "event_at",
    "sms_events": "event_at",
    "field_visits": "event_at",
    "agent_sessions": "login_at",
    "status_history": "event_at",
    "complaints": "event_at",
}


# All stored tables, in the order in which they are built.
LAYER_TABLES = (
    *[("clean", name) for name in CLEAN_TABLES],
    ("gold", "account_month"),
    ("feat", "account_month"),
    ("feat", "targeting_cohort"),
    ("feat", "account_month_enriched"),
    ("feat", "call_hour"),
    ("feat", "agent_month"),
    ("metrics", "monthly"),
    ("metrics", "channel_14d"),
    ("metrics", "investment_scenarios"),
)


def open_book(spark: SparkSession, raw: RawReader, start: date, end: date, root: str | None = None, version: str | None = None) -> Book:
    """A book over layers that an earlier session stored: the current version under `root`, or a named one.

    Tables are read when first asked for; staging still reads `raw`.
    """
    if version is None:
        root = root or shared_root(spark)
        if root is None:
            raise ValueError("name the folder of the layers, or set spark.checkpoint.dir")
        version = current_version(spark, root)
    book = Book(raw, start, end)
    book._stored = {(layer, name): partial(read_layer, spark, layer, name, version) for layer, name in stored_tables(spark, version)}
    return book


def materialise(
    book: Book, spark: SparkSession, root: str | None = None, catalog: bool = False, tables: Sequence[tuple[str, str]] = LAYER_TABLES
) -> str:
    """Write all 26 layer tables, or the named (layer, name) ones, in dependency order, each reading the ones before it.

    `root` is a path in shared storage; without it the folder the cluster names in
    `spark.checkpoint.dir` is used. Every run builds from the raw tables and writes to a
    version folder of its own; only when all tables are there does `root` point to it
    and `book` read from it, so a run that fails or is repeated harms nothing. With
    `catalog` the namespaces are created and list the tables. Returns the version folder.
    """
    root = root or shared_root(spark)
    if root is None:
        raise ValueError("name a folder in shared storage, or set spark.checkpoint.dir")
    version = new_version(root)
    fresh = Book(book.raw, book.start, book.end)

    def store(layer: str, name: str, build: Callable[[], DataFrame], partition_by: tuple[str, ...] = ()) -> None:
        if (layer, name) in tables:
            write_layer(build(), layer, name, version, partition_by)
            fresh._stored[(layer, name)] = partial(read_layer, spark, layer, name, version)

    def with_month(name: str, at: str) -> DataFrame:
        return fresh.clean(name).withColumn(month_column(at), month_of(F.col(at)))

    for name in CLEAN_TABLES:
        at = EVENT_TIME.get(name)
        if at is None:
            store("clean", name, partial(fresh.clean, name))
        else:
            store("clean", name, partial(with_month, name, at), (month_column(at),))
    store("gold", "account_month", fresh.gold, ("month_start",))
    store("feat", "account_month", fresh.features, ("month_start",))
    store("feat", "targeting_cohort", fresh.cohort)
    store("feat", "account_month_enriched", fresh.enriched, ("month_start",))
    store("feat", "call_hour", fresh.call_hours, ("month_start",))
    store("feat", "agent_month", fresh.agent_months)
    store("metrics", "monthly", fresh.monthly)
    store("metrics", "channel_14d", fresh.channel_14d)
    store("metrics", "investment_scenarios", fresh.investment_scenarios)
    list_stored(spark, version, list(fresh._stored))
    switch_version(spark, root, version)
    book._stored = dict(fresh._stored)
    if catalog:
        create_namespaces(spark)
        for layer, name in fresh._stored:
            list_table(spark, layer, name, version)
    return version
