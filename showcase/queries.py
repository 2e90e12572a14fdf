"""Registered queries: every operator of the library over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrearlens.functions.calendar import months_apart, to_local
from arrearlens.functions.codes import DPD_LABELS, INVESTMENT_COST
from arrearlens.functions.ratio import band
from arrearlens.operators import attribution, drivers, experiment, identity, quality
from arrearlens.operators.calendar import month_spine
from arrearlens.operators.lookup import attach_account, lookup
from arrearlens.operators.stack import stack
from arrearlens.plans import analysis, cleaning, metrics, report
from arrearlens.plans.book import CLEAN_TABLES, Book, materialise, open_book
from arrearlens.sources.layers import register_views, scratch_folder, write_result_csv
from arrearlens.sources.raw import raw_reader, rejected_records
from arrearlens.sources.schemas import TABLES

from .frames import raw_frames

# The months the supplied tables span.
START, END = date(1995, 1, 1), date(2001, 12, 1)
FROM_MONTH, TO_MONTH = date(1998, 2, 1), date(1998, 3, 1)
EXPERIMENT_START = date(1998, 3, 1)
SEED = "spring"
STRATA = ["dpd_band", "risk_segment", "loan_type"]

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def book(spark: SparkSession, sf_dir: str) -> Book:
    return Book(raw_frames(spark, sf_dir), START, END)


def month_text(day: date) -> str:
    return day.strftime("%Y-%m")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that results compare by value across engines."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(build: Callable[[Book], DataFrame], name: str | None = None):
    """Register `build` under its own name (or the one given)."""
    _QUERIES[name or build.__name__] = lambda spark, sf_dir: plain(build(book(spark, sf_dir)))
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# Staging and cleaning, one query per table.

for _table in TABLES:
    query(lambda b, t=_table: b.stg(t), f"stg_{_table}")

for _table in CLEAN_TABLES:
    query(lambda b, t=_table: b.clean(t), f"clean_{_table}")


@query
def vendors_current(b: Book) -> DataFrame:
    return b.vendors()


@query
def payments_first_kept(b: Book) -> DataFrame:
    return b.events("payments", keep="first")


@query
def calls_first_kept(b: Book) -> DataFrame:
    return b.events("calls", keep="first")


# Profiles and quality checks.


@query
def table_profile(b: Book) -> DataFrame:
    return quality.table_profile({t: b.stg(t) for t in TABLES})


@query
def cast_failures(b: Book) -> DataFrame:
    return stack([quality.cast_failures(b.raw(t), t) for t in TABLES])


@query
def gold_key_violations(b: Book) -> DataFrame:
    return quality.assert_unique(b.gold(), ["account_id", "month_start"]).agg(
        F.count(F.lit(1)).alias("violations")
    )


@query
def dup_payment_ids(b: Book) -> DataFrame:
    return quality.duplicate_keys(b.stg("payments"), "payment_id")


@query
def dup_call_ids(b: Book) -> DataFrame:
    return quality.duplicate_keys(b.stg("calls"), "call_id", "event_at_local")


@query
def reference_collision(b: Book) -> DataFrame:
    return report.reference_collisions(b.stg("payments"))


@query
def unstable_agents(b: Book) -> DataFrame:
    return report.unstable_agents(b.stg("agents"))


@query
def status_contradiction(b: Book) -> DataFrame:
    return report.contradictions(b)


@query
def late_arrivals(b: Book) -> DataFrame:
    return quality.late_share(b.stg("account_status_history"), "event_at", "recorded_at")


@query
def mixed_timezones(b: Book) -> DataFrame:
    return report.mixed_zones(b)


@query
def borrower_overwrite(b: Book) -> DataFrame:
    return quality.unstable_ids(b.stg("borrowers"), "borrower_id", ["phone"])


@query
def repeated_targeting(b: Book) -> DataFrame:
    return quality.repeated_groups(b.stg("daily_targeting"), ["account_id", "target_date"])


@query
def dq_report(b: Book) -> DataFrame:
    return report.dq_report(b)


# Gold and features.


@query
def month_starts(b: Book) -> DataFrame:
    # The spine, with the payments that fall into each month.
    spine = month_spine(b.raw("payments").sparkSession, b.start, b.end)
    per_month = b.payments().groupBy(F.trunc("event_at", "MM").alias("month_start")).agg(F.count(F.lit(1)).alias("payments"))
    return spine.join(per_month, "month_start", "left")


@query
def gold_account_month(b: Book) -> DataFrame:
    return b.gold()


@query
def features_account_month(b: Book) -> DataFrame:
    return b.features()


@query
def targeting_cohort(b: Book) -> DataFrame:
    return b.cohort()


@query
def features_enriched(b: Book) -> DataFrame:
    return b.enriched()


@query
def call_hours(b: Book) -> DataFrame:
    return b.call_hours()


@query
def local_call_times(b: Book) -> DataFrame:
    calls = b.events("calls", "event_at_utc")
    return calls.select(
        "call_id", "event_at_utc", to_local("event_at_utc", "timezone").alias("event_at_caller")
    )


@query
def agent_month_hours(b: Book) -> DataFrame:
    return b.agent_months()


# Sources: what was written is read back through the library's readers.


@query
def source_csv_payments(b: Book) -> DataFrame:
    raw = b.raw("payments")
    folder = scratch_folder(raw.sparkSession)
    write_result_csv(raw, f"{folder}/payments.csv")
    return Book(raw_reader(raw.sparkSession, folder), b.start, b.end).stg("payments")


@query
def source_csv_rejects(b: Book) -> DataFrame:
    """Records with a field too many, where an id holds a bare comma."""
    raw = b.raw("borrowers")
    folder = scratch_folder(raw.sparkSession)
    torn = F.when(F.col("borrower_id").endswith("7"), F.concat(F.col("borrower_id"), F.lit(",more"))).otherwise(F.col("borrower_id"))
    raw.withColumn("borrower_id", torn).write.options(header=True, quote="", escapeQuotes=False).csv(f"{folder}/borrowers.csv")
    bad = rejected_records(raw.sparkSession, folder, "borrowers")
    return bad.groupBy(F.col("fields").cast("long").alias("fields")).agg(F.count(F.lit(1)).alias("rejected"), F.countDistinct("file", "line").alias("lines"))


@query
def source_table_agents(b: Book) -> DataFrame:
    raw = b.raw("agents")
    raw.createOrReplaceGlobalTempView("agents")
    return Book(raw_reader(raw.sparkSession, "global_temp", "table"), b.start, b.end).stg("agents")


@query
def source_view_payments(b: Book) -> DataFrame:
    staged = b.stg("payments")
    register_views({"payments": staged})
    return staged.sparkSession.sql("select payment_status, count(*) as rows, sum(amount) as amount from stg_payments group by payment_status")


@query
def stored_monthly_kpis(b: Book) -> DataFrame:
    """Monthly KPIs by another session, from layers that this one stored."""
    spark = b.raw("payments").sparkSession
    root = scratch_folder(spark)
    materialise(b, spark, root, tables=[("clean", "accounts"), ("clean", "payments")])
    opened = open_book(spark.newSession(), b.raw, b.start, b.end, root)
    return metrics.monthly_kpis(opened.payments())


# Metrics.


@query
def monthly_kpis(b: Book) -> DataFrame:
    return metrics.monthly_kpis(b.payments())


@query
def monthly_kpis_first_kept(b: Book) -> DataFrame:
    return metrics.monthly_kpis(b.payments(keep="first"))


@query
def metrics_monthly(b: Book) -> DataFrame:
    return b.monthly()


@query
def ops_monthly(b: Book) -> DataFrame:
    return metrics.ops_monthly(
        b.events("calls", "account_id", "call_status", keep="first"),
        b.events("call_dispositions", "call_id", "account_id", "disposition_code_raw"),
        b.events("promises_to_pay", "status"),
        b.events("agent_sessions", "logout_at"),
        b.payments(),
    )


@query
def channel_14d(b: Book) -> DataFrame:
    return b.channel_14d()


@query
def investment_scenarios(b: Book) -> DataFrame:
    return b.investment_scenarios()


@query
def investment_scenarios_ledger(b: Book) -> DataFrame:
    complete = month_text(END)
    return metrics.published_scenarios(metrics.monthly_kpis(b.payments()), (0.0, 0.02, 0.05, 0.08), INVESTMENT_COST, complete)


@query
def growth_pivot(b: Book) -> DataFrame:
    return metrics.growth(b.monthly(), FROM_MONTH, TO_MONTH, ["recovery"], "month_start")


@query
def growth_decomposition(b: Book) -> DataFrame:
    kpis = metrics.monthly_kpis(b.payments())
    return metrics.growth(
        kpis,
        month_text(FROM_MONTH),
        month_text(TO_MONTH),
        ["recovery", "payers", "recovery_per_payer"],
        "month",
    )


@query
def two_months(b: Book) -> DataFrame:
    return analysis.two_months(b.monthly(), FROM_MONTH, TO_MONTH)


# Analyses.


@query
def dedup_impact(b: Book) -> DataFrame:
    return analysis.dedup_impact(b.stg("payments"), b.events("payments", "payment_status", "amount"))


@query
def attribution_sensitivity(b: Book) -> DataFrame:
    return attribution.window_sensitivity(b.targeting(), b.payments())


@query
def selection_bias(b: Book) -> DataFrame:
    return analysis.selection_bias(b.enriched("payments", "targets"))


@query
def dpd_strata(b: Book) -> DataFrame:
    return analysis.dpd_strata(b.features("payments"))


@query
def dpd_strata_banded(b: Book) -> DataFrame:
    return analysis.dpd_strata(b.features("payments"), banded=True)


@query
def cohort_tenure(b: Book) -> DataFrame:
    return analysis.cohort_tenure(b.enriched("payments", "targets"))


@query
def denominator_check(b: Book) -> DataFrame:
    return analysis.denominator_check(b.gold("payments"))


@query
def call_hour_contact(b: Book) -> DataFrame:
    return analysis.call_hour_contact(b.call_hours())


@query
def agent_tenure(b: Book) -> DataFrame:
    agents = b.identity()
    return analysis.agent_tenure(
        b.events("calls", "account_id", "agent_id_raw", "event_at_utc"),
        agents,
        cleaning.one_per_agent(agents),
        b.gold("payments"),
        b.start,
        b.end,
    )


@query
def vendor_stability(b: Book) -> DataFrame:
    return analysis.vendor_stability(
        b.events("calls", "call_status", "vendor_id_raw", "event_at_utc"),
        b.vendors(),
        b.events("call_dispositions", "call_id"),
    )


@query
def channel_conversion_ranked(b: Book) -> DataFrame:
    return b.channel_14d().orderBy(F.desc_nulls_last("recovery_14d"))


@query
def targeted_vs_never(b: Book) -> DataFrame:
    return analysis.targeted_vs_never(b.accounts("outstanding_amount"), b.targeting(), b.payments(), b.start, b.end)


@query
def channel_yield(b: Book) -> DataFrame:
    return attribution.channel_yield(b.targeting(), b.payments(), b.accounts("outstanding_amount"))


@query
def touch_multiplicity(b: Book) -> DataFrame:
    messages = stack([b.events(t, "account_id").select("account_id", "event_at") for t in ("whatsapp_events", "sms_events")])
    return attribution.touch_kinds(
        {
            "target": (b.targeting(), "target_date", 14),
            "call": (b.events("calls", "account_id"), "event_at_local", 7),
            "message": (messages, "event_at", 3),
            "visit": (b.events("field_visits", "account_id"), "event_at", 30),
        },
        b.payments(),
    )


@query
def target_multiplicity(b: Book) -> DataFrame:
    return attribution.touch_multiplicity(b.targeting(), b.payments())


@query
def zone_labels(b: Book) -> DataFrame:
    return quality.zone_labels(b.stg("calls"), "timezone")


@query
def age_cohort(b: Book) -> DataFrame:
    return drivers.age_cohort(b.gold("payments"))


@query
def step_check(b: Book) -> DataFrame:
    return metrics.step_check(
        metrics.monthly_kpis(b.payments()), month_text(FROM_MONTH), month_text(TO_MONTH)
    )


# Drivers.


def account_bands(b: Book) -> DataFrame:
    """Account dimension with its bands."""
    return b.accounts().withColumn("dpd_band", drivers.dpd_band())


def account_attributes(b: Book) -> DataFrame:
    """Account dimension with its bands and its borrower's place."""
    accounts = account_bands(b)
    places = b.borrowers().select("borrower_id", "city", "state")
    return lookup(accounts, places, "borrower_id", ["city", "state"])


for _dim, _attributes in (("loan_type", account_bands), ("risk_segment", account_bands), ("state", account_attributes)):
    query(lambda b, d=_dim, a=_attributes: drivers.driver_table(b.payments(), a(b), d), f"driver_{_dim}")


@query
def driver_dpd_band(b: Book) -> DataFrame:
    return drivers.driver_table(b.payments(), account_bands(b), "dpd_band", labels=DPD_LABELS)


def _modal_driver(name: str, source: Callable[[Book], DataFrame], column: str) -> None:
    def build(b: Book) -> DataFrame:
        return drivers.driver_table(b.payments(), drivers.modal_value(source(b), column, name), name)

    query(build, f"driver_{name}")


_modal_driver("channel", lambda b: b.targeting(), "recommended_channel")
_modal_driver("campaign", lambda b: b.events("calls", "account_id", "campaign_id"), "campaign_id")
_modal_driver("vendor", lambda b: b.events("calls", "account_id", "vendor_id_raw"), "vendor_id")
_modal_driver(
    "call_hour",
    lambda b: b.events("calls", "account_id", "event_at_utc").withColumn(
        "local_hour", F.hour(to_local("event_at_utc", "timezone"))
    ),
    "local_hour",
)

INTENSITY = ((0, 2, 5, 10, 20, None), ("1-2", "3-5", "6-10", "11-20", "21+"))
# Months between the joining month of the account's most frequent agent and its call.
TENURE = ((-1, 3, 6, 12, 24, None), ("0-3m", "4-6m", "7-12m", "13-24m", "25m+"))
SEGMENT = ((None, 0, 2000, 5000, None), ("settled", "small", "middle", "large"))


@query
def driver_attempt_intensity(b: Book) -> DataFrame:
    bands = drivers.event_count_band(b.events("call_attempts", "account_id"), *INTENSITY, "attempt_intensity")
    return drivers.driver_table(b.payments(), bands, "attempt_intensity")


@query
def driver_borrower_segment(b: Book) -> DataFrame:
    """Segment proxy: size of the account's outstanding amount."""
    accounts = b.accounts("outstanding_amount").withColumn("borrower_segment", band(F.col("outstanding_amount"), *SEGMENT))
    return drivers.driver_table(b.payments(), accounts, "borrower_segment")


@query
def driver_agent_tenure(b: Book) -> DataFrame:
    agents = cleaning.one_per_agent(b.identity())
    calls = lookup(
        b.events("calls", "account_id", "agent_id_raw", "event_at_utc"), agents, "agent_id", ["joined_at"]
    )
    tenure = band(months_apart(F.col("event_at_utc"), F.col("joined_at")), *TENURE)
    modal = drivers.modal_value(calls.withColumn("tenure", tenure), "tenure", "agent_tenure")
    return drivers.driver_table(b.payments(), modal, "agent_tenure")


@query
def mix_decomposition(b: Book) -> DataFrame:
    return drivers.mix_decomposition(b.payments(), account_bands(b), "risk_segment", FROM_MONTH, TO_MONTH)


@query
def simpson_check(b: Book) -> DataFrame:
    dims = ["loan_type", "risk_segment", "dpd_band"]
    return drivers.simpson_check(b.payments(), account_bands(b), dims, FROM_MONTH, TO_MONTH)


# Identity over time.


@query
def identity_scd2(b: Book) -> DataFrame:
    return identity.effective_dated(
        b.stg("agents"), "agent_id", "updated_at", ["employee_code", "vendor_id", "team", "agent_name"]
    )


@query
def borrower_asof(b: Book) -> DataFrame:
    paid = attach_account(b.events("payments", "account_id"), b.owners()).select(
        "payment_id", "event_at", "borrower_id"
    )
    return identity.as_of(paid, b.stg("borrowers"), "borrower_id", "event_at", "updated_at", ["phone", "state"])


# Experiment.


def assignment(b: Book) -> DataFrame:
    return experiment.stratified_assign(b.accounts().withColumn("dpd_band", drivers.dpd_band()), STRATA, SEED)


@query
def experiment_assignment(b: Book) -> DataFrame:
    return assignment(b)


@query
def experiment_readout(b: Book) -> DataFrame:
    span = EXPERIMENT_START, EXPERIMENT_START + timedelta(days=30)
    return experiment.experiment_readout(
        assignment(b),
        EXPERIMENT_START,
        b.payments_between(*span),
        b.events_between("complaints", *span, "account_id"),
        [
            (b.events_between("calls", *span, "account_id"), "event_at_local"),
            (b.events_between("whatsapp_events", *span, "account_id"), "event_at"),
            (b.events_between("sms_events", *span, "account_id"), "event_at"),
            (b.events_between("field_visits", *span, "account_id"), "event_at"),
        ],
    )
