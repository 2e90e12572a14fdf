from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from arrearlens.operators import quality
from arrearlens.operators.calendar import within
from arrearlens.plans import metrics
from arrearlens.plans.book import CLEAN_TABLES, Book, materialise
from arrearlens.plans.cleaning import dedupe
from arrearlens.plans.report import dq_report
from arrearlens.sources.layers import (
    create_namespaces,
    current_version,
    list_table,
    read_layer,
    register_views,
    shared_root,
    write_layer,
    write_result_csv,
)
from arrearlens.sources.raw import raw_reader, read_raw
from arrearlens.sources.schemas import TABLES
from showcase.frames import RAW_SQL
from showcase.oracle import oracle_sql
from showcase.queries import book
from showcase.queries import queries as showcase_queries

SF = "/root/testdata/sf0.001"

# Published monthly recovery, payers, payments.
PUBLISHED = [
    ("2026-01", 187229127.59, 2374, 2464),
    ("2026-02", 170142453.76, 2173, 2268),
    ("2026-03", 188912374.02, 2419, 2524),
    ("2026-04", 175138043.41, 2304, 2406),
    ("2026-05", 184250278.50, 2344, 2449),
    ("2026-06", 175559726.97, 2286, 2366),
    ("2026-07", 187242265.08, 2335, 2441),
    ("2026-08", 47109695.31, 608, 616),
]


@pytest.fixture(scope="module")
def published(spark):
    df = spark.createDataFrame(PUBLISHED, "month string, recovery double, payers long, payments long")
    return df.withColumn("recovery_per_payer", F.col("recovery") / F.col("payers"))


def test_published_changes(published):
    rows = {r.month: r for r in metrics.with_changes(published).collect()}
    assert rows["2026-01"].mom_cash_pct is None
    march = rows["2026-03"]
    assert march.recovery_per_payer == pytest.approx(78095.23522943366)
    assert march.mom_cash_pct == pytest.approx(11.031885249801654)
    assert march.mom_payer_pct == pytest.approx(11.32075471698113)
    assert march.mom_rpp_pct == pytest.approx(-0.25949291119513607)
    assert rows["2026-08"].mom_cash_pct == pytest.approx(-74.84024491485819)


def test_published_scenarios(published):
    rows = metrics.published_scenarios(published, (0.0, 0.02, 0.05, 0.08), 100_000_000, "2026-08").collect()
    assert [r.incremental_recovery for r in rows] == pytest.approx([0.0, 43490546.37702857, 108726365.94257143, 173962185.50811428])
    assert [r.net_roi_pct for r in rows] == pytest.approx([-100.0, -56.50945362297143, 8.726365942571434, 73.96218550811429])
    plan = metrics.scenarios(published, complete_before="2026-08", month_column="month").first()
    assert plan.break_even_lift == pytest.approx(0.045987, abs=1e-6)


def test_published_step_did_not_last(published):
    rows = {r.month: r for r in metrics.step_check(published.where("month < '2026-08'"), "2026-02", "2026-03").collect()}
    assert not rows["2026-07"].sustained and rows["2026-07"].vs_step_pct < 0
    row = metrics.growth(published, "2026-02", "2026-03", ["recovery", "payers", "recovery_per_payer"], "month").first()
    assert row.recovery_growth == pytest.approx(0.1103188524980165)


def test_every_table_has_a_frame():
    assert set(RAW_SQL) == set(TABLES) and len(TABLES) == 17


def test_every_query_has_sql():
    assert set(showcase_queries()) == set(oracle_sql()) <= set(entry.queries())


def test_pruned_dedup_agrees_with_the_full_one(spark):
    stg = book(spark, SF).stg("calls")
    need = ["account_id", "call_status"]
    cut = dedupe(stg, "calls", need).select("call_id", *need)
    full = dedupe(stg, "calls").select("call_id", *need)
    assert cut.exceptAll(full).isEmpty() and full.exceptAll(cut).isEmpty()
    assert "borrower_id_raw" not in dedupe(stg, "calls", need).columns


def test_months_are_looked_up_in_compiled_code(spark):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    whole = plan(book(spark, SF).enriched())
    assert "lambda" not in whole
    # sums of money stay whole numbers until a month is looked up
    assert "sum(cast(money" not in whole and "decimal(28,2)" not in whole
    # the check of the keys still joins the facts to the accounts
    assert "Join LeftOuter" in plan(showcase_queries()["gold_key_violations"](spark, SF))


def test_monthly_metrics_ask_for_their_measures_only(spark):
    b, facts = book(spark, SF), ("payments", "calls", "dispositions", "promises")
    whole = metrics.monthly_metrics(b.features(*facts))
    assert b.monthly().exceptAll(whole).isEmpty() and whole.exceptAll(b.monthly()).isEmpty()
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    # no value is counted once, so rows are not kept apart by campaign
    by_value = [line for line in plan(b.monthly()).splitlines() if "Aggregate [" in line and "sub" in line]
    assert not by_value and "sub" in plan(whole)
    with pytest.raises(ValueError):
        b.gold("payments", "sms", measures=["calls"])


def test_busy_months_are_not_gathered_into_maps(spark):
    plan = book(spark, SF).gold()._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "RepartitionByExpression [account_id" in plan


def test_every_month_comes_once_between_busy_ones(spark):
    raw = {t: f.limit(0) for t, f in ((t, book(spark, SF).raw(t)) for t in TABLES)}
    made = lambda table, rows: spark.createDataFrame(rows, ", ".join(" ".join(t) for t in raw[table].dtypes))
    empty = dict.fromkeys(raw["accounts"].columns)
    opened = {"early": date(2025, 3, 9), "inside": date(2026, 2, 14), "late": date(2026, 7, 1), "idle": date(2025, 1, 1), "none": None}
    raw["accounts"] = made("accounts", [tuple((empty | {"account_id": a, "opened_at": at}).values()) for a, at in opened.items()])
    paid = [("early", d) for d in ((2025, 11), (2026, 1), (2026, 4), (2026, 6), (2026, 7))] + [("inside", (2025, 12)), ("inside", (2026, 1)), ("late", (2026, 5)), ("none", (2026, 3)), ("early", (2026, 4))]
    empty = dict.fromkeys(raw["payments"].columns)
    rows = [empty | {"payment_id": str(k), "account_id": a, "event_at": datetime(*d, 5), "amount": Decimal("1.50"), "payment_status": "success"} for k, (a, d) in enumerate(paid)]
    raw["payments"] = made("payments", [tuple(r.values()) for r in rows])
    b = Book(raw.__getitem__, date(2026, 1, 1), date(2026, 6, 1))
    got = sorted((r.account_id, r.month_start.month, str(r.recovered_amount)) for r in b.gold("payments", "promises", "sms").collect())
    months = {"early": range(1, 7), "inside": range(2, 7), "idle": range(1, 7)}
    sums = {("early", 1): "1.50", ("early", 4): "3.00", ("early", 6): "1.50"}
    assert got == sorted((a, m, sums.get((a, m), "0.00")) for a, ms in months.items() for m in ms)


def test_gold_invariants(spark):
    b = book(spark, SF)
    gold = b.gold("payments").cache()
    assert quality.assert_unique(gold, ["account_id", "month_start"]).isEmpty()
    inside = (
        b.payments()
        .join(gold.select("account_id", "month_start"), "account_id")
        .where(F.trunc("event_at", "MM") == F.col("month_start"))
        .agg(F.sum("amount"))
        .first()[0]
    )
    assert gold.agg(F.sum("recovered_amount")).first()[0] == inside
    gold.unpersist()


def test_unused_facts_are_not_read(spark):
    gold = book(spark, SF).gold("payments", "sms").select("account_id", "month_start", "recovered_amount")
    plan = gold._jdf.queryExecution().optimizedPlan().toString()
    assert "events.parquet" not in plan and "sms" not in plan and plan.count("Join") == 1


def test_layers_round_trip(spark, tmp_path):
    """Stored layers give the same results as lazy ones, and reads prune columns."""
    lazy, stored = book(spark, SF), book(spark, SF)
    root = str(tmp_path)
    first = materialise(stored, spark, root)
    sizes = {key: read().count() for key, read in stored._stored.items()}
    second = materialise(stored, spark, root)  # a run on a stored book starts from raw again
    assert first != second == current_version(spark, root)
    assert sizes == {key: read().count() for key, read in stored._stored.items()} and len(sizes) == 26
    folder = Path(second)
    assert {p.name for p in (folder / "clean").iterdir()} == set(CLEAN_TABLES)
    for name in ("monthly", "channel_14d", "gold"):
        a, b = getattr(lazy, name)(), getattr(stored, name)()
        assert a.select(sorted(a.columns)).exceptAll(b.select(sorted(a.columns))).isEmpty()
        assert a.count() == b.count()
    a, b = dq_report(lazy), dq_report(stored)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    plan = stored.payments().select("amount")._jdf.queryExecution().executedPlan().toString()
    assert "payment_method" not in plan and "PushedFilters: [IsNotNull(payment_status), EqualTo(payment_status,SUCCESS)]" in plan
    recent = within(stored.payments(), "event_at", (date(1998, 3, 5), date(1998, 4, 2)))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_at_month" in plan and "(event_at_month" in plan
    assert recent.count() == within(lazy.payments(), "event_at", (date(1998, 3, 5), date(1998, 4, 2))).count() > 0
    months = sorted(p.name for p in (folder / "gold" / "account_month").glob("month_start=*"))
    assert months[0] == "month_start=1995-01-01" and len(months) == 84


def test_catalog_layers(spark):
    create_namespaces(spark)
    rows = spark.createDataFrame([("a", date(2026, 1, 1)), ("b", date(2026, 2, 1))], "account_id string, month_start date")
    write_layer(rows, "gold", "tiny", partition_by=("month_start",))
    write_layer(rows, "gold", "tiny", partition_by=("month_start",))  # replaces
    assert sorted(r.account_id for r in read_layer(spark, "gold", "tiny").collect()) == ["a", "b"]
    raw = read_raw(spark, "gold", "tiny", "table")
    assert raw.where("month_start = date'2026-02-01'").first().account_id == "b"
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_root(spark) == (f"{named}/arrearlens_layers" if named else None)


def test_listed_layers(spark, tmp_path):
    create_namespaces(spark)
    rows = spark.createDataFrame([("a", date(2026, 1, 1)), ("b", date(2026, 2, 1))], "account_id string, month_start date")
    for version in ("one", "two"):
        write_layer(rows, "gold", "listed", f"{tmp_path}/{version}", ("month_start",))
        list_table(spark, "gold", "listed", f"{tmp_path}/{version}")
    assert sorted(r.account_id for r in spark.table("gold.listed").collect()) == ["a", "b"]
    assert read_layer(spark, "gold", "listed", f"{tmp_path}/one").count() == 2


def test_materialise_needs_a_shared_folder(spark):
    if shared_root(spark) is None:
        with pytest.raises(ValueError):
            materialise(book(spark, SF), spark)


def test_csv_part_files_must_agree(spark, tmp_path):
    folder = tmp_path / "agents.csv"
    folder.mkdir()
    names = [f.raw for f in TABLES["agents"]]
    (folder / "1.csv").write_text(",".join(names) + "\n" + ",".join(["1"] * len(names)) + "\n")
    (folder / "2.csv").write_text(",".join(reversed(names)) + "\n" + ",".join(["2"] * len(names)) + "\n")
    with pytest.raises(Exception, match="header"):
        read_raw(spark, str(tmp_path), "agents").collect()


def test_csv_source_and_sinks(spark, tmp_path):
    path = str(tmp_path)
    rows = [(" 1 ", "a", "B", "2026-01-05 10:00:00", "r", "10.5", "success", "upi", "p", "extra")]
    names = "payment_id account_id borrower_id event_at payment_reference amount payment_status payment_method provider_id other"
    df = spark.createDataFrame(rows, names.split())
    df.select(*reversed(df.columns)).write.option("header", True).csv(f"{path}/payments.csv")
    raw = read_raw(spark, path, "payments")
    assert raw.columns == [f.raw for f in TABLES["payments"]]
    from arrearlens.plans.book import Book

    b = Book(raw_reader(spark, path), date(2026, 1, 1), date(2026, 1, 1))
    row = b.stg("payments").first()
    assert (row.payment_id, row.event_at, row.payment_status) == ("1", datetime(2026, 1, 5, 10), "SUCCESS")
    kpis = metrics.monthly_kpis(b.payments())
    write_result_csv(kpis, f"{path}/monthly_kpis")
    assert spark.read.option("header", True).csv(f"{path}/monthly_kpis").first().recovery == "10.50"
    register_views({"payments": b.stg("payments")})
    assert spark.sql("select count(*) from stg_payments").first()[0] == 1


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["month", "recovery", "payers", "payments"] and df.count() > 0
