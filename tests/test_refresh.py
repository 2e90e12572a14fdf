"""Stored layers in a new session, CSV records that are not whole, and the bucketed ledger over many batches."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from arrearlens.operators.candidates import may_be_among
from arrearlens.operators.dedup import latest_per_key
from arrearlens.plans.book import Book, LAYER_TABLES, materialise, open_book
from arrearlens.plans.cleaning import RULES, dedupe, dedupe_together
from arrearlens.sources.layers import current_version
from arrearlens.sources.raw import read_raw, rejected_records
from arrearlens.sources.schemas import TABLES
from arrearlens.streaming import payments as ledger
from showcase.queries import END, START, book
from showcase.frames import raw_frames

SF = "/root/testdata/sf0.001"


def same(a, b):
    names = sorted(a.columns)
    a, b = a.select(names), b.select(names)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_another_session_opens_stored_layers(spark, tmp_path):
    writer, root = book(spark, SF), str(tmp_path)
    version = materialise(writer, spark, root)
    other = spark.newSession()
    opened = open_book(other, raw_frames(other, SF), START, END, root)
    assert set(opened._stored) == set(LAYER_TABLES) and len(LAYER_TABLES) == 26
    assert current_version(other, root) == version
    lazy = book(other, SF)
    for name in ("gold", "enriched", "monthly", "call_hours"):
        same(getattr(opened, name)(), getattr(lazy, name)())
    span = date(1998, 3, 1), date(1998, 3, 31)
    same(opened.payments_between(*span).select("payment_id", "amount"), lazy.payments_between(*span).select("payment_id", "amount"))
    again = materialise(writer, spark, root)
    assert open_book(other, raw_frames(other, SF), START, END, root, version).gold().count() == open_book(other, raw_frames(other, SF), START, END, root).gold().count()
    assert again != version


def test_opening_needs_a_folder(spark):
    from arrearlens.sources.layers import shared_root

    if shared_root(spark) is None:
        with pytest.raises(ValueError):
            open_book(spark, raw_frames(spark, SF), START, END)


def exchanges(df):
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return sum("Exchange hashpartitioning" in line and "ReusedExchange" not in line for line in lines)


@pytest.fixture
def without_broadcasts(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_exchanges_stay_few(spark, without_broadcasts):
    b = book(spark, SF)
    gold = exchanges(b.gold())
    assert gold <= 13
    assert exchanges(b.enriched()) <= gold  # targets are there already
    assert exchanges(b.clean("payments")) < 8
    from arrearlens.plans.report import dq_report

    lines = [x for x in dq_report(b)._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x and "Reused" not in x]
    assert sum("SinglePartition" in x for x in lines) <= 1
    # All checks meet in three aggregations.
    assert sum("hashpartitioning(family" in x for x in lines) == 3


def test_wide_account_months_are_not_shuffled(spark, without_broadcasts):
    plan = book(spark, SF).enriched()._jdf.queryExecution().executedPlan().toString()
    above = plan.split("Exchange")[0]
    assert "Generate explode" in above and "SortMergeJoin" in above


def test_events_are_shuffled_once_behind_their_deduplication(spark, without_broadcasts):
    b = book(spark, SF)
    for frame in (b.gold(), b.features(), b.enriched()):
        lines = [x for x in frame._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
        by_account = [x for x in lines if "hashpartitioning(account_id" in x]
        # one for the accounts, one for all their events; none by month or by a value to be counted once
        assert len(by_account) == 2 and not any("month_start" in x or "sub" in x for x in lines)


def test_only_codes_that_count_look_up_their_call(spark, without_broadcasts):
    plan = book(spark, SF).gold()._jdf.queryExecution().executedPlan().toString()
    lookup = next(x for x in plan.splitlines() if "hashpartitioning(call_id" in x and "__event_hash" in x)
    below = plan[plan.index(lookup) + len(lookup) :].split("Exchange")[0]
    assert "INVALID" in below and "Filter" in below  # codes are mapped and chosen below the shuffle


def test_each_value_of_a_month_counts_once(spark):
    raw = {t: f.limit(0) for t, f in ((t, book(spark, SF).raw(t)) for t in TABLES)}
    made = lambda table, rows: spark.createDataFrame([tuple((dict.fromkeys(raw[table].columns) | r).values()) for r in rows], ", ".join(" ".join(t) for t in raw[table].dtypes))
    raw["accounts"] = made("accounts", [{"account_id": a, "opened_at": date(2026, 1, 5)} for a in "ab"])
    days = [(1, "a", "x", 3), (1, "a", "x", 9), (2, "a", "x", 9), (3, "a", "y", 11), (4, "a", None, 20), (5, "c", "z", 20), (6, None, "z", 20)]
    raw["daily_targeting"] = made("daily_targeting", [{"target_id": str(k), "account_id": a, "campaign_id": c, "target_date": date(2026, 2, d)} for k, a, c, d in days])
    raw["call_attempts"] = made("call_attempts", [{"attempt_id": str(k), "account_id": "a", "call_id": c, "event_at": datetime(2026, 2, 3, 4)} for k, c in enumerate(("p", "p", "q", None))])
    raw["calls"] = made("calls", [{"call_id": k, "account_id": "a", "call_status": "answered", "duration_sec": 7, "campaign_id": c, "timezone": "UTC", "event_at": datetime(2026, 2, 3, 4)} for k, c in (("p", "x"), ("q", "x"), ("r", None))])
    codes = [("p", "rpc"), ("p", "PTP"), ("q", "callback"), ("r", "rpc"), ("s", "rpc")]
    raw["call_dispositions"] = made("call_dispositions", [{"disposition_id": str(k), "account_id": "a", "call_id": c, "disposition_code": code, "event_at": datetime(2026, 2, 4)} for k, (c, code) in enumerate(codes)])
    b = Book(raw.__getitem__, date(2026, 1, 1), date(2026, 3, 1))
    got = {(r.account_id, r.month_start.month): r for r in b.enriched().collect()}
    assert set(got) == {(a, m) for a in "ab" for m in (1, 2, 3)}
    counted = {"target_events": 4, "target_campaigns": 2, "attempts": 4, "attempted_calls": 2, "calls": 3, "answered_seconds": 21, "campaigns_touched": 1, "rpc_events": 2, "ptp_events": 1}
    for at, r in got.items():
        assert {m: r[m] for m in counted} == (counted if at == ("a", 2) else dict.fromkeys(counted, 0))
        assert r.last_target_date == (date(2026, 2, 20) if at == ("a", 2) else None)
        assert r.first_target_date == (date(2026, 2, 3) if at[0] == "a" else None)


def test_gold_agrees_however_facts_are_joined(spark):
    b = book(spark, SF)
    whole = b.gold()
    for pair in (("payments", "attempts"), ("targets", "calls")):
        few = b.gold(*pair)
        same(few, whole.select(few.columns))
    three = b.gold("targets", "promises", "calls")
    same(three, whole.select(three.columns))
    enriched = b.enriched("payments", "sms")  # the first target without the targets' measures
    names = ["account_id", "month_start", "first_target_date", "months_since_first_target", "recovered_amount", "sms_events"]
    same(enriched.select(names), b.enriched().select(names))


def test_tables_deduplicated_together_agree_with_each_alone(spark):
    b = book(spark, SF)
    needs = {"payments": ["amount", "payment_status"], "call_attempts": ["call_id"], "promises_to_pay": ["promised_amount"], "complaints": ["account_id"], "field_visits": ["outcome"]}
    once, names = dedupe_together({t: (b.stg(t), t, need) for t, need in needs.items()})
    for table, need in needs.items():
        columns = [RULES[table].key, *RULES[table].order, *need]
        mine = once.where(F.col("source") == table).select(*[F.col(names[table][c]).alias(c) for c in columns])
        same(mine, dedupe(b.stg(table), table, need).select(columns))


def test_candidates_lose_nothing(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("v")).unionByName(spark.sql("select cast(null as string) as k, 1L as v"))
    seen = rows.where("v = 3").select("k")
    for bits in (64, 1 << 14, 1 << 24):
        got = may_be_among(rows, seen, "k", bits)
        assert seen.join(got, "k", "left_anti").where("k is not null").isEmpty() and got.where("k is null").isEmpty()
    assert may_be_among(rows, seen, "k").count() < 800
    assert may_be_among(rows, seen.limit(0), "k").isEmpty()


def test_window_reads_only_candidates(spark):
    b = book(spark, SF)
    span = date(1998, 3, 1), date(1998, 3, 31)
    whole = b.payments().where(F.col("event_at").cast("date").between(*map(F.lit, span)))
    got = b.payments_between(*span)
    same(got.select("payment_id", "amount", "account_id"), whole.select("payment_id", "amount", "account_id"))


def test_records_that_are_not_whole(spark, tmp_path):
    names = [f.raw for f in TABLES["agents"]]
    good = ",".join(f"v{k}" for k in range(len(names)))
    folder = tmp_path / "agents.csv"
    folder.mkdir()
    (folder / "1.csv").write_text("\n".join([",".join(names), good, "short,row", good, "", good + ",more", '"' + good.replace("v0", 'v0""x', 1).replace(",", '",', 1)]) + "\n")
    (folder / "2.csv").write_text("\n".join([",".join(names), *[good] * 50, '"open,' + good, good]) + "\n")
    bad = {(r.file.rsplit("/", 1)[1], r.line): r.record for r in rejected_records(spark, str(tmp_path), "agents").collect()}
    assert bad[("1.csv", 3)] == "short,row" and bad[("1.csv", 6)].endswith(",more") and bad[("2.csv", 52)].startswith('"open')
    assert set(bad) == {("1.csv", 3), ("1.csv", 6), ("2.csv", 52)}
    assert read_raw(spark, str(tmp_path), "agents", whole_only=True).count() == 2 + 1 + 51
    assert read_raw(spark, str(tmp_path), "agents").count() == 57


def test_lines_are_numbered_over_blocks(spark, tmp_path):
    from arrearlens.sources.raw import numbered_lines

    (tmp_path / "t.txt").write_text("".join(f"{k:07d}\n" for k in range(1, 20_001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16000")
    try:
        lines = numbered_lines(spark, str(tmp_path / "t.txt"))
        assert lines.where("line <> cast(value as int)").isEmpty() and lines.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_ledger_work_follows_the_batch(spark, tmp_path):
    """Fifty small batches: files read stay within the buckets touched, results equal a replay of the log."""
    root, rng = str(tmp_path / "ledger"), random.Random(7)
    schema = ledger._staged_schema(spark)
    sink = ledger.ledger_sink(root, buckets=64)
    empty = dict.fromkeys(schema.names)
    for batch in range(50):
        rows = [
            empty
            | {
                "payment_id": f"p{rng.randrange(60)}",
                "account_id": "a",
                "event_at": datetime(2026, 1, 1 + rng.randrange(5), rng.randrange(24)),
                "amount": Decimal(rng.randrange(1, 9)),
                "payment_status": rng.choice(["SUCCESS", "SUCCESS", "FAILED"]),
            }
            for _ in range(2)
        ]
        frame = spark.createDataFrame([tuple(r[n] for n in schema.names) for r in rows], schema)
        sink(frame, batch)
        if batch in (20, 49):  # a batch tried again
            sink(frame, batch)
    costs = ledger.batch_costs(spark, root).collect()
    assert {r.batch for r in costs} == {48, 49} and all(r.files_read <= 4 for r in costs)
    everything = spark.read.schema(schema).parquet(*[str(p) for p in (tmp_path / "ledger" / "payment_log").glob("batch=*/day=*")])
    rule = RULES["payments"]
    want = latest_per_key(everything, rule.key, rule.order, ties=rule.ties)
    same(ledger.current_ledger(spark, root), want)
    days = {r.day: (r.recovery, r.payments) for r in ledger.daily_totals(spark, root).collect()}
    paid = {r.d: (r.s, r.n) for r in want.where("payment_status = 'SUCCESS'").groupBy(F.col("event_at").cast("date").alias("d")).agg(F.sum("amount").cast("decimal(18,2)").alias("s"), F.count(F.lit(1)).alias("n")).collect()}
    seen = {r[0] for r in everything.select(F.col("event_at").cast("date")).distinct().collect()}
    assert days == {d: paid.get(d, (Decimal("0.00"), 0)) for d in seen}
    ledger.replay(spark, root, again := str(tmp_path / "again"), buckets=8)
    same(ledger.current_ledger(spark, again), want)
    with pytest.raises(ValueError, match="64 buckets"):
        ledger.ledger_sink(root, buckets=8)(everything.limit(1), 50)
    held = list((tmp_path / "ledger" / "ledger").glob("batch=*/bucket=*"))
    assert len(held) <= 64 + 4  # superseded files are gone
