import random
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from arrearlens.functions.calendar import clipped_micros, days_in_month, months_apart, on_days, to_local, to_utc
from arrearlens.functions.codes import DISPOSITION_GROUPS, DPD_EDGES, DPD_LABELS
from arrearlens.functions.conform import KINDS, map_codes
from arrearlens.functions.ratio import band, change_pct, stable_mean, safe_div
from arrearlens.operators import quality
from arrearlens.operators.attribution import (
    channel_conversion,
    channel_yield,
    touch_multiplicity,
    window_recovery,
    window_sensitivity,
)
from arrearlens.operators.calendar import account_month_base, month_spine
from arrearlens.operators.dedup import flag_repeated, latest_per_key
from arrearlens.operators.drivers import driver_table, mix_decomposition, modal_value, simpson_check
from arrearlens.operators.experiment import stratified_assign
from arrearlens.operators.identity import as_of, canonical_id, effective_dated
from arrearlens.operators.lookup import attach_account, lookup, without_match


def dicts(df, *order):
    rows = [r.asDict() for r in df.collect()]
    return sorted(rows, key=lambda r: tuple(str(r[c]) for c in order)) if order else rows


def scalar(spark, kind, value):
    df = spark.createDataFrame([(value,)], "c string")
    return df.selectExpr(KINDS[kind].format(c="c")).first()[0]


@pytest.mark.parametrize(
    "kind, raw, want",
    [
        ("id", "  a1 ", "a1"),
        ("id", "   ", None),
        ("code", " paid ", "PAID"),
        ("version", " V2", "v2"),
        ("email", " A@B.C ", "a@b.c"),
        ("money", "12.345", Decimal("12.35")),
        ("money", "n/a", None),
        ("int", "2.5", 3),
        ("int", "x", None),
        ("int0", None, 0),
        ("time", "2026-01-02 03:04:05", datetime(2026, 1, 2, 3, 4, 5)),
        ("time", "soon", None),
        ("date", "2026-01-02", date(2026, 1, 2)),
    ],
)
def test_conform(spark, kind, raw, want):
    assert scalar(spark, kind, raw) == want


def test_codes_and_bands(spark):
    df = spark.createDataFrame([("PTP",), ("CALL_BACK",), ("PAID",), (None,)], "c string")
    got = [r[0] for r in df.select(map_codes(F.col("c"), DISPOSITION_GROUPS)).collect()]
    assert got == ["PTP", "CALLBACK", "OTHER", "OTHER"]
    df = spark.createDataFrame([(x,) for x in (-1, 0, 7, 8, 180, 181, 999, 1000, None)], "d int")
    got = [r[0] for r in df.select(band(F.col("d"), DPD_EDGES, DPD_LABELS)).collect()]
    assert got == ["out_of_range", "0-7", "0-7", "8-30", "91-180", "181+", "181+", "out_of_range", None]


def test_ratios(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 0.0), ("c", 5.0, None)], "m string, x double, y double")
    assert [r[0] for r in df.select(safe_div(F.col("x"), F.col("y"))).collect()] == [0.5, None, None]
    assert [r.p for r in change_pct(df, "x", "m", "p").collect()] == pytest.approx([None, 200.0, 200 / 3])
    assert df.agg(stable_mean(F.col("x"))).first()[0] == 3.0


def test_calendar(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 1, 1, 0, 30), "Asia/Kolkata"), (datetime(2026, 1, 1), None), (datetime(2026, 1, 1), "Mars/Base")],
        "t timestamp_ntz, z string",
    ).withColumn("u", to_utc("t", "z"))
    # Half past midnight in Kolkata is still the old year in UTC.
    assert [r.u for r in df.collect()] == [
        datetime(2025, 12, 31, 19, 0),
        datetime(2025, 12, 31, 18, 30),
        datetime(2025, 12, 31, 18, 30),
    ]
    assert [r[0] for r in df.select(to_local("u", "z")).collect()] == [r.t for r in df.collect()]
    days = spark.createDataFrame([(date(2024, 2, 1), date(2023, 12, 31))], "a date, b date")
    assert days.select(days_in_month(F.col("a")), months_apart(F.col("a"), F.col("b"))).first()[:] == (29, 2)
    spans = spark.createDataFrame(
        [(datetime(2026, 1, 1, 10), datetime(2026, 1, 1, 9)), (datetime(2026, 1, 1, 10), None)], "a timestamp_ntz, b timestamp_ntz"
    )
    assert [r[0] for r in spans.select(clipped_micros(F.col("a"), F.col("b"))).collect()] == [0, None]
    edge = spark.createDataFrame([(datetime(2026, 1, 31, 23, 59, 59),), (datetime(2026, 2, 1),)], "t timestamp_ntz")
    assert [r[0] for r in edge.select(on_days(F.col("t"), date(2026, 1, 1), date(2026, 1, 31))).collect()] == [True, False]


def test_latest_per_key_is_deterministic(spark):
    rows = [("k", None, 9, "z"), ("k", 2, 5, "b"), ("k", 2, 5, "a"), ("k", 1, 7, "c"), (None, 3, 1, "x"), ("s", None, 1, "y")]
    df = spark.createDataFrame(rows, "k string, t int, n int, v string")
    want_last = {"k": "a", "s": "y"}
    for part in (1, 3, 6):
        shuffled = df.repartition(part).orderBy(F.rand(part))
        got = {r.k: r.v for r in latest_per_key(shuffled, "k", ["t"]).collect()}
        assert got == want_last  # a missing time never wins, ties fall to the smallest remaining values
    first = {r.k: r.v for r in latest_per_key(df, "k", ["t"], keep="first").collect()}
    assert first == {"k": "c", "s": "y"}
    once = latest_per_key(df, "k", ["t"])
    assert dicts(latest_per_key(once, "k", ["t"]), "k") == dicts(once, "k")
    with pytest.raises(ValueError):
        latest_per_key(df, "k", ["t"], keep="any")


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as t")
    plan = latest_per_key(df, "k", ["t"])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below  # ranked inside the map tasks, not only after them


def test_flag_repeated(spark):
    df = spark.createDataFrame([(1, "r"), (2, "r"), (3, "s"), (4, None), (5, None)], "id int, ref string")
    got = {r.id: r.rep for r in flag_repeated(df, "ref", "rep").collect()}
    assert got == {1: True, 2: True, 3: False, 4: False, 5: False}


def test_lookup_keeps_every_event(spark):
    events = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, "z"), (4, "a", "w")], "id int, account_id string, borrower_id_raw string")
    accounts = spark.createDataFrame([("a", "B1"), ("c", "B3")], "account_id string, borrower_id string")
    got = dicts(attach_account(events, accounts), "id")
    assert [(r["id"], r["borrower_id"]) for r in got] == [(1, "B1"), (2, None), (3, None), (4, "B1")]
    assert "borrower_id_raw" not in got[0]
    assert sorted(r.id for r in without_match(events, accounts, "account_id").collect()) == [2, 3]


def test_lookup_splits_a_hot_key(spark):
    """One key with most of the rows: AQE splits its partition even though the keyed side
    comes out of a deduplication and an aggregate follows."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        events = spark.range(0, 120000, 1, 8).selectExpr("id", "case when id % 3 < 2 then 7 else id % 500 end as k", "md5(cast(id as string)) as pad")
        dims = latest_per_key(spark.range(1000).selectExpr("id % 500 as k", "id as v"), "k", ["v"])
        joined = lookup(events, dims, "k", ["v"])
        out = joined.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("v"), F.max(F.xxhash64("pad")).alias("p"))
        rows = {r.k: (r.n, r.v) for r in out.collect()}
        assert rows[7][1] == 507 and sum(n for n, _ in rows.values()) == 120000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_canonical_id(spark):
    rows = [("a1", "E1", 1), ("a2", "E1", 3), ("a3", "E1", 3), ("a4", None, 2), ("a5", None, 5), ("a6", "E2", None)]
    df = spark.createDataFrame(rows, "agent_id string, employee_code string, updated_at int")
    got = {r.agent_id: r.c for r in canonical_id(df, "agent_id", "employee_code", ["updated_at"], "c").collect()}
    assert got == {"a1": "a2", "a2": "a2", "a3": "a2", "a4": "a5", "a5": "a5", "a6": "a6"}


def test_identity_over_time(spark):
    versions = spark.createDataFrame(
        [("b", datetime(2026, 1, 1, 9), "p1"), ("b", datetime(2026, 1, 1, 18), "p2"), ("b", datetime(2026, 1, 5), "p3")],
        "k string, at timestamp_ntz, phone string",
    )
    got = dicts(effective_dated(versions, "k", "at", ["phone"]), "valid_from")
    assert [(r["phone"], r["valid_from"], r["valid_to"]) for r in got] == [
        ("p1", datetime(2026, 1, 1, 9), datetime(2026, 1, 1, 18)),
        ("p2", datetime(2026, 1, 1, 18), datetime(2026, 1, 5)),
        ("p3", datetime(2026, 1, 5), None),
    ]
    events = spark.createDataFrame(
        [(1, "b", datetime(2025, 12, 31)), (2, "b", datetime(2026, 1, 1, 1)), (3, "b", datetime(2026, 1, 4)), (4, "b", datetime(2026, 1, 5)), (5, None, datetime(2026, 1, 5)), (6, "c", None), (7, "b", datetime(2026, 1, 1, 9)), (8, "b", datetime(2026, 1, 1, 17)), (9, "b", datetime(2026, 1, 1, 19))],
        "id int, k string, t timestamp_ntz",
    )
    got = {r.id: r.phone for r in as_of(events, versions, "k", "t", "at", ["phone"]).collect()}
    assert got == {1: None, 2: None, 3: "p2", 4: "p3", 5: None, 6: None, 7: "p1", 8: "p1", 9: "p2"}


def test_month_base(spark):
    accounts = spark.createDataFrame(
        [("old", datetime(2020, 5, 1)), ("mid", datetime(2026, 1, 31, 23)), ("late", datetime(2026, 4, 1)), ("none", None)],
        "account_id string, opened_at timestamp_ntz",
    )
    base = account_month_base(accounts, date(2026, 1, 1), date(2026, 3, 1))
    got = dicts(base.groupBy("account_id").agg(F.count("*").alias("n"), F.min("month_start").alias("m")), "account_id")
    assert [(r["account_id"], r["n"], r["m"]) for r in got] == [("mid", 3, date(2026, 1, 1)), ("old", 3, date(2026, 1, 1))]
    assert month_spine(spark, date(2026, 1, 1), date(2026, 8, 1)).count() == 8


@pytest.fixture()
def ledger(spark):
    rows = [(1, "a", datetime(2026, 1, 10, 23, 59), 10), (2, "a", datetime(2026, 1, 24), 5), (3, "a", datetime(2026, 1, 25), 7), (4, "b", datetime(2026, 1, 9), 3), (5, None, datetime(2026, 1, 9), 99)]
    return spark.createDataFrame(rows, "payment_id int, account_id string, event_at timestamp_ntz, amount int").withColumn(
        "amount", F.col("amount").cast("decimal(18,2)")
    )


@pytest.fixture()
def targeting(spark):
    rows = [("a", date(2026, 1, 10), "SMS", 1), ("a", date(2026, 1, 10), "SMS", 2), ("a", date(2026, 1, 11), "VOICE", 3), ("b", date(2026, 1, 10), "SMS", 4)]
    return spark.createDataFrame(rows, "account_id string, target_date date, recommended_channel string, target_id int")


def test_window_recovery_includes_both_ends(spark, targeting, ledger):
    got = dicts(window_recovery(targeting, ledger, [0, 14, 15], ["recommended_channel"]), "account_id", "target_date")
    # Day 0 and day 14 count, day 15 does not; repeated targets are one record; no payment stays null.
    assert [(r["account_id"], r["recommended_channel"], r["r0"], r["r14"], r["r15"]) for r in got] == [
        ("a", "SMS", 10, 15, 22),
        ("a", "VOICE", None, 12, 12),
        ("b", "SMS", None, None, None),
    ]


def test_attribution_against_brute_force(spark):
    """The day-axis windows against all pairs, on random rows with one account owning a third."""
    rng = random.Random(7)

    def account():
        return "hot" if rng.random() < 1 / 3 else f"a{rng.randrange(30)}"

    start = datetime(2026, 1, 1)
    paid = [(i, account(), start + timedelta(minutes=rng.randrange(120 * 1440)), rng.randrange(1, 500)) for i in range(600)]
    aimed = [(i, account(), (start + timedelta(days=rng.randrange(120))).date(), rng.choice("XYZ")) for i in range(500)]
    payments = spark.createDataFrame(paid, "payment_id int, account_id string, event_at timestamp_ntz, n int").selectExpr(
        "*", "cast(n as decimal(18,2)) as amount"
    )
    targets = spark.createDataFrame(aimed, "target_id int, account_id string, target_date date, recommended_channel string")

    want = {}
    for a, d, c in {(a, d, c) for _, a, d, c in aimed}:
        hits = [n for _, pa, t, n in paid if pa == a and 0 <= (t.date() - d).days <= 14]
        want[a, d, c] = sum(hits) if hits else None
    got = window_recovery(targets, payments, [14], ["recommended_channel"]).collect()
    assert {(r.account_id, r.target_date, r.recommended_channel): r.r14 for r in got} == want and len(got) == len(want)

    touches = Counter()
    for _, a, t, _n in paid:
        k = sum(1 for _, ta, d, _c in aimed if ta == a and 0 <= (t.date() - d).days <= 14)
        touches["many" if k > 1 else str(k)] += 1
    assert {r.candidate_touches: r.payments for r in touch_multiplicity(targets, payments).collect()} == dict(touches)

    cash = Counter()
    for _, a, t, n in paid:
        for c in {c for _, ta, d, c in aimed if ta == a and 0 <= (t.date() - d).days <= 14}:
            cash[c] += n
    accounts = targets.select("account_id").distinct().withColumn("outstanding_amount", F.lit(1))
    assert {r.channel: r.recovery for r in channel_yield(targets, payments, accounts).collect()} == dict(cash)


def test_channel_tables(spark, targeting, ledger):
    got = {r.recommended_channel: r for r in channel_conversion(targeting, ledger).collect()}
    sms = got["SMS"]
    assert (sms.target_records, sms.converting_target_records, sms.recovery_14d) == (2, 1, 15)
    assert (sms.recovery_per_target, sms.recovery_per_target_all, sms.conversion_rate_14d) == (15.0, 7.5, 0.5)
    accounts = spark.createDataFrame([("a", 100), ("b", 50)], "account_id string, outstanding_amount int")
    got = {r.channel: r for r in channel_yield(targeting, ledger, accounts).collect()}
    assert (got["SMS"].accounts, got["SMS"].recovery, got["SMS"].exposure, got["SMS"].yield14) == (2, 15, 150, 0.1)
    assert (got["VOICE"].accounts, got["VOICE"].recovery) == (1, 12)


def test_sensitivity_grows_with_the_window(targeting, ledger):
    row = window_sensitivity(targeting, ledger).first()
    assert (row.r1, row.r7, row.r14, row.r30) == (10, 10, 15, 22)


def test_touch_multiplicity(targeting, ledger):
    got = {r.candidate_touches: (r.payments, r.amount) for r in touch_multiplicity(targeting, ledger).collect()}
    # Jan 10 has two touches, Jan 24 three, Jan 25 one, and the payment of b precedes its target.
    assert got == {"0": (1, 3), "1": (1, 7), "many": (2, 15)}


def test_quality_checks(spark):
    events = spark.createDataFrame(
        [("a", "B1"), ("a", "B9"), ("a", None), ("z", "B1"), (None, "B1"), ("n", None)], "account_id string, borrower_id_raw string"
    )
    accounts = spark.createDataFrame([("a", "B1"), ("n", None)], "account_id string, borrower_id string")
    got = {r.source: (r.conflict_rows, r.total_rows) for r in quality.count_conflicts({"x": events, "y": events.limit(1)}, accounts).collect()}
    assert got == {"x": (2, 4), "y": (0, 1)}  # a missing borrower equals a missing one
    df = events.withColumn("id", F.monotonically_increasing_id())
    orphans = quality.quarantine_orphans({"CALL": (df, "id")}, accounts).collect()
    assert sorted(str(r.account_id) for r in orphans) == ["None", "z"]
    dup = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (2, 5, "b"), (2, 5, "c"), (3, 1, None), (None, 1, "d")], "k int, t int, v string")
    assert quality.duplicate_keys(dup, "k", "t").first().asDict() == {"affected": 2, "total": 3, "conflicting": 1}
    assert quality.unstable_ids(dup, "k", ["v"]).first()[:] == (1, 3)
    assert quality.distinct_values(dup, "v").first()[:] == (4, 6)
    assert quality.assert_unique(dup.where("k = 3"), ["k"]).count() == 0
    assert {r.k for r in quality.assert_unique(dup, ["k"]).collect()} == {1, 2}
    late = spark.createDataFrame(
        [(datetime(2026, 1, 1), datetime(2026, 1, 2)), (datetime(2026, 1, 1), datetime(2026, 1, 2, 0, 0, 1)), (datetime(2026, 1, 1), None)],
        "e timestamp_ntz, r timestamp_ntz",
    )
    assert quality.late_share(late, "e", "r").first()[:] == (1, 3)
    dispositions = spark.createDataFrame([(1, True), (1, True), (2, True), (9, True), (2, False)], "call_id int, rpc boolean")
    calls = spark.createDataFrame([(1, "ANSWERED"), (2, "FAILED")], "call_id int, call_status string")
    row = quality.status_contradictions(dispositions, calls, F.col("rpc")).first()
    assert (row.affected, row.not_answered, row.unmatched, row.total) == (2, 1, 1, 5)


def test_cast_failures(spark):
    raw = spark.createDataFrame([("c", "x", None), ("d", "2", "2026-01-01")], "priority string, x string, target_date string")
    raw = raw.selectExpr("x as priority", "target_date", "priority as target_id")
    got = {r.column: r.failed for r in quality.cast_failures(raw, "daily_targeting").collect()}
    assert got == {"target_date": 0, "priority": 1}


def test_drivers(spark, ledger):
    attributes = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "x")], "account_id string, seg string")
    got = driver_table(ledger, attributes, "seg", labels=["w", "x", "y"]).collect()
    assert [(r.seg, r.recovery, r.payers, r.recovery_per_payer) for r in got] == [("x", 22, 1, 22.0), ("y", 3, 1, 3.0), ("w", 0, 0, None)]
    events = spark.createDataFrame([("a", "u"), ("a", "v"), ("a", "v"), ("b", "v"), ("b", "u"), ("c", None)], "account_id string, c string")
    assert {r.account_id: r.m for r in modal_value(events, "c", "m").collect()} == {"a": "v", "b": "u"}


def test_mix_effects_add_up(spark):
    rows = [("a", 2, 10), ("b", 2, 40), ("c", 2, 20), ("a", 3, 12), ("b", 3, 44), ("d", 3, 50), ("e", 3, 9)]
    payments = spark.createDataFrame(rows, "account_id string, m int, amount int").selectExpr(
        "account_id", "cast(make_date(2026, m, 5) as timestamp_ntz) as event_at", "cast(amount as decimal(18,2)) as amount"
    )
    attributes = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "x"), ("d", "y"), ("e", "z")], "account_id string, s string")
    effects = mix_decomposition(payments, attributes, "s", date(2026, 2, 1), date(2026, 3, 1)).agg(
        F.sum("mix_effect") + F.sum("rate_effect")
    ).first()[0]
    assert effects == pytest.approx(115 / 4 - 70 / 3)
    row = simpson_check(payments, attributes, ["s"], date(2026, 2, 1), date(2026, 3, 1)).first()
    assert (row.overall_direction, row.strata, row.opposing_strata) == (1, 2, 1)


def test_assignment_is_exact_and_repeatable(spark):
    accounts = spark.range(3000).selectExpr("cast(id as string) as account_id", "if(id % 3 = 0, 'hot', cast(id % 7 as string)) as s")
    first = stratified_assign(accounts, ["s"], "seed")
    again = stratified_assign(accounts.repartition(7), ["s"], "seed")
    assert dicts(first, "account_id") == dicts(again, "account_id")
    shares = first.groupBy("stratum").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("arm") == "treatment").alias("t"),
        F.countDistinct("position").alias("p"),
        F.max("position").alias("top"),
        F.max("wave").alias("w"),
    )
    for r in shares.collect():
        assert r.p == r.top == r.n and r.w == 4
        assert r.t == int(r.n * 0.5 + 0.5)
