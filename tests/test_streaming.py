from datetime import date
from decimal import Decimal

import pytest

from arrearlens.streaming.payments import (
    current_ledger,
    daily_recovery,
    daily_totals,
    ledger_sink,
    payment_stream,
    rejected_payments,
)

HEADER = "payment_id,account_id,borrower_id,event_at,payment_reference,amount,payment_status,payment_method,provider_id"


def drop_file(folder, name, rows):
    folder.mkdir(exist_ok=True)
    lines = [f"{pid},a,b,{at},r,{amount},{status},upi,p" for pid, at, amount, status in rows]
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def run(query):
    query.trigger(availableNow=True).start().awaitTermination()


def test_ledger_backfills_late_events(spark, tmp_path):
    source, root, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    stream = payment_stream(spark, str(source))

    def pump():
        run(stream.writeStream.foreachBatch(ledger_sink(root)).option("checkpointLocation", state))

    drop_file(source, "1.csv", [("p1", "2026-01-01 10:00:00", 10, "success"), ("p2", "2026-01-02 10:00:00", 5, "SUCCESS")])
    pump()
    # p1 is corrected to a later day, p3 arrives a month late, p2 turns out to have failed.
    drop_file(source, "2.csv", [("p1", "2026-01-03 10:00:00", 11, "SUCCESS"), ("p3", "2025-12-01 10:00:00", 7, "SUCCESS"), ("p2", "2026-01-02 11:00:00", 5, "FAILED")])
    pump()
    got = {r.day: r.recovery for r in daily_totals(spark, root).collect()}
    assert got == {
        date(2025, 12, 1): Decimal("7.00"),
        date(2026, 1, 1): Decimal("0.00"),
        date(2026, 1, 2): Decimal("0.00"),
        date(2026, 1, 3): Decimal("11.00"),
    }
    assert {r.payment_id: r.amount for r in current_ledger(spark, root).collect()} == {
        "p1": Decimal("11.00"),
        "p2": Decimal("5.00"),
        "p3": Decimal("7.00"),
    }
    # A retried batch changes nothing.
    batch = spark.read.parquet(f"{root}/payment_log").where("batch = 1").drop("batch", "day")
    ledger_sink(root)(spark.createDataFrame(batch.collect(), batch.schema), 1)
    assert {r.day: r.recovery for r in daily_totals(spark, root).collect()} == got


def test_first_batch_without_usable_events(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    drop_file(source, "1.csv", [("", "2026-01-01 10:00:00", 10, "SUCCESS"), ("p1", "never", 10, "SUCCESS")])
    stream = payment_stream(spark, str(source))
    run(stream.writeStream.foreachBatch(ledger_sink(root)).option("checkpointLocation", str(tmp_path / "state")))
    assert daily_totals(spark, root).count() == 0 and current_ledger(spark, root).count() == 0
    assert rejected_payments(spark, root).count() == 2


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_watermarked_daily_totals(spark, tmp_path, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        check_watermarked_daily_totals(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def check_watermarked_daily_totals(spark, tmp_path):
    source = tmp_path / "in"
    drop_file(source, "1.csv", [("p1", "2026-01-01 10:00:00", 10, "SUCCESS"), ("p1", "2026-01-01 12:00:00", 10, "SUCCESS"), ("p2", "2026-01-01 23:00:00", 5, "FAILED"), ("p3", "2026-01-01 23:30:00", 2, "SUCCESS")])
    stream = daily_recovery(payment_stream(spark, str(source), maxFilesPerTrigger="1"))

    drop_file(source, "2.csv", [("p9", "2026-01-05 10:00:00", 1, "SUCCESS")])
    query = (
        stream.writeStream.format("memory").queryName("daily").outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = {r.day: (r.recovery, r.payments) for r in spark.table("daily").collect()}
    assert got == {date(2026, 1, 1): (Decimal("12.00"), 2)}
