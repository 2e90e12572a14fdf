"""Month spines and per-month measures."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import month_of, on_days



def month_sequence(start: Column, end: Column) -> Column:
    """Array of month starts from `start` to `end`, both inclusive."""
    return F.sequence(start, end, F.expr("interval 1 month"))


def month_range(start: date, end: date) -> Column:
    return month_sequence(F.lit(start), F.lit(end))


def month_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    return spark.range(1).select(F.explode(month_range(start, end)).alias("month_start"))


def account_months_array(start: date, end: date, opened: str = "opened_at") -> Column:
    """Months from the later of the account's opening month and `start` up to `end`; null if there are none."""
    first = F.greatest(month_of(F.col(opened)), F.lit(start))
    return F.when(
        month_of(F.col(opened)) <= F.lit(end), F.sequence(first, F.lit(end), F.expr("interval 1 month"))
    )


def account_month_base(accounts: DataFrame, start: date, end: date, opened: str = "opened_at") -> DataFrame:
    """One row per account and month from the later of its opening month and `start`.

    Each account generates only the months it belongs to, so there is no product of
    accounts and months to filter afterwards. Accounts without an opening date, or
    opened after `end`, are not in the population.
    """
    return accounts.select("*", F.explode(account_months_array(start, end, opened)).alias("month_start"))


def month_column(at: str) -> str:
    """Name of the partition column that stored event tables derive from their time column."""
    return f"{at}_month"


def within(df: DataFrame, at: str, *ranges: tuple[date, date]) -> DataFrame:
    """Rows whose `at` falls in any of the closed date ranges.

    Parquet cannot skip data by a zone-less timestamp, so a stored table is partitioned
    by the month of its event time, and the months of the ranges prune partitions.
    """
    inside = reduce(lambda a, b: a | b, [on_days(F.col(at), lo, hi) for lo, hi in ranges])
    out = df.where(inside)
    month = month_column(at)
    if month in df.columns:
        spans = [F.col(month).between(F.lit(lo.replace(day=1)), F.lit(hi)) for lo, hi in ranges]
        out = out.where(reduce(lambda a, b: a | b, spans))
    return out


def monthly_measures(
    df: DataFrame, at: Column, measures: Mapping[str, Column], account: str = "account_id"
) -> DataFrame:
    """Aggregate one event table to (account_id, month_start); events without either are left out.

    Rows are partially aggregated before the shuffle, so an account or month that
    owns a large share of the events is no heavier than any other afterwards.
    """
    keyed = df.withColumn("month_start", month_of(at))
    if account != "account_id":
        keyed = keyed.withColumn("account_id", F.col(account))
    keyed = keyed.where("account_id is not null and month_start is not null")
    return keyed.groupBy("account_id", "month_start").agg(*[e.alias(n) for n, e in measures.items()])
