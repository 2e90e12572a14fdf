"""Calendar and time-zone expressions.

Everything here works on zone-less timestamps, so results do not depend on the
session time zone. A "UTC" column holds the UTC wall-clock reading.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from .codes import DEFAULT_ZONE


def month_of(c: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(c.cast("date"), "MM")


def month_label(c: Column) -> Column:
    """`yyyy-MM` text of a date."""
    return F.date_format(c.cast("date"), "yyyy-MM")


def days_in_month(month_start: Column) -> Column:
    return F.dayofmonth(F.last_day(month_start))


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole calendar months between the months of two dates (may be negative)."""
    return ((F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)).cast("int")


def day_number(c: Column) -> Column:
    """Days since 1970-01-01, the integer axis of every day-range window."""
    return F.unix_date(c.cast("date"))


def on_days(c: Column, first: date, last: date) -> Column:
    """Wall time within the closed date range, as bare comparisons a scan can prune by."""
    lower = F.lit(first.isoformat()).cast("timestamp_ntz")
    upper = F.lit((last + timedelta(days=1)).isoformat()).cast("timestamp_ntz")
    return (c >= lower) & (c < upper)


def month_end(month_start: date) -> date:
    return (month_start.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)


MICROS_PER_HOUR = 3.6e9


def micros_between(start: Column, end: Column) -> Column:
    """Signed whole microseconds; null when either end is missing.

    Durations are added up as integers and divided once, so totals are exact and do
    not depend on the order in which partitions are merged.
    """
    return F.timestamp_diff("MICROSECOND", start, end)


def clipped_micros(start: Column, end: Column) -> Column:
    """Duration floored at zero; a missing end stays null instead of becoming zero."""
    micros = micros_between(start, end)
    return F.when(micros.isNotNull(), F.greatest(micros, F.lit(0)))


def known_zone(zone: str) -> Column:
    """Whether the engine's own parser of time stamps knows the zone: a name, an abbreviation or an offset.

    It is the parser that conversions use, so a label that passes can't fail them.
    """
    return F.expr(f"coalesce(try_cast(concat('2000-01-01 00:00:00 ', {zone}) as timestamp) is not null and trim({zone}) <> '', false)")


def zone_or_default(zone: str, default: str = DEFAULT_ZONE) -> Column:
    """Zone column; a missing or unknown zone falls back (a conversion fails on an unknown one)."""
    return F.when(known_zone(zone), F.col(zone)).otherwise(default)


def to_utc(local: str, zone: str, default: str = DEFAULT_ZONE) -> Column:
    return F.convert_timezone(zone_or_default(zone, default), F.lit("UTC"), F.col(local))


def to_local(utc: str, zone: str, default: str = DEFAULT_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), zone_or_default(zone, default), F.col(utc))
