"""Ratios, bands and period-over-period change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """Ratio as double; null when the denominator is zero or either side is null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def stable_mean(c: Column) -> Column:
    """Mean of a ratio of any size, to twelve significant digits: doubles added up in another
    order of partitions differ far behind them."""
    mean = F.avg(c.cast("double"))
    return F.when(mean.isNotNull(), F.format_string("%.11e", mean).cast("double"))


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.when(condition, 1).otherwise(0)


def count_if(condition: Column) -> Column:
    """Summable 0/1 long, so that counts share one type with `lit(1)` counts."""
    return F.when(condition, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))


def band(c: Column, edges: Sequence[float | None], labels: Sequence[str], outside: str = "out_of_range") -> Column:
    """Right-closed bands (edge[i], edge[i+1]]; None as the first or last edge leaves that side open.

    Values beyond a closed end get `outside`, null stays null.
    """
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    if edges[0] is not None:
        out = out.when(c <= edges[0], outside)
    for upper, name in zip(edges[1:], labels, strict=True):
        out = out.when(F.lit(True) if upper is None else c <= upper, name)
    return out.otherwise(outside)


def change_pct(df: DataFrame, column: str, order: str, out: str) -> DataFrame:
    """Percent change of `column` against the previous row in `order`.

    For series that are already one row per calendar period: the single window
    partition holds as many rows as there are months.
    """
    previous = F.lag(F.col(column).cast("double")).over(Window.orderBy(order))
    return df.withColumn(out, (safe_div(F.col(column), previous) - 1) * 100)
