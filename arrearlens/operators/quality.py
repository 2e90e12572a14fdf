"""Data-quality checks. Each returns counts as columns; none of them stops a job."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import MICROS_PER_HOUR, known_zone, micros_between
from ..functions.ratio import count_if
from ..sources.schemas import TABLES
from ..functions.conform import CASTING_KINDS, KINDS
from .lookup import without_match
from .stack import stack


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty when `keys` is a unique key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    return stack(
        [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    )


def count_conflicts(sources: dict[str, DataFrame], accounts: DataFrame) -> DataFrame:
    """Per source: rows of known accounts whose own borrower differs from the account's.

    No join. Account rows and event rows are laid together and grouped by
    (account, borrower, source): a group holding the account's own pair agrees, any
    other conflicts, and grouping treats two missing borrowers as equal. All sources
    share these aggregations, each of which shrinks before it shuffles.
    """
    names = F.array(*[F.lit(n) for n in sources])
    own = accounts.select(
        "account_id",
        F.col("borrower_id").alias("borrower"),
        F.explode(F.sequence(F.lit(0), F.lit(len(sources) - 1))).alias("src"),
        F.lit(1).alias("own"),
    )
    events = [
        df.where(F.col("account_id").isNotNull()).select(
            "account_id", F.col("borrower_id_raw").alias("borrower"), F.lit(i).alias("src")
        )
        for i, df in enumerate(sources.values())
    ]
    pairs = stack([own, *events]).groupBy("account_id", "borrower", "src").agg(
        F.max("own").alias("own"), F.count_if(F.col("own").isNull()).alias("n")
    )
    per_account = pairs.groupBy("account_id", "src").agg(
        F.max("own").alias("known"),
        F.sum("n").alias("total_rows"),
        F.sum(F.when(F.col("own").isNull(), F.col("n")).otherwise(0)).alias("conflict_rows"),
    )
    # Every account has a row per source, so a source without events still reports zero.
    return (
        per_account.where("known = 1")
        .groupBy("src")
        .agg(F.sum("conflict_rows").alias("conflict_rows"), F.sum("total_rows").alias("total_rows"))
        .select(F.element_at(names, F.col("src") + 1).alias("source"), "conflict_rows", "total_rows")
    )


def quarantine_orphans(sources: dict[str, tuple[DataFrame, str]], accounts: DataFrame) -> DataFrame:
    """Events whose account is missing or unknown: (source, event_id, account_id).

    Sources are united before the one anti join; events without an account spread by
    their own id.
    """
    events = stack(
        [
            df.select(F.lit(name).alias("source"), F.col(id_col).alias("event_id"), "account_id")
            for name, (df, id_col) in sources.items()
        ]
    )
    return without_match(events, accounts, "account_id", spread="event_id")


def duplicate_keys(df: DataFrame, key: str, conflicting: str | None = None) -> DataFrame:
    """(affected, total[, conflicting]): keys occurring more than once, and how many of
    those disagree on `conflicting`."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if conflicting:
        aggs += [F.min(conflicting).alias("lo"), F.max(conflicting).alias("hi")]
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    out = [
        F.coalesce(F.sum(count_if(F.col("n") > 1)), F.lit(0)).alias("affected"),
        F.count(F.lit(1)).alias("total"),
    ]
    if conflicting:
        differs = (F.col("n") > 1) & (F.col("lo") != F.col("hi"))
        out.append(F.coalesce(F.sum(count_if(differs)), F.lit(0)).alias("conflicting"))
    return per_key.agg(*out)


def unstable_ids(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(affected, total): keys with more than one distinct non-null value in any column.

    "More than one distinct value" is min <> max, which needs no distinct sets.
    """
    bounds = [f(c).alias(f"{p}_{c}") for c in columns for p, f in (("lo", F.min), ("hi", F.max))]
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(*bounds)
    differs = [F.coalesce(F.col(f"lo_{c}") != F.col(f"hi_{c}"), F.lit(False)) for c in columns]
    unstable = reduce(lambda a, b: a | b, differs)
    return per_key.agg(
        F.coalesce(F.sum(count_if(unstable)), F.lit(0)).alias("affected"), F.count(F.lit(1)).alias("total")
    )


def repeated_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(affected, total): key combinations occurring more than once."""
    per_key = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum(count_if(F.col("n") > 1)), F.lit(0)).alias("affected"), F.count(F.lit(1)).alias("total")
    )


def contradictions_by_call(
    dispositions: DataFrame, calls: DataFrame, rpc_like: Column, answered: str = "ANSWERED"
) -> DataFrame:
    """(rows, not_answered, unmatched) by call id: its dispositions, and the right-party ones among them on a
    call that was not answered or is unknown. Dispositions are counted per call before meeting calls."""
    per_call = dispositions.groupBy("call_id").agg(
        F.sum(count_if(rpc_like)).alias("rpc_rows"), F.count(F.lit(1)).alias("rows")
    )
    known = calls.select("call_id", "call_status", F.lit(True).alias("known"))
    joined = per_call.join(known, "call_id", "left")
    unmatched = F.col("known").isNull()
    contradicting = ~unmatched & ~F.col("call_status").eqNullSafe(F.lit(answered))
    rpc = F.col("rpc_rows")
    return joined.select("rows", F.when(contradicting, rpc).otherwise(0).alias("not_answered"), F.when(unmatched, rpc).otherwise(0).alias("unmatched"))


def status_contradictions(
    dispositions: DataFrame, calls: DataFrame, rpc_like: Column, answered: str = "ANSWERED"
) -> DataFrame:
    """Right-party dispositions on calls that were not answered, split from those whose call is unknown."""
    return contradictions_by_call(dispositions, calls, rpc_like, answered).agg(
        F.coalesce(F.sum(F.col("not_answered") + F.col("unmatched")), F.lit(0)).alias("affected"),
        F.coalesce(F.sum("not_answered"), F.lit(0)).alias("not_answered"),
        F.coalesce(F.sum("unmatched"), F.lit(0)).alias("unmatched"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
    )


def late_share(df: DataFrame, event_at: str, recorded_at: str, hours: float = 24) -> DataFrame:
    """(affected, total): rows recorded more than `hours` after they happened."""
    late = micros_between(F.col(event_at), F.col(recorded_at)) > int(hours * MICROS_PER_HOUR)
    return df.agg(F.coalesce(F.sum(count_if(late)), F.lit(0)).alias("affected"), F.count(F.lit(1)).alias("total"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """(affected, total): number of distinct non-null values, and rows."""
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return per_value.agg(
        F.count(column).alias("affected"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")
    )


def zone_labels(df: DataFrame, column: str) -> DataFrame:
    """(label, rows, resolved): each zone label, and whether the engine knows it; others mean the default zone."""
    labels = df.groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    return labels.withColumn("resolved", known_zone("label"))


def cast_failures(raw: DataFrame, table: str) -> DataFrame:
    """Per typed column: values present in the source that the lenient cast turned to null."""
    fields = [f for f in TABLES[table] if f.kind in CASTING_KINDS]

    def failed(f) -> str:
        kind = "int" if f.kind == "int0" else f.kind
        present = f"trim(cast({f.raw} as string)) <> ''"
        return f"count_if({present} and {KINDS[kind].format(c=f.raw)} is null) as {f.staged}"

    if not fields:
        return raw.sparkSession.createDataFrame([], "table string, column string, failed long")
    rows = [
        F.struct(F.lit(table).alias("table"), F.lit(f.staged).alias("column"), F.col(f.staged).alias("failed"))
        for f in fields
    ]
    return raw.selectExpr(*[failed(f) for f in fields]).select(F.inline(F.array(*rows)))
