"""Row-preserving joins of large event tables to keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Keys = str | Sequence[str]


def as_list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _join(
    events: DataFrame, keyed: DataFrame, keys: list[str], take: Sequence[str], how: str, spread: str | None = None
) -> DataFrame:
    """Join on the keys plus a hash of them.

    The hash adds nothing to the match, but
    - rows with a null key, which can match nothing, hash by `spread` (a column of many
      values) or by all other columns, and so spread over all partitions;
    - neither side can reuse a partitioning it inherited from a deduplication or an
      aggregate, so both inputs of the join are plain shuffles. That is the shape in
      which AQE can split a partition made heavy by one hot key, and a later
      aggregate cannot insist on the unsplit partitioning either.
    """
    names = ", ".join(keys)
    right = keyed.selectExpr(*[f"{k} as __key_{k}" for k in keys], f"xxhash64({names}) as __key_hash", *take)
    missing = " or ".join(f"{k} is null" for k in keys)
    others = [spread] if spread else [c for c in events.columns if c not in keys] or keys
    left = events.withColumn(
        "__event_hash", F.expr(f"case when {missing} then xxhash64({', '.join(others)}) else xxhash64({names}) end")
    )
    on = " and ".join(f"{k} = __key_{k}" for k in keys) + " and __event_hash = __key_hash"
    joined = left.join(right, F.expr(on), how)
    return joined.drop("__event_hash", "__key_hash", *[f"__key_{k}" for k in keys])


def lookup(events: DataFrame, keyed: DataFrame, key: Keys, take: Sequence[str]) -> DataFrame:
    """Left join `take` columns from `keyed` (unique on `key`) onto every event."""
    return _join(events, keyed, as_list(key), take, "left")


def without_match(events: DataFrame, keyed: DataFrame, key: Keys, spread: str | None = None) -> DataFrame:
    """Events whose `key` is null or absent from `keyed`."""
    return _join(events, keyed, as_list(key), (), "left_anti", spread)


def attach_account(events: DataFrame, accounts: DataFrame) -> DataFrame:
    """Replace the event's own (distrusted) borrower with the account's borrower."""
    return lookup(events.drop("borrower_id_raw"), accounts, "account_id", ["borrower_id"])

