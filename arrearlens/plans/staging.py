"""Staging: one typed projection per source table, no row filtering."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.conform import KINDS
from ..sources.schemas import TABLES


def stage(raw: DataFrame, table: str) -> DataFrame:
    return raw.selectExpr(*[f"{KINDS[f.kind].format(c=f.raw)} as {f.staged}" for f in TABLES[table]])
