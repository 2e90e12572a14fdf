"""Expressions that turn a raw source value into its conformed form.

Sources may be CSV (every column a string) or typed Parquet; each expression
casts to string first, which Catalyst removes when the column already is one.
Casts are lenient: a malformed value becomes null instead of failing a job that
has been reading for an hour, and `operators.quality.cast_failures` counts them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


_TRIMMED = "trim(cast({c} as string))"
_WHOLE = "try_cast(round(try_cast({c} as decimal(18,6)), 0) as int)"

# Kind -> SQL expression over the raw column {c}.
KINDS: dict[str, str] = {
    # Identifiers and free text: trimmed, and a blank one is none.
    "id": f"nullif({_TRIMMED}, '')",
    "text": f"nullif({_TRIMMED}, '')",
    # Labels keep their case and are none when blank; codes are upper case, version markers lower case.
    "label": f"nullif({_TRIMMED}, '')",
    "code": f"upper({_TRIMMED})",
    "version": f"lower({_TRIMMED})",
    "email": f"nullif(lower({_TRIMMED}), '')",
    "money": "try_cast({c} as decimal(18,2))",
    "coordinate": "try_cast({c} as decimal(9,6))",
    # Half-up rounding; a bare cast would truncate.
    "int": _WHOLE,
    "int0": f"coalesce({_WHOLE}, 0)",
    # Wall-clock reading the source recorded, without zone.
    "time": "try_cast({c} as timestamp_ntz)",
    "date": "try_cast({c} as date)",
}

# Kinds whose cast can fail; used by the cast-failure check.
CASTING_KINDS = ("money", "coordinate", "int", "int0", "time", "date")


def map_codes(c: Column, groups: dict[str, tuple[str, ...]], default: str = "OTHER") -> Column:
    """Map raw codes to standard ones; anything unlisted (or null) gets `default`."""
    out = None
    for standard, raw_codes in groups.items():
        hit = c.isin(*raw_codes)
        out = F.when(hit, standard) if out is None else out.when(hit, standard)
    return F.lit(default) if out is None else out.otherwise(default)
