"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # One reporting zone; the library itself only uses zone-less timestamps.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed join partitions,
    # switch to a broadcast only once the measured side is small enough.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The gold plan alone compiles more classes than the default cache of 100 holds.
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.ui.enabled": "false",
}


# Shuffled bytes one task should receive: fits an executor core's share of memory, so
# sorts and hash tables rarely spill.
TASK_BYTES = 200 * 1024 * 1024


def shuffle_partitions(input_bytes: int) -> int:
    """Shuffle partitions for a job over `input_bytes` of source data.

    AQE merges partitions that turn out small but never splits one that is not skewed,
    so the count errs on the high side.
    """
    return max(200, -(-input_bytes // TASK_BYTES))


def get_session(
    app: str = "arrearlens", master: str | None = None, input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """Build (or get) a session; on a cluster leave `master` unset and pass the input size."""
    builder = SparkSession.builder.appName(app)
    if input_bytes is not None:
        extra = {"spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes)), **extra}
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
