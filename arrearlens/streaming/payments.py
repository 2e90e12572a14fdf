"""Late payment events, two ways.

`daily_recovery` is the cheap answer: state is bounded by a watermark, later copies of
a payment are ignored, and events beyond the watermark are dropped from the totals.

`ledger_sink` is the exact one: every event is kept in a replayable log (those without an id or a time
among the rejects), and a ledger holds the winning copy of each payment, however late its events come.
The ledger lies in buckets by payment id. A batch reads and rewrites only the buckets that its payments
fall into, each together with its own daily totals; the log is never read again. `heads` says which batch
wrote each bucket last. It is written when all else is, and a batch starts from the heads of the one before
it, so a batch may be retried: it overwrites what it wrote and nothing else. Files that no head of the last
two batches names are deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codes import SUCCESS
from ..operators.dedup import latest_per_key
from ..plans.cleaning import RULES
from ..plans.staging import stage
from ..sources.schemas import raw_schema


def payment_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Staged payments from CSV files arriving under `path`."""
    reader = spark.readStream.schema(raw_schema("payments")).option("header", True)
    # A header in another column order is an error, not silently shifted columns.
    return stage(reader.options(enforceSchema="false", **options).csv(path), "payments")


_DAY_MICROS = 86_400_000_000


def daily_recovery(payments: DataFrame, delay: str = "24 hours") -> DataFrame:
    """Successful cash per day, each payment id counted once within the watermark."""
    # A watermark needs a zoned timestamp: read the wall clock as if it were UTC, and the
    # window's day back the same way, so the session zone has no part in it.
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    as_utc = F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col("event_at")))
    day = F.date_from_unix_date(F.floor(F.unix_micros(F.col("window.start")) / _DAY_MICROS).cast("int"))
    return (
        payments.withColumn("event_at", as_utc)
        .withWatermark("event_at", delay)
        .dropDuplicatesWithinWatermark(["payment_id"])
        .where(F.col("payment_status") == SUCCESS)
        .groupBy(F.window("event_at", "1 day"))
        .agg(F.sum("amount").alias("recovery"), F.count(F.lit(1)).alias("payments"))
        .select(day.alias("day"), "recovery", "payments")
    )


def _log(root: str) -> str:
    return f"{root}/payment_log"


def _rejects(root: str) -> str:
    return f"{root}/payment_rejects"


def _heads(root: str) -> str:
    return f"{root}/heads"


_BUCKETS = 256
_DAILY = "day date, recovery decimal(18,2), payments bigint"


def _staged_schema(spark: SparkSession) -> T.StructType:
    empty = spark.createDataFrame([], raw_schema("payments"))
    return stage(empty, "payments").schema


def _of_buckets(spark: SparkSession, root: str, kind: str, heads: Mapping[int, int], schema: T.StructType | str) -> DataFrame:
    """The named buckets of `kind` (ledger or daily), each as its head wrote it."""
    paths = [f"{root}/{kind}/batch={batch}/bucket={bucket}" for bucket, batch in heads.items()]
    # Paths are known to be there; the base path would be searched for partitions otherwise.
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _read_heads(spark: SparkSession, root: str, batch_id: int | None = None) -> dict[int, int]:
    """Bucket -> batch that wrote it last, as of a batch, or now. One row a bucket."""
    if batch_id is None:
        batch_id = max(_known_batches(spark, root), default=-1)
    if batch_id not in _known_batches(spark, root):
        return {}
    return {r.bucket: r.head for r in spark.read.schema(_HEAD).parquet(f"{_heads(root)}/batch={batch_id}").collect() if r.bucket >= 0}


_HEAD = "bucket int, head bigint, buckets int, files_read int"


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under a path in whatever storage holds it."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    storage = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in storage.listStatus(place) if s.isDirectory()] if storage.exists(place) else []


def _drop(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _known_batches(spark: SparkSession, root: str) -> list[int]:
    return [int(name.split("=")[1]) for name in _folders(spark, _heads(root)) if name.startswith("batch=")]


def current_ledger(spark: SparkSession, root: str) -> DataFrame:
    """One row per payment over everything received so far."""
    return _of_buckets(spark, root, "ledger", _read_heads(spark, root), _staged_schema(spark))


def daily_totals(spark: SparkSession, root: str) -> DataFrame:
    """Successful cash by day; a day left without cash has zero."""
    parts = _of_buckets(spark, root, "daily", _read_heads(spark, root), _DAILY)
    return parts.groupBy("day").agg(F.sum("recovery").cast("decimal(18,2)").alias("recovery"), F.sum("payments").alias("payments")).select("recovery", "payments", "day")


def rejected_payments(spark: SparkSession, root: str) -> DataFrame:
    """Events without an id or a time, with the batch they came in."""
    return spark.read.schema(_staged_schema(spark).add("batch", T.LongType())).parquet(_rejects(root))


def batch_costs(spark: SparkSession, root: str) -> DataFrame:
    """(batch, buckets, files_read): what the last batches rewrote and read of the ledger."""
    heads = spark.read.schema(_HEAD + ", batch bigint").parquet(_heads(root))
    return heads.groupBy("batch").agg(F.count_if(F.col("head") == F.col("batch")).alias("buckets"), F.max("files_read").alias("files_read"))


def merge_batch(spark: SparkSession, root: str, events: DataFrame, batch_id: int, buckets: int = _BUCKETS) -> None:
    """Merge a batch of usable events into the buckets of the ledger that they fall into."""
    rule, schema = RULES["payments"], _staged_schema(spark)
    bucket = F.pmod(F.xxhash64("payment_id"), F.lit(buckets)).cast("int")
    # Few rows: no more than there are buckets.
    touched = [r.bucket for r in events.select(bucket.alias("bucket")).distinct().collect()]
    heads = _read_heads(spark, root, batch_id - 1)
    before = {k: heads[k] for k in touched if k in heads}
    held = _of_buckets(spark, root, "ledger", before, schema)
    days_held = _of_buckets(spark, root, "daily", before, _DAILY)
    files_read = len(held.inputFiles()) + len(days_held.inputFiles()) if before else 0
    if touched:
        # The winner among winners and newcomers is the winner among all copies.
        merged = latest_per_key(held.unionByName(events.select(schema.names)), rule.key, rule.order, ties=rule.ties)
        merged.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/ledger/batch={batch_id}")
        now = _of_buckets(spark, root, "ledger", dict.fromkeys(touched, batch_id), schema)
        day = F.col("event_at").cast("date").alias("day")
        paid = now.where(F.col("payment_status") == SUCCESS).select(bucket.alias("bucket"), day, "amount", F.lit(1).alias("n"))
        # Days seen before stay, at zero if all their cash has moved.
        seen = events.select(bucket.alias("bucket"), day)
        if before:
            seen = seen.unionByName(_of_buckets_with(spark, root, before))
        rows = paid.unionByName(seen.withColumns({"amount": F.lit(None).cast("decimal(18,2)"), "n": F.lit(0)}))
        totals = rows.groupBy("bucket", "day").agg(F.coalesce(F.sum("amount"), F.lit(0)).cast("decimal(18,2)").alias("recovery"), F.sum("n").cast("long").alias("payments"))
        totals.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/daily/batch={batch_id}")
    rows = [(k, b, buckets, files_read) for k, b in (heads | dict.fromkeys(touched, batch_id)).items()]
    # A row of its own keeps the number of buckets and the batch even before the first payment.
    rows.append((-1, -1, buckets, files_read))
    spark.createDataFrame(rows, _HEAD).coalesce(1).write.mode("overwrite").parquet(f"{_heads(root)}/batch={batch_id}")


def _of_buckets_with(spark: SparkSession, root: str, heads: Mapping[int, int]) -> DataFrame:
    """(bucket, day) of the daily totals of the named buckets."""
    frames = [f"{root}/daily/batch={batch}/bucket={bucket}" for bucket, batch in heads.items()]
    path = F.regexp_extract(F.col("_metadata.file_path"), "bucket=([0-9]+)", 1).cast("int")
    return spark.read.schema(_DAILY).parquet(*frames).select(path.alias("bucket"), "day")


def expire(spark: SparkSession, root: str, batch_id: int) -> None:
    """Delete heads before the last two batches, and the bucket files that only they named."""
    known = sorted(b for b in _known_batches(spark, root) if b <= batch_id)
    for old, newer in zip(known, known[1:-1]):
        then, later = _read_heads(spark, root, old), _read_heads(spark, root, newer)
        for bucket, batch in then.items():
            if later.get(bucket) != batch:
                for kind in ("ledger", "daily"):
                    _drop(spark, f"{root}/{kind}/batch={batch}/bucket={bucket}")
        _drop(spark, f"{_heads(root)}/batch={old}")


def ledger_sink(root: str, buckets: int = _BUCKETS) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that keeps the log, its rejects, the ledger and the daily totals under `root`.

    The number of buckets belongs to `root`: another one is an error. A bucket is rewritten by one task,
    so choose as many as keep a bucket small."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if found := _known_batches(spark, root):
            said = spark.read.schema(_HEAD).parquet(f"{_heads(root)}/batch={max(found)}").first().buckets
            if said != buckets:
                raise ValueError(f"{root} has {said} buckets, not {buckets}")
        numbered = batch.withColumn("batch", F.lit(batch_id).cast("long"))
        usable = F.col("payment_id").isNotNull() & F.col("event_at").isNotNull()
        replace = {"partitionOverwriteMode": "dynamic"}
        rows = numbered.where(usable).withColumn("day", F.col("event_at").cast("date"))
        rows.write.mode("overwrite").options(**replace).partitionBy("batch", "day").parquet(_log(root))
        numbered.where(~usable).write.mode("overwrite").options(**replace).partitionBy("batch").parquet(_rejects(root))
        mine = f"{_log(root)}/batch={batch_id}"
        logged = _folders(spark, mine)
        events = spark.read.schema(_staged_schema(spark)).parquet(*[f"{mine}/{d}" for d in logged]) if logged else spark.createDataFrame([], _staged_schema(spark))
        merge_batch(spark, root, events, batch_id, buckets)
        expire(spark, root, batch_id)

    return write


def replay(spark: SparkSession, root: str, into: str, buckets: int = _BUCKETS) -> None:
    """Build ledger and totals anew from the whole log, in one merge, under another root."""
    events = spark.read.schema(_staged_schema(spark).add("batch", T.LongType()).add("day", T.DateType())).parquet(_log(root))
    merge_batch(spark, into, events.drop("batch", "day"), 0, buckets)
