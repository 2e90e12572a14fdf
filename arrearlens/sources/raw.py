"""Raw table readers: CSV, Parquet, or catalog tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import raw_schema

RawReader = Callable[[str], DataFrame]


#: Holds a record that does not have as many fields as its header.
_CORRUPT = "__record"


def _header(spark: SparkSession, files: str) -> T.StructType:
    """All columns of the first header, as strings."""
    names = spark.read.option("header", True).csv(files).columns
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_raw(spark: SparkSession, path: str, table: str, fmt: str = "csv", whole_only: bool = False) -> DataFrame:
    """Read one raw table stored at `path/table[.ext]`.

    CSV records with too few fields are filled up with nulls, with too many cut; with `whole_only`
    they are left out, to be had from `rejected_records`.
    """
    if fmt == "csv":
        # No inference pass: all columns are strings. The first header names them, in
        # whatever order; further part files must have the same header, else the read
        # fails instead of mixing columns. Extra columns are ignored.
        files = f"{path}/{table}.csv"
        reader, header = spark.read.option("header", True), _header(spark, files)
        if whole_only:
            header, reader = T.StructType([*header, T.StructField(_CORRUPT, T.StringType())]), reader.option("columnNameOfCorruptRecord", _CORRUPT)
        rows = reader.schema(header).option("enforceSchema", False).csv(files)
        if whole_only:
            # The reader only sees that fields are missing where it reads them all, whatever is asked for later.
            all_read = F.pmod(F.xxhash64(*[F.col(f"`{n}`") for n in header.names if n != _CORRUPT]), F.lit(2)) < 2
            rows = rows.where(F.col(_CORRUPT).isNull() & all_read)
        return rows.select(*raw_schema(table).names)
    if fmt == "parquet":
        return spark.read.parquet(f"{path}/{table}.parquet")
    if fmt == "table":
        return spark.table(f"{path}.{table}")
    raise ValueError(f"unknown raw format: {fmt}")


def numbered_lines(spark: SparkSession, files: str) -> DataFrame:
    """(file, line, value): every line with its number in its file, from 1.

    Lines are numbered within each block that is read as one, and blocks of a file are put behind one
    another by their counts, so no file is sorted or read in one task.
    """
    block = ["file", "start"]
    lines = spark.read.text(files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"), "value"
    )
    blocks = lines.groupBy(*block).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    # One row for each block of a file.
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(*block, "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return lines.join(offsets, block).select("file", (F.col("before") + F.col("id") - F.col("first") + 1).alias("line"), "value")


def rejected_records(spark: SparkSession, path: str, table: str) -> DataFrame:
    """(file, line, fields, record): lines of the table's CSV files that don't have the header's fields.

    Too short, too long, or with a quote that does not close. Headers and blank lines are no records.
    """
    files = f"{path}/{table}.csv"
    header = _header(spark, files)
    parsed = F.from_csv(
        F.col("value"), F.lit(T.StructType([*header, T.StructField(_CORRUPT, T.StringType())]).toDDL()), {"columnNameOfCorruptRecord": _CORRUPT}
    )
    lines = numbered_lines(spark, files).where((F.col("line") > 1) & (F.trim("value") != ""))
    bad = lines.withColumn("r", parsed).where(F.col(f"r.{_CORRUPT}").isNotNull())
    return bad.select("file", "line", F.lit(len(header)).alias("fields"), F.col("value").alias("record"))


def raw_reader(spark: SparkSession, path: str, fmt: str = "csv", whole_only: bool = False) -> RawReader:
    return lambda table: read_raw(spark, path, table, fmt, whole_only)
