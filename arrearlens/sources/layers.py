"""Storage of the layer tables (clean, gold, feat, metrics) and CSV result files."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ("stg", "clean", "gold", "feat", "metrics")


def shared_root(spark: SparkSession) -> str | None:
    """Layer folder in the shared storage the cluster names, if it names one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return f"{folder.rstrip('/')}/arrearlens_layers" if folder else None


def create_namespaces(spark: SparkSession, layers: Sequence[str] = LAYERS) -> None:
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def new_version(root: str) -> str:
    """A folder for one run of the layers."""
    return f"{root.rstrip('/')}/version-{uuid.uuid4().hex}"


def switch_version(spark: SparkSession, root: str, version: str) -> None:
    """Let `root` point to a finished version. Pointers are only ever added; the last one holds."""
    row = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("at"))
    row.write.mode("append").parquet(f"{root.rstrip('/')}/versions")


def list_stored(spark: SparkSession, version: str, tables: Sequence[tuple[str, str]]) -> None:
    """Note which (layer, name) tables a version holds."""
    spark.createDataFrame(tables, "layer string, name string").coalesce(1).write.parquet(f"{version}/tables")


def stored_tables(spark: SparkSession, version: str) -> list[tuple[str, str]]:
    return [(r.layer, r.name) for r in spark.read.parquet(f"{version}/tables").collect()]


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared storage the session names; of this machine only under a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="arrearlens-scratch-")
    return f"{named.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def current_version(spark: SparkSession, root: str) -> str:
    """The version that `root` points to."""
    return spark.read.parquet(f"{root.rstrip('/')}/versions").agg(F.max_by("version", "at").alias("version")).first().version


def list_table(spark: SparkSession, layer: str, name: str, version: str) -> None:
    """List a stored table in the catalog; dropping an earlier entry leaves its files."""
    spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
    spark.sql(f"CREATE TABLE {layer}.{name} USING parquet LOCATION '{version}/{layer}/{name}'")
    if [c for c in spark.catalog.listColumns(f"{layer}.{name}") if c.isPartition]:
        spark.sql(f"MSCK REPAIR TABLE {layer}.{name}")


def write_layer(
    df: DataFrame,
    layer: str,
    name: str,
    root: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Replace one layer table: Parquet under `root`, or a catalog table without it."""
    if partition_by:
        # One write task per partition value and shuffle slot, instead of every task
        # opening a file in every partition; rebalance also splits a hot value.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if root is not None:
        writer.parquet(f"{root}/{layer}/{name}")
    else:
        writer.format("parquet").saveAsTable(f"{layer}.{name}")


def read_layer(spark: SparkSession, layer: str, name: str, root: str | None = None) -> DataFrame:
    return spark.read.parquet(f"{root}/{layer}/{name}") if root is not None else spark.table(f"{layer}.{name}")


def write_result_csv(df: DataFrame, path: str) -> None:
    """Write a result table as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def register_views(frames: dict[str, DataFrame], prefix: str = "stg_") -> None:
    """Expose lazy frames to SQL users as temporary views."""
    for name, df in frames.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
