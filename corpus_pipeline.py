"""From raw documents to tokenised training text, in five stages.

Every stage reads what the one before it wrote. The first four return the columns of `documents`; the
last returns a row of token digests for each document that is left. A stage is a plain function of
(spark, docs, sf_dir), so that stages can be run and tested one by one.

Defined results: documents with a null or empty text fail the quality rules and go. Rows without an id pass
the line and near-duplicate stages as they are; repeated rows are copies, of which one stays. Ties go to the
smaller id, then to the earlier line. Columns beyond those of `documents` stay, whatever their names. Empty
tables give no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearlens.llm import decontaminate, line_dedup, minhash_join, pieces, repetition
from arrearlens.llm.common import checkpoint_dir, ship, table, unused

#: Documents are near copies from this percentage of their runs of words on (op5's own threshold is 85).
SIMILAR = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with under 20 words or much repetition go."""
    ship(spark)
    return docs.where(repetition.judged(F.col("text"))["kept"])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier one go, and with them documents that had no other words."""
    (kept,) = unused(docs, "_kept")
    while f"{kept}_removed" in docs.columns:
        kept += "_"
    rows = line_dedup.dedup_lines(docs, kept)
    has_words = r"[^\x20\x09-\x0D]"
    emptied = (F.col(f"{kept}_removed") > 0) & ~F.col(kept).rlike(has_words)
    rows = rows.where(~F.coalesce(emptied, F.lit(False)))
    changed = F.col(f"{kept}_removed") > 0
    rows = rows.withColumn("n_chars", F.when(changed, F.char_length(kept).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.withColumn("text", F.col(kept)).select(*[F.col(f"`{c}`") for c in docs.columns])


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash_join.deduplicated(docs, SIMILAR)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark go."""
    (found,) = unused(docs, "_found")
    rows = decontaminate.with_hits(docs, table(spark, sf_dir, "benchmark"), found)
    return rows.where(~decontaminate.contaminated(found)).drop(found)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the texts that are left, as digests, with the check that they decode."""
    import public_tokenizers

    return pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("minhash_near_dedup", dedup_documents),
    ("benchmark_decontamination", decontaminate_documents),
    ("sentencepiece", tokenize),
]

#: The tokens of a SentencePiece model can't be had in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's result is a Parquet table in the shared checkpoint folder."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(folder := f"{root}/{k}-{name}")
        docs = spark.read.parquet(folder)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
