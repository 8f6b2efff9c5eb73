"""A training corpus in five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm import decontaminate, mixing, near_dedup, quality, sharding
from obslake.llm.scratch import prepare, stored

#: Documents that a Python worker of the first two stages holds at once. Spark's own 10 000, with their sets and sketches, beside a full heap are
#: more than an executor of 3000 MB has.
DOCUMENTS_AT_ONCE = "1000"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the rules and the repute of their source reject."""
    prepare(spark).conf.set(_BATCH, DOCUMENTS_AT_ONCE)
    return quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of documents similar in their runs of five words, that of least doc_id.

    A row without doc_id is kept only where none of its group has one. Rows that share a doc_id
    are judged by their own texts, each; a row in no group stays.
    """
    prepare(spark).conf.set(_BATCH, DOCUMENTS_AT_ONCE)
    return near_dedup.single_documents(docs, width=5)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain a benchmark item."""
    prepare(spark).conf.unset(_BATCH)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_matches(docs, items)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mix of its source asks for."""
    prepare(spark)
    return mixing.draw(docs)


def sharding_by_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Give every row its shard of equal bytes and its place there."""
    prepare(spark)
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    return sharding.histogram_sort(docs, ["doc_id", "text"], size)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing", source_mixing),
    ("sharding", sharding_by_bytes),
]

#: Near duplicates, random rounding and a hash order are not expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
