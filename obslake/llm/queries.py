"""One query per operator, over the whole of the table it is meant for, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm import decontaminate, extraction, infill, lines, mixing, near_dedup, quality, repeats, runs, secrets, sharding, tokens, warc
from obslake.llm.scratch import prepare
from obslake.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    versions = docs.select(F.col("doc_id").alias("path"), F.col("text").alias("content"))
    found = secrets.scan(versions, shared_folder(spark, "ledger"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    base = F.filter("spans", lambda s: s.kind.isin(*secrets.BASE_KINDS))
    return found.select(
        F.col("path").alias("doc_id"),
        *map(count, secrets.BASE_KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        "digest",
    )


def op2_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    lean = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("text_md5"),
    )
    placed = sharding.histogram_sort(lean, ["doc_id", "text_md5"], F.col("size"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=2)


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_passages(_table(spark, sf_dir, "documents"))


def op5_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    assessed = quality.assess(_table(spark, sf_dir, "documents"))
    return assessed.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "n_failed",
        "host_failed",
        "kept",
    )


def op6_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = extraction.extract(_table(spark, sf_dir, "pages"))
    return extracted.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    archives = shared_folder(spark, "archives")
    warc.write_archives(pages, archives)
    return warc.read_archives(spark, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    counted = docs.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        tokens.token_count(spark, F.col("text")).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > tokens.LIMIT)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.links(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    planted = docs.select("doc_id", runs.with_planted_period(F.col("doc_id"), F.col("text")).alias("text"))
    found = runs.with_runs(planted).select("doc_id", "runs", F.get("runs", F.col("best")).alias("top"), "collapsed")
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = lines.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    made = infill.infilled(docs).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    rebuilt = infill.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(rebuilt, 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_secret_ledger": op1_secret_ledger,
    "op2_histogram_sort": op2_histogram_sort,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_repeated_passages": op4_repeated_passages,
    "op5_host_quality": op5_host_quality,
    "op6_pivotal_mix": op6_pivotal_mix,
    "op7_main_text": op7_main_text,
    "op8_warc_revisits": op8_warc_revisits,
    "op9_token_counts": op9_token_counts,
    "op10_decontaminate": op10_decontaminate,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_line_dedup": op12_line_dedup,
    "op13_fill_in_middle": op13_fill_in_middle,
}
