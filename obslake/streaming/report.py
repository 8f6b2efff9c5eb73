"""A running report of how loading goes: files that came through and files that failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from obslake.sources.catalog import path_exists
from obslake.streaming.ingest import replace_batch, run_batches

DELAY = "2 hours"


def _counts() -> list:
    return [F.count_if(~F.col("failed")).alias("n_ok"), F.count_if(F.col("failed")).alias("n_failed")]


def hourly_counts(outcomes: DataFrame, time: str = "arrived", failed: str = "failed") -> DataFrame:
    """Files that came through and that failed, per hour of arrival."""
    hour = F.window(time, "1 hour").alias("window")
    counted = outcomes.withColumnRenamed(failed, "failed").groupBy(hour).agg(*_counts())
    return counted.select(F.col("window.start").alias("hour"), "n_ok", "n_failed")


def watch(stream: DataFrame, report: str, checkpoint: str, time: str = "arrived", failed: str = "failed") -> StreamingQuery:
    """Keep each batch's counts per hour.

    Counts of different batches add up, so a file that arrives late is counted like any
    other and no state is held between batches.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        replace_batch(hourly_counts(batch, time, failed), report, batch_id)

    return run_batches(stream, add, checkpoint)


def _summed(parts: DataFrame, key: str) -> DataFrame:
    return parts.groupBy(key).agg(F.sum("n_ok").alias("n_ok"), F.sum("n_failed").alias("n_failed"))


def totals(spark: SparkSession, report: str) -> DataFrame:
    """Counts per hour over all batches so far."""
    return _summed(spark.read.parquet(report), "hour")


def by_batch(spark: SparkSession, report: str) -> DataFrame:
    """Counts per batch, with the percentage that failed."""
    sums = _summed(spark.read.parquet(report), "batch_id")
    share = F.try_divide(F.col("n_failed") * F.lit(100e0), F.col("n_ok") + F.col("n_failed"))
    return sums.withColumn("failed_percent", share)


# --- hours that close ---------------------------------------------------------------

_PART = "hour timestamp, n_ok long, n_failed long, latest timestamp"


def _hour(time: str) -> Column:
    """Start of the hour, the same as that of the window that closes; but ``window`` itself drops rows without time."""
    seconds = F.unix_timestamp(F.col(time).cast("timestamp"))
    return F.timestamp_seconds(F.floor(seconds / 3600) * 3600)


def _sorted_out(stream: DataFrame, root: str, delay: str, time: str, failed: str) -> StreamingQuery:
    """Split each batch into counts of rows in time and rows too late.

    The mark of a batch is the latest time of the batches before it. An hour that ended ``delay`` or more before
    the mark is closed, and a row of such an hour is late. A batch reads the mark that its
    predecessor left, so one that runs again splits its rows as before.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = f"{root}/marks/batch_id={batch_id - 1}"
        mark = spark.read.parquet(before).first()["mark"] if batch_id and path_exists(spark, before) else None
        end = _hour(time) + F.expr("interval 1 hour")
        closed = end <= F.lit(mark).cast("timestamp") - F.expr(f"interval {delay}")
        in_time = F.col(time).isNotNull() & ~F.coalesce(closed, F.lit(False))
        counted = batch.where(in_time).withColumnRenamed(failed, "failed")
        counted = counted.groupBy(_hour(time).alias("hour")).agg(*_counts(), F.max(time).cast("timestamp").alias("latest"))
        replace_batch(counted, f"{root}/parts", batch_id)
        replace_batch(batch.where(~in_time), f"{root}/late", batch_id)
        latest = spark.read.schema(_PART).parquet(f"{root}/parts/batch_id={batch_id}").agg(F.max("latest").alias("latest"))
        kept = F.greatest(F.col("latest"), F.lit(mark).cast("timestamp")).alias("mark")
        replace_batch(latest.select(kept), f"{root}/marks", batch_id)

    return run_batches(stream, add, f"{root}/checkpoints/sort")


def close_hours(stream: DataFrame, root: str, delay: str = DELAY, time: str = "arrived", failed: str = "failed") -> None:
    """Bring a report of closed hours under ``root`` up to date with a stream of files, and return.

    An hour closes once something ``delay`` later than its end has arrived; then its counts are appended to
    the table of closed hours, once, and never change. What arrives for it later goes as it is to a table
    of late rows, as does a row without time, so every row is counted in an hour or kept there.

    The stream is sorted out in its own batches first. Of each batch only the counts per hour go on, to a
    stream with a watermark and windows in append mode, whose state holds the open hours only. It takes all new
    counts as one batch, so its watermark is never ahead of the one that sorted the rows out.
    Run again after a failure it goes on where it stopped.
    """
    spark = stream.sparkSession
    _sorted_out(stream, root, delay, time, failed).awaitTermination()
    if not path_exists(spark, f"{root}/parts"):
        return
    parts = spark.readStream.schema(_PART).parquet(f"{root}/parts").withWatermark("latest", delay)
    summed = parts.groupBy(F.window("latest", "1 hour").alias("window")).agg(F.sum("n_ok").alias("n_ok"), F.sum("n_failed").alias("n_failed"))
    (
        summed.select(F.col("window.start").alias("hour"), "n_ok", "n_failed")
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{root}/checkpoints/close")
        .trigger(availableNow=True)
        .start(f"{root}/closed")
        .awaitTermination()
    )


def closed_hours(spark: SparkSession, root: str) -> DataFrame:
    """(hour, n_ok, n_failed) of the hours that are final; hours are moments, also where the stream's times have no zone."""
    return spark.read.schema("hour timestamp, n_ok long, n_failed long").parquet(f"{root}/closed")


def open_hours(spark: SparkSession, root: str) -> DataFrame:
    """The counts so far of the hours that are not closed yet."""
    parts = spark.read.schema(_PART).parquet(f"{root}/parts")
    return _summed(parts, "hour").join(closed_hours(spark, root), "hour", "left_anti")


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows that came when their hour was closed, and rows without time, as they came."""
    return spark.read.parquet(f"{root}/late").drop("batch_id")
