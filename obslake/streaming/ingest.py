"""Incremental ingest: files that arrive are converted once each, in bounded batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

FILES_PER_BATCH = 1000

Transform = Callable[[DataFrame], DataFrame]


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_batch: int = FILES_PER_BATCH,
    fmt: str = "parquet",
    names: str | None = None,
) -> DataFrame:
    """The files in a folder, or those whose names match a pattern, as a stream of bounded batches."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if names is not None:
        reader = reader.option("pathGlobFilter", names)
    return reader.format(fmt).load(path)


def ingest(stream: DataFrame, transform: Transform, out: str, checkpoint: str) -> StreamingQuery:
    """Append the transformed stream to a Parquet table, then stop when no new file is left.

    Started again with the same checkpoint it goes on with the files it has not seen.
    The sink's log makes each file's rows appear exactly once, also after a failure.
    """
    return (
        transform(stream)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )


def ingest_with_restarts(
    stream: Callable[[], DataFrame], transform: Transform, out: str, checkpoint: str, attempts: int = 3
) -> int:
    """As ``ingest``, started again after a failure, ``attempts`` times in all; the number of failures.

    ``stream`` is called for each start. Batches that are committed are not run again, and the sink's log leaves
    out files of one that failed, so each row appears once. The last failure is raised.
    """
    for failures in range(attempts):
        try:
            ingest(stream(), transform, out, checkpoint).awaitTermination()
            return failures
        except StreamingQueryException:
            if failures + 1 == attempts:
                raise
    raise ValueError("at least one attempt")


def replace_batch(df: DataFrame, root: str, batch_id: int) -> None:
    """Write a batch's rows under its number; a batch that runs again replaces its own rows."""
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/batch_id={batch_id}")


def run_batches(stream: DataFrame, per_batch: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run a function for each batch of a stream until no new file is left."""
    return (
        stream.writeStream.foreachBatch(per_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
