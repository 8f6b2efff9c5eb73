"""Standard deviations per group over a stream, without going back to the rows.

Each batch leaves, for every group, the number of values, their mean and the sum of squared deviations from
it. Two such triples combine to that of both by a formula that adds no large numbers of nearly
the same size, so no digits are lost however far the mean is from zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from obslake.streaming.ingest import replace_batch, run_batches

#: Triples of a group that are combined at once, at most: the batches go up a tree of this width.
FAN_IN = 64

_MOMENTS = "struct<n:bigint,mean:double,m2:double>"


def group_moments(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """The group's columns with n, mean and m2 of the values that are there."""
    number = F.col(value).cast("double")
    return df.groupBy(*by).agg(
        F.count(number).alias("n"),
        F.coalesce(F.avg(number), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(number) * F.count(number), F.lit(0.0)).alias("m2"),
    )


def follow(stream: DataFrame, state: str, checkpoint: str, by: Sequence[str], value: str) -> StreamingQuery:
    """Add each batch's moments per group to the state."""

    def add(batch: DataFrame, batch_id: int) -> None:
        replace_batch(group_moments(batch, by, value), state, batch_id)

    return run_batches(stream, add, checkpoint)


def _both(a: Column, b: Column) -> Column:
    n = a["n"] + b["n"]
    share = F.coalesce(F.try_divide(b["n"], n), F.lit(0.0))
    step = b["mean"] - a["mean"]
    joined = F.struct(
        n.alias("n"), (a["mean"] + step * share).alias("mean"), (a["m2"] + b["m2"] + step * step * a["n"] * share).alias("m2")
    )
    return F.when(a["n"] == 0, b).when(b["n"] == 0, a).otherwise(joined)


def combined(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row of n, mean and m2 per group, from many with ``batch_id``."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2")).cast(_MOMENTS)
    last = parts.agg(F.max("batch_id")).first()[0] or 0
    while True:
        parts = parts.withColumn("batch_id", F.floor(F.col("batch_id") / FAN_IN))
        some = F.array_sort(F.collect_list(F.struct("batch_id", F.struct("n", "mean", "m2").cast(_MOMENTS).alias("m"))))
        listed = parts.groupBy(*by, "batch_id").agg(some.alias("some"))
        merged = listed.select(*by, "batch_id", F.aggregate("some", zero, lambda a, b: _both(a, b["m"])).alias("m"))
        parts, last = merged.select(*by, "batch_id", "m.*"), last // FAN_IN
        if last == 0:
            return parts.drop("batch_id")


def deviation(spark: SparkSession, state: str, by: Sequence[str], name: str = "std") -> DataFrame:
    """Sample standard deviation per group over all batches so far; null for a group of one value."""
    moments = combined(spark.read.parquet(state), by)
    spread = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return moments.select(*by, spread.alias(name))
