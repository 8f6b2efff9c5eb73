"""Exact positions in a global order, without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# 32 coarse times 32 fine boundaries. Both numbers bound what is held in one row.
FANOUT = 32
SAMPLE = FANOUT * FANOUT * 4


def _bucket_boundaries(df: DataFrame, key: str) -> DataFrame:
    """One row with up to FANOUT * FANOUT - 1 keys that split the table evenly.

    They are quantiles of the keys with the smallest hashes, which is a fixed random
    sample: every evaluation gives the same boundaries. They only balance the work.
    """
    sample = df.select(key).orderBy(F.xxhash64(key), key).limit(SAMPLE)
    keys = sample.agg(F.array_sort(F.collect_set(key)).alias("keys")).select(
        "keys", F.greatest(F.lit(1), F.ceil(F.size("keys") / F.lit(FANOUT * FANOUT))).cast("int").alias("step")
    )
    every = keys.select(F.filter("keys", lambda k, i: (i > 0) & (i % F.col("step") == 0)).alias("fine"))
    coarse = F.filter("fine", lambda k, i: i % F.lit(FANOUT) == F.lit(FANOUT - 1))
    return every.select(F.struct("fine", coarse.alias("coarse")))


def with_position(df: DataFrame, key: str, position: str = "position") -> DataFrame:
    """Add the row's 1-based position in the order of a unique, non-null ``key``.

    Rows are put in about a thousand key ranges, numbered within their range, and shifted
    by the size of the ranges before it. The range sizes are one small row each. The table
    is used three times, for the boundaries, the sizes and the rows: give a stored one.
    """
    bounded = df.withColumn("__b", _bucket_boundaries(df, key).scalar())
    reached = F.size(F.filter("__b.coarse", lambda b: b <= F.col(key)))
    coarse = bounded.withColumn("__start", reached * F.lit(FANOUT))
    in_range = F.slice("__b.fine", F.col("__start") + F.lit(1), F.lit(FANOUT))
    bucket = F.col("__start") + F.size(F.filter(in_range, lambda b: b <= F.col(key)))
    # Declared non-null, or the join below would test it for null inside the scan.
    ranged = coarse.withColumn("__bucket", F.coalesce(bucket, F.lit(0))).drop("__b", "__start")
    sizes = ranged.groupBy("__bucket").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    # At most FANOUT * FANOUT + FANOUT rows: safe to sort in one task and to broadcast.
    shifts = sizes.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    within = F.row_number().over(Window.partitionBy("__bucket").orderBy(key))
    return (
        ranged.join(F.broadcast(shifts), "__bucket")
        .withColumn(position, F.col("__shift") + within)
        .drop("__bucket", "__shift")
    )
