"""The newest entry per profile file, from an index that is re-issued again and again.

State is an append-only table of each batch's newest entries. A batch writes only what it
has seen, not the whole state. ``compact`` combines the batches so far into a snapshot; a reader
then takes the snapshot and the batches after it. Which snapshot counts is said by a pointer, a small
file that appears whole by a rename. So a compaction that dies before that leaves the old snapshot in force, and
one that dies after it has done all that readers need.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from obslake.sources.catalog import delete_path, matching_paths, write_file
from obslake.streaming.ingest import replace_batch, run_batches

_NONE = -1


def newest_entries(entries: DataFrame, key: str = "file", time: str = "date_update") -> DataFrame:
    """One row per key: the one with the latest time, ties broken by the other columns.

    Rows are combined before they are shuffled, so a key with very many entries is cheap.
    An entry without a time loses against any with one.
    """
    others = [c for c in entries.columns if c not in (key, time)]
    rank = F.struct(F.col(time), *[F.col(c) for c in others])
    best = entries.groupBy(key).agg(F.max(rank).alias("__best"))
    return best.select(*[F.col(key) if c == key else F.col(f"__best.{c}").alias(c) for c in entries.columns])


def follow(
    stream: DataFrame, state: str, checkpoint: str, key: str = "file", time: str = "date_update", compact_every: int | None = None
) -> StreamingQuery:
    """Reduce each batch to its newest entries and add them to the state; compact it after every so many batches."""

    def add(batch: DataFrame, batch_id: int) -> None:
        replace_batch(newest_entries(batch, key, time), state, batch_id)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, state, key, time)

    return run_batches(stream, add, checkpoint)


def _batches(spark: SparkSession, state: str) -> dict[int, str]:
    """Folder of every finished batch, by number."""
    done = matching_paths(spark, f"{state}/batch_id=*/_SUCCESS")
    folders = [path.removesuffix("/_SUCCESS") for path in done]
    return {int(folder.rpartition("=")[2]): folder for folder in folders}


def _pointer(spark: SparkSession, state: str) -> tuple[int, str | None]:
    """Number of the last batch in the snapshot that is in force, and the snapshot's folder."""
    pointers = matching_paths(spark, f"{state}/_pointers/[0-9]*")
    if not pointers:
        return _NONE, None
    last = max(pointers)
    return int(last.rpartition("/")[2]), f"{state}/_snapshots/{spark.read.text(last).first()[0]}"


def _entries(spark: SparkSession, state: str, until: int | None = None) -> DataFrame:
    upto, snapshot = _pointer(spark, state)
    later = [folder for number, folder in sorted(_batches(spark, state).items()) if number > upto and (until is None or number <= until)]
    paths = ([snapshot] if snapshot else []) + later
    if not paths:
        raise FileNotFoundError(f"no finished batch in {state}")
    return spark.read.parquet(*paths)


def current(spark: SparkSession, state: str, key: str = "file", time: str = "date_update") -> DataFrame:
    """The newest entry per key over all batches so far: of the snapshot and the batches after it."""
    return newest_entries(_entries(spark, state), key, time)


def compact(spark: SparkSession, state: str, key: str = "file", time: str = "date_update") -> int:
    """Combine the snapshot and the batches after it into a new snapshot; the last batch it holds.

    Without new batches nothing is done. Old snapshots and batches stay until ``prune``.
    """
    upto, _ = _pointer(spark, state)
    last = max(_batches(spark, state), default=_NONE)
    if last > upto:
        name = f"{last:012d}-{uuid.uuid4().hex}"
        newest_entries(_entries(spark, state, last), key, time).write.parquet(f"{state}/_snapshots/{name}")
        _point(spark, state, last, name)
    return max(last, upto)


def _point(spark: SparkSession, state: str, last: int, name: str) -> None:
    write_file(spark, f"{state}/_pointers/{last:012d}", name)


def prune(spark: SparkSession, state: str) -> int:
    """Delete what the snapshot in force replaces: batches it holds, older and unfinished snapshots. Returns how many folders.

    For when no reader is at work: one that started before the last compaction may still read them.
    """
    upto, snapshot = _pointer(spark, state)
    if snapshot is None:
        return 0
    old = [folder for number, folder in _batches(spark, state).items() if number <= upto]
    old += [path for path in matching_paths(spark, f"{state}/_snapshots/*") if path.rpartition("/")[2] != snapshot.rpartition("/")[2]]
    for path in [*old, *(p for p in matching_paths(spark, f"{state}/_pointers/[0-9]*") if int(p.rpartition("/")[2]) < upto)]:
        delete_path(spark, path)
    return len(old)

