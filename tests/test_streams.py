"""Streams of several batches: hours that close, compacted state, moments, restarts."""

from __future__ import annotations

import math
import random
import statistics
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from checks import queries
from obslake.sources.catalog import matching_paths
from obslake.streaming import ingest, latest, moments, report

START = datetime(2024, 3, 1)
ARRIVALS = "arrived timestamp_ntz, failed boolean, name string"


def arrive(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder, schema):
    return ingest.file_stream(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)


# --- hours that close ---------------------------------------------------------------


def expected_hours(batches, delay):
    """Counts of closed and open hours and the late names, by the rule itself."""
    counts, late, mark = {}, [], None
    for batch in batches:
        for time, failed, name in batch:
            hour = time and time.replace(minute=0, second=0, microsecond=0)
            if time is None or (mark is not None and hour + timedelta(hours=1) <= mark - delay):
                late.append(name)
            else:
                n = counts.setdefault(hour, [0, 0])
                n[failed] += 1
        times = [t for t, _, _ in batch if t is not None]
        mark = max([*times, *([mark] if mark else [])], default=None)
    closed = {h: tuple(n) for h, n in counts.items() if h + timedelta(hours=1) <= mark - delay}
    return closed, {h: tuple(n) for h, n in counts.items() if h not in closed}, sorted(late)


def reported(spark, root):
    def hours(df):
        return {r.hour: (r.n_ok, r.n_failed) for r in df.withColumn("hour", F.col("hour").cast("timestamp_ntz")).collect()}

    return hours(report.closed_hours(spark, root)), hours(report.open_hours(spark, root)), sorted(r.name for r in report.late_rows(spark, root).collect())


def test_hours_close_and_no_row_is_lost(spark, scratch):
    """Late, early, undated rows and an hour's very edges; the stream is brought up to date three times."""
    rng, batches, number = random.Random(4), [], 0
    for day in range(9):
        rows = []
        for _ in range(40):
            time = START + timedelta(hours=3 * day, minutes=rng.randrange(180)) - timedelta(hours=rng.choice([0, 0, 0, 1, 2, 3, 5, 9]))
            rows.append((rng.choice([time, time.replace(minute=0), time, None if rng.random() < 0.1 else time]), rng.random() < 0.3, f"n{number}"))
            number += 1
        batches.append(rows)
    for k, rows in enumerate(batches):
        arrive(spark, f"{scratch}/in", rows, ARRIVALS)
        if k in (3, 4, 8):
            report.close_hours(stream(spark, f"{scratch}/in", ARRIVALS), f"{scratch}/r", delay="2 hours")
            closed, still_open, late = expected_hours(batches[: k + 1], timedelta(hours=2))
            got = reported(spark, f"{scratch}/r")
            assert (got[0], got[1]) == (closed, still_open) and set(got[2]) == set(late), (k, len(got[2]), set(got[2]) ^ set(late))
            assert sum(map(sum, [*closed.values(), *still_open.values()])) + len(late) == 40 * (k + 1)
    assert late and closed and still_open


def test_closing_goes_on_after_a_failure(spark, scratch, monkeypatch):
    batches = [[(START + timedelta(hours=4 * k + h), h == 1, f"{k}-{h}") for h in (0, 1, -6)] for k in range(5)]
    for rows in batches:
        arrive(spark, f"{scratch}/in", rows, ARRIVALS)
    plain, calls = report.replace_batch, Counter()

    def failing(df, root, batch_id):
        calls[root] += 1
        if root.endswith("/marks") and batch_id == 2 and calls["failed"] == 0:
            calls["failed"] += 1
            raise RuntimeError("injected")
        plain(df, root, batch_id)

    monkeypatch.setattr(report, "replace_batch", failing)
    with pytest.raises(StreamingQueryException):
        report.close_hours(stream(spark, f"{scratch}/in", ARRIVALS), f"{scratch}/r")
    report.close_hours(stream(spark, f"{scratch}/in", ARRIVALS), f"{scratch}/r")
    assert reported(spark, f"{scratch}/r") == expected_hours(batches, timedelta(hours=2))


# --- compacted state ----------------------------------------------------------------

ENTRIES = "file string, date_update timestamp_ntz, v int"


def entries(seed, count=60):
    rng = random.Random(seed)
    return [(f"f{rng.randrange(25)}", rng.choice([None, START + timedelta(days=rng.randrange(50))]), seed * 1000 + k) for k in range(count)]


def newest(rows):
    best = {}
    for file, time, v in rows:
        best[file] = max(best.get(file, ((datetime.min, -1))), (time or datetime.min, v))
    return {f: v for f, (_, v) in best.items()}


def state_of(spark, state):
    return {r.file: r.v for r in latest.current(spark, state).collect()}


def test_snapshot_and_tail(spark, scratch, monkeypatch):
    """A compaction that dies before its pointer changes nothing; one batch written again counts once."""
    state, rows = f"{scratch}/state", []
    with pytest.raises(FileNotFoundError):
        latest.current(spark, state)
    for k in range(9):
        rows += entries(k)
        arrive(spark, f"{scratch}/in", entries(k), ENTRIES)
        latest.follow(stream(spark, f"{scratch}/in", ENTRIES), state, f"{scratch}/c", compact_every=4).awaitTermination()
        assert state_of(spark, state) == newest(rows)
        if k == 5:
            with monkeypatch.context() as m:
                m.setattr(latest, "_point", lambda *a: (_ for _ in ()).throw(OSError("killed")))
                with pytest.raises(OSError):
                    latest.compact(spark, state)
            assert latest._pointer(spark, state)[0] == 3 and state_of(spark, state) == newest(rows)
    assert latest._pointer(spark, state)[0] == 7 and latest.compact(spark, state) == 8 == latest.compact(spark, state)
    assert latest.prune(spark, state) > 0 and state_of(spark, state) == newest(rows)
    assert not matching_paths(spark, f"{state}/batch_id=*") and len(matching_paths(spark, f"{state}/_snapshots/*")) == 1
    ingest.replace_batch(spark.createDataFrame([("f1", START + timedelta(days=99), 5)], ENTRIES), state, 9)
    ingest.replace_batch(spark.createDataFrame([("f1", START + timedelta(days=99), 5)], ENTRIES), state, 9)
    assert state_of(spark, state) == newest(rows) | {"f1": 5}
    assert latest.prune(spark, state) == 0


def test_an_unfinished_batch_is_not_compacted(spark, scratch):
    state = f"{scratch}/state"
    ingest.replace_batch(spark.createDataFrame([("a", START, 1)], ENTRIES), state, 0)
    spark.createDataFrame([("a", START, 9)], ENTRIES).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{state}/batch_id=1")
    assert latest.compact(spark, state) == 0 and state_of(spark, state) == {"a": 1}


# --- moments ------------------------------------------------------------------------


@pytest.mark.parametrize("fan_in", [2, 3, 64])
def test_moments_combine_without_loss(spark, scratch, monkeypatch, fan_in):
    """Values far from zero, groups of one, of none and of missing values, and a missing group."""
    monkeypatch.setattr(moments, "FAN_IN", fan_in)
    rng, values = random.Random(1), {}
    for k in range(11):
        rows = [(rng.choice(["a", "b", None]), rng.choice([1e9 + rng.random(), None])) for _ in range(50)]
        rows += [("one", 3.0)] if k == 4 else [("none", None)]
        for g, x in rows:
            values.setdefault(g, []).extend([] if x is None else [x])
        ingest.replace_batch(moments.group_moments(spark.createDataFrame(rows, "g string, x double"), ["g"], "x"), f"{scratch}/state", k)
    got = {r.g: r.std for r in moments.deviation(spark, f"{scratch}/state", ["g"]).collect()}
    assert set(got) == set(values) and got["one"] is None and got["none"] is None
    for g in ("a", "b", None):
        assert math.isclose(got[g], statistics.stdev(values[g]), rel_tol=1e-5)


# --- restarts -----------------------------------------------------------------------


def test_restarted_ingest_has_each_row_once(spark, scratch):
    for k in range(5):
        arrive(spark, f"{scratch}/in", [(k * 10 + j,) for j in range(10)], "x long")
    tries = []

    def transform(df):
        tries.append(1)
        if len(tries) < 3:
            return df.withColumn("x", F.when(F.col("x") == 10 * len(tries) + 13, F.raise_error(F.lit("injected")).cast("long")).otherwise(F.col("x")))
        return df

    failures = ingest.ingest_with_restarts(lambda: stream(spark, f"{scratch}/in", "x long"), transform, f"{scratch}/out", f"{scratch}/c")
    assert failures == 2 and sorted(r.x for r in spark.read.parquet(f"{scratch}/out").collect()) == list(range(50))


def test_the_last_failure_is_raised(spark, scratch):
    arrive(spark, f"{scratch}/in", [(1,)], "x long")

    def broken(df):
        return df.select(F.raise_error(F.lit("always")).cast("long").alias("x"))

    with pytest.raises(StreamingQueryException):
        ingest.ingest_with_restarts(lambda: stream(spark, f"{scratch}/in", "x long"), broken, f"{scratch}/out", f"{scratch}/c", attempts=2)


# --- batches as they are issued -----------------------------------------------------


def test_batches_are_written_by_several_tasks_and_taken_one_by_one(spark, scratch):
    spark.range(0, 4000, 1, 8).withColumn("batch", F.when(F.col("id") % 3 == 1, 3).otherwise(F.col("id") % 3)).write.parquet(f"{scratch}/table")
    table = spark.read.parquet(f"{scratch}/table")
    schema, files = queries._issued(table, "batch", 4, f"{scratch}/in", file_bytes=4000)
    assert files > 1 and schema.names == ["id"]
    assert len(matching_paths(spark, f"{scratch}/in/*.parquet")) == 4 * files
    seen = {}

    def add(batch, batch_id):
        seen[batch_id] = sorted(r.id for r in batch.collect())

    arriving = ingest.file_stream(spark, f"{scratch}/in", schema, files_per_batch=files)
    ingest.run_batches(arriving, add, f"{scratch}/checkpoint").awaitTermination()
    assert seen == {0: list(range(0, 4000, 3)), 1: [], 2: list(range(2, 4000, 3)), 3: list(range(1, 4000, 3))}
