"""Files that cannot be read, records over several lines, and what a second issue of the index changes."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks import queries
from obslake.operators import inventory, profiles
from obslake.plans import jobs
from obslake.sources import catalog, readers

# --- unreadable files ---------------------------------------------------------------


def parquet_files(folder):
    """Sound files, an empty one, and files broken in every way; names of the broken ones by reason."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    sound = pa.table({"k": pa.array(range(2000), pa.int64()), "t": [f"text {i}" for i in range(2000)]})
    for name in ("a", "b", "cut", "pages", "footer"):
        pq.write_table(sound, f"{folder}/{name}.parquet", row_group_size=500, compression="none", use_dictionary=False)
    pq.write_table(sound.slice(0, 0), f"{folder}/empty.parquet")
    whole = Path(f"{folder}/cut.parquet").read_bytes()
    Path(f"{folder}/cut.parquet").write_bytes(whole[: len(whole) // 2])
    Path(f"{folder}/text.parquet").write_bytes(b"no parquet at all")
    Path(f"{folder}/nothing.parquet").write_bytes(b"")
    footer = int.from_bytes(whole[-8:-4], "little")
    Path(f"{folder}/footer.parquet").write_bytes(whole[: -8 - footer] + b"\xff" * footer + whole[-8:])
    pq.write_table(sound, f"{folder}/pages.parquet", row_group_size=500, compression="snappy", use_dictionary=False)
    damaged = bytearray(Path(f"{folder}/pages.parquet").read_bytes())
    damaged[len(damaged) // 2 : len(damaged) // 2 + 400] = b"\xff" * 400
    Path(f"{folder}/pages.parquet").write_bytes(bytes(damaged))
    return {"pages": readers.BAD_PAGES, "cut": readers.NO_PARQUET, "text": readers.NO_PARQUET, "nothing": readers.NO_PARQUET, "footer": readers.BAD_FOOTER}


def by_name(rows):
    return {r.input_file.rpartition("/")[2].removesuffix(".parquet"): r for r in rows}


def test_every_file_is_judged(spark, scratch):
    broken = parquet_files(f"{scratch}/in")
    probed = by_name(readers.probe_parquet(spark, f"{scratch}/in", deep=True).collect())
    assert set(probed) == {"a", "b", "cut", "pages", "footer", "empty", "text", "nothing"}
    reasons = {name: r.reason for name, r in probed.items() if r.reason}
    assert reasons == broken
    assert (probed["a"].n_rows, probed["b"].n_rows, probed["empty"].n_rows, probed["cut"].n_rows) == (2000, 2000, 0, None)


def test_rows_of_sound_files_only(spark, scratch):
    broken = parquet_files(f"{scratch}/in")
    rows, rejects = readers.read_parquet_with_rejects(spark, f"{scratch}/in", deep=True)
    bad = by_name(rejects.collect())
    assert set(bad) == set(broken)
    kept = {r.input_file.rpartition("/")[2]: r.n for r in rows.groupBy("input_file").agg(F.count("*").alias("n")).collect()}
    assert kept == {"a.parquet": 2000, "b.parquet": 2000}
    assert rows.select("k", "t").distinct().count() == 2000


def test_only_broken_files(spark, scratch):
    Path(f"{scratch}/in").mkdir()
    Path(f"{scratch}/in/x.parquet").write_bytes(b"PAR1" + bytes(20) + b"PAR1")
    assert [r.reason for r in readers.probe_parquet(spark, f"{scratch}/in").collect()] == [readers.BAD_FOOTER]
    with pytest.raises(readers.UnreadableFileError):
        readers.read_parquet_with_rejects(spark, f"{scratch}/in")


def test_job_goes_on_without_a_broken_file(spark, scratch):
    arrays = spark.createDataFrame([(k, 1, [1.0, 2.0]) for k in range(20)], "PLATFORM_NUMBER long, N_PROF int, PRES array<double>")
    arrays.repartition(4).write.parquet(f"{scratch}/in")
    Path(f"{scratch}/in/broken.parquet").write_bytes(b"PAR1 then nothing")
    jobs.raw_files(spark, f"{scratch}/in", "PHY", f"{scratch}/PHY", f"{scratch}/rejects")
    assert spark.read.parquet(f"{scratch}/PHY").count() == 40
    assert [r.reason for r in spark.read.parquet(f"{scratch}/rejects_files").collect()] == [readers.NO_PARQUET]


# --- records over several lines -----------------------------------------------------


def test_records_over_several_lines(spark, scratch):
    text = 'SampleId,Latitude,Longitude\n"1\n2, and\n3",4.5,6\nplain,1,2\n"x\ny",north,3\nshort,1\n"says ""hi""",7,8\n'
    Path(f"{scratch}/one.csv").write_text(text)
    Path(f"{scratch}/two.csv").write_text("SampleId,Latitude,Longitude\nlast,0,0\n")
    good, bad = readers.read_records_with_rejects(spark, [f"{scratch}/one.csv", f"{scratch}/two.csv"], "CPR")
    assert sorted(map(tuple, good.collect())) == [("1\n2, and\n3", 4.5, 6.0), ("last", 0.0, 0.0), ("plain", 1.0, 2.0), ('says "hi"', 7.0, 8.0)]
    rejects = {r.row: (r.input_file.rpartition("/")[2], r.reason) for r in bad.collect()}
    assert {row.strip() for row in rejects} == {'"x\ny",north,3', "short,1"} and set(rejects.values()) == {("one.csv", "malformed")}


# --- index issues -------------------------------------------------------------------

INDEX = "file string, date_update timestamp_ntz"


def issue(spark, rows):
    df = spark.createDataFrame(rows, INDEX).select("*", *[F.lit(None).cast("string").alias(c) for c in ("parameters",)])
    return inventory.enrich_index(df)


def entry(dac, number, cycle, day):
    return (f"{dac}/{number}/profiles/R{number}_{cycle:03d}.nc", None if day is None else datetime(2020, 1, 1) + timedelta(days=day))


def random_issue(seed):
    rng = random.Random(seed)
    rows = [entry(rng.choice(["aoml", "bodc"]), 1900000 + rng.randrange(40), rng.randrange(4), rng.choice([None, rng.randrange(30)])) for _ in range(120)]
    return rows + [("not a profile", None), ("other/thing.nc", datetime(2020, 1, 2))]


def test_changes_between_two_issues(spark):
    before = [entry("aoml", 1900001, 1, 1), entry("aoml", 1900001, 2, 1), entry("aoml", 1900002, 1, 1), entry("aoml", 1900003, 1, None)]
    after = [entry("aoml", 1900001, 1, 1), entry("aoml", 1900001, 2, 5), entry("bodc", 1900002, 1, 1), entry("aoml", 1900003, 1, 2), entry("aoml", 1900004, 7, 3)]
    got = {r.file: r.change for r in inventory.index_changes(issue(spark, before), issue(spark, after)).collect()}
    assert got == {
        "aoml/1900001/profiles/R1900001_002.nc": "reissued",
        "aoml/1900002/profiles/R1900002_001.nc": "moved",
        "bodc/1900002/profiles/R1900002_001.nc": "moved",
        "aoml/1900003/profiles/R1900003_001.nc": "reissued",
        "aoml/1900004/profiles/R1900004_007.nc": "new",
    }
    assert inventory.index_changes(issue(spark, after), issue(spark, after)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_updated_state_equals_a_new_one(spark, seed):
    old = random_issue(seed)
    rng = random.Random(seed + 50)
    new = [row for row in old if rng.random() > 0.03] + random_issue(seed + 100)[:5]
    before, after = issue(spark, old), issue(spark, new)
    for first, second in ((before, after), (before, before), (before, before.limit(0)), (before.limit(0), after)):
        state = inventory.updated_state(inventory.platform_state(first), inventory.index_changes(first, second), second)
        assert sorted(map(repr, state.collect())) == sorted(map(repr, inventory.platform_state(second).collect()))


def test_staleness_at_a_moment(spark):
    index = issue(spark, [entry("aoml", 1900001, 1, 1), entry("aoml", 1900001, 2, 9), entry("aoml", 1900002, 1, None)])
    day = [datetime(2020, 1, 1) + timedelta(days=d) for d in range(12)]
    copies = spark.createDataFrame([(1900001, day[5]), (1900002, day[5]), (1900003, day[5]), (1900001, day[8])], "wmoid long, mtime timestamp_ntz")
    got = {(r.wmoid, r.moment): (r.latest_update, r.stale) for r in inventory.staleness_as_of(index, copies, [day[0], day[1], day[8], day[9]]).collect()}
    assert got == {
        (1900001, day[0]): (None, True), (1900001, day[1]): (day[1], False), (1900001, day[8]): (day[1], False), (1900001, day[9]): (day[9], True),
        **{(n, m): (None, True) for n in (1900002, 1900003) for m in (day[0], day[1], day[8], day[9])},
    }


def test_modes_as_rows(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "id long, TEMP_DATA_MODE string")
    rows = spark.createDataFrame(
        [(1, 0, "TEMP ", "R"), (1, 3, "TEMP", "D "), (1, 1, "PRES", "A"), (1, 2, "MTIME", "R"), (None, 0, "PRES", "D"), (9, 0, "PRES", "D")],
        "id long, POSITION int, PARAMETER string, DATA_MODE string",
    )
    got = profiles.modes_from_rows(df, rows, ["id"], names=["PRES", "TEMP"], strict=False)
    assert got.columns == ["id", "PRES_DATA_MODE", "TEMP_DATA_MODE"]
    assert {r.id: tuple(r)[1:] for r in got.collect()} == {1: ("A", "D"), 2: ("", ""), None: ("D", "")}


def test_contents_of_files_with_rows_are_not_looked_at(spark, scratch):
    spark.range(0, 50_000, 1, 1).write.parquet(f"{scratch}/in")
    spark.range(10).coalesce(1).write.parquet(f"{scratch}/small")
    (small,) = catalog.matching_paths(spark, f"{scratch}/small/*.parquet")
    catalog.cut_file(spark, small, 100)
    (Path(scratch) / "in" / "cut.parquet").write_bytes(Path(small.removeprefix("file:")).read_bytes())
    # A longer content than this, once asked for, is an error.
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        probed = {r.n_bytes: r.reason for r in readers.probe_parquet(spark, f"{scratch}/in").collect()}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert len(probed) == 2 and probed[100] == readers.NO_PARQUET and probed[max(probed)] is None


def test_one_file_is_written_from_many_tasks(spark, scratch):
    queries._in_one_file(spark.range(0, 1000, 1, 8).withColumn("task", F.spark_partition_id()), f"{scratch}/one")
    (path,) = catalog.matching_paths(spark, f"{scratch}/one/*.parquet")
    assert spark.read.parquet(path).select("task").distinct().count() == 8
    length = catalog.file_bytes(spark, path)
    whole = bytes(spark.read.format("binaryFile").load(path).first()["content"])
    catalog.cut_file(spark, path, length // 2)
    assert bytes(spark.read.format("binaryFile").load(path).first()["content"]) == whole[: length // 2]
