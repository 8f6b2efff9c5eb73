import os
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from checks import queries as q
from obslake import vocab
from obslake.operators import standardize
from obslake.plans import jobs, lake
from obslake.sources import catalog, readers, writers
from obslake.streaming import ingest, latest, report
from tests.conftest import SMALL, rows


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    for name, table in q.phy_tables(spark, SMALL).items():
        writers.write_table(table, f"{root}/{vocab.source(name).folder_mark}_PHY")
    return root


def count_files(path):
    return len(list(Path(path).glob("*.parquet")))


def test_source_selection():
    assert catalog.selected_sources(None) == list(vocab.SOURCES)
    assert catalog.selected_sources("CPR") == ["CPR"]
    for bad in (["NOWHERE"], 3):
        with pytest.raises(ValueError):
            catalog.selected_sources(bad)


def test_column_selection():
    assert lake.selected_columns(None, "PHY") == vocab.lake_columns("PHY")
    assert lake.selected_columns("TEMP", "PHY") == ["TEMP"]
    assert lake.selected_columns("PRES_ADJUSTED", "PHY", "ALL") == ["PRES_ADJUSTED"]
    for bad in (["DOXY"], [], ["PRES_ADJUSTED"]):
        with pytest.raises(ValueError):
            lake.selected_columns(bad, "PHY")


def test_load_everything(spark, root):
    df = lake.load_lake(spark, root)
    assert df.columns == vocab.lake_columns("PHY")
    counts = {r.DB_NAME: r["count"] for r in df.groupBy("DB_NAME").count().collect()}
    assert counts == {name: t.count() for name, t in q.phy_tables(spark, SMALL).items()}


def test_load_some(spark, root):
    df = lake.load_lake(spark, root, sources=["CPR", "GLODAP"], columns=["TEMP", "DB_NAME", "ABS_SAL_COMPUTED"])
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [("TEMP", "float"), ("DB_NAME", "string"), ("ABS_SAL_COMPUTED", "float")]
    assert {r.DB_NAME for r in df.select("DB_NAME").distinct().collect()} == {"CPR", "GLODAP"}


def test_filter_and_projection_reach_every_scan(spark, root):
    df = lake.load_lake(spark, root, sources=["ARGO", "GLODAP"], columns=["TEMP"], filters=[("PRES", "<", 100.0)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [s.split("\n")[0] for s in plan.split("FileScan parquet")[1:]]
    assert len(scans) == 2
    assert all("LessThan(PRES,100.0)" in s and "ReadSchema: struct<PRES:float,TEMP:float>" in s for s in scans)
    assert "Exchange" not in plan


def test_only_filtered_columns(spark, root):
    df = lake.load_lake(spark, root, sources="ARGO", filters=[("TEMP", ">", 1), ("LATITUDE", "<", 0)], only_filtered_columns=True)
    assert df.columns == ["LATITUDE", "TEMP"]


def test_discovery(spark, scratch):
    frame = spark.createDataFrame([("x", 1.0)], "DB_NAME string, TEMP float")
    with pytest.raises(ValueError, match="no source"), pytest.warns(UserWarning):
        catalog.discover(spark, scratch)
    frame.write.parquet(f"{scratch}/0001_CPR_PHY")
    with pytest.warns(UserWarning, match="left out"):
        assert list(catalog.discover(spark, scratch)) == ["CPR"]
    frame.write.parquet(f"{scratch}/0002_CPR_PHY")
    with pytest.raises(ValueError, match="more than one"):
        catalog.discover(spark, scratch, "CPR")


def test_schema_sidecar(spark, root, scratch):
    path = f"{root}/GLODAP_PHY"
    assert catalog.load_schema(spark, path) == spark.read.parquet(path).schema
    plain = spark.createDataFrame([(1,)], "a int")
    plain.write.parquet(f"{scratch}/t")
    assert catalog.load_schema(spark, f"{scratch}/t").fieldNames() == ["a"]


@pytest.mark.parametrize(
    ("state", "overwrite", "total"),
    [("absent", True, 2), ("absent", False, 2), ("empty", True, 2), ("empty", False, 2), ("full", True, 2), ("full", False, 4)],
)
def test_append_and_overwrite(spark, scratch, state, overwrite, total):
    path = f"{scratch}/t"
    df = spark.createDataFrame([(1.0,), (2.0,)], "TEMP float")
    if state == "empty":
        os.makedirs(path)
    if state == "full":
        writers.write_table(df, path)
    writers.write_table(df, path, overwrite=overwrite)
    assert spark.read.parquet(path).count() == total


def test_layouts(spark, scratch):
    df = spark.range(0, 40_000, 1, 16).selectExpr("cast(id % 7 as float) TEMP", "cast(id as float) PRES")
    writers.write_table(df, f"{scratch}/a")
    assert count_files(f"{scratch}/a") == 1
    writers.write_table(df, f"{scratch}/b", layout="scan", sidecar=False)
    assert count_files(f"{scratch}/b") == 16
    assert not catalog.path_exists(spark, f"{scratch}/b/{catalog.SCHEMA_FOLDER}")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    writers.write_table(df, f"{scratch}/c", cluster_by=["TEMP"], target_bytes=20_000)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before
    assert rows(spark.read.parquet(f"{scratch}/c").selectExpr("count(*)", "sum(PRES)")) == rows(df.selectExpr("count(*)", "sum(PRES)"))
    with pytest.raises(ValueError):
        writers.write_table(df, f"{scratch}/d", layout="other")


def test_table_names():
    assert writers.table_name("CPR", "PHY") == "CPR_PHY"
    assert writers.table_name("CPR", "PHY", "x.parquet") == "x_PHY"
    assert writers.table_name("CPR", "PHY", "x_PHY") == "x_PHY"


def test_sizes(spark, root):
    df = lake.load_lake(spark, root, sources="GLODAP")
    report_rows = lake.size_report(df).collect()
    assert lake.total_bytes(df) == sum(r.n_bytes for r in report_rows)
    assert isinstance(lake.to_local(df), pd.DataFrame)
    with pytest.raises(lake.TooLargeError):
        lake.to_local(df, max_bytes=1000)


def test_union_refuses_type_conflicts(spark):
    a = spark.createDataFrame([(1.0,)], "TEMP float")
    b = spark.createDataFrame([("x",)], "TEMP string")
    with pytest.raises(ValueError, match="TEMP"):
        lake.unite({"ARGO": a, "CPR": b}, ["TEMP"])


def test_csv_errors(spark, scratch):
    with pytest.raises(FileNotFoundError):
        readers.read_csv(spark, f"{scratch}/none.csv", "CPR")
    open(f"{scratch}/empty.csv", "w").close()
    with pytest.raises(readers.EmptyFileError):
        readers.read_csv(spark, f"{scratch}/empty.csv", "CPR")
    with open(f"{scratch}/bad.csv", "w") as f:
        f.write("SampleId,Latitude,Longitude,Year\na,1.5,2.5,1999\nb,not,2.5,1999\nc,3.5,4.5,2000,9\n")
    with pytest.raises(Exception, match="Malformed"):
        readers.read_csv(spark, f"{scratch}/bad.csv", "CPR").collect()
    with pytest.raises(readers.UnreadableFileError):
        readers.read_csv(spark, f"{scratch}/bad.csv", "CPR", check=True)
    good, bad = readers.read_csv_with_rejects(spark, f"{scratch}/bad.csv", "CPR")
    assert rows(good) == [("a", 1.5, 2.5, 1999.0)]
    assert rows(bad.select("row", "reason"), "row") == [("b,not,2.5,1999", "malformed"), ("c,3.5,4.5,2000,9", "malformed")]
    assert good.count() == 1 and bad.count() == 2
    with pytest.raises(ValueError):
        readers.read_csv(spark, f"{scratch}/", "CPR")


def test_foreign_parquet(spark, scratch):
    """Nanosecond times, unsigned flags and NaN, as other writers leave them."""
    table = pa.table(
        {
            "JULD": pa.array([1_600_000_000_123_456_789, None], pa.timestamp("ns")),
            "TEMP_QC": pa.array([255, 1], pa.uint8()),
            "TEMP": pa.array([float("nan"), 2.0], pa.float32()),
            "DATA_MODE": pa.array(["R", "A"]).dictionary_encode(),
        }
    )
    pq.write_table(table, f"{scratch}/t.parquet")
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        df = standardize.null_for_nan(readers.read_parquet(spark, f"{scratch}/t.parquet", nanosecond_times=("JULD",)))
        got = rows(df, "TEMP_QC")
    finally:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "false")
    assert got[0][1:] == (1, 2.0, "A") and got[1][1:] == (255, None, "R")
    assert got[1][0].microsecond == 123456


def test_stream_goes_on_where_it_stopped(spark, scratch):
    src, out, checkpoint = (f"{scratch}/{n}" for n in ("in", "out", "checkpoint"))
    part = spark.createDataFrame([(1.0, 1), (2.0, 9)], "TEMP float, TEMP_QC short")

    def run():
        stream = ingest.file_stream(spark, src, part.schema, files_per_batch=1)
        ingest.ingest(stream, lambda df: df.where("TEMP_QC = 1"), out, checkpoint).awaitTermination()
        return spark.read.parquet(out).count()

    part.coalesce(1).write.mode("append").parquet(src)
    part.coalesce(1).write.mode("append").parquet(src)
    assert run() == 2
    assert run() == 2
    part.coalesce(1).write.mode("append").parquet(src)
    assert run() == 3


def test_latest_entries_over_batches(spark, scratch):
    src, state, checkpoint = (f"{scratch}/{n}" for n in ("in", "state", "checkpoint"))
    schema = "file string, date_update timestamp_ntz, v int"

    def arrive(*data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(src)
        stream = ingest.file_stream(spark, src, spark.createDataFrame([], schema).schema)
        latest.follow(stream, state, checkpoint).awaitTermination()
        return {r.file: r.v for r in latest.current(spark, state).collect()}

    day = [pd.Timestamp(2020, 1, d).to_pydatetime() for d in range(1, 10)]
    assert arrive(("a", day[0], 1), ("a", day[3], 2), ("b", None, 3)) == {"a": 2, "b": 3}
    assert arrive(("a", day[1], 4), ("b", day[0], 5), ("c", day[0], 6)) == {"a": 2, "b": 5, "c": 6}
    assert arrive(("a", day[5], 7)) == {"a": 7, "b": 5, "c": 6}
    assert latest.compact(spark, state) == 2
    assert arrive(("a", day[8], 8)) == {"a": 8, "b": 5, "c": 6}


def test_load_report_counts_late_arrivals(spark, scratch):
    src, out, checkpoint = (f"{scratch}/{n}" for n in ("in", "out", "checkpoint"))
    schema = "arrived timestamp_ntz, failed boolean"
    times = [pd.Timestamp(2020, 1, 1, h, 30).to_pydatetime() for h in (9, 9, 8)]
    for t, failed in zip(times, (False, True, True)):
        spark.createDataFrame([(t, failed)], schema).coalesce(1).write.mode("append").parquet(src)
        stream = ingest.file_stream(spark, src, spark.createDataFrame([], schema).schema)
        report.watch(stream, out, checkpoint).awaitTermination()
    assert [r[1:] for r in rows(report.totals(spark, out), "hour")] == [(0, 1), (1, 1)]
    assert rows(report.by_batch(spark, out), "batch_id") == [(0, 1, 0, 0.0), (1, 0, 1, 100.0), (2, 0, 1, 100.0)]


def test_bottle_job(spark, scratch):
    q.v.SRC_BOTTLE.read(spark, SMALL).coalesce(1).write.csv(f"{scratch}/csv", header=True)
    jobs.bottles(spark, f"{scratch}/csv", f"{scratch}/phy", f"{scratch}/bgc")
    phy, bgc = spark.read.parquet(f"{scratch}/phy"), spark.read.parquet(f"{scratch}/bgc")
    assert phy.count() == bgc.count() > 0
    assert set(vocab.DERIVED_COLUMNS) <= set(phy.columns)
    assert "DOXY" in bgc.columns and "DOXY" not in phy.columns
    # Without salinity, a fill value in one bottle of nine, there is nothing to derive from.
    assert bgc.where("CONSERVATIVE_TEMP_COMPUTED is not null").count() == bgc.where("PSAL is not null").count() < bgc.count()


def test_argo_job_counts_its_rows(spark, scratch):
    raw = f"{scratch}/raw"
    q.v.OBS_PHY.read(spark, SMALL).write.parquet(raw)
    jobs.argo_best_values(spark, raw, "PHY", f"{scratch}/out")
    out = spark.read.parquet(f"{scratch}/out")
    assert out.count() == 3993
    assert out.columns == vocab.lake_columns("PHY") + list(vocab.DERIVED_COLUMNS)


def test_glider_and_plankton_jobs(spark, scratch):
    q.v.SRC_GLIDER.read(spark, SMALL).write.parquet(f"{scratch}/gliders")
    jobs.gliders(spark, [f"{scratch}/gliders"], f"{scratch}/out")
    assert spark.read.parquet(f"{scratch}/out").where("PRES_QC = 1").count() > 0
    q.v.SRC_PLANKTON.read(spark, SMALL).coalesce(1).write.csv(f"{scratch}/plankton", header=True)
    jobs.plankton(spark, f"{scratch}/plankton", f"{scratch}/phy", f"{scratch}/bgc")
    assert rows(spark.read.parquet(f"{scratch}/phy"), "PLATFORM_NUMBER") == rows(q.std_plankton(spark, SMALL), "PLATFORM_NUMBER")


def test_glider_arrays_are_spread(spark):
    df = spark.createDataFrame([(1, 4.0, [1.0, 2.0], [10.0, 11.0])], "profile int, lat double, depth array<double>, temp array<double>")
    assert rows(jobs.glider_levels(df), "depth") == [(1, 4.0, 1.0, 10.0), (1, 4.0, 2.0, 11.0)]


def test_index_to_raw_table_job(spark, scratch):
    with open(f"{scratch}/index.txt", "w") as f:
        f.write("# preamble\nfile,date,latitude,longitude,ocean,profiler_type,institution,parameters,parameter_data_mode,date_update\n")
        for platform in (1000001, 1000002, 5):
            f.write(f"aoml/{platform}/profiles/R{platform}_001.nc,19970729200300,0.267,-16.032,A,845,AO,PRES TEMP,RR,20181011180520\n")
    q.v.profile_arrays(spark, SMALL).write.parquet(f"{scratch}/arrays")
    plan = jobs.plan_and_ingest(spark, f"{scratch}/index.txt", f"{scratch}/arrays", "bgc", f"{scratch}/lake", save_to="gdac")
    assert [r.wmoid for r in plan.orderBy("wmoid").collect()] == [5, 1000001, 1000002]
    raw = spark.read.parquet(f"{scratch}/lake/BGC")
    assert raw.columns == vocab.raw_columns("BGC")
    assert {r[0] for r in raw.select("PLATFORM_NUMBER").distinct().collect()} == {1000001, 1000002}
    assert spark.read.parquet(f"{scratch}/lake/metadata/bgc").count() == 3
    assert "reject_reason" in spark.read.parquet(f"{scratch}/lake/rejects/BGC").columns


def write_index(path, platforms):
    with open(path, "w") as f:
        f.write("file,date,latitude,longitude,parameters,date_update\n")
        for platform in platforms:
            f.write(f"aoml/{platform}/profiles/R{platform}_001.nc,19970729200300,0.267,-16.032,PRES TEMP,20181011180520\n")


def test_raw_profiles_append_keeps_what_is_there(spark, scratch, monkeypatch):
    """Two runs, an index per dataset, and local copies that are up to date."""
    monkeypatch.setattr(jobs, "build_session", lambda name: spark)
    q.v.profile_arrays(spark, SMALL).write.parquet(f"{scratch}/arrays")
    spark.sql("select 1000002L wmoid, timestamp_ntz'2020-01-01 00:00:00' mtime").write.parquet(f"{scratch}/copies")
    for platform, more in ((1000001, []), (1000002, ["--append"])):
        write_index(f"{scratch}/phy-{platform}.txt", [platform])
        jobs.main([
            "raw-profiles", "--index", f"phy={scratch}/phy-{platform}.txt", "--index", f"{scratch}/none.txt", "--dataset", "phy",
            "--input", f"{scratch}/arrays", "--output", f"{scratch}/lake", "--plan", f"{scratch}/plan", "--local-copies", f"{scratch}/copies", *more,
        ])
        due = {r.wmoid for r in spark.read.parquet(f"{scratch}/plan/phy").collect()}
        assert due == ({1000001} if platform == 1000001 else set())
    raw = spark.read.parquet(f"{scratch}/lake/PHY")
    assert {r[0] for r in raw.select("PLATFORM_NUMBER").distinct().collect()} == {1000001, 1000002}
    assert spark.read.parquet(f"{scratch}/lake/metadata/phy").count() == 2
    with pytest.raises(ValueError, match="no index"):
        jobs._index_of(["bgc=x"], "phy")


def test_bottles_twice(spark, scratch):
    q.v.SRC_BOTTLE.read(spark, SMALL).coalesce(1).write.csv(f"{scratch}/csv", header=True)
    for overwrite in (True, False):
        jobs.bottles(spark, f"{scratch}/csv", f"{scratch}/phy", f"{scratch}/bgc", overwrite=overwrite)
    counts = {spark.read.parquet(f"{scratch}/{p}").count() for p in ("phy", "bgc")}
    assert counts == {2 * q.v.SRC_BOTTLE.read(spark, SMALL).count()}


def test_append_refuses_a_column_of_another_type(spark, scratch):
    writers.write_table(spark.createDataFrame([(1.0, 2)], "TEMP float, a int"), f"{scratch}/t")
    writers.write_table(spark.createDataFrame([(1.0,)], "TEMP float"), f"{scratch}/t", overwrite=False)
    assert catalog.load_schema(spark, f"{scratch}/t").names == ["TEMP", "a"]
    with pytest.raises(ValueError):
        writers.write_table(spark.createDataFrame([("x",)], "TEMP string"), f"{scratch}/t", overwrite=False)
    assert spark.read.parquet(f"{scratch}/t").count() == 2


def test_several_text_files_are_one_scan(spark, scratch):
    for k, line in enumerate(["1,2.5,x", "2,3.5,y"]):
        Path(f"{scratch}/{k}.csv").write_text(f"SampleId,Latitude,Other\n{line}\n")
    df = readers.read_csv(spark, [f"{scratch}/0.csv", f"{scratch}/1.csv"], "CPR")
    assert rows(df, "SampleId") == [("1", 2.5, "x"), ("2", 3.5, "y")]
    assert df._jdf.queryExecution().toString().count("FileScan") == 1
    Path(f"{scratch}/2.csv").write_text("SampleId,Longitude,Other\n3,4.5,z\n")
    with pytest.raises(readers.UnreadableFileError):
        readers.read_csv(spark, [f"{scratch}/0.csv", f"{scratch}/2.csv"], "CPR")


def test_a_malformed_row_fails_whatever_columns_are_used(spark, scratch):
    Path(f"{scratch}/bad.csv").write_text("SampleId,Latitude,Longitude\na,1.0,2.0\nb,no,3.0\nc,4.0\n")
    df = readers.read_csv(spark, f"{scratch}/bad.csv", "CPR")
    for query in (df.groupBy().count(), df.select("SampleId")):
        with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
            query.collect()


def test_command_line(spark, scratch, monkeypatch):
    monkeypatch.setattr(jobs, "build_session", lambda name: spark)
    q.v.OBS_PHY.read(spark, SMALL).write.parquet(f"{scratch}/raw")
    jobs.main(["argo-best-values", "--input", f"{scratch}/raw", "--profile", "PHY", "--output", f"{scratch}/out"])
    jobs.main(["argo-best-values", "--input", f"{scratch}/raw", "--profile", "PHY", "--output", f"{scratch}/out", "--append"])
    assert spark.read.parquet(f"{scratch}/out").count() == 2 * 3993
    jobs.main(["argo-best-values", "--input", f"{scratch}/raw", "--profile", "PHY", "--output", f"{scratch}/by-time", "--cluster-by", "JULD"])
    times = [r.JULD for r in spark.read.parquet(f"{scratch}/by-time").coalesce(1).select("JULD").collect()]
    assert len(times) == 3993 and times == sorted(times)
