import datetime as dt
import math
import random

import pytest

from obslake.functions import text
from obslake.operators import inventory, ranking
from obslake.sources import readers
from tests.conftest import rows

NOON = "120000"


def index(spark, entries):
    """Entries are (file, date_update[, parameters])."""
    full = [(f, "20050601" + NOON, "1.0", "2.0", rest[0] if rest else "PRES TEMP", upd) for f, upd, *rest in entries]
    raw = spark.createDataFrame(full, "file string, date string, latitude string, longitude string, parameters string, date_update string")
    return inventory.enrich_index(inventory.parse_index(raw))


def test_file_parts(spark):
    out = index(spark, [("aoml/1900722/profiles/SD1900722_011D.nc", "20100101000000"), ("README", "")])
    got = {r.file: r for r in out.collect()}
    r = got["aoml/1900722/profiles/SD1900722_011D.nc"]
    assert (r.wmoid, r.cycle, r.filepath_main, r.filepath, r.filename) == (
        1900722, 11, "aoml/1900722/", "aoml/1900722/profiles/", "SD1900722_011D.nc",
    )
    assert got["README"].wmoid is None and got["README"].date_update is None
    assert [r.file for r in inventory.index_rejects(out).collect()] == ["README"]


def test_index_file_with_preamble(spark, scratch):
    path = f"{scratch}/index.txt"
    with open(path, "w") as f:
        f.write("# Title : Profile directory file\n# Project : X\n" + "# more\n" * 6)
        f.write("file,date,latitude,longitude,ocean,profiler_type,institution,parameters,parameter_data_mode,date_update\n")
        f.write("aoml/1/profiles/R1_001.nc,19970729200300,0.267,-16.032,A,845,AO,PRES TEMP,RR,20181011180520\n")
        f.write("aoml/1/profiles/R1_002.nc,,,,A,845,AO,PRES,R,20181011180520\n")
    got = rows(readers.read_index(spark, path).select("file", "date", "latitude", "date_update"), "file")
    assert got[0] == ("aoml/1/profiles/R1_001.nc", dt.datetime(1997, 7, 29, 20, 3), 0.267, dt.datetime(2018, 10, 11, 18, 5, 20))
    assert got[1][1:3] == (None, None)
    index = inventory.enrich_index(readers.read_index(spark, path))
    assert inventory.subset_index(index, "phy").count() == 2
    assert inventory.subset_index(index, "phy", latitudes=[-90, 90]).count() == 1


def test_sensors(spark):
    df = spark.createDataFrame([("PRES CHLA_FLUORESCENCE",), ("PRES CHLA DOXY",)], "p string")
    assert df.where(text.has_sensor(df.p, "CHLA")).count() == 1
    assert df.where(text.has_sensor(df.p, "CHLA", "contains")).count() == 2
    with pytest.raises(ValueError):
        text.has_sensor(df.p, "CHLA", "like")


def test_subset_arguments(spark):
    idx = index(spark, [("aoml/1/profiles/R1_001.nc", "20100101000000"), ("aoml/2/profiles/R2_001.nc", "20100101000000")])
    assert inventory.subset_index(idx, platforms=1).count() == 1
    wanted = spark.createDataFrame([(2,), (2,)], "wmoid int")
    assert [r.wmoid for r in inventory.subset_index(idx, platforms=wanted).collect()] == [2]
    with pytest.raises(ValueError, match="bgc"):
        inventory.subset_index(idx, "phy", sensors="DOXY")
    with pytest.raises(ValueError):
        inventory.subset_index(idx, "other")


def test_platform_that_changed_data_centre_has_two_paths(spark):
    idx = index(spark, [("coriolis/1/profiles/R1_002.nc", "20100101000000"), ("bodc/1/profiles/R1_001.nc", "20120101000000"), ("bodc/1/profiles/R1_003.nc", "")])
    assert rows(inventory.distinct_platforms(idx), "filepath_main") == [("bodc/1/", 1), ("coriolis/1/", 1)]


@pytest.mark.parametrize(
    ("updates", "mtime", "stale"),
    [
        (["20100101000000"], dt.datetime(2010, 1, 2), False),
        (["20100101000000", "20110101000000"], dt.datetime(2010, 1, 2), True),
        (["20100101000000"], dt.datetime(2010, 1, 1), True),
        (["20100101000000", ""], dt.datetime(2020, 1, 1), True),
        (["20100101000000"], None, True),
    ],
)
def test_staleness(spark, updates, mtime, stale):
    idx = index(spark, [(f"aoml/1/profiles/R1_00{i}.nc", u) for i, u in enumerate(updates)])
    copies = spark.createDataFrame([(1, mtime)] if mtime else [], "wmoid int, mtime timestamp_ntz")
    assert inventory.staleness(idx, copies).first().stale is stale
    assert inventory.fetch_plan(idx, copies).count() == int(stale)


def test_plan_by_local_path_and_dataset(spark):
    idx = index(spark, [("aoml/1/profiles/R1_001.nc", "20100101000000"), ("bodc/1/profiles/R1_002.nc", "20100101000000")])
    copies = spark.createDataFrame([("gdac/aoml/1/1_prof.nc", dt.datetime(2020, 1, 1))], "local_path string, mtime timestamp_ntz")
    plan = inventory.fetch_plan(idx, copies, dataset="phy", url_root="u/", save_to="gdac/")
    assert rows(plan.select("url", "local_path", "file_name")) == [("u/bodc/1/", "gdac/bodc/1/1_prof.nc", "1_prof.nc")]
    assert inventory.fetch_plan(idx, copies, dataset="phy", save_to="gdac", check_time=False).count() == 2
    assert inventory.fetch_plan(idx).count() == 2


def test_second_copy_does_not_hide_a_stale_one(spark):
    idx = index(spark, [("aoml/1/profiles/R1_001.nc", "20100101000000")])
    copies = spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (1, dt.datetime(2000, 1, 1))], "wmoid int, mtime timestamp_ntz")
    assert inventory.fetch_plan(idx, copies).count() == 1


def test_actions(spark):
    old, new = dt.datetime(2000, 1, 1), dt.datetime(2010, 1, 1)
    plan = spark.createDataFrame([(1, new, None), (2, new, old), (3, old, new), (4, old, old), (5, None, old)], "k int, latest_update timestamp_ntz, mtime timestamp_ntz")

    def actions(**options):
        return [r.action for r in inventory.fetch_actions(plan, **options).orderBy("k").collect()]

    assert actions() == ["fetch", "overwrite", "skip_fresh", "skip_fresh", "skip_fresh"]
    assert actions(check_time=False) == ["fetch"] + ["skip_exists"] * 4
    assert actions(check_time=False, overwrite=True) == ["fetch"] + ["overwrite"] * 4


@pytest.mark.parametrize("n", [0, 1, 5, 700, 9000])
def test_positions_are_exact(spark, n):
    rng = random.Random(n)
    keys = rng.sample([f"{c}/{i}/" for c in ("aoml", "bodc") for i in range(8000)], n)
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, payload int")
    got = ranking.with_position(df, "key").collect()
    assert len(got) == n
    assert {r.key: r.position for r in got} == {k: i + 1 for i, k in enumerate(sorted(keys))}
    assert {r.key: r.payload for r in got} == {k: i for i, k in enumerate(keys)}


@pytest.mark.parametrize(("n", "batches"), [(10, 3), (10, 200), (250, 200), (1, 36), (0, 4)])
def test_batches(spark, n, batches):
    plan = spark.createDataFrame([(f"a/{i:05d}/",) for i in range(n)], "filepath_main string")
    got = [r.batch_id for r in inventory.assign_batches(plan, batches).orderBy("filepath_main").collect()]
    size = math.ceil(n / max(1, min(batches, n)))
    assert got == [i // size for i in range(n)]
    with pytest.raises(ValueError):
        inventory.assign_batches(plan, 0)


def test_load_failures(spark):
    manifest = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "input_file string")
    loaded = spark.createDataFrame([("a",), ("a",), ("c",)], "input_file string")
    assert rows(inventory.load_failures(manifest, loaded), "input_file") == [("b",), ("d",)]
    assert rows(inventory.failure_summary(manifest, loaded)) == [(4, 2, 50.0)]
    assert rows(inventory.failure_summary(manifest.limit(0), loaded)) == [(0, 0, None)]


def test_index_is_combined_before_it_is_shuffled(spark):
    idx = index(spark, [("aoml/1/profiles/R1_001.nc", "")])
    plan = inventory.staleness(idx, spark.createDataFrame([], "wmoid int, mtime timestamp_ntz"))._jdf.queryExecution().executedPlan().toString()
    first = plan.rindex("Exchange hashpartitioning(filepath_main")
    assert "partial_max" in plan[first:]
