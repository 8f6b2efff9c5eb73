import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from obslake import vocab
from obslake.operators import profiles
from tests.conftest import rows


def arrays(spark, data):
    return spark.createDataFrame(data, "input_file string, N_PROF int, PLATFORM_NUMBER long, PRES array<double>, TEMP array<double>, PARAMETER array<string>, PARAMETER_DATA_MODE array<string>, CALIBRATION_PARAMETERS array<array<string>>")


GOOD = ("a", 0, 7, [1.0, 2.0, 3.0], [5.0, 4.0], ["PRES", "TEMP  "], ["R", " D"], [["PRES"], ["PRES"]])


def test_flatten_pads_short_arrays(spark):
    out = profiles.flatten_profiles(arrays(spark, [GOOD]))
    assert out.columns == ["N_PROF", "PLATFORM_NUMBER", "N_LEVELS", "PRES", "TEMP"]
    assert rows(out, "N_LEVELS") == [(0, 7, 0, 1.0, 5.0), (0, 7, 1, 2.0, 4.0), (0, 7, 2, 3.0, None)]


def modes(spark, parameters, codes, strict=True):
    df = arrays(spark, [("a", 0, 7, [1.0], [1.0], parameters, codes, None)])
    out = profiles.spread_data_modes(df, names=["PRES", "TEMP", "DOXY"], strict=strict)
    return rows(out.select("PRES_DATA_MODE", "TEMP_DATA_MODE", "DOXY_DATA_MODE"))[0]


def test_modes(spark):
    assert modes(spark, ["PRES", "TEMP  "], ["R", " D"]) == ("R", "D", "")
    assert modes(spark, ["TEMP", "PRES", "TEMP"], ["R", "A", "D"]) == ("A", "D", "")
    assert modes(spark, ["PRES", "TEMP"], ["R"]) == ("R", "", "")
    assert modes(spark, ["PRES"], ["R", "D", "A"]) == ("R", "", "")
    assert modes(spark, [" ", "DOXY"], ["R", "A"]) == ("", "", "A")
    assert modes(spark, ["PRES"], ["RA"], strict=False) == ("", "", "")
    with pytest.raises(PySparkException, match="longer than one letter"):
        modes(spark, ["PRES"], ["RA"])


def test_calibrations(spark):
    cases = [([["P"], ["P"]], True), ([["P", "T"], ["T", "P"]], False), ([["P"]], True), ([], True)]
    for listed, same in cases:
        df = arrays(spark, [(*GOOD[:7], listed)])
        assert rows(df.select(profiles.same_in_all_calibrations(F.col("CALIBRATION_PARAMETERS")))) == [(same,)]


def test_rejects_by_profile_and_by_file(spark):
    bad = ("b", 0, 8, [1.0], [1.0], ["PRES"], ["R"], [["PRES"], ["TEMP"]])
    mate = ("b", 1, 9, *GOOD[3:])
    long_mode = ("c", 0, 10, [1.0], [1.0], ["PRES"], ["RA"], None)
    marked = profiles.mark_rejects(arrays(spark, [GOOD, bad, mate, long_mode]))
    sound, unsound = profiles.split_rejects(marked)
    assert sorted(r.PLATFORM_NUMBER for r in sound.collect()) == [7, 9]
    assert {r.PLATFORM_NUMBER: r.reject_reason for r in unsound.collect()} == {8: profiles.CALIBRATION, 10: profiles.LONG_MODE}
    sound, unsound = profiles.split_rejects(marked, "input_file")
    assert [r.PLATFORM_NUMBER for r in sound.collect()] == [7]
    assert {r.PLATFORM_NUMBER for r in unsound.collect()} == {8, 9, 10}
    assert sound.columns == arrays(spark, [GOOD]).columns


def test_bad_values_and_nameless_files(spark):
    blank = F.expr("case when PLATFORM_NUMBER = 8 then array('1', ' ') else array('1', null) end")
    table = arrays(spark, [GOOD, ("b", 0, 8, [1.0], [1.0], ["PRES"], ["R"], None)]).withColumn("PRES_QC", blank)
    marked = profiles.mark_rejects(table, schema=vocab.raw_schema("PHY"))
    assert {(r.PLATFORM_NUMBER, r.reject_reason) for r in marked.collect()} == {(7, None), (8, profiles.MISFIT)}
    nameless = marked.withColumn("input_file", F.lit(None).cast("string"))
    sound, unsound = profiles.split_rejects(nameless, "input_file")
    assert [r.PLATFORM_NUMBER for r in sound.collect()] == [7]
    assert [r.PLATFORM_NUMBER for r in unsound.collect()] == [8]


def test_unknown_parameters(spark):
    df = arrays(spark, [(*GOOD[:5], ["PRES", "MTIME ", "MTIME", ""], ["R"] * 4, None), (*GOOD[:5], ["MTIME"], ["R"], None)])
    assert rows(profiles.unknown_parameters(df)) == [("MTIME", 2)]


@pytest.mark.parametrize("profile", ["PHY", "BGC"])
def test_raw_table_has_the_raw_schema(spark, profile):
    out = profiles.raw_table(arrays(spark, [GOOD]), profile)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in vocab.raw_schema(profile)]
    assert "Exchange" not in out._jdf.queryExecution().toString()
    assert out.count() == 3
