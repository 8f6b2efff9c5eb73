import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake import vocab
from obslake.functions import times
from obslake.operators import derived, standardize
from tests.conftest import rows


def plankton(spark, **drop):
    data = [
        ("100DA-13", 48.66, -25.1733, "1972-10-24T06:05Z", 1972, 10, 24, 6),
        ("100DA-14", 49.66, -26.1733, "1972-10-25T06:05Z", 1972, 10, 25, 6),
    ]
    return spark.createDataFrame(
        data, "SampleId string, Latitude double, Longitude double, MidPoint_Date_UTC string, Year int, Month int, Day int, Hour int"
    )


def test_plankton_golden(spark):
    out = standardize.standardize_plankton(plankton(spark))
    assert rows(out, "PLATFORM_NUMBER")[0] == ("CPR", "100DA-13", 48.66, -25.1733, dt.datetime(1972, 10, 24, 6, 5))
    assert isinstance(out.schema["JULD"].dataType, T.TimestampNTZType)
    parts = standardize.standardize_plankton(plankton(spark).drop("MidPoint_Date_UTC"))
    assert rows(parts.select("JULD"), "JULD")[0] == (dt.datetime(1972, 10, 24, 6, 0),)


def test_plankton_without_dates_warns(spark):
    with pytest.warns(UserWarning, match="JULD"):
        out = standardize.standardize_plankton(plankton(spark).drop("MidPoint_Date_UTC", "Hour"))
    assert "JULD" not in out.columns


def test_times_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("1972-10-24T06:05Z", "1972-10-24T06:05:30+02:00", 1_600_000_000_123_456_789)], "a string, b string, n long")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = rows(df.select(times.from_iso(F.col("a")), times.from_iso(F.col("b")), times.from_nanos(F.col("n"))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [(dt.datetime(1972, 10, 24, 6, 5), dt.datetime(1972, 10, 24, 4, 5, 30), dt.datetime(2020, 9, 13, 12, 26, 40, 123456))]


def test_nanoseconds_before_1970_round_down(spark):
    df = spark.createDataFrame([(-1,)], "n long")
    assert rows(df.select(times.from_nanos(F.col("n")))) == [(dt.datetime(1969, 12, 31, 23, 59, 59, 999999),)]


def test_impossible_parts(spark):
    df = spark.createDataFrame([(2001, 13, 1)], "y int, m int, d int")
    parts = [F.col(c) for c in "ymd"]
    assert rows(df.select(times.from_parts(parts, strict=False))) == [(None,)]
    with pytest.raises(PySparkException):
        df.select(times.from_parts(parts)).collect()


def test_flags_must_fit(spark):
    df = spark.createDataFrame([(9,), (256,), (None,)], "TEMP_QC int")
    schema = vocab.lake_schema("PHY")
    assert rows(standardize.conform(df, schema, strict=False)) == [(9,), (None,), (None,)]
    with pytest.raises(PySparkException, match="not a flag"):
        standardize.conform(df, schema).collect()


def test_reindex_is_idempotent(spark):
    df = spark.createDataFrame([("x", 1.0)], "DB_NAME string, TEMP float")
    schema = vocab.lake_schema("PHY")
    once = standardize.reindex(df, schema)
    assert once.columns == schema.fieldNames()
    assert rows(standardize.reindex(once, schema)) == rows(once)


def test_companions_come_from_the_table_not_from_each_other(spark):
    df = spark.createDataFrame([(1.0, 1.0)], "PSAL float, LATITUDE double")
    out = standardize.add_companions(df, vocab.lake_columns("PHY"))
    assert out.columns == ["PSAL", "LATITUDE", "PSAL_ERROR", "PSAL_QC"]
    assert dict(out.dtypes) == {"PSAL": "float", "LATITUDE": "double", "PSAL_ERROR": "float", "PSAL_QC": "smallint"}


def test_nan_and_fill_values(spark):
    df = spark.createDataFrame([(float("nan"), 1), (-9999.0, 2), (3.0, 3), (None, 4)], "TEMP double, k int")
    assert [r[0] for r in rows(standardize.null_for_nan(df), "k")] == [None, -9999.0, 3.0, None]
    assert [r[0] for r in rows(standardize.null_for_nan(df, [-9999.0]), "k")] == [None, None, 3.0, None]


def test_labels_and_domains(spark):
    df = spark.createDataFrame([("OLD", "R", "A"), ("CPR", "X", "U")], "DB_NAME string, DATA_MODE string, DIRECTION string")
    assert rows(standardize.restrict_domains(df), "DATA_MODE") == [("CPR", None, None), (None, "R", "A")]
    assert {r[0] for r in rows(standardize.label_source(df, "ARGO").select("DB_NAME"))} == {"ARGO"}
    assert standardize.label_source(df, "ARGO", overwrite=False) is df
    with pytest.raises(ValueError):
        standardize.label_source(df, "NOWHERE")


def test_wrong_names_are_an_error(spark):
    with pytest.raises(ValueError):
        standardize.conform(spark.createDataFrame([(1,)], "x int"), vocab.lake_schema("PHY"))


def test_glider_short_and_long_names_and_arrays(spark):
    when = dt.datetime(2020, 1, 1)
    short = spark.createDataFrame([(1, 10.0, 4.0, 5.0, when, "m1", 20.0, 35.0)], "profile int, depth double, lat double, lon double, time timestamp_ntz, mission_name string, temp double, sal double")
    long = short.withColumnsRenamed({"temp": "temperature", "sal": "salinity"})
    a, b = derived.standardize_glider(short), derived.standardize_glider(long)
    assert rows(a) == rows(b)
    row = a.first()
    assert (row.DB_NAME, row.PLATFORM_NUMBER, row.TEMP, row.TEMP_QC, row.PRES_QC) == ("SprayGliders", "m1", 20.0, 1, 1)
    assert row.PRES == pytest.approx(10.05572672, abs=1e-5)
    assert row.TEMP_ERROR is None
