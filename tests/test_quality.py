"""Golden rows for best values, gates and flags, and properties of the choice."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks import views
from obslake import vocab
from obslake.operators import quality
from tests.conftest import MEDIUM, rows

# platform, mode, position flag, time flag, then per parameter raw, flag, adjusted, flag, error
FLAGS = [(1, None), (2, None), (3, None), (1, 1), (1, 2), (1, 3)]


def raw_table(spark, base=(20.1, 11.1, 25.1, 16.1)):
    data = []
    for i, (flag, adjusted_flag) in enumerate(FLAGS):
        raw = base[0] if i < 2 else base[1]
        adjusted = None if adjusted_flag is None else (base[3] if adjusted_flag == 3 else base[2])
        error = None if adjusted_flag is None else 0.02
        one = (raw, flag, adjusted, adjusted_flag, error)
        data.append((1000001 + i, "R" if adjusted_flag is None else "D", 1, 1, *one, *one, *one))
    fields = ["PLATFORM_NUMBER long, DATA_MODE string, POSITION_QC short, JULD_QC short"]
    for p in vocab.PHY_PARAMETERS:
        fields.append(f"{p} float, {p}_QC short, {p}_ADJUSTED float, {p}_ADJUSTED_QC short, {p}_ADJUSTED_ERROR float")
    return spark.createDataFrame(data, ", ".join(fields))


def close(got, want):
    return all(
        (g is None and w is None) or (g is not None and w is not None and math.isclose(g, w, rel_tol=1e-6))
        for g, w in zip(got, want, strict=True)
    )


def test_best_value_golden(spark):
    best = quality.best_values(raw_table(spark), "PHY")
    assert not [c for c in best.columns if "ADJUSTED" in c]
    got = rows(best.select("TEMP", "TEMP_QC", "TEMP_ERROR", "PLATFORM_NUMBER"), "PLATFORM_NUMBER")
    want = [
        (20.1, 1, None), (20.1, 2, None), (None, None, None), (25.1, 1, 0.02), (25.1, 2, 0.02), (None, None, None),
    ]
    assert all(close(g[:3], w) for g, w in zip(got, want, strict=True))
    assert dict(best.dtypes)["PSAL"] == "float" and dict(best.dtypes)["PSAL_QC"] == "smallint"


@pytest.mark.parametrize(
    ("mode", "raw", "flag", "adjusted", "adjusted_flag", "want"),
    [
        (None, 1.0, 1, 2.0, 1, (None, None, None)),
        ("A", 1.0, 1, 2.0, 8, (2.0, 8, 0.5)),
        ("R", 1.0, 5, 2.0, 1, (1.0, 5, None)),
        ("R", None, 1, 2.0, 1, (None, None, None)),
        ("D", 1.0, 1, None, 1, (None, None, None)),
        ("D", 1.0, 1, 2.0, None, (None, None, None)),
        ("X", 1.0, 1, 2.0, 1, (None, None, None)),
    ],
)
def test_best_value_cases(spark, mode, raw, flag, adjusted, adjusted_flag, want):
    schema = "DATA_MODE string, T float, T_QC short, T_ADJUSTED float, T_ADJUSTED_QC short, T_ADJUSTED_ERROR float"
    df = spark.createDataFrame([(mode, raw, flag, adjusted, adjusted_flag, 0.5)], schema)
    assert rows(quality.best_values(df, "PHY").select("T", "T_QC", "T_ERROR")) == [want]


cell = st.one_of(st.none(), st.floats(-5, 40, width=32))
flag = st.one_of(st.none(), st.integers(0, 9))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["R", "A", "D", None, ""]), cell, flag, cell, flag, cell), min_size=1, max_size=40))
def test_best_value_is_raw_adjusted_or_null(spark, data):
    schema = "k int, DATA_MODE string, T float, T_QC short, T_ADJUSTED float, T_ADJUSTED_QC short, T_ADJUSTED_ERROR float"
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], schema)
    got = rows(quality.best_values(df, "PHY").select("k", "T", "T_QC", "T_ERROR"), "k")
    for (_, *triple), (mode, raw, raw_flag, adjusted, adjusted_flag, error) in zip(got, data, strict=True):
        if mode in ("A", "D") and adjusted is not None and adjusted_flag in vocab.GOOD_FLAGS:
            assert tuple(triple) == (adjusted, adjusted_flag, error)
        elif mode == "R" and raw is not None and raw_flag in vocab.GOOD_FLAGS:
            assert tuple(triple) == (raw, raw_flag, None)
        else:
            assert triple == [None, None, None]


def test_position_time_gate_golden(spark):
    position, juld = [1, 2, 2, 9, 1, 1], [1, 3, 1, 1, 1, None]
    data = [(i, p, j, 20.0, 1, 0.5) for i, (p, j) in enumerate(zip(position, juld))]
    df = spark.createDataFrame(data, "k int, POSITION_QC short, JULD_QC short, TEMP float, TEMP_QC short, TEMP_ERROR float")
    got = rows(quality.null_unless_located(df).select("TEMP", "TEMP_QC", "TEMP_ERROR", "k"), "k")
    assert [r[0] for r in got] == [20.0, None, 20.0, None, 20.0, None]
    assert all(r[1:3] == (1, 0.5) for r in got)


def test_drop_empty_rows_golden(spark):
    data = [(i, None if i in (2, 5) else 1.0, None, 1, 1) for i in range(6)]
    df = spark.createDataFrame(data, "k int, TEMP float, PSAL float, TEMP_QC short, PSAL_QC short")
    assert [r.k for r in quality.drop_empty_rows(df).orderBy("k").collect()] == [0, 1, 3, 4]


def test_whole_table_golden(spark):
    out = quality.best_value_table(raw_table(spark), "PHY")
    got = rows(out.select("PLATFORM_NUMBER", "DB_NAME", "TEMP_QC"), "PLATFORM_NUMBER")
    assert got == [("1000001", "ARGO", 1), ("1000002", "ARGO", 2), ("1000004", "ARGO", 1), ("1000005", "ARGO", 2)]
    assert not [c for c in out.columns if "ADJUSTED" in c or c in ("POSITION_QC", "JULD_QC")]


def test_whole_table_known_sums(spark):
    out = quality.best_value_table(views.OBS_PHY.read(spark, MEDIUM), "PHY")
    total = out.agg(F.count("*"), F.count("PRES"), F.count("TEMP"), F.count("PSAL"), F.sum(F.col("PRES").cast("double"))).first()
    assert tuple(total) == (39486, 27476, 17576, 22178, 27959902.0)
    bgc = quality.best_value_table(views.OBS_BGC.read(spark, MEDIUM), "BGC")
    counts = bgc.agg(F.count("*"), F.count("PRES"), F.count("TEMP"), F.count("PSAL"), F.count("DOXY")).first()
    assert tuple(counts) == (40511, 26232, 17249, 20739, 15938)


def test_row_gate_shape():
    columns = ["POSITION_QC", "JULD_QC", "PRES", "PRES_QC", "PRES_ADJUSTED_QC", "PRES_DATA_MODE"]
    assert quality.flagged_parameters(columns) == ["PRES"]
    assert quality.row_gate_filters(columns, "PHY") == [[("PRES_QC", "in", [1, 2])], [("PRES_ADJUSTED_QC", "in", [1, 2])]]
    groups = quality.row_gate_filters(columns, "BGC")
    assert all(len(g) == 2 and all(len(p) == 3 for p in g) for g in groups)
    assert groups[0][1] == ("PRES_DATA_MODE", "==", "R")


def test_gate_is_stricter_than_the_value(spark):
    """Flags 5 and 8 are good for a value, but some flag must be 1 or 2 for the row to count."""
    df = raw_table(spark).where("PLATFORM_NUMBER = 1000001")
    only_5 = df.withColumns({f"{p}_QC": F.lit(5).cast("short") for p in vocab.PHY_PARAMETERS})
    assert quality.best_value_table(only_5, "PHY").count() == 0
    one_clean = only_5.withColumn("PSAL_QC", F.lit(2).cast("short"))
    assert rows(quality.best_value_table(one_clean, "PHY").select("TEMP_QC", "PSAL_QC")) == [(5, 2)]


def test_row_kept_for_a_value_the_lake_has_no_column_for(spark):
    names = {"CHLA_FLUORESCENCE": 1.0, "PRES": None}
    fields, data = ["PLATFORM_NUMBER long, POSITION_QC short, JULD_QC short"], [1, 1, 1]
    for n, value in names.items():
        fields.append(f"{n} float, {n}_QC short, {n}_ADJUSTED float, {n}_ADJUSTED_QC short, {n}_ADJUSTED_ERROR float, {n}_DATA_MODE string")
        data += [value, 1, None, None, None, "R"]
    out = quality.best_value_table(spark.createDataFrame([tuple(data)], ", ".join(fields)), "BGC")
    assert rows(out.select("PRES")) == [(None,)] and "CHLA_FLUORESCENCE" not in out.columns


def test_constant_flags(spark):
    df = spark.createDataFrame([(1.0,)], "TEMP float")
    out = quality.constant_flags(df, ["TEMP", "PSAL"], [1, 2], "PHY")
    assert rows(out.select("TEMP_QC", "PSAL_QC")) == [(1, 2)]
    assert rows(quality.constant_flags(df, ["TEMP"], 3, "PHY").select("TEMP_QC")) == [(3,)]
    for bad in (["NOPE"], 1), (["TEMP"], "1"), (["TEMP"], [1, 2]), (["DOXY"], 1):
        with pytest.raises(ValueError):
            quality.constant_flags(df, *bad, "PHY")


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_best_value_table_does_not_shuffle_and_filters_in_the_scan(spark, scratch):
    raw_table(spark).write.parquet(f"{scratch}/raw")
    out = quality.best_value_table(spark.read.parquet(f"{scratch}/raw"), "PHY")
    plan = plan_of(out)
    assert "Exchange" not in plan
    pushed = plan[plan.rindex("PushedFilters") :].split("ReadSchema")[0]
    assert "In(POSITION_QC, [1,2,5,8])" in pushed and "Or(" in pushed
    narrow = plan_of(out.select("TEMP"))
    schema = narrow[narrow.rindex("ReadSchema") :]
    assert "PLATFORM_NUMBER" not in schema and "PSAL_ADJUSTED_ERROR" not in schema


def test_wide_table_keeps_columnar_scan(spark, scratch):
    spark.createDataFrame([], vocab.raw_schema("BGC")).write.parquet(f"{scratch}/raw")
    out = quality.best_value_table(spark.read.parquet(f"{scratch}/raw"), "BGC")
    assert "Batched: true" in plan_of(out)
    assert out.columns == [c for c in vocab.lake_columns("BGC") if c in out.columns]
