"""Seawater variables against the published check values of TEOS-10."""

import random

import pytest
from pyspark.sql import functions as F

from obslake import vocab
from obslake.functions import seawater
from obslake.operators import derived
from obslake.operators.atlas import Grid, with_anomaly
from tests.conftest import rows

# Published check inputs and results.
SA = [34.7118, 34.8915, 35.0256, 34.8472, 34.7366, 34.7324]
P = [10.0, 50.0, 125.0, 250.0, 600.0, 1000.0]
T = [28.7856, 28.4329, 22.8103, 10.2600, 6.8863, 4.4036]
CT = [28.80991983, 28.43922782, 22.78617689, 10.22618927, 6.82721363, 4.32357575]
CT_IN = [28.8099, 28.4392, 22.7862, 10.2262, 6.8272, 4.3236]
SIGMA1 = [25.95561885, 26.21313142, 28.12542378, 31.12036004, 31.63772422, 32.00245322]
PRESSURE = [10.05572672, 50.28354337, 125.73185844, 251.54029959, 604.21001234, 1007.99033769]


@pytest.fixture(scope="module")
def check(spark):
    data = [(i, *v) for i, v in enumerate(zip(SA, P, T, CT_IN))]
    return spark.createDataFrame(data, "k int, sa double, p double, t double, ct double").withColumn("lat", F.lit(4.0))


def values(df, column):
    return [r[column] for r in df.orderBy("k").collect()]


def test_conservative_temperature(check):
    out = seawater.with_conservative_temperature(check, "out", "sa", "t", "p")
    assert values(out, "out") == pytest.approx(CT, abs=2e-6)


def test_sigma1(check):
    assert values(seawater.with_sigma1(check, "out", "sa", "ct"), "out") == pytest.approx(SIGMA1, abs=2e-6)


def test_pressure(check):
    out = seawater.with_pressure(check, "out", "p", "lat")
    assert values(out, "out") == pytest.approx(PRESSURE, abs=1e-4)


def table(spark, rows_):
    return spark.createDataFrame(rows_, "LATITUDE double, LONGITUDE double, PSAL float, PRES float, TEMP float")


def test_columns_types_and_nulls(spark):
    df = table(spark, [(35.0, -70.0, 1.1, 2.1, 20.2), (36.25, -70.0, 1.1, 1.9, 22.9), (0.0, 0.0, None, 5.0, 4.0), (0.0, 0.0, 35.0, 5.0, None)])
    out = derived.add_derived(df)
    assert [dict(out.dtypes)[c] for c in vocab.DERIVED_COLUMNS] == ["float"] * 3
    got = {(r.PSAL, r.TEMP): tuple(r[c] is not None for c in vocab.DERIVED_COLUMNS) for r in out.collect()}
    assert list(got.values()).count((True, True, True)) == 2
    assert (False, False, False) in got.values() and (True, False, False) in got.values()


def test_absent_inputs(spark):
    df = spark.createDataFrame([(1.0,)], "LATITUDE double")
    with pytest.raises(ValueError, match="PSAL"):
        derived.add_derived(df)
    assert rows(derived.add_derived(df, strict=False)) == [(1.0, None, None, None)]


def test_recomputing_replaces(spark):
    once = derived.add_derived(table(spark, [(35.0, -70.0, 35.0, 2.0, 20.0)]))
    assert rows(derived.add_derived(once)) == rows(once)


def test_filter_on_a_result_stays_above_the_stages(spark):
    df = table(spark, [(35.0, -70.0, 35.0, 2.0, 20.0)])
    out = derived.add_derived(df).where("SIGMA1_COMPUTED > 20 and CONSERVATIVE_TEMP_COMPUTED < 30 and LATITUDE > 0")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 60_000
    assert out.count() == 1


def interpolated(points, grid, lon, lat, p):
    """The ratio by hand: bilinear on the levels around the pressure."""
    east, north = ((lon - grid.longitude) % 360) / grid.step, (lat - grid.latitude) / grid.step
    i, j = int(east // 1), int(north // 1)
    u, v = east - i, north - j
    levels = sorted({q for (_, _, q) in points})
    p = min(max(p, levels[0]), levels[-1])
    lo, hi = max(q for q in levels if q <= p), min(q for q in levels if q >= p)

    def at(q):
        corner = [points.get(((i + a) % grid.around, j + b, q)) for b in (0, 1) for a in (0, 1)]
        there = [c for c in corner if c is not None]
        r = [sum(there) / len(there) if c is None else c for c in corner]
        return (r[0] * (1 - u) + r[1] * u) * (1 - v) + (r[2] * (1 - u) + r[3] * u) * v

    w = 0 if hi == lo else (p - lo) / (hi - lo)
    return at(lo) * (1 - w) + at(hi) * w


def test_atlas_against_brute_force(spark):
    grid, rng = Grid(step=30.0, longitude=0.0, latitude=-90.0), random.Random(1)
    points = {(i, j, q): rng.random() for i in range(12) for j in range(7) for q in (0.0, 100.0, 500.0)}
    for q in (0.0, 100.0, 500.0):
        del points[(3, 3, q)]
    atlas = spark.createDataFrame([(30.0 * i, 30.0 * j - 90, q, r) for (i, j, q), r in points.items()], "longitude double, latitude double, pressure double, ratio double")
    where = [(k, rng.uniform(-180, 179.9), rng.uniform(-89, 89), rng.uniform(-10, 800)) for k in range(200)]
    df = spark.createDataFrame(where, "k int, LONGITUDE double, LATITUDE double, PRES double")
    got = values(with_anomaly(df, atlas, grid), "__anomaly")
    assert got == pytest.approx([interpolated(points, grid, *w[1:]) for w in where], abs=1e-12)


def test_atlas_changes_absolute_salinity(spark):
    grid = Grid(step=90.0, longitude=0.0, latitude=-90.0)
    atlas = spark.createDataFrame([(90.0 * i, 90.0 * j - 90, 0.0, 0.01) for i in range(4) for j in range(3)], "longitude double, latitude double, pressure double, ratio double")
    df = table(spark, [(10.0, 20.0, 35.0, 2.0, 20.0)])
    plain, moved = derived.add_derived(df).first(), derived.add_derived(df, atlas, grid).first()
    assert moved.ABS_SAL_COMPUTED == pytest.approx(plain.ABS_SAL_COMPUTED * 1.01, rel=1e-6)
    assert moved.SIGMA1_COMPUTED > plain.SIGMA1_COMPUTED
