import operator

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from obslake.functions import geo
from obslake.operators import filters
from tests.conftest import rows

SALTY = [("PSAL", ">=", 34), ("CYCLE_NUMBER", "!=", 0)]
SHALLOW = [("PRES", "in", [5, 10])]
COLUMNS = ["PSAL", "CYCLE_NUMBER", "PRES"]


def test_unknown_columns_are_discarded_with_a_warning():
    with pytest.warns(UserWarning, match="WAVES"):
        assert filters.discard_missing([("WAVES", "=", 3), *SALTY], COLUMNS) == SALTY
    with pytest.warns(UserWarning, match="ICE"):
        assert filters.discard_missing([[("ICE", "<", 2), *SHALLOW], SALTY], COLUMNS) == [SHALLOW, SALTY]


def test_emptied_group_goes_and_one_group_is_unnested():
    with pytest.warns(UserWarning):
        assert filters.discard_missing([[("ICE", "<", 2)], SALTY], COLUMNS) == SALTY
        assert filters.discard_missing([("ICE", "<", 2)], COLUMNS) == []


def test_restrict_to_filtered_keeps_order():
    assert filters.restrict_to_filtered(["PRES", "TEMP", "PSAL"], [SALTY, SHALLOW]) == ["PRES", "PSAL"]


def test_bad_filters_raise():
    with pytest.raises(ValueError):
        filters.groups_of([("a", "~", 1)])
    with pytest.raises(ValueError):
        filters.groups_of([[("a", "=")]])
    for empty in ([[]], [SALTY, []]):
        with pytest.raises(ValueError, match="no predicate"):
            filters.groups_of(empty)


def test_missing_policies(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    both = [("a", ">", 1), ("zzz", "=", 1)]
    with pytest.warns(UserWarning):
        assert rows(filters.filter_rows(df, both)) == [(2,)]
    assert rows(filters.filter_rows(df, both, "null")) == []
    assert rows(filters.filter_rows(df, [[("a", "=", 1)], [("zzz", "=", 1)]], "null")) == [(1,)]
    with pytest.raises(ValueError):
        filters.filter_rows(df, both, "error")
    with pytest.raises(ValueError):
        filters.filter_rows(df, both, "other")
    assert filters.filter_rows(df, None) is df


def test_nulls_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (None, None), (3, 20.0)], "a int, f double")

    def kept(*predicate):
        return sorted(r[0] or 0 for r in filters.filter_rows(df, [predicate]).collect())

    assert kept("a", "not in", [1]) == [0, 2, 3]
    assert kept("a", "not in", [1, None]) == [2, 3]
    assert kept("a", "in", [1, None]) == [0, 1]
    assert kept("a", "!=", 1) == [2, 3]
    assert kept("f", ">", 10) == [3]
    assert kept("f", "!=", 1.0) == [2, 3]


OPS = {"=": operator.eq, "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def passes(row, groups):
    def holds(column, op, value):
        have = row[column]
        if op == "in":
            return have in value
        if op == "not in":
            return have not in value
        return have is not None and OPS[op](have, value)

    return any(all(holds(*p) for p in g) for g in groups) if groups else True


small = st.integers(-2, 2)
predicate = st.one_of(
    st.tuples(st.sampled_from("abx"), st.sampled_from(sorted(OPS)), small),
    st.tuples(st.sampled_from("abx"), st.sampled_from(["in", "not in"]), st.lists(small, min_size=1, max_size=3)),
)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(predicate, min_size=1, max_size=3), min_size=1, max_size=3))
@pytest.mark.filterwarnings("ignore::UserWarning")
def test_filters_agree_with_row_by_row_evaluation(spark, groups):
    values = [None, -1, 0, 2]
    data = [(i * 4 + j, a, b) for i, a in enumerate(values) for j, b in enumerate(values)]
    df = spark.createDataFrame(data, "k int, a int, b int")
    known = [[p for p in g if p[0] != "x"] for g in groups]
    wanted = [g for g in known if g]
    got = {r.k for r in filters.filter_rows(df, groups).collect()}
    assert got == {k for k, a, b in data if passes({"a": a, "b": b}, wanted)}


def test_filters_reach_the_scan(spark, scratch):
    spark.createDataFrame([(1, 2)], "a int, b int").write.parquet(f"{scratch}/t")
    df = filters.filter_rows(spark.read.parquet(f"{scratch}/t"), [[("a", ">", 1), ("b", "in", [1, 2])], [("b", "=", 7)]])
    assert "PushedFilters: [Or(And(GreaterThan(a,1),In(b, [1,2])),EqualTo(b,7))]" in df._jdf.queryExecution().toString()


@pytest.mark.parametrize(
    ("bounds", "want"),
    [([170, -170], (170, -170)), ([170, 190], (170, -170)), ([350, 370], (-10, 10)), ([0, 360], (-180, 180)), ([-20, 30], (-20, 30))],
)
def test_longitude_bounds(bounds, want):
    given_bounds = list(bounds)
    assert geo.normalise_longitudes(bounds) == want
    assert bounds == given_bounds


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(-179, 178), st.integers(1, 300))
def test_range_over_the_date_line_is_the_rest_of_the_circle(spark, lo, width):
    hi = min(lo + width, 179)
    df = spark.range(-179, 180).withColumnRenamed("id", "x")
    inner = {r.x for r in df.where(geo.in_longitudes(df.x, [lo, hi])).collect()}
    outer = {r.x for r in df.where(geo.in_longitudes(df.x, [hi, lo])).collect()}
    assert inner & outer == {lo, hi}
    assert inner | outer == set(range(-179, 180))
