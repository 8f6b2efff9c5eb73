import json

import pytest
from pyspark.sql import types as T

from obslake import vocab


@pytest.mark.parametrize(
    ("profile", "level", "n"), [("PHY", "QC", 15), ("PHY", "ALL", 21), ("BGC", "QC", 157), ("BGC", "ALL", 215)]
)
def test_lake_column_counts(profile, level, n):
    columns = vocab.lake_columns(profile, level)
    assert len(columns) == len(set(columns)) == n


def test_raw_column_counts():
    assert len(vocab.raw_columns("PHY")) == 26
    assert len(vocab.raw_columns("BGC")) == 219
    assert "CHLA_FLUORESCENCE" in vocab.raw_columns("BGC")
    assert "PRES_dPRES" not in vocab.raw_columns("BGC")


def test_phy_columns_are_bgc_columns_but_for_the_mode():
    assert set(vocab.lake_columns("PHY")) - set(vocab.lake_columns("BGC")) == {"DATA_MODE"}


@pytest.mark.parametrize(
    ("name", "lake", "raw"),
    [
        ("N_LEVELS", T.IntegerType(), T.IntegerType()),
        ("PRES_ADJUSTED_QC", T.ShortType(), T.ShortType()),
        ("LATITUDE", T.DoubleType(), T.DoubleType()),
        ("JULD", T.TimestampNTZType(), T.TimestampNTZType()),
        ("TEMP_DATA_MODE", T.StringType(), T.StringType()),
        ("DIRECTION", T.FloatType(), T.StringType()),
        ("PLATFORM_NUMBER", T.StringType(), T.LongType()),
        ("DOXY_ERROR", T.FloatType(), T.FloatType()),
    ],
)
def test_types_follow_from_names(name, lake, raw):
    assert vocab.column_type(name) == lake
    assert vocab.column_type(name, raw=True) == raw


def test_arguments_are_checked():
    assert vocab.profile_type(None) == "PHY"
    assert vocab.profile_type("bgc") == "BGC"
    for bad in ("X", 3):
        with pytest.raises(ValueError):
            vocab.profile_type(bad)
    with pytest.raises(ValueError):
        vocab.quality_level("BEST")
    with pytest.raises(ValueError):
        vocab.source("NOWHERE")


def test_pruned_to_nothing_is_an_error():
    with pytest.raises(ValueError):
        vocab.prune_schema(vocab.lake_schema("PHY"), ["lat", "lon"])


def test_merged_schemas_keep_first_order_and_refuse_conflicts():
    a = T.StructType().add("x", T.IntegerType()).add("y", T.FloatType())
    b = T.StructType().add("y", T.FloatType()).add("z", T.StringType())
    assert vocab.merge_schemas([a, b]).fieldNames() == ["x", "y", "z"]
    with pytest.raises(ValueError):
        vocab.merge_schemas([a, T.StructType().add("y", T.StringType())])


def test_schema_survives_json():
    schema = vocab.lake_schema("BGC", derived=True)
    assert T.StructType.fromJson(json.loads(schema.json())) == schema
    assert schema.fieldNames()[-3:] == list(vocab.DERIVED_COLUMNS)


def test_bottle_renames():
    renames = vocab.SOURCES["GLODAP"].renames
    assert len(renames) == 33
    assert renames["G2chlaf"] == "CHLA_QC"
    assert "G2pressuref" not in renames
