"""Seawater variables computed from the measured ones."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake import vocab
from obslake.functions import seawater, times
from obslake.operators.atlas import Grid, with_anomaly
from obslake.operators.quality import constant_flags
from obslake.operators.standardize import harmonise_aliases, reindex, standardize, typed_null

_INPUTS = ("PSAL", "PRES", "TEMP", "LONGITUDE", "LATITUDE")

_GLIDER_TYPES = {
    "mission": T.StringType(),
    "mission_name": T.StringType(),
    "time": T.TimestampNTZType(),
    "profile": T.IntegerType(),
    "mission_profile": T.IntegerType(),
    "trajectory_index": T.IntegerType(),
}
GLIDER_SCHEMA = T.StructType(
    [T.StructField(name, _GLIDER_TYPES.get(name, T.DoubleType())) for name in vocab.GLIDER_COLUMNS]
)


def add_pressure_from_depth(df: DataFrame, depth: str = "depth", latitude: str = "lat") -> DataFrame:
    """Add ``PRES`` in dbar from depth in metres, positive down."""
    return seawater.with_pressure(df, "PRES", depth, latitude)


def add_derived(
    df: DataFrame, atlas: DataFrame | None = None, grid: Grid = Grid(), strict: bool = True
) -> DataFrame:
    """Add absolute salinity, conservative temperature and the density anomaly at 1000 dbar.

    Each step uses the rounded float column of the step before. A null input gives null.
    If inputs are absent that is an error, or three null columns if not ``strict``.

    ``atlas`` holds the regional salinity anomaly ratio, see ``operators.atlas``. Without
    it, absolute salinity is the reference salinity and misses the regional anomaly.
    """
    absent = [c for c in _INPUTS if c not in df.columns]
    if absent:
        if strict:
            raise ValueError(f"derived variables need {absent}")
        return df.withColumns({c: typed_null(T.FloatType()) for c in vocab.DERIVED_COLUMNS})
    sa, ct, sigma1 = vocab.DERIVED_COLUMNS
    ratio = None
    # Counting the rows, which query listeners may read, ends the generated code of what comes
    # before. Else a long choice of best values and the polynomials make one method too
    # large for the JVM to compile.
    df = df.observe(f"derived_rows_{uuid.uuid4().hex}", F.count("*").alias("n_rows"))
    if atlas is not None:
        df, ratio = with_anomaly(df, atlas, grid), F.col("__anomaly")
    # Like the stages that follow it, the result is kept apart by a one-element explode.
    salinity = F.explode(F.array(seawater.absolute_salinity(F.col("PSAL"), ratio)))
    df = df.select(*[c for c in df.columns if c not in (sa, "__anomaly")], salinity.alias(sa))
    df = seawater.with_conservative_temperature(df, ct, sa, "TEMP", "PRES")
    return seawater.with_sigma1(df, sigma1, sa, ct)


def _in_utc(time: Column, dtype: T.DataType) -> Column:
    """A moment as zone-free UTC; what has no zone already is taken as UTC."""
    return times.utc_ntz(time) if isinstance(dtype, T.TimestampType) else time.cast("timestamp_ntz")


def standardize_glider(df: DataFrame, profile: str = "PHY", strict: bool = True) -> DataFrame:
    """Glider data; pressure comes from depth, and all measurements are flagged good."""
    named = reindex(harmonise_aliases(df, vocab.source("SprayGliders").aliases), GLIDER_SCHEMA)
    timed = named.withColumn("time", _in_utc(F.col("time"), named.schema["time"].dataType))
    lake = standardize(add_pressure_from_depth(timed), "SprayGliders", profile, strict)
    return constant_flags(lake, ["TEMP", "PSAL", "PRES"], 1, profile)
