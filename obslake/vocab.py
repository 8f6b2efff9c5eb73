"""The column vocabulary, the data sources and the types that follow from column names."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------------------

PROFILE_TYPES = ("PHY", "BGC")
LEVELS = ("QC", "ALL")

GOOD_FLAGS = (1, 2, 5, 8)
GATE_FLAGS = (1, 2)
REALTIME_MODE = "R"
ADJUSTED_MODES = ("A", "D")
DATA_MODES = ("R", "A", "D")
DIRECTIONS = ("A", "D")

PHY_PARAMETERS = ("PRES", "TEMP", "PSAL")

FLOAT_PARAMETERS = (
    "PRES", "TEMP", "PSAL", "DOXY", "BBP", "BBP470", "BBP532", "BBP700", "TURBIDITY",
    "CP", "CP660", "CHLA", "CDOM", "NITRATE", "BISULFIDE", "PH_IN_SITU_TOTAL",
    "DOWN_IRRADIANCE", "DOWN_IRRADIANCE380", "DOWN_IRRADIANCE412", "DOWN_IRRADIANCE443",
    "DOWN_IRRADIANCE490", "DOWN_IRRADIANCE555",
    "UP_IRRADIANCE", "UP_IRRADIANCE380", "UP_IRRADIANCE412", "UP_IRRADIANCE443",
    "UP_IRRADIANCE490", "UP_IRRADIANCE555", "DOWNWELLING_PAR",
)

BOTTLE_PARAMETERS = (
    "SILICATE", "PHOSPHATE", "TCO2", "TOT_ALKALINITY", "CFC11", "CFC12", "CFC113", "CCL4", "SF6",
)

# Known to raw files only; the lake has no column for it.
RAW_ONLY_PARAMETER_AFTER = {"CHLA": "CHLA_FLUORESCENCE"}

DERIVED_COLUMNS = ("ABS_SAL_COMPUTED", "CONSERVATIVE_TEMP_COMPUTED", "SIGMA1_COMPUTED")

BOTTLE_FILE = "GLODAPv2.2023_Merged_Master_File.csv"

BOTTLE_RENAMES = {
    "G2expocode": "PLATFORM_NUMBER",
    "G2latitude": "LATITUDE",
    "G2longitude": "LONGITUDE",
    "G2pressure": "PRES",
    "G2temperature": "TEMP",
    "G2salinity": "PSAL",
    "G2oxygen": "DOXY",
    "G2nitrate": "NITRATE",
    "G2silicate": "SILICATE",
    "G2phosphate": "PHOSPHATE",
    "G2tco2": "TCO2",
    "G2talk": "TOT_ALKALINITY",
    "G2phtsinsitutp": "PH_IN_SITU_TOTAL",
    "G2cfc11": "CFC11",
    "G2cfc12": "CFC12",
    "G2cfc113": "CFC113",
    "G2ccl4": "CCL4",
    "G2sf6": "SF6",
    "G2chla": "CHLA",
}
BOTTLE_TIME_PARTS = ("G2year", "G2month", "G2day", "G2hour", "G2minute")
# Bottle values without a flag column of their own.
BOTTLE_UNFLAGGED = ("G2expocode", "G2latitude", "G2longitude", "G2pressure", "G2temperature")

GLIDER_ALIASES = {"temp": "temperature", "sal": "salinity"}
GLIDER_COLUMNS = (
    "profile", "depth", "lat", "lon", "time",
    "acoustic_backscatter_at_1MHz", "acoustic_backscatter_at_750kHz",
    "mission", "mission_name", "mission_profile", "salinity", "temperature", "trajectory_index",
)
GLIDER_RENAMES = {
    "mission_name": "PLATFORM_NUMBER",
    "lat": "LATITUDE",
    "lon": "LONGITUDE",
    "temperature": "TEMP",
    "salinity": "PSAL",
    "time": "JULD",
}

PLANKTON_COLUMNS = ("SampleId", "Latitude", "Longitude", "MidPoint_Date_UTC", "Year", "Month", "Day", "Hour")
PLANKTON_RENAMES = {
    "SampleId": "PLATFORM_NUMBER",
    "Latitude": "LATITUDE",
    "Longitude": "LONGITUDE",
    "MidPoint_Date_UTC": "JULD",
}

# --- end of fixed values ------------------------------------------------------------


def flag_renames(value_renames: dict[str, str], unflagged: tuple[str, ...]) -> dict[str, str]:
    """The bottle data flags each value in a column named after it plus ``f``."""
    return {f"{src}f": f"{dst}_QC" for src, dst in value_renames.items() if src not in unflagged}


@dataclass(frozen=True)
class Source:
    """One family of observations and how its columns map to the vocabulary."""

    name: str
    folder_mark: str
    renames: dict[str, str] = field(default_factory=dict)
    aliases: dict[str, str] = field(default_factory=dict)
    columns: tuple[str, ...] = ()
    default_file: str | None = None
    fill_values: tuple[float, ...] = ()


SOURCES = {
    s.name: s
    for s in (
        Source("ARGO", "ARGO"),
        Source(
            "GLODAP",
            "GLODAP",
            renames={**BOTTLE_RENAMES, **flag_renames(BOTTLE_RENAMES, BOTTLE_UNFLAGGED)},
            columns=(*BOTTLE_TIME_PARTS, *(c for c in BOTTLE_RENAMES if c != "G2expocode")),
            default_file=BOTTLE_FILE,
            fill_values=(-9999.0,),
        ),
        Source("SprayGliders", "SPRAY", GLIDER_RENAMES, GLIDER_ALIASES, GLIDER_COLUMNS),
        Source("CPR", "CPR", PLANKTON_RENAMES, columns=PLANKTON_COLUMNS),
    )
}


def source(name: str) -> Source:
    try:
        return SOURCES[name]
    except KeyError:
        raise ValueError(f"unknown source {name!r}; known: {sorted(SOURCES)}") from None


def profile_type(value: str | None) -> str:
    """``PHY`` unless told otherwise; case does not matter."""
    if value is None:
        return "PHY"
    if not isinstance(value, str) or value.upper() not in PROFILE_TYPES:
        raise ValueError(f"profile type must be one of {PROFILE_TYPES}, got {value!r}")
    return value.upper()


def quality_level(value: str | None) -> str:
    """``QC`` (best values only) unless told otherwise."""
    name = "QC" if value is None else value.lstrip("_")
    if name not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}, got {value!r}")
    return name


def parameters(profile: str, raw: bool = False) -> tuple[str, ...]:
    """Base parameters of the lake, or of raw profile files."""
    if profile_type(profile) == "PHY":
        return PHY_PARAMETERS
    if not raw:
        return FLOAT_PARAMETERS + BOTTLE_PARAMETERS
    names: list[str] = []
    for name in FLOAT_PARAMETERS:
        names.append(name)
        if name in RAW_ONLY_PARAMETER_AFTER:
            names.append(RAW_ONLY_PARAMETER_AFTER[name])
    return tuple(names)


def lake_columns(profile: str, level: str = "QC") -> list[str]:
    """Column names of the lake, in order: 15/21 for PHY and 157/215 for BGC (QC/ALL)."""
    profile, level = profile_type(profile), quality_level(level)
    keys = ["DB_NAME", "PLATFORM_NUMBER"]
    keys += ["DATA_MODE"] if profile == "PHY" else []
    keys += ["LATITUDE", "LONGITUDE", "JULD"]
    best = ["", "_QC", "_ERROR"]
    both = ["", "_QC", "_ADJUSTED", "_ADJUSTED_QC", "_ADJUSTED_ERROR"]
    mode = ["_DATA_MODE"] if profile == "BGC" else []
    columns = list(keys)
    for name in parameters(profile):
        adjusted = level == "ALL" and name not in BOTTLE_PARAMETERS
        columns += [name + suffix for suffix in (both if adjusted else best) + mode]
    return columns


def raw_columns(profile: str) -> list[str]:
    """Column names of raw profile tables, in order: 26 for PHY and 219 for BGC."""
    profile = profile_type(profile)
    columns = ["PLATFORM_NUMBER", "N_PROF", "N_LEVELS", "CYCLE_NUMBER", "DIRECTION"]
    columns += ["DATA_MODE"] if profile == "PHY" else []
    columns += ["LATITUDE", "LONGITUDE", "POSITION_QC", "JULD", "JULD_QC"]
    for name in parameters(profile, raw=True):
        spread = ["_dPRES"] if profile == "BGC" and name != "PRES" else []
        mode = ["_DATA_MODE"] if profile == "BGC" else []
        suffixes = ["", "_QC", *spread, "_ADJUSTED", "_ADJUSTED_QC", "_ADJUSTED_ERROR", *mode]
        columns += [name + suffix for suffix in suffixes]
    return columns


def column_type(name: str, raw: bool = False) -> T.DataType:
    """The type a column has by its name alone; the first rule that fits wins."""
    if name in ("N_PROF", "N_LEVELS", "CYCLE_NUMBER"):
        return T.IntegerType()
    if "_QC" in name:
        return T.ShortType()
    if name in ("LATITUDE", "LONGITUDE"):
        return T.DoubleType()
    if name == "JULD":
        return T.TimestampNTZType()
    if "DATA_MODE" in name or name == "DB_NAME" or (raw and name == "DIRECTION"):
        return T.StringType()
    if name == "PLATFORM_NUMBER":
        return T.LongType() if raw else T.StringType()
    return T.FloatType()


def _struct(names: list[str], raw: bool) -> T.StructType:
    return T.StructType([T.StructField(n, column_type(n, raw), True) for n in names])


def lake_schema(profile: str, level: str = "QC", derived: bool = False) -> T.StructType:
    """Schema of the lake, with the derived variables at the end if asked for."""
    names = lake_columns(profile, level) + (list(DERIVED_COLUMNS) if derived else [])
    return _struct(names, raw=False)


def raw_schema(profile: str) -> T.StructType:
    return _struct(raw_columns(profile), raw=True)


def prune_schema(schema: T.StructType, present: list[str]) -> T.StructType:
    """The fields of ``schema`` that are ``present``; none left means the names are wrong."""
    kept = [f for f in schema.fields if f.name in set(present)]
    if not kept:
        raise ValueError("no column of the table is in the vocabulary; were its columns renamed?")
    return T.StructType(kept)


def merge_schemas(schemas: list[T.StructType]) -> T.StructType:
    """Ordered union of fields over several sources; a type conflict is an error."""
    merged: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            known = merged.setdefault(f.name, T.StructField(f.name, f.dataType, True))
            if known.dataType != f.dataType:
                raise ValueError(f"{f.name} is {known.dataType.simpleString()} and {f.dataType.simpleString()}")
    return T.StructType(list(merged.values()))
