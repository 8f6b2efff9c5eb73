"""Text: parts of profile file names, sensor lists and short codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the form of a profile file's path, <data centre>/<platform>/profiles/<mode><platform>_<cycle>[D].nc
PROFILE_FILE = r"^(([a-z]+/[0-9]+/)profiles/)([A-Z]+([0-9]+)_([0-9]+)D?\.nc)$"

_GROUP_OF = {"filepath": 1, "filepath_main": 2, "filename": 3, "wmoid": 4, "cycle": 5}


def profile_file_parts(path: Column) -> dict[str, Column]:
    """Platform number, cycle and the path pieces of a profile file; null where it has another form."""

    def part(group: int) -> Column:
        return F.nullif(F.regexp_extract(path, PROFILE_FILE, group), F.lit(""))

    columns = {name: part(group) for name, group in _GROUP_OF.items()}
    for number in ("wmoid", "cycle"):
        columns[number] = columns[number].try_cast("int")
    return columns


def has_sensor(listed: Column, sensor: str, how: str = "token") -> Column:
    """Whether a space-separated list names the sensor.

    ``token`` compares whole names. ``contains`` searches the text for the name as a
    pattern, so that ``CHLA`` also finds ``CHLA_FLUORESCENCE``.
    """
    if how == "token":
        return F.array_contains(F.split(listed, " +"), sensor)
    if how == "contains":
        return listed.rlike(sensor)
    raise ValueError(f"how must be 'token' or 'contains', got {how!r}")


def short_code(text: Column, strict: bool = True) -> Column:
    """A trimmed one-letter code; longer text is an error, or null if not ``strict``."""
    code = F.trim(text)
    too_long = F.length(code) > 1
    bad = F.raise_error(F.concat(F.lit("code longer than one letter: "), code)) if strict else F.lit(None)
    return F.when(too_long, bad.cast("string")).otherwise(code)
