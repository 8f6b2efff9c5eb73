"""Profiles: rows that hold one array per variable, one element per level.

The input has one row per profile. Flattening it gives one row per level. All operators
work within a row, so nothing is shuffled, except when one bad profile is to take its
whole file with it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake import vocab
from obslake.functions.text import short_code
from obslake.operators.standardize import typed_null
from obslake.session import written

CALIBRATION = "parameters differ between calibrations"
LONG_MODE = "data mode longer than one letter"
MISFIT = "value that does not fit the type of its column"


def array_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]


def flatten_profiles(df: DataFrame, levels: Sequence[str] | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """One row per level, with its number from 0 as ``N_LEVELS``.

    ``levels`` are the array columns to spread (all that the raw vocabulary knows unless
    given); shorter arrays end in nulls. ``keep`` are the per-profile columns to repeat.
    """
    known = set(vocab.raw_columns("BGC")) | set(vocab.raw_columns("PHY"))
    present, columns = array_columns(df), df.columns
    arrays = list(levels) if levels is not None else [c for c in present if c in known]
    scalars = list(keep) if keep is not None else [c for c in columns if c in known and c not in present]
    zipped = F.arrays_zip(*[F.col(c) for c in arrays])
    spread = df.select(*scalars, F.posexplode(zipped).alias("N_LEVELS", "__level"))
    return spread.select(*scalars, "N_LEVELS", *[F.col("__level").getField(c).alias(c) for c in arrays])


def spread_data_modes(
    df: DataFrame,
    parameters: str = "PARAMETER",
    modes: str = "PARAMETER_DATA_MODE",
    names: Sequence[str] | None = None,
    unset: str = "",
    strict: bool = True,
) -> DataFrame:
    """Add ``<parameter>_DATA_MODE`` for each parameter of the raw vocabulary (or each of ``names``).

    Where a parameter is listed twice its last mode counts. Parameters the vocabulary does
    not know are skipped; ``unknown_parameters`` lists them. A mode longer than one letter
    is an error, or counts as unset if not ``strict``.
    """
    names = vocab.parameters("BGC", raw=True) if names is None else names
    own = [c for c in df.columns if c not in {f"{n}_DATA_MODE" for n in names}]
    codes = F.transform(F.slice(modes, F.lit(1), F.size(parameters)), lambda m: short_code(m, strict))
    # The names are turned round so that the first position found is the last one listed.
    lists = df.withColumns(
        {"__names": F.reverse(F.transform(parameters, lambda name: F.trim(name))), "__modes": codes}
    )
    listed = "get(__modes, size(__names) - cast(array_position(__names, '{n}') as int))"
    spread = [f"coalesce({listed.format(n=n)}, '{unset}') as {n}_DATA_MODE" for n in names]
    return lists.selectExpr(*[f"`{c}`" for c in own], *spread)


def modes_from_rows(
    df: DataFrame,
    rows: DataFrame,
    key: Sequence[str],
    parameter: str = "PARAMETER",
    mode: str = "DATA_MODE",
    position: str = "POSITION",
    names: Sequence[str] | None = None,
    unset: str = "",
    strict: bool = True,
) -> DataFrame:
    """As ``spread_data_modes``, for modes given as ``rows`` of (key, position, parameter, mode) instead of arrays.

    The rows are pivoted over the known names, in one aggregate that combines before its shuffle; of several rows
    for a parameter the one of the highest position counts. Profiles without rows have all modes unset, and
    rows without profile do nothing.
    """
    names = vocab.parameters("BGC", raw=True) if names is None else list(names)
    name = F.trim(F.col(parameter))
    code = short_code(F.col(mode), strict)
    listed = rows.where(name.isin(*names))
    last = [F.max(F.when(name == n, F.struct(F.col(position).alias("p"), code.alias("m")))).alias(f"{n}_DATA_MODE") for n in names]
    wide = listed.groupBy(*key).agg(*last)
    pairs = [(k, f"__{k}") for k in key]
    wide = wide.withColumnsRenamed(dict(pairs))
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs]
    own = [c for c in df.columns if c not in {f"{n}_DATA_MODE" for n in names}]
    joined = df.select(*own).join(wide, same, "left")
    return joined.select(*own, *[F.coalesce(F.col(f"{n}_DATA_MODE")["m"], F.lit(unset)).alias(f"{n}_DATA_MODE") for n in names])


def unknown_parameters(df: DataFrame, parameters: str = "PARAMETER") -> DataFrame:
    """Parameter names outside the raw vocabulary, with the number of profiles that list them."""
    names = df.select(F.explode(F.array_distinct(F.transform(parameters, lambda name: F.trim(name)))).alias("parameter"))
    known = vocab.parameters("BGC", raw=True)
    outside = names.where((F.col("parameter") != "") & ~F.col("parameter").isin(*known))
    return outside.groupBy("parameter").agg(F.count("*").alias("n_profiles"))


def same_in_all_calibrations(calibrations: Column) -> Column:
    """Whether every calibration lists the same parameters as the first."""
    return F.forall(calibrations, lambda listed: listed.eqNullSafe(F.get(calibrations, F.lit(0))))


def _misfits(df: DataFrame, schema: T.StructType) -> list[Column]:
    """For each column of another type than the schema's: whether a value cannot be brought to it."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def misfit(dtype: T.DataType, value: Column) -> Column:
        return value.isNotNull() & value.try_cast(dtype).isNull()

    def never_fails(dtype: T.DataType, want: T.DataType) -> bool:
        return dtype == want or (isinstance(dtype, T.NumericType) and isinstance(want, (T.FloatType, T.DoubleType)))

    tests = []
    for field in schema.fields:
        dtype = have.get(field.name)
        if never_fails(dtype.elementType if isinstance(dtype, T.ArrayType) else dtype, field.dataType):
            continue
        if isinstance(dtype, T.ArrayType):
            tests.append(F.exists(field.name, partial(misfit, field.dataType)))
        elif dtype is not None:
            tests.append(misfit(field.dataType, F.col(field.name)))
    return tests


def mark_rejects(
    df: DataFrame,
    calibrations: str | None = "CALIBRATION_PARAMETERS",
    modes: str | None = "PARAMETER_DATA_MODE",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Add ``reject_reason``, null for sound profiles.

    With the raw table's ``schema`` a profile with any value that cannot be brought to its
    column's type, as a blank flag, is unsound too, and does not fail the job.
    """
    reason = F.lit(None).cast("string")
    for test in _misfits(df, schema) if schema is not None else []:
        reason = F.when(test, F.lit(MISFIT)).otherwise(reason)
    if modes is not None:
        too_long = F.exists(modes, lambda m: F.length(F.trim(m)) > 1)
        reason = F.when(too_long, F.lit(LONG_MODE)).otherwise(reason)
    if calibrations is not None:
        sound = F.coalesce(same_in_all_calibrations(F.col(calibrations)), F.lit(True))
        reason = F.when(~sound, F.lit(CALIBRATION)).otherwise(reason)
    return df.withColumn("reject_reason", reason)


def split_rejects(marked: DataFrame, file: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Sound profiles, and the others with their reason.

    With the name of a ``file`` column one bad profile rejects all profiles of its file; a
    profile without file name stands for itself. Only the names of bad files are aggregated,
    never the profiles of one file.
    """
    bad = F.col("reject_reason").isNotNull()
    judged = marked
    if file is not None:
        named = marked.where(bad & F.col(file).isNotNull())
        files = written(named.groupBy(file).agg(F.min("reject_reason").alias("__file_reason")), "bad-files")
        joined = marked.join(files, file, "left")
        judged = joined.withColumn("reject_reason", F.coalesce("__file_reason", "reject_reason")).select(marked.columns)
    return judged.where(~bad).drop("reject_reason"), judged.where(bad)


def raw_table(profiles: DataFrame, profile: str) -> DataFrame:
    """Sound profiles to the raw table: modes spread for BGC, flattened, all raw columns in order and type."""
    modes = vocab.profile_type(profile) == "BGC" and "PARAMETER_DATA_MODE" in profiles.columns
    spread = spread_data_modes(profiles) if modes else profiles
    flat = flatten_profiles(spread)
    present = set(flat.columns)
    return flat.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in present else typed_null(f.dataType)).alias(f.name)
            for f in vocab.raw_schema(profile).fields
        ]
    )
