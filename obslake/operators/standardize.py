"""Bringing a source's table to the lake's names, columns and types."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake import vocab
from obslake.functions import times

_FLOATING = (T.FloatType, T.DoubleType)
_FLAG_RANGE = (0, 255)


def typed_null(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are there."""
    present = set(df.columns)
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in present})


def harmonise_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Give a column its usual source name, where the file used a shorter one."""
    return rename(df, aliases)


def drop_outside(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the columns that are not in ``names``."""
    names = set(names)
    return df.select(*[c for c in df.columns if c in names])


def reindex(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns in its order; those the table lacks are null."""
    present = set(df.columns)
    return df.select(
        *[F.col(f.name) if f.name in present else typed_null(f.dataType).alias(f.name) for f in schema.fields]
    )


def add_companions(df: DataFrame, vocabulary: Iterable[str]) -> DataFrame:
    """Add a null flag and error for each column whose flag or error is in the vocabulary but not in the table."""
    vocabulary, present = set(vocabulary), set(df.columns)
    new = [name + suffix for name in df.columns for suffix in ("_ERROR", "_QC")]
    return df.withColumns(
        {c: typed_null(vocab.column_type(c)) for c in new if c in vocabulary and c not in present}
    )


def label_source(df: DataFrame, source: str, overwrite: bool = True) -> DataFrame:
    """Set ``DB_NAME``; without ``overwrite`` only where there is no such column."""
    vocab.source(source)
    if "DB_NAME" in df.columns and not overwrite:
        return df
    return df.withColumn("DB_NAME", F.lit(source))


def domain_column(name: str, allowed: Sequence[str]) -> Column:
    return F.when(F.col(name).isin(*allowed), F.col(name))


def restrict_domains(df: DataFrame) -> DataFrame:
    """Null out enumerated values outside their domain: data modes, directions and sources."""
    domains: dict[str, Sequence[str]] = {c: vocab.DATA_MODES for c in df.columns if "DATA_MODE" in c}
    domains |= {"DIRECTION": vocab.DIRECTIONS, "DB_NAME": tuple(vocab.SOURCES)}
    present = set(df.columns)
    return df.withColumns({c: domain_column(c, allowed) for c, allowed in domains.items() if c in present})


def null_for_nan(df: DataFrame, sentinels: Sequence[float] = ()) -> DataFrame:
    """Turn NaN, and on request fill values such as -9999, of floating-point columns into null."""

    def clean(name: str) -> Column:
        bad = F.isnan(name)
        return F.when(~(bad | F.col(name).isin(*sentinels) if sentinels else bad), F.col(name))

    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, _FLOATING)]
    return df.withColumns({name: clean(name) for name in floating})


def _converted(name: str, have: T.DataType, want: T.DataType, strict: bool) -> Column:
    column = F.col(name)
    if have == want:
        return column

    def cast(to: T.DataType) -> Column:
        return column.cast(to) if strict else column.try_cast(to)

    if not ("_QC" in name and isinstance(want, T.ShortType)) or isinstance(have, (T.ByteType, T.NullType)):
        return cast(want)
    other = typed_null(want)
    if strict:
        message = F.concat(F.lit(f"{name} is not a flag: "), column.cast("string"))
        other = F.when(column.isNotNull(), F.raise_error(message).cast(want))
    return F.when(cast(T.DoubleType()).between(*_FLAG_RANGE), cast(want)).otherwise(other)


def conform(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """The table's columns that are in the schema, in its order and with its types.

    A value that does not fit its type, or a flag outside 0..255, is an error, or null if
    not ``strict``.
    """
    pruned = vocab.prune_schema(schema, df.columns)
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[_converted(f.name, have[f.name], f.dataType, strict).alias(f.name) for f in pruned.fields]
    )


def trim_to_phy(df: DataFrame, level: str = "QC") -> DataFrame:
    """A BGC table without its BGC columns."""
    return drop_outside(df, vocab.lake_columns("PHY", level))


def standardize(df: DataFrame, source: str, profile: str = "PHY", strict: bool = True) -> DataFrame:
    """A source's table in the lake's names and types: rename, drop, add companions, label, cast."""
    columns = vocab.lake_columns(profile)
    named = drop_outside(rename(df, vocab.source(source).renames), columns)
    clean = null_for_nan(named, vocab.source(source).fill_values)
    labelled = label_source(add_companions(clean, columns), source)
    return conform(labelled, vocab.lake_schema(profile), strict)


def standardize_bottle(df: DataFrame, profile: str = "PHY", strict: bool = True) -> DataFrame:
    """Bottle data; the time comes in five columns."""
    parts = [F.col(c) for c in vocab.BOTTLE_TIME_PARTS]
    return standardize(df.withColumn("JULD", times.from_parts(parts, strict)), "GLODAP", profile, strict)


def standardize_plankton(df: DataFrame, profile: str = "PHY", strict: bool = True) -> DataFrame:
    """Plankton samples; the time is a text, or else four columns, or else absent with a warning."""
    parts = ("Year", "Month", "Day", "Hour")
    named = rename(df, vocab.source("CPR").renames)
    if "JULD" in named.columns:
        if isinstance(named.schema["JULD"].dataType, T.StringType):
            named = named.withColumn("JULD", times.from_iso(F.col("JULD"), strict))
    elif set(parts) <= set(named.columns):
        named = named.withColumn("JULD", times.from_parts([F.col(c) for c in parts], strict))
    else:
        warnings.warn("no date columns: the table gets no JULD", stacklevel=2)
    return standardize(named, "CPR", profile, strict)
