"""Loading the lake: choose sources, filter each, pad to common columns, and unite."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake import vocab
from obslake.operators.filters import Filters, filter_rows, restrict_to_filtered
from obslake.operators.standardize import label_source, reindex
from obslake.sources import catalog

SMALL_RESULT_BYTES = 256 * 1000 * 1000

_WIDTHS = {
    T.ByteType: 1,
    T.BooleanType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.FloatType: 4,
    T.DateType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def selected_columns(columns: str | Sequence[str] | None, profile: str, level: str = "QC") -> list[str]:
    """The columns asked for, all by default; names outside the vocabulary are an error."""
    admitted = vocab.lake_columns(profile, level) + list(vocab.DERIVED_COLUMNS)
    if columns is None:
        return vocab.lake_columns(profile, level)
    chosen = [columns] if isinstance(columns, str) else list(columns)
    unknown = [c for c in chosen if c not in admitted]
    if unknown or not chosen:
        raise ValueError(f"columns not in the {profile} {level} vocabulary: {unknown or 'none given'}")
    return chosen


def target_schema(columns: Sequence[str]) -> T.StructType:
    """The columns with the types their names imply, whether a source has them or not."""
    return T.StructType([T.StructField(c, vocab.column_type(c)) for c in columns])


def unite(
    tables: Mapping[str, DataFrame],
    columns: Sequence[str],
    filters: Filters | None = None,
    missing: str = "discard",
) -> DataFrame:
    """Union of source tables, duplicates kept, with exactly these columns.

    Each source is filtered by what it has before it is padded, so a filter on a column
    it lacks follows ``missing`` and does not meet the padding.
    """
    vocab.merge_schemas([df.schema for df in tables.values()])
    schema = target_schema(columns)
    prepared = [
        reindex(label_source(filter_rows(df, filters, missing), name, overwrite=False), schema)
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, prepared)


def load_lake(
    spark: SparkSession,
    root: str,
    sources: str | Sequence[str] | None = None,
    profile: str | None = None,
    level: str = "QC",
    columns: str | Sequence[str] | None = None,
    filters: Filters | None = None,
    missing: str = "discard",
    only_filtered_columns: bool = False,
) -> DataFrame:
    """The lake under ``root`` as one table.

    ``only_filtered_columns`` narrows the columns to those the filters use.
    """
    kind = vocab.profile_type(profile)
    wanted = selected_columns(columns, kind, level)
    if only_filtered_columns:
        wanted = restrict_to_filtered(wanted, filters)
        if not wanted:
            raise ValueError("the filters use none of the selected columns")
    tables = {}
    for name, path in catalog.discover(spark, root, sources).items():
        schema = catalog.load_schema(spark, path)
        tables[name] = spark.read.schema(schema).parquet(path)
    return unite(tables, wanted, filters, missing)


def _variable_size(field: T.StructField) -> Column:
    text = F.col(f"`{field.name}`")
    if not isinstance(field.dataType, (T.StringType, T.BinaryType)):
        text = F.to_json(F.struct(text))
    return F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).cast("bigint")


def _split_fields(df: DataFrame) -> tuple[list[T.StructField], list[T.StructField]]:
    fixed = [f for f in df.schema.fields if type(f.dataType) in _WIDTHS]
    return fixed, [f for f in df.schema.fields if type(f.dataType) not in _WIDTHS]


def size_report(df: DataFrame) -> DataFrame:
    """One row per column: its values' total size in bytes, with the number of rows and of nulls."""
    fixed, variable = _split_fields(df)
    sizes = {f.name: F.lit(_WIDTHS[type(f.dataType)]).cast("bigint") * F.count("*") for f in fixed}
    sizes |= {f.name: _variable_size(f) for f in variable}
    row = df.agg(
        F.count("*").alias("__rows"),
        *[sizes[c].alias(f"s{i}") for i, c in enumerate(df.columns)],
        *[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("__rows").alias("n_rows"),
            (F.col("__rows") - F.col(f"n{i}")).alias("n_null"),
            F.col(f"s{i}").alias("n_bytes"),
        )
        for i, c in enumerate(df.columns)
    ]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def total_bytes(df: DataFrame) -> int:
    """Size of the table's values."""
    fixed, variable = _split_fields(df)
    size = sum(_WIDTHS[type(f.dataType)] for f in fixed) * df.count()
    if not variable:
        return size
    texts = df.agg(*[_variable_size(f).alias(f"s{i}") for i, f in enumerate(variable)]).first()
    return size + sum(texts)


class TooLargeError(ValueError):
    """A table that does not fit the bound set for local memory."""


def to_local(df: DataFrame, max_bytes: int = SMALL_RESULT_BYTES) -> pd.DataFrame:
    """The table in local memory; an error if its values take more than ``max_bytes``.

    pandas needs several times the size of the values.
    """
    size = total_bytes(df)
    if size > max_bytes:
        raise TooLargeError(f"{size} bytes of values, the bound is {max_bytes}; work on the DataFrame, or raise it")
    return df.toPandas()


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first rows in the order of these columns, further ties by all others."""
    others = [c for c in df.columns if c not in order]
    return df.orderBy(*order, *others).limit(n)


def last_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The last rows in the order of these columns, last row first."""
    others = [c for c in df.columns if c not in order]
    return df.orderBy(*[F.col(c).desc() for c in [*order, *others]]).limit(n)


def group_deviation(df: DataFrame, by: Sequence[str], value: str, name: str = "std") -> DataFrame:
    """Sample standard deviation of a column per group; null for a group of one."""
    return df.groupBy(*by).agg(F.stddev_samp(F.col(value).cast("double")).alias(name))
