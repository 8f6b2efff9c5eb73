"""Writing tables of the lake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from obslake.session import TARGET_FILE_BYTES
from obslake.sources.catalog import is_empty_folder, load_schema, save_schema
from obslake.vocab import merge_schemas

LAYOUTS = ("rebalance", "scan")


def table_name(source: str, profile: str, base: str | None = None) -> str:
    """Folder name of a table: the base name without extension, ending in the profile type."""
    if base is None:
        return f"{source}_{profile}"
    name = base.removesuffix(".parquet")
    return name if profile in name else f"{name}_{profile}"


def save_mode(df: DataFrame, path: str, overwrite: bool) -> str:
    """Append only to a table that has files, and only if it is not to be replaced."""
    return "overwrite" if overwrite or is_empty_folder(df.sparkSession, path) else "append"


def write_table(
    df: DataFrame,
    path: str,
    overwrite: bool = True,
    layout: str = "rebalance",
    cluster_by: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
    sidecar: bool = True,
) -> None:
    """Write a table as Parquet, with its schema beside it.

    ``rebalance`` gives files of about the target size by one shuffle that splits large
    and merges small partitions. ``scan`` writes each task's rows as they come, without a
    shuffle: for very large row-by-row jobs, where the scan's split size sets the file
    size. ``cluster_by`` brings equal keys together and sorts within files, so that
    filters on the keys skip row groups; keys too big for one file are split.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, got {layout!r}")
    spark = df.sparkSession
    mode = save_mode(df, path, overwrite)
    schema = df.schema
    if sidecar and mode == "append":
        # What is there keeps its columns; a column of two types is an error before anything is written.
        schema = merge_schemas([load_schema(spark, path), schema])
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size, None)
    out = df
    if layout == "rebalance":
        out = df.hint("rebalance", *cluster_by)
    if cluster_by:
        out = out.sortWithinPartitions(*cluster_by)
    try:
        if layout == "rebalance":
            spark.conf.set(size, str(target_bytes))
        out.write.mode(mode).parquet(path)
    finally:
        if layout == "rebalance":
            spark.conf.unset(size) if before is None else spark.conf.set(size, before)
    if sidecar:
        save_schema(spark, schema, path)


def write_index_metadata(index: DataFrame, root: str, dataset: str, overwrite: bool = True) -> str:
    """Keep the index subset a table was made from beside it; returns the path."""
    path = f"{root.rstrip('/')}/metadata/{dataset}"
    index.write.mode("overwrite" if overwrite else "append").parquet(path)
    return path
