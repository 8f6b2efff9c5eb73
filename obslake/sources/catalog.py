"""Finding the tables of a lake, and their schemas."""

from __future__ import annotations

import json
import uuid
import warnings
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from obslake import vocab

# Spark does not list names that start with an underscore as data.
SCHEMA_FOLDER = "_schema"


def _paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, on whatever file system the path names."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(f.getPath().toString()) for f in found or [])


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, in order, on whatever file system the pattern names."""
    return _paths(spark, pattern)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete_path(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: it is written beside its place and renamed."""
    folder, _, name = path.rpartition("/")
    files, beside = _file_system(spark, f"{folder}/_{name}-{uuid.uuid4().hex}")
    out = files.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not files.rename(beside, place) and not files.exists(place):
        raise OSError(f"could not write {path}")


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(_paths(spark, path))


def file_bytes(spark: SparkSession, path: str) -> int:
    """Length of a file."""
    files, place = _file_system(spark, path)
    return files.getFileStatus(place).getLen()


def cut_file(spark: SparkSession, path: str, length: int) -> None:
    """Leave the first ``length`` bytes of a file. They are copied in pieces and never held as a whole."""
    files, place = _file_system(spark, path)
    folder, _, name = path.rpartition("/")
    _, beside = _file_system(spark, f"{folder}/_{name}-{uuid.uuid4().hex}")
    start, out = files.open(place), files.create(beside, True)
    try:
        spark._jvm.org.apache.commons.io.IOUtils.copyLarge(start, out, 0, length)
    finally:
        start.close()
        out.close()
    files.delete(place, False)
    if not files.rename(beside, place):
        raise OSError(f"could not write {path}")


def is_empty_folder(spark: SparkSession, path: str) -> bool:
    """Whether there is nothing at the path, or a folder without files."""
    return not _paths(spark, f"{path.rstrip('/')}/*")


def selected_sources(names: str | Iterable[str] | None) -> list[str]:
    """All sources, or those named; one name may come without a list."""
    if names is None:
        return list(vocab.SOURCES)
    if not isinstance(names, (str, list, tuple)):
        raise ValueError("sources must be a name or a list of names")
    chosen = [names] if isinstance(names, str) else list(names)
    for name in chosen:
        vocab.source(name)
    return chosen


def discover(spark: SparkSession, root: str, sources: str | Iterable[str] | None = None) -> dict[str, str]:
    """The folder of each source under a lake's root.

    Two folders for one source are an error, none is a warning, and none for all sources
    is an error.
    """
    found: dict[str, str] = {}
    for name in selected_sources(sources):
        mark = vocab.source(name).folder_mark
        paths = _paths(spark, f"{root.rstrip('/')}/*{mark}*")
        if len(paths) > 1:
            raise ValueError(f"more than one folder for {name}: {paths}")
        if paths:
            found[name] = paths[0]
        else:
            warnings.warn(f"no folder *{mark}* under {root}; {name} is left out", stacklevel=2)
    if not found:
        raise ValueError(f"no source found under {root}")
    return found


def save_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """Write a schema beside the data of a table."""
    stored = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    row = spark.createDataFrame([(stored.json(),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}/{SCHEMA_FOLDER}")


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    """The saved schema of a table; where none was saved, that of its files."""
    try:
        text = spark.read.text(f"{path.rstrip('/')}/{SCHEMA_FOLDER}", wholetext=True).first()
    except AnalysisException:
        text = None
    if text is None:
        return spark.read.parquet(path).schema
    return T.StructType.fromJson(json.loads(text[0]))
