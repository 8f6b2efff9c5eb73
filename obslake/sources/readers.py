"""Reading source files."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake import vocab
from obslake.functions import times
from obslake.operators.filters import Filters, filter_rows
from obslake.operators.inventory import parse_index
from obslake.session import written
from obslake.sources.catalog import path_exists

CORRUPT = "_corrupt_record"

_TEXT_COLUMNS = {"G2expocode", "SampleId", "MidPoint_Date_UTC"}


class EmptyFileError(ValueError):
    """A delimited file without a header."""


class UnreadableFileError(ValueError):
    """A delimited file with rows that do not fit its columns."""


def _header(spark: SparkSession, path: str) -> list[str]:
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    try:
        names = spark.read.csv(path, header=True).columns
    except AnalysisException as error:
        raise UnreadableFileError(f"{path}: {error}") from error
    if not names:
        raise EmptyFileError(path)
    return names


def source_csv_schema(source: str, header: list[str]) -> T.StructType:
    """The columns of the header: numbers where the source is known to have them, else text."""
    known = vocab.source(source)
    numeric = (set(known.columns) | set(known.renames)) - _TEXT_COLUMNS
    return T.StructType([T.StructField(c, T.DoubleType() if c in numeric else T.StringType()) for c in header])


def _resolve(path: str, source: str) -> str:
    """The source's usual file, where only a folder is given."""
    if not path.endswith("/"):
        return path
    default = vocab.source(source).default_file
    if default is None:
        raise ValueError(f"{source} has no default file name; name one")
    return path + default


def _one_header(spark: SparkSession, paths: list[str]) -> list[str]:
    """The header all files share; the files are then read as one table."""
    first = _header(spark, paths[0])
    if len(paths) > 1:
        lines = spark.read.text(paths, wholetext=False)
        marked = lines.where(F.col("_metadata.file_block_start") == 0).select(F.col("_metadata.file_path").alias("f"), "value")
        starts = marked.where(F.col("value").isin(",".join(first), ",".join(f'"{c}"' for c in first)))
        if starts.select("f").distinct().count() < lines.select(F.col("_metadata.file_path").alias("f")).distinct().count():
            raise UnreadableFileError(f"the files have not all the header of {paths[0]}")
    return first


def read_csv(spark: SparkSession, paths: str | list[str], source: str, check: bool = False) -> DataFrame:
    """Delimited files with one common header, read as one table without a pass to infer types.

    A missing and an empty file raise ``FileNotFoundError`` and ``EmptyFileError``. A
    malformed row fails the query that meets it, whichever columns that query uses; with
    ``check`` the rows are looked through first and the error is ``UnreadableFileError``.
    """
    paths = [_resolve(p, source) for p in ([paths] if isinstance(paths, str) else paths)]
    schema = source_csv_schema(source, _one_header(spark, paths))
    if check:
        for path in paths:
            first = read_csv_with_rejects(spark, path, source)[1].first()
            if first is not None:
                raise UnreadableFileError(f"{path}: {first['row']}")
    # Without column pruning every row is parsed, and so checked, in full.
    return spark.read.schema(schema).option("columnPruning", "false").csv(paths, header=True, mode="FAILFAST")


def read_csv_with_rejects(spark: SparkSession, path: str, source: str) -> tuple[DataFrame, DataFrame]:
    """The well-formed rows of a delimited file, and its malformed rows with the file they are in.

    Lines are parsed by an expression, since the file reader itself parses, and so checks,
    only the columns a query uses.
    """
    path = _resolve(path, source)
    schema = source_csv_schema(source, _header(spark, path))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("input_file"))
    header = spark.read.text(path).first()["value"]
    marked = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.add(CORRUPT, T.StringType()).fields)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.where((F.col("value") != header) & (F.trim("value") != "")).withColumn(
        "parsed", F.from_csv("value", marked, options)
    )
    bad = F.col(f"parsed.{CORRUPT}").isNotNull()
    return (
        parsed.where(~bad).select("parsed.*").drop(CORRUPT),
        parsed.where(bad).select("input_file", F.col("value").alias("row"), F.lit("malformed").alias("reason")),
    )


def read_records_with_rejects(spark: SparkSession, paths: str | list[str], source: str) -> tuple[DataFrame, DataFrame]:
    """As ``read_csv_with_rejects``, for records that may go over several lines inside quotes.

    One record is one row, however many lines it takes; a malformed one is a reject as a whole, with its file.
    A file is read by one task, since only from its start can be told which line breaks are quoted. All
    files have the header of the first.
    """
    paths = [_resolve(p, source) for p in ([paths] if isinstance(paths, str) else paths)]
    schema = source_csv_schema(source, _header(spark, paths[0]))
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
    options = {"multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false", "escape": '"'}
    # Stored, so that the text is parsed once for both tables.
    parsed = written(reader.options(**options).csv(paths, header=True).withColumn("input_file", F.col("_metadata.file_path")), "records")
    bad = F.col(CORRUPT).isNotNull()
    return (
        parsed.where(~bad).drop(CORRUPT, "input_file"),
        parsed.where(bad).select("input_file", F.col(CORRUPT).alias("row"), F.lit("malformed").alias("reason")),
    )


# --- files that cannot be read ------------------------------------------------------

NO_PARQUET = "not a whole Parquet file"
BAD_FOOTER = "footer that cannot be read"
BAD_PAGES = "pages that cannot be read"


def _what_can_be_read(spark: SparkSession, path: str, recursive: bool, schema: T.StructType | None = None) -> DataFrame | None:
    """All rows that come out of the files under ``path`` before a fault, if any; None where no file has a footer."""
    options = {"ignoreCorruptFiles": "true", "recursiveFileLookup": str(recursive).lower(), "pathGlobFilter": "*.parquet"}
    if schema is not None:
        return spark.read.options(**options).schema(schema).parquet(path)
    # The columns are those of one file, and if it has none, of all files.
    for merge in ("false", "true"):
        try:
            return spark.read.options(**options, mergeSchema=merge).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
    return None


def probe_parquet(spark: SparkSession, path: str, deep: bool = False, recursive: bool = False) -> DataFrame:
    """(input_file, n_bytes, n_rows, reason), one row for each Parquet file under ``path``; reason is null for a sound one.

    Footers are read in tasks, and every file's outcome is a row. A file that gives no row has its first and last
    bytes looked at, and what those do not tell is found by reading halves of the remaining files. ``deep``
    also reads all columns and compares the rows that come out with those the footer promises; without it a file
    whose footer is sound and whose pages are not fails the job that reads it.
    """
    look = str(recursive).lower()
    contents = spark.read.format("binaryFile").option("recursiveFileLookup", look).option("pathGlobFilter", "*.parquet").load(path)
    listed = contents.select(F.col("_metadata.file_path").alias("input_file"), F.col("length").alias("n_bytes"))
    rows = _what_can_be_read(spark, path, recursive)
    file = F.col("_metadata.file_path").alias("input_file")
    promised = spark.createDataFrame([], "input_file string, n_rows long")
    if rows is not None:
        promised = rows.select(file).groupBy("input_file").agg(F.count("*").alias("n_rows"))
    # Files of no bytes are in the index that Spark holds but are not scanned.
    named = [(re.sub(r"^(\w+):///", r"\1:/", name),) for name in contents.inputFiles()]
    names = spark.createDataFrame(named, "input_file string")
    listed = names.join(listed, "input_file", "left").select("input_file", F.coalesce("n_bytes", F.lit(0).cast("long")).alias("n_bytes"))
    found = written(listed.join(promised, "input_file", "left"), "probed-files")

    silent = found.where("n_rows IS NULL").select("input_file")
    mark = F.lit(b"PAR1")
    whole = (F.col("length") >= 12) & (F.substring("content", 1, 4) == mark) & (F.substring("content", -4, 4) == mark)
    # Named one by one, so that the scan leaves out the contents of all other files.
    mute = [r.input_file for r in silent.toLocalIterator()]
    looked_at = contents.where(F.col("_metadata.file_path").isin(mute)).select(F.col("_metadata.file_path").alias("input_file"), "length", "content")
    judged = written(looked_at.select("input_file", F.coalesce(whole, F.lit(False)).alias("whole")), "silent-files")
    cut = judged.where(~F.col("whole")).select("input_file").union(found.where("n_bytes = 0").select("input_file"))
    broken = cut.select("input_file", F.lit(NO_PARQUET).alias("reason"))
    doubtful = [r.input_file for r in judged.where("whole").select("input_file").orderBy("input_file").toLocalIterator()]
    bad = [(f, BAD_FOOTER) for f in _without_footer(spark, doubtful)]
    broken = broken.union(spark.createDataFrame(bad, "input_file string, reason string"))
    if deep and rows is not None:
        every = rows.select(file, F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).alias("h"))
        # The hashes are asked for, or no column would be read to count rows.
        read = every.groupBy("input_file").agg(F.count("*").alias("n"), F.bit_xor("h").alias("x"))
        read = read.select("input_file", F.when(F.col("x").isNotNull(), F.col("n")).alias("n_read"))
        short = found.where("n_rows > 0").join(read, "input_file", "left").where(F.coalesce("n_read", F.lit(0)) < F.col("n_rows"))
        broken = broken.union(short.select("input_file", F.lit(BAD_PAGES).alias("reason")))
    outcome = found.join(broken, "input_file", "left")
    return outcome.withColumn("n_rows", F.when(F.col("reason").isNull(), F.coalesce("n_rows", F.lit(0))))


def _without_footer(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of some whole files without rows that Spark cannot open, by halving."""
    if not paths:
        return []
    try:
        spark.read.schema("none int").parquet(*paths).count()
        return []
    except Exception:  # noqa: BLE001 - whatever the reader raises says the same
        if len(paths) == 1:
            return paths
        half = len(paths) // 2
        return _without_footer(spark, paths[:half]) + _without_footer(spark, paths[half:])


def read_parquet_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType | None = None, deep: bool = False, recursive: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The rows of all sound files under ``path`` with their ``input_file``, and (input_file, reason) for the others.

    A table that has an ``input_file`` of its own keeps that. No row of an unsound file is among the rows, also not those before its fault.
    """
    probed = written(probe_parquet(spark, path, deep, recursive), "probed")
    rejects = probed.where("reason IS NOT NULL").select("input_file", "reason")
    rows = _what_can_be_read(spark, path, recursive, schema)
    if rows is None:
        raise UnreadableFileError(f"no file in {path} can be read")
    marked = rows.select("*", F.col("_metadata.file_path").alias("__file"))
    sound = marked.join(rejects.select(F.col("input_file").alias("__file")), "__file", "left_anti")
    own = [F.col(f"`{c}`") for c in rows.columns]
    return sound.select(*own, *([] if "input_file" in rows.columns else [F.col("__file").alias("input_file")])), rejects


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """A profile index: comment lines, a header, then one line per profile file."""
    text = spark.read.csv(path, header=True, comment="#")
    return parse_index(text)


def read_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    columns: list[str] | None = None,
    filters: Filters | None = None,
    missing: str = "discard",
    nanosecond_times: tuple[str, ...] = (),
    recursive: bool = False,
) -> DataFrame:
    """A Parquet table with filters and column choice handed to the scan.

    ``nanosecond_times`` names columns that other writers stored as nanoseconds, which
    Spark reads as numbers once its setting ``spark.sql.legacy.parquet.nanosAsLong`` is on.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.parquet(path)
    if nanosecond_times:
        df = df.withColumns({c: times.from_nanos(F.col(c)) for c in nanosecond_times})
    df = filter_rows(df, filters, missing)
    return df if columns is None else df.select(*columns)
