"""What a job needs on every executor: the shared folder, and this package's code."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from obslake.session import shared_folder


def ensure_shared_folder(spark: SparkSession) -> None:
    """On a local master without spark.checkpoint.dir, as in tests, set a folder of its own.

    On a cluster the setting must name a folder that driver and executors share; it is left
    as it is, and ``shared_folder`` raises where it is missing.
    """
    context = spark.sparkContext
    given = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not given and context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="obslake-"))


def ship_package(spark: SparkSession) -> None:
    """Send the package's code to the executors, as ``--py-files`` would; once per session."""
    context = spark.sparkContext
    if any(path.endswith("/obslake.zip") for path in context.listFiles):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="obslake-code-")) / "obslake"
    context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))


def prepare(spark: SparkSession) -> SparkSession:
    ensure_shared_folder(spark)
    ship_package(spark)
    return spark


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The table written to the shared folder and read back.

    What follows reads files that a finished job has committed, so a lost executor costs
    the tasks it ran and not the whole chain, and nothing above is computed twice.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` gave, once all that reads them is stored itself."""
    for table in tables:
        spark, path = table.sparkSession, table.stored_at
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
