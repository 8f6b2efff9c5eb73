"""One Spark query per operator, over the derived observation tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import views as v
from obslake import vocab
from obslake.functions import times
from obslake.operators import derived, filters, inventory, profiles, quality, standardize
from obslake.operators.atlas import Grid
from obslake.plans import jobs, lake
from obslake.session import apply_settings, shared_folder
from obslake.sources import catalog, readers, writers
from obslake.streaming import ingest, latest, moments, report

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def with_folder(spark: SparkSession) -> SparkSession:
    """Here, on a local master, a folder for intermediate tables where the session names none."""
    context = spark.sparkContext
    if not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()) and context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="obslake-"))
    return spark


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(apply_settings(with_folder(spark)), sf_dir)

    QUERIES[build.__name__] = run
    return run


# --- quality ------------------------------------------------------------------------


@query
def qc_row_gate_phy(spark, d):
    return quality.row_gate(v.OBS_PHY.read(spark, d), "PHY")


@query
def qc_row_gate_bgc(spark, d):
    return quality.row_gate(v.OBS_BGC.read(spark, d), "BGC")


@query
def qc_best_value_phy(spark, d):
    return quality.best_values(v.OBS_PHY.read(spark, d), "PHY")


@query
def qc_best_value_bgc(spark, d):
    return quality.best_values(v.OBS_BGC.read(spark, d), "BGC")


@query
def qc_position_time_gate(spark, d):
    return quality.null_unless_located(v.OBS_PHY.read(spark, d))


@query
def qc_drop_empty_rows(spark, d):
    best = quality.best_values(v.OBS_PHY.read(spark, d), "PHY")
    return quality.drop_empty_rows(quality.null_unless_located(best))


@query
def qc_best_value_table_phy(spark, d):
    return quality.best_value_table(v.OBS_PHY.read(spark, d), "PHY")


@query
def qc_best_value_table_bgc(spark, d):
    return quality.best_value_table(v.OBS_BGC.read(spark, d), "BGC")


@query
def qc_platform_summary(spark, d):
    best = quality.best_value_table(v.OBS_PHY.read(spark, d), "PHY")
    values = [
        column
        for name in vocab.PHY_PARAMETERS
        for column in (
            F.count(name).alias(f"n_{name.lower()}"),
            F.round(F.avg(F.col(name).cast("double")), 6).alias(f"mean_{name.lower()}"),
        )
    ]
    return best.groupBy("PLATFORM_NUMBER").agg(F.count("*").alias("n_rows"), *values)


@query
def qc_constant_flags(spark, d):
    named = standardize.rename(v.SRC_GLIDER.read(spark, d), {"temp": "TEMP", "sal": "PSAL"})
    return quality.constant_flags(named, ["TEMP", "PSAL"], [1, 2], "PHY")


# --- standardizing ------------------------------------------------------------------


@query
def std_bottle_phy(spark, d):
    return standardize.standardize_bottle(v.SRC_BOTTLE.read(spark, d), "PHY")


@query
def std_bottle_bgc(spark, d):
    return standardize.standardize_bottle(v.SRC_BOTTLE.read(spark, d), "BGC")


@query
def std_plankton(spark, d):
    return standardize.standardize_plankton(v.SRC_PLANKTON.read(spark, d))


@query
def std_plankton_parts(spark, d):
    return standardize.standardize_plankton(v.SRC_PLANKTON.read(spark, d).drop("MidPoint_Date_UTC"))


@query
def std_glider(spark, d):
    return derived.standardize_glider(v.SRC_GLIDER.read(spark, d))


@query
def trim_bgc_to_phy(spark, d):
    return standardize.trim_to_phy(quality.best_value_table(v.OBS_BGC.read(spark, d), "BGC"))


@query
def domain_check(spark, d):
    table = v.OBS_BGC.read(spark, d).withColumn("DB_NAME", F.concat(F.lit("ARGO"), F.when(F.col("N_LEVELS") > 3, "x").otherwise("")))
    keys = ["PLATFORM_NUMBER", "CYCLE_NUMBER", "N_LEVELS", "DIRECTION", "DB_NAME"]
    return standardize.restrict_domains(table.select(*keys, *[c for c in table.columns if c.endswith("_DATA_MODE")]))


@query
def null_normalise(spark, d):
    return standardize.null_for_nan(v.MESSY.read(spark, d).select("key", "TEMP", "PSAL"), sentinels=[-9999.0])


@query
def reindex_raw_phy(spark, d):
    return standardize.reindex(v.OBS_PHY.read(spark, d), vocab.raw_schema("PHY"))


@query
def cast_lenient(spark, d):
    table = v.MESSY.read(spark, d).select("key", "TEMP_QC", "PRES")
    schema = T.StructType([T.StructField("key", T.LongType()), *vocab.prune_schema(vocab.lake_schema("PHY"), table.columns).fields])
    return standardize.conform(table, schema, strict=False)


@query
def add_null_companions(spark, d):
    named = standardize.rename(v.SRC_BOTTLE.read(spark, d), vocab.SOURCES["GLODAP"].renames)
    return standardize.add_companions(standardize.drop_outside(named, vocab.lake_columns("BGC")), vocab.lake_columns("BGC"))


@query
def parse_times(spark, d):
    table = v.MESSY.read(spark, d)
    parts = [F.lit(1999), F.col("month"), F.lit(31)]
    return table.select(
        "key",
        times.from_parts(parts, strict=False).alias("from_parts"),
        times.from_iso(F.col("iso"), strict=False).alias("from_iso"),
        times.from_compact(F.col("compact")).alias("from_compact"),
        times.from_nanos(F.col("nanos")).alias("from_nanos"),
    )


# --- the lake -----------------------------------------------------------------------


def phy_tables(spark, d) -> dict[str, DataFrame]:
    return {
        "ARGO": quality.best_value_table(v.OBS_PHY.read(spark, d), "PHY"),
        "GLODAP": standardize.standardize_bottle(v.SRC_BOTTLE.read(spark, d), "PHY"),
        "SprayGliders": derived.standardize_glider(v.SRC_GLIDER.read(spark, d)),
        "CPR": standardize.standardize_plankton(v.SRC_PLANKTON.read(spark, d)),
    }


def bgc_tables(spark, d) -> dict[str, DataFrame]:
    return {
        "ARGO": quality.best_value_table(v.OBS_BGC.read(spark, d), "BGC"),
        "GLODAP": standardize.standardize_bottle(v.SRC_BOTTLE.read(spark, d), "BGC"),
        "CPR": standardize.standardize_plankton(v.SRC_PLANKTON.read(spark, d), "BGC"),
    }


# Between them the filters use every comparison; measurements and DATA_MODE are absent from some sources.
AND_FILTER = [
    ("PSAL", ">=", 31), ("PSAL", "<=", 34.5), ("PRES", ">", 150), ("LONGITUDE", "!=", 0), ("TEMP_QC", "in", [1, 2, 5]),
]
OR_FILTER = [
    [("DB_NAME", "==", "CPR"), ("LONGITUDE", ">", 100)],
    [("PRES", "<=", 400), ("PSAL", "<", 32)],
    [("TEMP", "<", 4)],
]
MODE_FILTER = [[("DATA_MODE", "in", ["D", "A"]), ("LATITUDE", ">", 0)], [("DATA_MODE", "==", "R")]]
NOT_IN_FILTER = [("TEMP_QC", "not in", [1, 2]), ("PRES", ">", 100)]


@query
def lake_union(spark, d):
    return lake.unite(phy_tables(spark, d), lake.selected_columns(None, "PHY"))


@query
def lake_union_bgc(spark, d):
    return lake.unite(bgc_tables(spark, d), lake.selected_columns(None, "BGC"))


@query
def lake_union_select(spark, d):
    tables = phy_tables(spark, d)
    chosen = {name: tables[name] for name in catalog.selected_sources(["ARGO", "CPR"])}
    return lake.unite(chosen, lake.selected_columns(["JULD", "DB_NAME", "TEMP", "DATA_MODE"], "PHY"))


@query
def lake_filter_and(spark, d):
    return lake.unite(phy_tables(spark, d), lake.selected_columns(None, "PHY"), AND_FILTER)


@query
def lake_filter_or(spark, d):
    return lake.unite(phy_tables(spark, d), lake.selected_columns(None, "PHY"), OR_FILTER)


@query
def lake_filter_missing_discard(spark, d):
    return lake.unite(phy_tables(spark, d), lake.selected_columns(None, "PHY"), MODE_FILTER)


@query
def lake_filter_missing_null(spark, d):
    return lake.unite(phy_tables(spark, d), lake.selected_columns(None, "PHY"), MODE_FILTER, missing="null")


@query
def lake_filter_not_in(spark, d):
    return lake.unite(phy_tables(spark, d), lake.selected_columns(None, "PHY"), NOT_IN_FILTER)


@query
def lake_filter_reset(spark, d):
    wanted = filters.restrict_to_filtered(lake.selected_columns(None, "PHY"), AND_FILTER)
    return lake.unite(phy_tables(spark, d), wanted, AND_FILTER)


@query
def lake_size_report(spark, d):
    return lake.size_report(lake_union(spark, d))


@query
def lake_head(spark, d):
    return lake.first_rows(lake_union(spark, d), 100, ["JULD", "PLATFORM_NUMBER"])


@query
def lake_tail(spark, d):
    return lake.last_rows(lake_union(spark, d), 100, ["JULD", "PLATFORM_NUMBER"])


@query
def lake_group_std(spark, d):
    spread = lake.group_deviation(lake_union(spark, d), ["LATITUDE"], "LONGITUDE")
    return spread.select("LATITUDE", F.round("std", 6).alias("std"))


# --- the profile index --------------------------------------------------------------


def index(spark, d) -> DataFrame:
    return inventory.enrich_index(inventory.parse_index(v.PROFILE_INDEX.read(spark, d)))


def copies(spark, d) -> DataFrame:
    return v.LOCAL_INVENTORY.read(spark, d).withColumn("mtime", F.col("mtime").cast("timestamp_ntz"))


@query
def index_enrich(spark, d):
    return index(spark, d)


@query
def index_box(spark, d):
    return inventory.subset_index(
        index(spark, d), latitudes=[-30, 45.5], longitudes=[-60, 20], start=datetime(1994, 1, 1), end=datetime(1997, 6, 1, 12)
    )


@query
def index_dateline(spark, d):
    return inventory.subset_index(index(spark, d), latitudes=[0, 60], longitudes=[170, 190])


@query
def index_platforms(spark, d):
    return inventory.subset_index(index(spark, d), platforms=[1900007, 1900010, 1900101])


@query
def index_no_range(spark, d):
    return inventory.subset_index(index(spark, d))


@query
def index_platforms_from_table(spark, d):
    wanted = v.LOCAL_INVENTORY.read(spark, d).where("mtime < timestamp'2004-01-01'")
    return inventory.subset_index(index(spark, d), platforms=wanted)


@query
def index_sensors(spark, d):
    return inventory.subset_index(index(spark, d), sensors=["DOXY", "CHLA"])


@query
def index_sensors_contains(spark, d):
    return inventory.subset_index(index(spark, d), sensors="CHLA", sensor_match="contains")


@query
def index_rejects(spark, d):
    raw = v.PROFILE_INDEX.read(spark, d)
    broken = raw.withColumn("file", F.when(F.col("parameters").endswith("CHLA"), F.upper("file")).otherwise(F.col("file")))
    return inventory.index_rejects(inventory.enrich_index(inventory.parse_index(broken))).select("file", "date", "wmoid", "cycle")


@query
def index_unique_platforms(spark, d):
    return inventory.distinct_platforms(index(spark, d))


@query
def index_staleness(spark, d):
    return inventory.staleness(index(spark, d), copies(spark, d))


@query
def fetch_plan(spark, d):
    return inventory.fetch_plan(index(spark, d), copies(spark, d), dataset="bgc", url_root="dac/", save_to="gdac")


@query
def fetch_plan_profiles(spark, d):
    return inventory.profile_fetch_plan(inventory.subset_index(index(spark, d), sensors="DOXY"), "dac/", "gdac")


@query
def fetch_actions(spark, d):
    plan = inventory.platform_plan(index(spark, d), copies(spark, d), dataset="phy")
    return plan.select(
        "filepath_main",
        inventory.fetch_action().alias("action"),
        inventory.fetch_action(check_time=False).alias("action_keep"),
        inventory.fetch_action(check_time=False, overwrite=True).alias("action_force"),
    )


@query
def fetch_batches(spark, d):
    return inventory.assign_batches(fetch_plan(spark, d), 36).select("filepath_main", "batch_id")


@query
def fetch_batches_many(spark, d):
    return inventory.assign_batches(fetch_plan(spark, d), 200).select("filepath_main", "batch_id")


@query
def load_failures(spark, d):
    return inventory.load_failures(v.MANIFEST.read(spark, d), v.LOADED.read(spark, d))


@query
def load_failure_summary(spark, d):
    return inventory.failure_summary(v.MANIFEST.read(spark, d), v.LOADED.read(spark, d))


# --- profiles -----------------------------------------------------------------------

_PROFILE_KEYS = ["input_file", "PLATFORM_NUMBER", "CYCLE_NUMBER", "N_PROF"]


@query
def profile_flatten(spark, d):
    arrays = v.profile_arrays(spark, d)
    return profiles.flatten_profiles(arrays, keep=["PLATFORM_NUMBER", "CYCLE_NUMBER", "N_PROF", "LATITUDE", "LONGITUDE", "JULD"], levels=["PRES", "TEMP", "PSAL"])


@query
def profile_data_mode(spark, d):
    arrays = v.profile_arrays(spark, d).select(*_PROFILE_KEYS, *v.PROFILE_LISTS)
    names = ["PRES", "TEMP", "PSAL", "DOXY"]
    spread = profiles.spread_data_modes(arrays, names=names, strict=False)
    return spread.select(*_PROFILE_KEYS, *[f"{n}_DATA_MODE" for n in names])


@query
def profile_calibration_check(spark, d):
    arrays = v.profile_arrays(spark, d)
    same = profiles.same_in_all_calibrations(F.col("CALIBRATION_PARAMETERS"))
    return arrays.select(*_PROFILE_KEYS, same.alias("same_parameters"))


@query
def profile_rejects(spark, d):
    _, rejected = profiles.split_rejects(profiles.mark_rejects(v.profile_arrays(spark, d)))
    return rejected.select(*_PROFILE_KEYS, "reject_reason")


@query
def profile_rejects_by_file(spark, d):
    _, rejected = profiles.split_rejects(profiles.mark_rejects(v.profile_arrays(spark, d)), "input_file")
    return rejected.select(*_PROFILE_KEYS, "reject_reason")


def _judged(marked: DataFrame) -> DataFrame:
    """All profiles with their reason, sound ones with none, from the two tables of a split."""
    sound, rejected = profiles.split_rejects(marked, "input_file")
    sound = sound.withColumn("reject_reason", F.lit(None).cast("string"))
    return sound.unionByName(rejected).select(*_PROFILE_KEYS, "reject_reason")


@query
def profile_rejects_bad_values(spark, d):
    """A blank flag, which is no number, rejects its file and does not fail the query."""
    flags = F.expr("transform(PRES, p -> case when CYCLE_NUMBER%883=5 then ' ' else '1' end)")
    arrays = v.profile_arrays(spark, d).withColumn("TEMP_QC", flags)
    return _judged(profiles.mark_rejects(arrays, schema=vocab.raw_schema("PHY")))


@query
def profile_rejects_null_file(spark, d):
    nameless = F.expr("case when CYCLE_NUMBER%5<>0 then input_file end")
    return _judged(profiles.mark_rejects(v.profile_arrays(spark, d).withColumn("input_file", nameless)))


@query
def profile_unknown_parameters(spark, d):
    return profiles.unknown_parameters(v.profile_arrays(spark, d))


@query
def profile_raw_table(spark, d):
    sound, _ = profiles.split_rejects(profiles.mark_rejects(v.profile_arrays(spark, d)), "input_file")
    return profiles.raw_table(sound, "BGC")


# --- derived variables --------------------------------------------------------------

_DERIVED_KEYS = ["PLATFORM_NUMBER", "LATITUDE", "LONGITUDE", "JULD", "PRES", "TEMP", "PSAL"]


def _derived(spark, d, name: str) -> DataFrame:
    best = quality.best_value_table(v.OBS_PHY.read(spark, d), "PHY").select(*_DERIVED_KEYS)
    return derived.add_derived(best).select(*_DERIVED_KEYS, name)


@query
def derived_abs_salinity(spark, d):
    return _derived(spark, d, "ABS_SAL_COMPUTED")


@query
def derived_ct(spark, d):
    return _derived(spark, d, "CONSERVATIVE_TEMP_COMPUTED")


@query
def derived_sigma1(spark, d):
    return _derived(spark, d, "SIGMA1_COMPUTED")


@query
def derived_pressure(spark, d):
    return derived.add_pressure_from_depth(v.SRC_GLIDER.read(spark, d)).select("profile", "time", "depth", "lat", "PRES")


@query
def job_argo_phy(spark, d):
    return jobs.to_lake(v.OBS_PHY.read(spark, d), "ARGO", "PHY", add_derived=True)


@query
def job_bottle_phy(spark, d):
    return jobs.to_lake(v.SRC_BOTTLE.read(spark, d), "GLODAP", "PHY", add_derived=True)


# --- files and streams --------------------------------------------------------------


@query
def scan_filtered(spark, d):
    return readers.read_parquet(
        spark,
        f"{d}/lineitem.parquet",
        columns=["l_orderkey", "l_linenumber", "l_quantity"],
        filters=[[("l_quantity", "<", 10), ("l_returnflag", "in", ["R", "A"])], [("l_discount", ">", 0.09), ("no_such", "=", 1)]],
    )


@query
def sink_roundtrip(spark, d):
    """Write in two goes, the second appending, and read back with the saved schema."""
    path = shared_folder(spark, "roundtrip")
    table = quality.best_value_table(v.OBS_PHY.read(spark, d), "PHY")
    writers.write_table(table.where("LATITUDE < 0"), path, overwrite=True)
    writers.write_table(table.where("LATITUDE >= 0"), path, overwrite=False, cluster_by=["JULD"])
    return readers.read_parquet(spark, path, schema=catalog.load_schema(spark, path))


@query
def sink_append_fewer_columns(spark, d):
    """Append a table without the derived columns; those of the rows that are there stay."""
    path = shared_folder(spark, "narrower")
    table = quality.best_value_table(v.OBS_PHY.read(spark, d), "PHY")
    writers.write_table(derived.add_derived(table.where("LATITUDE < 0")), path)
    writers.write_table(table.where("LATITUDE >= 0"), path, overwrite=False)
    return readers.read_parquet(spark, path, schema=catalog.load_schema(spark, path))


@query
def job_bottle_append(spark, d):
    """The bottle job run twice, the second time appending: both profile types hold each row twice."""
    root = shared_folder(spark, "bottles-twice")
    v.SRC_BOTTLE.read(spark, d).write.csv(f"{root}/text", header=True)
    for again in (False, True):
        jobs.bottles(spark, f"{root}/text", f"{root}/PHY", f"{root}/BGC", overwrite=not again)
    counts = spark.read.parquet(f"{root}/BGC").agg(F.count("*").alias("n_bgc"))
    return spark.read.parquet(f"{root}/PHY").crossJoin(F.broadcast(counts))


@query
def job_raw_append(spark, d):
    """Raw profiles in two runs, the second appending."""
    root, arrays = shared_folder(spark, "raw-twice"), v.profile_arrays(spark, d)
    for odd in (0, 1):
        part = arrays.where(F.col("PLATFORM_NUMBER") % 2 == odd)
        jobs.raw_profiles(spark, part, "PHY", f"{root}/PHY", f"{root}/rejects", overwrite=odd == 0)
    kept = spark.read.parquet(f"{root}/PHY").groupBy("PLATFORM_NUMBER").agg(F.count("*").alias("n_levels"))
    bad = spark.read.parquet(f"{root}/rejects").groupBy("PLATFORM_NUMBER").agg(F.count("*").alias("n_rejects"))
    return kept.join(bad, "PLATFORM_NUMBER", "full")


@query
def lake_from_disk(spark, d):
    """Write each source, then load the lake from its root with a filter."""
    root = shared_folder(spark, "lake")
    for name, table in phy_tables(spark, d).items():
        folder = writers.table_name(vocab.source(name).folder_mark, "PHY")
        writers.write_table(table, f"{root}/{folder}", layout="scan")
    return lake.load_lake(spark, root, filters=OR_FILTER)


@query
def csv_roundtrip(spark, d):
    """Bottle data through a delimited file."""
    path = shared_folder(spark, "bottles")
    v.SRC_BOTTLE.read(spark, d).write.csv(path, header=True)
    return standardize.standardize_bottle(readers.read_csv(spark, path, "GLODAP"), "PHY")


@query
def job_raw_profiles(spark, d):
    """Profiles with arrays to the raw table on disk, sound files only."""
    root = shared_folder(spark, "raw")
    jobs.raw_profiles(spark, v.profile_arrays(spark, d), "PHY", f"{root}/PHY", f"{root}/rejects", "input_file", layout="scan")
    return spark.read.parquet(f"{root}/PHY")


def _stream(spark, d, view: v.View) -> DataFrame:
    path = f"{d}/{view.table}.parquet"
    schema = spark.read.parquet(path).schema
    if catalog.is_empty_folder(spark, path):  # a single file, not a folder of files
        return view.over(ingest.file_stream(spark, d, schema, names=f"{view.table}.parquet"))
    return view.over(ingest.file_stream(spark, path, schema))


@query
def ingest_stream(spark, d):
    """Best values of newly arrived raw files."""
    root = shared_folder(spark, "ingest")
    raw = _stream(spark, d, v.OBS_PHY)
    ingest.ingest(raw, lambda df: quality.best_value_table(df, "PHY"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query
def stream_latest_index(spark, d):
    root = shared_folder(spark, "latest")
    latest.follow(_stream(spark, d, v.REISSUED), f"{root}/state", f"{root}/checkpoint").awaitTermination()
    return latest.current(spark, f"{root}/state")


@query
def stream_load_report(spark, d):
    root = shared_folder(spark, "report")
    report.watch(_stream(spark, d, v.ARRIVALS), f"{root}/report", f"{root}/checkpoint").awaitTermination()
    return report.totals(spark, f"{root}/report")


# --- streams of several batches -----------------------------------------------------


#: Bytes of input that one file of a batch is made from, about.
ISSUED_BYTES = 128 * 1024 * 1024


def _issued(df: DataFrame, batch: str, count: int, path: str, file_bytes: int = ISSUED_BYTES) -> tuple[T.StructType, int]:
    """Write a table as batches of files, in order, as they arrive one after another; the files' schema and how many each batch has.

    A file is written by a task of its own, from a bounded part of the input. Every batch has as many files, so a stream that takes that
    many at a time takes batch by batch: files without rows stand in for tasks that have none.
    """
    spark, rows = df.sparkSession, df.drop(batch)
    size = sum(catalog.file_bytes(spark, file) for file in df.inputFiles())
    files = max(1, min(-(-size // file_bytes), df.rdd.getNumPartitions()))
    for number in range(count):
        df.where(F.col(batch) == number).drop(batch).coalesce(files).write.mode("append").parquet(path)
        for _ in range((number + 1) * files - len(catalog.matching_paths(spark, f"{path}/*.parquet"))):
            spark.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(path)
    return rows.schema, files


@query
def stream_hourly_closed(spark, d):
    """Hours closed by a watermark, those still open, and what came too late for its hour."""
    root = shared_folder(spark, "closing")
    schema, files = _issued(v.ARRIVALS_IN_BATCHES.read(spark, d), "batch", 10, f"{root}/in")
    report.close_hours(ingest.file_stream(spark, f"{root}/in", schema, files_per_batch=files), f"{root}/report", delay="2 hours")
    late = report.late_rows(spark, f"{root}/report").groupBy(F.date_trunc("hour", "arrived").alias("hour")).agg(F.count("*").alias("n_late"))
    hour = F.col("hour").cast("timestamp_ntz")
    closed = report.closed_hours(spark, f"{root}/report").withColumn("closed", F.lit(True))
    counted = closed.unionByName(report.open_hours(spark, f"{root}/report").withColumn("closed", F.lit(False)))
    return counted.withColumn("hour", hour).join(late.withColumn("hour", hour), "hour", "full")


@query
def stream_latest_compacted(spark, d):
    """Index entries in seven batches, compacted twice on the way; a third compaction dies before its pointer."""
    root = shared_folder(spark, "compacted")
    entries = v.REISSUED.read(spark, d).withColumn("batch", F.pmod("version", F.lit(7)).cast("int"))
    schema, files = _issued(entries, "batch", 7, f"{root}/in")
    stream = ingest.file_stream(spark, f"{root}/in", schema, files_per_batch=files)
    latest.follow(stream, f"{root}/state", f"{root}/checkpoint", compact_every=3).awaitTermination()
    spark.read.parquet(f"{root}/in").limit(0).write.parquet(f"{root}/state/_snapshots/000000000006-unfinished")
    latest.prune(spark, f"{root}/state")
    return latest.current(spark, f"{root}/state")


@query
def stream_group_std(spark, d):
    """The deviation of a lake's column per platform, from batches that are not read again."""
    root = shared_folder(spark, "moments")
    raw = v.OBS_PHY.read(spark, d).withColumn("batch", F.col("N_LEVELS") - 1)
    schema, files = _issued(raw, "batch", 7, f"{root}/in")
    lake_rows = quality.best_value_table(ingest.file_stream(spark, f"{root}/in", schema, files_per_batch=files), "PHY")
    moments.follow(lake_rows, f"{root}/state", f"{root}/checkpoint", ["PLATFORM_NUMBER"], "PSAL").awaitTermination()
    spread = moments.deviation(spark, f"{root}/state", ["PLATFORM_NUMBER"])
    return spread.select("PLATFORM_NUMBER", F.round("std", 6).alias("std"))


@query
def ingest_stream_restarted(spark, d):
    """Best values of raw files in six batches; the transform fails in the fourth, and the ingest is started again."""
    root = shared_folder(spark, "restarted")
    raw = v.OBS_PHY.read(spark, d).withColumn("batch", F.pmod("CYCLE_NUMBER", F.lit(6)))
    schema, files = _issued(raw, "batch", 6, f"{root}/in")

    def stream() -> DataFrame:
        return ingest.file_stream(spark, f"{root}/in", schema, files_per_batch=files)

    def sound(df: DataFrame) -> DataFrame:
        return quality.best_value_table(df, "PHY")

    def failing(df: DataFrame) -> DataFrame:
        broken = F.when(F.pmod("CYCLE_NUMBER", F.lit(6)) == 3, F.raise_error(F.lit("injected")).cast("bigint"))
        return sound(df.withColumn("PLATFORM_NUMBER", broken.otherwise(F.col("PLATFORM_NUMBER"))))

    try:
        ingest.ingest(stream(), failing, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    except StreamingQueryException:
        ingest.ingest_with_restarts(stream, sound, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


# --- two issues of the index --------------------------------------------------------


def _issue(spark, d, view: v.View) -> DataFrame:
    return inventory.enrich_index(inventory.parse_index(view.read(spark, d)))


@query
def index_changes(spark, d):
    return inventory.index_changes(_issue(spark, d, v.PROFILE_INDEX_BEFORE), _issue(spark, d, v.PROFILE_INDEX_AFTER))


@query
def fetch_plan_delta(spark, d):
    """The plan after an index is issued again, from the earlier state and what has changed."""
    before, after = _issue(spark, d, v.PROFILE_INDEX_BEFORE), _issue(spark, d, v.PROFILE_INDEX_AFTER)
    state = inventory.platform_state(before)
    state = inventory.updated_state(state, inventory.index_changes(before, after), after)
    return inventory.plan_from_state(state, copies(spark, d), dataset="bgc", url_root="dac/", save_to="gdac")


MOMENTS = [datetime(2002, 1, 1), datetime(2003, 6, 15, 6), datetime(2004, 6, 15, 5, 59, 59), datetime(2001, 1, 1)]


@query
def index_staleness_as_of(spark, d):
    return inventory.staleness_as_of(index(spark, d), copies(spark, d), MOMENTS)


@query
def profile_data_mode_long(spark, d):
    """The modes of ``profile_data_mode``, given as rows."""
    arrays = v.profile_arrays(spark, d).select(*_PROFILE_KEYS, *v.PROFILE_LISTS)
    names = ["PRES", "TEMP", "PSAL", "DOXY"]
    pairs = F.arrays_zip("PARAMETER", F.slice("PARAMETER_DATA_MODE", F.lit(1), F.size("PARAMETER")).alias("DATA_MODE"))
    long = arrays.select(*_PROFILE_KEYS, F.posexplode(pairs).alias("POSITION", "pair")).select(*_PROFILE_KEYS, "POSITION", "pair.*")
    spread = profiles.modes_from_rows(arrays, long, _PROFILE_KEYS, names=names, strict=False)
    return spread.select(*_PROFILE_KEYS, *[f"{n}_DATA_MODE" for n in names])


# --- the salinity atlas -------------------------------------------------------------

ATLAS_GRID = Grid(step=float(v.ATLAS_STEP), longitude=1.0, latitude=-90.0)


def atlas(spark, d) -> DataFrame:
    points = v.ATLAS_POINTS.read(spark, d).where("(east + 3 * north + level) % 7 <> 5")
    ratios = points.groupBy("east", "north", "level").agg(F.min("ratio").alias("ratio"))
    return ratios.selectExpr("1e0 + 30e0 * east AS longitude", "-90e0 + 30e0 * north AS latitude", "500e0 * level AS pressure", "ratio")


@query
def derived_abs_salinity_atlas(spark, d):
    """Absolute salinity with the regional anomaly: over holes, round the date line and at the poles."""
    best = quality.best_value_table(v.OBS_PHY.read(spark, d), "PHY").select(*_DERIVED_KEYS)
    return derived.add_derived(best, atlas(spark, d), ATLAS_GRID).select(*_DERIVED_KEYS, "ABS_SAL_COMPUTED")


@query
def job_bottle_phy_atlas(spark, d):
    return jobs.to_lake(v.SRC_BOTTLE.read(spark, d), "GLODAP", "PHY", True, atlas(spark, d), ATLAS_GRID)


# --- files that cannot be read, and the jobs end to end -----------------------------


def _in_one_file(df: DataFrame, folder: str) -> None:
    """Write rows as one file; the task that writes it gets only these rows, not the input they are picked from."""
    df.repartition(1).write.parquet(folder)


def _cut_short(spark, folder: str) -> None:
    """Leave half of the one data file in a folder, as a copy that was broken off does."""
    (path,) = catalog.matching_paths(spark, f"{folder}/*.parquet")
    catalog.cut_file(spark, path, catalog.file_bytes(spark, path) // 2)


@query
def job_corrupt_file(spark, d):
    """Files of raw profiles of which one is cut short: the others' rows, and how many files were rejected why."""
    root, arrays = shared_folder(spark, "cut-short"), v.profile_arrays(spark, d)
    cut = F.col("PLATFORM_NUMBER") % 50 == 3
    _in_one_file(arrays.where(cut), f"{root}/in")
    _cut_short(spark, f"{root}/in")
    arrays.where(~cut).write.mode("append").parquet(f"{root}/in")
    jobs.raw_files(spark, f"{root}/in", "PHY", f"{root}/PHY", f"{root}/rejects", deep=True)
    files = spark.read.parquet(f"{root}/rejects_files").agg(F.count("*").alias("n_files"), F.max("reason").alias("file_reason"))
    return spark.read.parquet(f"{root}/PHY").crossJoin(F.broadcast(files))


@query
def csv_rejects(spark, d):
    """Text records of one and of three lines: the sound ones, and for the others the sample, the reason and the line breaks."""
    path = shared_folder(spark, "records")
    v.PLANKTON_LINES.read(spark, d).write.csv(path, header=True, escape='"')
    good, bad = readers.read_records_with_rejects(spark, path, "CPR")
    kept = good.select("SampleId", "Latitude", "Longitude", "MidPoint_Date_UTC", "Chlorophyll_Index")
    sample = F.regexp_extract("row", '^"?([0-9]+DA)', 1).alias("SampleId")
    breaks = (F.length("row") - F.length(F.replace("row", F.lit("\n")))).cast("int").alias("n_breaks")
    return kept.unionByName(bad.select(sample, "reason", breaks), allowMissingColumns=True)


@query
def job_argo_bgc(spark, d):
    """Raw profiles on disk to best values with derived variables on disk."""
    root = shared_folder(spark, "argo-bgc")
    v.OBS_BGC.read(spark, d).write.parquet(f"{root}/raw")
    jobs.argo_best_values(spark, f"{root}/raw", "BGC", f"{root}/out")
    return spark.read.parquet(f"{root}/out")


@query
def job_glider(spark, d):
    root = shared_folder(spark, "glider")
    v.SRC_GLIDER.read(spark, d).write.parquet(f"{root}/raw")
    jobs.gliders(spark, f"{root}/raw", f"{root}/out")
    return spark.read.parquet(f"{root}/out")


@query
def job_plankton(spark, d):
    """Plankton text to both profile types."""
    root = shared_folder(spark, "plankton")
    v.SRC_PLANKTON.read(spark, d).write.csv(f"{root}/text", header=True)
    jobs.plankton(spark, f"{root}/text", f"{root}/PHY", f"{root}/BGC")
    both = [spark.read.parquet(f"{root}/{p}").withColumn("profile", F.lit(p)) for p in ("PHY", "BGC")]
    return both[0].unionByName(both[1], allowMissingColumns=True)


@query
def convert_many_files(spark, d):
    """Bottle text in many files with one header to the lake."""
    root = shared_folder(spark, "many")
    rows = v.SRC_BOTTLE.read(spark, d)
    for part in range(4):
        rows.where(F.col("G2month") % 4 == part).coalesce(1).write.csv(f"{root}/text/{part}", header=True)
    paths = catalog.matching_paths(spark, f"{root}/text/*/*.csv")
    jobs.convert(spark, paths, "GLODAP", "BGC", f"{root}/out")
    return spark.read.parquet(f"{root}/out")


def _index_file(spark, d, folder: str) -> str:
    """The index as text: a comment, a header, then the entries."""
    entries = v.PROFILE_INDEX.read(spark, d)
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in entries.columns])
    top = spark.createDataFrame([("# Title : index of profile files",), (",".join(entries.columns),)], "value string").coalesce(1)
    top.union(entries.select(line.alias("value"))).coalesce(1).write.text(folder)
    return folder


def _platforms_of_index(arrays: DataFrame) -> DataFrame:
    return arrays.withColumn("PLATFORM_NUMBER", F.col("PLATFORM_NUMBER") + 900000)


def _index_to_raw(spark, d) -> tuple[str, DataFrame]:
    root = shared_folder(spark, "index-to-raw")
    _platforms_of_index(v.profile_arrays(spark, d)).write.parquet(f"{root}/arrays")
    index_path = _index_file(spark, d, f"{root}/index")
    plan = jobs.plan_and_ingest(
        spark, index_path, f"{root}/arrays", "phy", f"{root}/lake", copies(spark, d), "dac/", "gdac", latitudes=[-30, 45.5], longitudes=[-60, 20]
    )
    return root, plan


@query
def job_index_to_raw(spark, d):
    """Index text and profiles with arrays to the raw table of the wanted platforms."""
    return spark.read.parquet(f"{_index_to_raw(spark, d)[0]}/lake/PHY")


@query
def job_index_plan(spark, d):
    """The files that are still to fetch after the same job."""
    return _index_to_raw(spark, d)[1]


@query
def index_metadata(spark, d):
    """The wanted part of the index, as it lies beside the data after the same job."""
    return spark.read.parquet(f"{_index_to_raw(spark, d)[0]}/lake/metadata/phy")


@query
def index_text(spark, d):
    """The index read from text with a comment line."""
    return inventory.enrich_index(readers.read_index(spark, _index_file(spark, d, shared_folder(spark, "index-text"))))
