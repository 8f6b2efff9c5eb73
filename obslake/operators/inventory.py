"""The profile index: what there is, what is wanted, and what is to be fetched."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.functions import geo, text, times
from obslake.operators.ranking import with_position
from obslake.session import written

# Endings of the per-platform files.
PLATFORM_FILE_ENDING = {"bgc": "_Sprof.nc", "phy": "_prof.nc"}


def dataset_name(value: str) -> str:
    if value not in PLATFORM_FILE_ENDING:
        raise ValueError(f"dataset must be one of {sorted(PLATFORM_FILE_ENDING)}, got {value!r}")
    return value


def parse_index(text_index: DataFrame) -> DataFrame:
    """Types of a profile index read as text: two times and two coordinates."""
    numbers = {c: F.col(c).try_cast("double") for c in ("latitude", "longitude")}
    dates = {c: times.from_compact(F.col(c)) for c in ("date", "date_update")}
    return text_index.withColumns(numbers | dates)


def enrich_index(index: DataFrame) -> DataFrame:
    """Add platform number, paths, file name and cycle, all taken from ``file``."""
    return index.withColumns(text.profile_file_parts(F.col("file")))


def index_rejects(enriched: DataFrame) -> DataFrame:
    """Index entries whose ``file`` is not of the usual form."""
    return enriched.where(F.col("wmoid").isNull() | F.col("cycle").isNull())


def subset_index(
    index: DataFrame,
    dataset: str = "bgc",
    latitudes: Sequence[float] | None = None,
    longitudes: Sequence[float] | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
    platforms: int | Sequence[int] | DataFrame | None = None,
    sensors: str | Sequence[str] | None = None,
    sensor_match: str = "token",
) -> DataFrame:
    """Entries in the given ranges (ends included), of the given platforms, with all given sensors.

    What is not asked for is not tested: entries without date or position stay unless a range
    is given, and then a null is in no range. Longitudes may cross the date line.
    ``platforms`` may be a table with a ``wmoid`` column.
    """
    dataset_name(dataset)
    wanted = F.lit(True)
    if latitudes is not None:
        wanted = wanted & F.col("latitude").between(*latitudes)
    if longitudes is not None:
        wanted = wanted & geo.in_longitudes(F.col("longitude"), longitudes)
    if start is not None:
        wanted = wanted & (F.col("date") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        wanted = wanted & (F.col("date") <= F.lit(end).cast("timestamp_ntz"))
    if sensors is not None:
        if dataset != "bgc":
            raise ValueError("sensors can only be asked for in the bgc dataset")
        for sensor in [sensors] if isinstance(sensors, str) else sensors:
            wanted = wanted & text.has_sensor(F.col("parameters"), sensor, sensor_match)
    if isinstance(platforms, DataFrame):
        listed = platforms.select("wmoid").distinct()
        return index.where(wanted).join(listed, "wmoid", "left_semi").select(index.columns)
    if platforms is not None:
        wanted = wanted & F.col("wmoid").isin(*([platforms] if isinstance(platforms, int) else platforms))
    return index.where(wanted)


def _by_path_and_platform(index: DataFrame) -> DataFrame:
    """The index cut down to what plans need: one row per path and platform.

    All profiles of a platform are combined before they are shuffled.
    """
    return index.groupBy("filepath_main", "wmoid").agg(
        F.min("file").alias("first_file"),
        F.max("date_update").alias("latest_update"),
        F.max(F.col("date_update").isNull()).alias("undated"),
    )


def _one_per_path(pairs: DataFrame) -> DataFrame:
    placed = pairs.where(F.col("filepath_main").isNotNull())
    return placed.groupBy("filepath_main").agg(F.min_by("wmoid", "first_file").alias("wmoid"))


def distinct_platforms(index: DataFrame) -> DataFrame:
    """One row per platform path, with the number of the path's first file in name order.

    Platforms change data centre, so it is the path that tells them apart.
    """
    return _one_per_path(_by_path_and_platform(index))


def _newest(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("wmoid").isNotNull()).groupBy("wmoid").agg(
        F.max("latest_update").alias("latest_update"), F.max("undated").alias("undated")
    )


def _out_of_date() -> Column:
    """Up to date is only a copy newer than every dated entry, with no entry undated."""
    fresh = (F.col("latest_update") < F.col("mtime")) & ~F.col("undated")
    return ~F.coalesce(fresh, F.lit(False))


def _copies(inventory: DataFrame, key: str) -> DataFrame:
    """The oldest copy per key, so that a second copy cannot hide a stale one."""
    return inventory.groupBy(key).agg(F.min("mtime").alias("mtime"))


def staleness(index: DataFrame, inventory: DataFrame) -> DataFrame:
    """Per platform number: newest update, time of the local copy, and whether that is out of date."""
    joined = _newest(_by_path_and_platform(index)).join(_copies(inventory, "wmoid"), "wmoid", "left")
    return joined.select("wmoid", "latest_update", "mtime", _out_of_date().alias("stale"))


def staleness_as_of(index: DataFrame, inventory: DataFrame, moments: Sequence[datetime]) -> DataFrame:
    """For each local copy and moment: the newest index entry not later than it, and whether the copy is out of date then.

    All moments are answered by one aggregate over the index, which combines before its shuffle. An entry
    without time may be of any moment, so its platform is always out of date, as in ``staleness``. A platform
    without an entry by then has nulls, and its copy is out of date as one without update is.
    """
    times_asked = [F.lit(m).cast("timestamp_ntz") for m in moments]
    dated = F.struct(F.col("date_update").alias("latest_update"), F.col("file").alias("latest_file"))
    newest = [F.max(F.when(F.col("date_update") <= m, dated)).alias(f"__m{k}") for k, m in enumerate(times_asked)]
    by_platform = index.where(F.col("wmoid").isNotNull()).groupBy("wmoid").agg(F.max(F.col("date_update").isNull()).alias("undated"), *newest)
    joined = _copies(inventory, "wmoid").join(by_platform, "wmoid", "left")
    asked = F.array(*[F.struct(m.alias("moment"), F.col(f"__m{k}").alias("newest")) for k, m in enumerate(times_asked)])
    spread = joined.select("wmoid", "mtime", "undated", F.explode(asked).alias("a")).select(
        "wmoid", "mtime", "undated", "a.moment", "a.newest.latest_update", "a.newest.latest_file"
    )
    return spread.select("wmoid", "moment", "latest_update", "latest_file", "mtime", _out_of_date().alias("stale"))


# --- between two issues of the index ------------------------------------------------

CHANGES = ("new", "moved", "reissued", "withdrawn")


def _by_file(index: DataFrame) -> DataFrame:
    return index.groupBy("file").agg(
        F.first("filename").alias("filename"),
        F.first("wmoid").alias("wmoid"),
        F.first("filepath_main").alias("filepath_main"),
        F.max("date_update").alias("latest_update"),
        F.max(F.col("date_update").isNull()).alias("undated"),
    )


def index_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What differs between two issues of the index: a row for each ``file`` with its ``change``.

    new: only the later issue has it; withdrawn: only the earlier one; reissued: its newest update time differs, or
    whether one is missing. A file name that one data centre's folder loses and another's gains is moved, in both rows.
    """
    old, new = _by_file(before), _by_file(after)
    sides = {c: (F.col(f"o.{c}"), F.col(f"n.{c}")) for c in ("filename", "wmoid", "filepath_main")}
    joined = old.alias("o").join(new.alias("n"), F.col("o.file") == F.col("n.file"), "full")
    same = F.col("o.latest_update").eqNullSafe(F.col("n.latest_update")) & F.col("o.undated").eqNullSafe(F.col("n.undated"))
    change = F.when(F.col("o.file").isNull(), "new").when(F.col("n.file").isNull(), "withdrawn").when(~same, "reissued")
    found = joined.select(
        F.coalesce("o.file", "n.file").alias("file"),
        *[F.coalesce(b, a).alias(c) for c, (a, b) in sides.items()],
        change.alias("change"),
        F.col("o.latest_update").alias("old_update"),
        F.col("n.latest_update").alias("new_update"),
    )
    changed = written(found.where("change IS NOT NULL"), "index-changes")
    both = changed.where("filename IS NOT NULL").groupBy("filename").agg(
        (F.max(F.col("change") == "new") & F.max(F.col("change") == "withdrawn")).alias("__moved")
    )
    joined = changed.join(both, "filename", "left")
    moved = F.coalesce("__moved", F.lit(False)) & F.col("change").isin("new", "withdrawn")
    return joined.withColumn("change", F.when(moved, "moved").otherwise(F.col("change"))).select(*changed.columns)


def platform_state(index: DataFrame) -> DataFrame:
    """(filepath_main, wmoid, latest_update, undated): what a plan needs of the index, one row per platform path."""
    pairs = written(_by_path_and_platform(index), "platforms")
    return _one_per_path(pairs).join(_newest(pairs), "wmoid", "left").select("filepath_main", "wmoid", "latest_update", "undated")


def updated_state(state: DataFrame, changes: DataFrame, after: DataFrame) -> DataFrame:
    """The platform state of a new issue of the index, from that of the one before and the ``changes`` between them.

    Only platforms that a change touches, and those that share a path with one, are worked out again. The
    rest of the state is taken over, so the new index is read but not aggregated as a whole.
    """
    touched_paths = changes.select("filepath_main").where("filepath_main IS NOT NULL").distinct()
    touched = changes.select("wmoid").where("wmoid IS NOT NULL").distinct()
    lean = after.select("file", "filepath_main", "wmoid", "date_update")
    of_platforms = lean.join(touched, "wmoid", "left_semi").select("filepath_main").where("filepath_main IS NOT NULL")
    shown = state.join(touched, "wmoid", "left_semi").select("filepath_main")
    paths = written(touched_paths.union(of_platforms).union(shown).distinct(), "touched-paths")
    platforms = written(lean.join(paths, "filepath_main", "left_semi").select("wmoid").where("wmoid IS NOT NULL").distinct(), "touched-platforms")
    by_path = lean.join(paths, "filepath_main", "left_semi").select(*lean.columns)
    by_platform = lean.join(platforms, "wmoid", "left_semi").select(*lean.columns)
    others = by_platform.join(paths, "filepath_main", "left_anti").select(*lean.columns)
    again = platform_state(by_path.union(others)).join(paths, "filepath_main", "left_semi")
    return state.join(paths, "filepath_main", "left_anti").unionByName(again)


def plan_from_state(
    state: DataFrame,
    inventory: DataFrame | None = None,
    dataset: str = "bgc",
    url_root: str = "",
    save_to: str = "",
    check_time: bool = True,
) -> DataFrame:
    """As ``platform_plan``, from a platform state."""
    root = f"{save_to.rstrip('/')}/" if save_to else ""
    platforms = state.withColumn(
        "file_name", F.concat(F.col("wmoid").cast("string"), F.lit(PLATFORM_FILE_ENDING[dataset_name(dataset)]))
    )
    dated = platforms.withColumns(
        {
            "url": F.concat(F.lit(url_root), F.col("filepath_main")),
            "local_path": F.concat(F.lit(root), F.col("filepath_main"), F.col("file_name")),
        }
    )
    if inventory is None:
        dated = dated.withColumn("mtime", F.lit(None).cast("timestamp_ntz"))
    else:
        key = "local_path" if "local_path" in inventory.columns else "wmoid"
        dated = dated.join(_copies(inventory, key), key, "left")
    due = _out_of_date() if check_time else F.lit(True)
    return dated.select(
        "filepath_main", "wmoid", "file_name", "url", "local_path", "latest_update", "mtime", due.alias("stale")
    )


def platform_plan(
    index: DataFrame,
    inventory: DataFrame | None = None,
    dataset: str = "bgc",
    url_root: str = "",
    save_to: str = "",
    check_time: bool = True,
) -> DataFrame:
    """One row per platform path: file to fetch, where from, where to, and whether it is due.

    ``inventory`` lists local copies with their ``mtime``, by ``local_path`` if it has
    that column, else by ``wmoid``. Without ``check_time`` every file is due.

    The index is read once: what is left of it, a row per path and platform, is stored and
    then used twice.
    """
    return plan_from_state(platform_state(index), inventory, dataset, url_root, save_to, check_time)


def fetch_plan(index: DataFrame, inventory: DataFrame | None = None, **options: object) -> DataFrame:
    """The platform files that are missing or out of date; a dry run is this table."""
    return platform_plan(index, inventory, **options).where("stale").drop("stale")


def profile_fetch_plan(index: DataFrame, url_root: str = "", save_to: str = "") -> DataFrame:
    """One row per profile file, for fetching profiles one by one."""
    root = f"{save_to.rstrip('/')}/" if save_to else ""
    return index.select(
        "file",
        "wmoid",
        F.col("filename").alias("file_name"),
        F.concat(F.lit(url_root), F.col("filepath")).alias("url"),
        F.concat(F.lit(root), F.col("filepath"), F.col("filename")).alias("local_path"),
    )


def fetch_action(remote_time: str = "latest_update", check_time: bool = True, overwrite: bool = False) -> Column:
    """What to do with a file, given the local copy's ``mtime`` (null if there is none).

    With ``check_time`` a copy is replaced only by a newer file, whatever ``overwrite``
    says; an unknown remote time is not newer.
    """
    newer = F.coalesce(F.col(remote_time) > F.col("mtime"), F.lit(False))
    replace, keep = F.lit("overwrite"), F.lit("skip_fresh" if check_time else "skip_exists")
    present = F.when(newer if check_time else F.lit(overwrite), replace).otherwise(keep)
    return F.when(F.col("mtime").isNull(), F.lit("fetch")).otherwise(present)


def fetch_actions(
    plan: DataFrame, remote_time: str = "latest_update", check_time: bool = True, overwrite: bool = False
) -> DataFrame:
    """Add ``action``, see ``fetch_action``."""
    return plan.withColumn("action", fetch_action(remote_time, check_time, overwrite))


def assign_batches(plan: DataFrame, batches: int, key: str = "filepath_main") -> DataFrame:
    """Add ``batch_id`` from 0: runs of consecutive keys, all of one size but the last.

    There are as many batches as asked for, or one per row if the rows are fewer. The plan is
    stored once, then the positions are computed without sorting all of it in one task.
    """
    if batches < 1:
        raise ValueError("at least one batch")
    stored = written(plan, "fetch-plan")
    total = stored.count()
    size = math.ceil(total / max(1, min(batches, total)))
    placed = with_position(stored, key, "__position")
    batch = F.floor((F.col("__position") - 1) / F.lit(max(1, size)))
    return placed.withColumn("batch_id", batch.cast("int")).drop("__position")


def load_failures(manifest: DataFrame, loaded: DataFrame, key: str = "input_file") -> DataFrame:
    """Inputs of the manifest from which no row was loaded."""
    return manifest.join(loaded.select(key).distinct(), key, "left_anti").select(manifest.columns)


def failure_summary(manifest: DataFrame, loaded: DataFrame, key: str = "input_file") -> DataFrame:
    """One row: number of inputs, number and percentage of those that failed."""
    known = loaded.select(key).distinct().withColumn("__loaded", F.lit(True))
    flagged = manifest.select(key).join(known, key, "left").agg(
        F.count("*").alias("n_inputs"), F.count_if(F.col("__loaded").isNull()).alias("n_failed")
    )
    percent = F.try_divide(F.col("n_failed") * F.lit(100e0), F.col("n_inputs"))
    return flagged.withColumn("failed_percent", percent)
