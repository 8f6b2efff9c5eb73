"""The jobs: each reads a source, brings it to the lake's form and writes it.

Run one with ``python -m obslake.plans.jobs <job> …`` or under ``spark-submit``.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake import vocab
from obslake.operators import derived, inventory, profiles, quality, standardize
from obslake.operators.atlas import Grid
from obslake.operators.filters import Filters
from obslake.session import build_session, written
from obslake.sources import readers, writers

_STANDARDIZERS: dict[str, Callable[[DataFrame, str], DataFrame]] = {
    "ARGO": quality.best_value_table,
    "GLODAP": standardize.standardize_bottle,
    "CPR": standardize.standardize_plankton,
    "SprayGliders": derived.standardize_glider,
}


def to_lake(
    df: DataFrame, source: str, profile: str, add_derived: bool = False, atlas: DataFrame | None = None, grid: Grid = Grid()
) -> DataFrame:
    """A source's table in the lake's form, with derived variables if asked for.

    ``atlas`` is the regional salinity anomaly the derived variables take into account.
    """
    vocab.source(source)
    lake = _STANDARDIZERS[source](df, vocab.profile_type(profile))
    return derived.add_derived(lake, atlas, grid) if add_derived else lake


def read_source(spark: SparkSession, paths: str | Sequence[str], source: str) -> DataFrame:
    """One or many files of a source: delimited text for bottles and plankton, else Parquet."""
    many = [paths] if isinstance(paths, str) else list(paths)
    if not many:
        raise ValueError("no file to read")
    if source in ("GLODAP", "CPR"):
        return readers.read_csv(spark, many, source)
    if source == "SprayGliders":
        return glider_levels(spark.read.parquet(*many))
    return standardize.null_for_nan(spark.read.parquet(*many))


def glider_levels(df: DataFrame) -> DataFrame:
    """Glider tables may hold one row per dive with arrays over depth; those are spread."""
    arrays = profiles.array_columns(df)
    if not arrays:
        return df
    keep = [c for c in df.columns if c not in arrays]
    return profiles.flatten_profiles(df, arrays, keep).drop("N_LEVELS")


def convert(
    spark: SparkSession,
    data: DataFrame | str | Sequence[str],
    source: str,
    profile: str,
    out: str,
    add_derived: bool = False,
    atlas: DataFrame | None = None,
    grid: Grid = Grid(),
    **write_options: object,
) -> None:
    """Any source to a table of the lake."""
    df = data if isinstance(data, DataFrame) else read_source(spark, data, source)
    writers.write_table(to_lake(df, source, profile, add_derived, atlas, grid), out, **write_options)


def argo_best_values(spark: SparkSession, raw: str, profile: str, out: str, filters: Filters | None = None, **options: object) -> None:
    """Raw profiles to best values with derived variables.

    Row by row from scan to file, so by default nothing is shuffled.
    """
    df = standardize.null_for_nan(readers.read_parquet(spark, raw, filters=filters))
    convert(spark, df, "ARGO", profile, out, add_derived=True, **{"layout": "scan", **options})


def bottles(
    spark: SparkSession,
    path: str | Sequence[str],
    out_phy: str,
    out_bgc: str,
    atlas: DataFrame | None = None,
    grid: Grid = Grid(),
    **write_options: object,
) -> None:
    """Bottle data to both profile types. The text is parsed once; both are made from this run's rows."""
    table = to_lake(read_source(spark, path, "GLODAP"), "GLODAP", "BGC", True, atlas, grid)
    rows = written(table, "bottles")
    writers.write_table(rows, out_bgc, **write_options)
    wanted = set(vocab.lake_columns("PHY")) | set(vocab.DERIVED_COLUMNS)
    writers.write_table(rows.select(*[c for c in rows.columns if c in wanted]), out_phy, **write_options)


def gliders(spark: SparkSession, paths: str | Sequence[str], out: str, **options: object) -> None:
    """Glider data to PHY with derived variables."""
    convert(spark, paths, "SprayGliders", "PHY", out, add_derived=True, **options)


def plankton(spark: SparkSession, path: str, out_phy: str, out_bgc: str, **write_options: object) -> None:
    """Plankton samples to both profile types; they have no measurement to derive from."""
    for profile, out in (("PHY", out_phy), ("BGC", out_bgc)):
        convert(spark, path, "CPR", profile, out, **write_options)


def raw_profiles(
    spark: SparkSession,
    source: DataFrame,
    profile: str,
    out: str,
    rejects: str,
    file: str | None = None,
    overwrite: bool = True,
    **write_options: object,
) -> None:
    """Profiles with arrays to the raw table; unsound ones go to a table of rejects with the reason.

    By default rows are written as the scan gives them, without a shuffle.
    """
    bgc = vocab.profile_type(profile) == "BGC"
    has = set(source.columns)
    marked = profiles.mark_rejects(
        source,
        calibrations="CALIBRATION_PARAMETERS" if "CALIBRATION_PARAMETERS" in has else None,
        modes="PARAMETER_DATA_MODE" if bgc and "PARAMETER_DATA_MODE" in has else None,
        schema=vocab.raw_schema(profile),
    )
    sound, unsound = profiles.split_rejects(marked, file)
    options = {"layout": "scan", **write_options, "overwrite": overwrite}
    writers.write_table(profiles.raw_table(sound, profile), out, **options)
    scalars = [c for c in unsound.columns if c not in profiles.array_columns(unsound)]
    writers.write_table(unsound.select(*scalars), rejects, layout="scan", sidecar=False, overwrite=overwrite)


def raw_files(
    spark: SparkSession, path: str, profile: str, out: str, rejects: str, overwrite: bool = True, deep: bool = False, **write_options: object
) -> None:
    """Files of profiles with arrays to the raw table; a file that cannot be read does not stop the others.

    Unsound profiles go to ``rejects``, files that cannot be read to ``rejects``_files, each with the reason.
    """
    arrays, unreadable = readers.read_parquet_with_rejects(spark, path, deep=deep)
    raw_profiles(spark, arrays, profile, out, rejects, "input_file", overwrite, **write_options)
    writers.write_table(unreadable, f"{rejects.rstrip('/')}_files", layout="scan", sidecar=False, overwrite=overwrite)


def plan_and_ingest(
    spark: SparkSession,
    index_path: str,
    arrays_path: str,
    dataset: str,
    root: str,
    local_copies: DataFrame | None = None,
    url_root: str = "",
    save_to: str = "",
    overwrite: bool = True,
    check_time: bool = True,
    **subset: object,
) -> DataFrame:
    """Index to plan to raw table: returns the plan of files still to fetch.

    The wanted part of the index is kept beside the data. Profiles that are there already
    are ingested if their file belongs to a wanted platform; files that cannot be read are listed among the
    rejects. Without ``overwrite`` all tables, raw, rejects and metadata, are added to.
    """
    index = inventory.subset_index(inventory.enrich_index(readers.read_index(spark, index_path)), dataset, **subset)
    kept = written(index, "index")
    writers.write_index_metadata(kept, root, dataset, overwrite)
    wanted = kept.select(F.col("wmoid").cast("bigint").alias("PLATFORM_NUMBER")).distinct()
    arrays, unreadable = readers.read_parquet_with_rejects(spark, arrays_path)
    arrays = arrays.join(wanted, "PLATFORM_NUMBER", "left_semi")
    profile = vocab.profile_type(dataset)
    raw_profiles(spark, arrays, profile, f"{root}/{profile}", f"{root}/rejects/{profile}", "input_file", overwrite)
    writers.write_table(unreadable, f"{root}/rejects/{profile}_files", layout="scan", sidecar=False, overwrite=overwrite)
    return inventory.fetch_plan(
        kept, local_copies, dataset=dataset, url_root=url_root, save_to=save_to, check_time=check_time
    )


def _cli() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="obslake", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    argo = jobs.add_parser("argo-best-values")
    argo.add_argument("--input", required=True)
    argo.add_argument("--profile", choices=vocab.PROFILE_TYPES, required=True)
    argo.add_argument("--output", required=True)
    for name in ("bottles", "plankton"):
        job = jobs.add_parser(name)
        job.add_argument("--input", required=True)
        job.add_argument("--phy", required=True)
        job.add_argument("--bgc", required=True)
        job.add_argument("--basename", default=None)
    glider = jobs.add_parser("gliders")
    glider.add_argument("--input", required=True, nargs="+")
    glider.add_argument("--output", required=True)
    raw = jobs.add_parser("raw-profiles")
    raw.add_argument("--index", required=True, action="append", help="PATH for all datasets, or DATASET=PATH, as often as needed")
    raw.add_argument("--input", required=True)
    raw.add_argument("--dataset", choices=sorted(inventory.PLATFORM_FILE_ENDING), action="append")
    raw.add_argument("--output", required=True)
    raw.add_argument("--plan", help="where to write the plan of files to fetch")
    raw.add_argument("--local-copies", help="Parquet table of local_path or wmoid, and mtime, of files already fetched")
    raw.add_argument("--save-to", default="", help="folder of the local copies")
    raw.add_argument("--url-root", default="")
    raw.add_argument("--no-check-time", action="store_true", help="plan to fetch every file, also those up to date")
    for job in (argo, glider, jobs.choices["bottles"]):
        job.add_argument("--atlas", help="Parquet table of longitude, latitude, pressure and ratio: the salinity anomaly")
        job.add_argument("--atlas-step", type=float, default=Grid().step, help="degrees between the atlas's places")
    for job in (argo, glider, jobs.choices["bottles"], jobs.choices["plankton"]):
        job.add_argument("--cluster-by", nargs="+", default=[], help="columns, as JULD LATITUDE, whose ranges files and row groups shall keep apart")
    for job in jobs.choices.values():
        job.add_argument("--append", action="store_true", help="add to tables that are there")
    return parser


def _folder(root: str, source: str, profile: str, base: str | None) -> str:
    return f"{root.rstrip('/')}/{writers.table_name(source, profile, base)}"


def _index_of(given: Sequence[str], dataset: str) -> str:
    """The index named for a dataset, else the one that is for all."""
    named = {d: path for d, _, path in (g.partition("=") for g in given) if d in inventory.PLATFORM_FILE_ENDING and path}
    common = [g for g in given if g.partition("=")[0] not in inventory.PLATFORM_FILE_ENDING]
    if dataset not in named and len(common) != 1:
        raise ValueError(f"no index, or more than one, for {dataset} in {list(given)}")
    return named.get(dataset) or common[0]


def main(argv: Sequence[str] | None = None) -> None:
    args = _cli().parse_args(argv)
    spark = build_session(f"obslake {args.job}")
    overwrite = not args.append
    options: dict[str, object] = {"overwrite": overwrite}
    if getattr(args, "cluster_by", None):
        options |= {"layout": "rebalance", "cluster_by": args.cluster_by}
    if getattr(args, "atlas", None):
        options |= {"atlas": spark.read.parquet(args.atlas), "grid": Grid(step=args.atlas_step)}
    if args.job == "argo-best-values":
        argo_best_values(spark, args.input, args.profile, args.output, **options)
    elif args.job == "gliders":
        gliders(spark, args.input, args.output, **options)
    elif args.job in ("bottles", "plankton"):
        source, job = {"bottles": ("GLODAP", bottles), "plankton": ("CPR", plankton)}[args.job]
        outs = [_folder(root, source, p, args.basename) for root, p in ((args.phy, "PHY"), (args.bgc, "BGC"))]
        job(spark, args.input, *outs, **options)
    else:
        copies = spark.read.parquet(args.local_copies) if args.local_copies else None
        for dataset in args.dataset or sorted(inventory.PLATFORM_FILE_ENDING):
            plan = plan_and_ingest(
                spark, _index_of(args.index, dataset), args.input, dataset, args.output, copies, args.url_root,
                args.save_to, overwrite, not args.no_check_time,
            )
            if args.plan:
                plan.write.mode("overwrite").parquet(f"{args.plan}/{dataset}")


if __name__ == "__main__":
    main()
