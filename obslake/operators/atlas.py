"""The regional salinity anomaly, looked up in a gridded atlas.

An atlas table has one row per grid point and level: ``longitude`` and ``latitude`` in
degrees on a regular grid, ``pressure`` in dbar, and ``ratio``. The ratio at an observation
is interpolated linearly in all three directions. Grid points over land have no row; the
mean of the remaining corners stands in for them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.session import written

# The corners of a cell, in steps east and north of its south-west corner.
_CORNERS = ((0, 0), (1, 0), (0, 1), (1, 1))


@dataclass(frozen=True)
class Grid:
    """Step and origin of the grid, in degrees; the published atlas has these values."""

    step: float = 4.0
    longitude: float = 1.0
    latitude: float = -86.0

    def steps_east(self, longitude: Column) -> Column:
        return F.pmod(longitude - F.lit(self.longitude), F.lit(360.0)) / F.lit(self.step)

    def steps_north(self, latitude: Column) -> Column:
        return (latitude - F.lit(self.latitude)) / F.lit(self.step)

    @property
    def around(self) -> int:
        return round(360 / self.step)


def atlas_cells(atlas: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """One row per cell ``(i, j)``: the pressure levels with the ratio at the cell's four corners."""
    point = atlas.select(
        F.round(grid.steps_east(F.col("longitude"))).cast("int").alias("east"),
        F.round(grid.steps_north(F.col("latitude"))).cast("int").alias("north"),
        F.col("pressure").cast("double").alias("pressure"),
        F.col("ratio").cast("double").alias("ratio"),
    )
    corners = F.array(
        *[F.struct(F.lit(n).alias("n"), F.lit(e).alias("e"), F.lit(u).alias("u")) for n, (e, u) in enumerate(_CORNERS)]
    )
    spread = point.withColumn("c", F.explode(corners)).select(
        F.pmod(F.col("east") - F.col("c.e"), F.lit(grid.around)).alias("i"),
        (F.col("north") - F.col("c.u")).alias("j"),
        "pressure",
        "c.n",
        "ratio",
    )
    per_level = spread.groupBy("i", "j", "pressure").agg(
        F.avg("ratio").alias("mean"),
        *[F.max(F.when(F.col("n") == n, F.col("ratio"))).alias(f"r{n}") for n in range(len(_CORNERS))],
    )
    filled = [F.coalesce(f"r{n}", "mean").alias(f"r{n}") for n in range(len(_CORNERS))]
    level = F.struct("pressure", *filled)
    return per_level.groupBy("i", "j").agg(F.array_sort(F.collect_list(level)).alias("levels"))


def with_anomaly(df: DataFrame, atlas: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Add ``__anomaly``, the ratio at each row's place and pressure; null outside the atlas.

    The cells are broadcast if there are few enough, so that the observations are not
    shuffled; those of a larger atlas are joined on the cell.
    """
    cells = atlas_cells(atlas, grid).withColumnsRenamed({"i": "__i", "j": "__j", "levels": "__levels"})
    own = list(df.columns)
    placed = df.withColumns(
        {"__east": grid.steps_east(F.col("LONGITUDE")), "__north": grid.steps_north(F.col("LATITUDE"))}
    ).withColumns({"__i": F.floor("__east").cast("int"), "__j": F.floor("__north").cast("int")})
    joined = placed.join(written(cells, "atlas-cells"), ["__i", "__j"], "left")

    # The levels on both sides of the pressure; beyond either end the end level counts.
    top, bottom = F.get("__levels", F.lit(0))["pressure"], F.try_element_at("__levels", F.lit(-1))["pressure"]
    inside = joined.withColumn("__p", F.least(F.greatest(F.col("PRES").cast("double"), top), bottom))
    bracketed = inside.withColumns(
        {
            "__lo": F.try_element_at(F.filter("__levels", lambda lv: lv["pressure"] <= F.col("__p")), F.lit(-1)),
            "__hi": F.get(F.filter("__levels", lambda lv: lv["pressure"] >= F.col("__p")), F.lit(0)),
            "__u": F.col("__east") - F.col("__i"),
            "__v": F.col("__north") - F.col("__j"),
        }
    )

    def between(start: Column, end: Column, share: Column) -> Column:
        return start * (F.lit(1.0) - share) + end * share

    def on_level(level: str) -> Column:
        r = [F.col(level)[f"r{n}"] for n in range(len(_CORNERS))]
        south, north = between(r[0], r[1], F.col("__u")), between(r[2], r[3], F.col("__u"))
        return between(south, north, F.col("__v"))

    lo, hi = F.col("__lo")["pressure"], F.col("__hi")["pressure"]
    share = F.coalesce(F.try_divide(F.col("__p") - lo, hi - lo), F.lit(0.0))
    return bracketed.select(*own, between(on_level("__lo"), on_level("__hi"), share).alias("__anomaly"))
