"""Geography of the city: its box, its grid, distances and directions.

Coordinates are float degrees. Differences are taken in float and widened
afterwards, as the results to match do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The box of the city, the grid over it, km per degree.
LON_WEST = -74.05
LON_EAST = -73.7
LAT_SOUTH = 40.5
LAT_NORTH = 41.0
DELTA_LON = 0.0014
DELTA_LAT = 0.00125
GRID_WIDTH = 250
GRID_HEIGHT = 400
DEGREE_KM = 110.25

# How near to a corner of a cell (in cells) a path may pass and still count as
# going through the corner.
CORNER = 0.05
# Added to the run of a way; without it some ways that meet a corner get another cell.
RUN_EXTRA = 1e-8


def in_city(lon: Column, lat: Column) -> Column:
    """Whether a point is in the box, edges included; null and NaN are not."""
    return lon.cast("double").between(LON_WEST, LON_EAST) & lat.cast("double").between(
        LAT_SOUTH, LAT_NORTH
    )


def grid_x(lon: Column) -> Column:
    west = F.lit(abs(LON_WEST))
    return F.floor((west - F.abs(lon).cast("double")) / F.lit(DELTA_LON)).cast("int")


def grid_y(lat: Column) -> Column:
    return F.floor((F.lit(LAT_NORTH) - lat.cast("double")) / F.lit(DELTA_LAT)).cast("int")


def grid_cell(lon: Column, lat: Column) -> Column:
    """The cell of a point, numbered row by row from the north-west corner."""
    return grid_x(lon) + grid_y(lat) * GRID_WIDTH


def cell_centre_lon(cell: Column) -> Column:
    x = cell % GRID_WIDTH
    centre = F.lit(abs(LON_WEST)) - x * F.lit(DELTA_LON) - F.lit(DELTA_LON / 2)
    return -centre.cast("float")


def cell_centre_lat(cell: Column) -> Column:
    y = F.floor(cell / GRID_WIDTH)
    return (F.lit(LAT_NORTH) - y * F.lit(DELTA_LAT) - F.lit(DELTA_LAT / 2)).cast("float")


def _angle(degrees: Column, compat: bool) -> Column:
    wide = degrees.cast("double")
    return wide if compat else F.radians(wide)


def distance_km(
    lon1: Column, lat1: Column, lon2: Column, lat2: Column, compat: bool = False
) -> Column:
    """Flat distance in km. ``compat`` takes degrees for radians, an old fault."""
    north = (lat1 - lat2).cast("double")
    east = (lon1 - lon2).cast("double") * F.cos(_angle(lat2, compat))
    return F.lit(DEGREE_KM) * F.sqrt(north * north + east * east)


def direction_degrees(
    lon1: Column, lat1: Column, lon2: Column, lat2: Column, compat: bool = False
) -> Column:
    """Direction of travel as whole degrees from -1 to 359.

    ``compat`` scales by the cosine of the start's longitude in degrees, an old
    fault; the default takes its latitude in radians.
    """
    north = (lat2 - lat1).cast("double")
    scale = _angle(lon1, True) if compat else _angle(lat1, False)
    east = (lon2 - lon1).cast("double") * F.cos(scale)
    return F.degrees(F.atan2(north, east)).cast("int") + 179


def route_cells(
    df: DataFrame,
    lon1: str,
    lat1: str,
    lon2: str,
    lat2: str,
    name: str = "cell",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """One row per grid cell on the straight way between two points in the city.

    Each row has the columns to ``keep`` (by default all of ``df``) and the cell.

    The way runs west to east from cell to cell. In each column it covers the
    rows between where the line enters and where it leaves, and it goes to the
    diagonal neighbour where it passes within ``CORNER`` of a corner. Points
    outside the city are left out, which bounds a way to 650 cells.
    """
    inside = df.where(
        in_city(F.col(lon1), F.col(lat1)) & in_city(F.col(lon2), F.col(lat2))
    )
    keep = df.columns if keep is None else list(keep)
    ends = inside.select(
        *keep,
        grid_x(F.col(lon1)).alias("x1__"),
        grid_y(F.col(lat1)).alias("y1__"),
        grid_x(F.col(lon2)).alias("x2__"),
        grid_y(F.col(lat2)).alias("y2__"),
    )
    forward = F.col("x1__") <= F.col("x2__")
    rise = F.when(forward, F.col("y2__") - F.col("y1__")).otherwise(
        F.col("y1__") - F.col("y2__")
    )
    line = ends.select(
        *keep,
        F.least("x1__", "x2__").alias("x__"),
        F.when(forward, F.col("y1__")).otherwise(F.col("y2__")).alias("y__"),
        F.abs(F.col("x2__") - F.col("x1__")).alias("run__"),
        F.abs(rise).alias("rise__"),
        F.when(rise < 0, -1).otherwise(1).alias("turn__"),
    )
    columns = line.withColumn("i__", F.explode(F.sequence(F.lit(0), F.col("run__"))))

    def height(i: Column) -> Column:
        # Height of the line at the right edge of column i, above the lower
        # edge of the first cell, in cells.
        slope = F.col("rise__") / (F.col("run__") + F.lit(RUN_EXTRA))
        return (i + F.lit(0.5)) * slope - F.lit(0.5)

    entered = F.when(
        F.col("i__") > 0,
        F.greatest(F.lit(0), F.ceil(height(F.col("i__") - 1) + F.lit(CORNER)).cast("int")),
    ).otherwise(0)
    left = F.when(
        F.col("i__") < F.col("run__"),
        F.floor(height(F.col("i__")) - F.lit(CORNER)).cast("int") + 1,
    ).otherwise(F.col("rise__"))
    spans = columns.select(
        *keep, "x__", "y__", "turn__", "i__",
        entered.alias("from__"), F.greatest(entered, left).alias("to__"),
    )
    steps = spans.withColumn("k__", F.explode(F.sequence("from__", "to__")))
    cell = F.col("x__") + F.col("i__") + (F.col("y__") + F.col("turn__") * F.col("k__")) * GRID_WIDTH
    return steps.select(*keep, cell.alias(name))
