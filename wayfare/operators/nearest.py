"""The nearest places of many points, by a tree of cells.

Places are counted in cells, each cut four by four, down to cells with few places.
A point first goes down to one leaf near it and measures the places there: the ``k``-th
distance bounds that of the answer. Then it goes down again to all leaves within that
bound, mostly its own and one or two beside it, so a point meets the places of a few
small cells only, and none is missed. Places of a leaf lie in an array, so that their
distances are made and cut down to ``k`` where the leaf meets the point.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.geo import DEGREE_KM, distance_km
from wayfare.session import written

#: So many cells are broadcast: with what is inside them, and without.
FEW_FULL, FEW_BARE = 4_096, 100_000
DEEPEST = 14
SPOT = ["lon__", "lat__"]
CELL = ["level__", "x__", "y__"]


def _located(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """Rows with finite coordinates, which are ``lon__`` and ``lat__`` as floats."""
    located = df.withColumns({"lon__": F.col(lon).cast("float"), "lat__": F.col(lat).cast("float")})
    # NaN is above infinity.
    return located.where((F.abs("lon__") < math.inf) & (F.abs("lat__") < math.inf))


def _off(at: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """Least and greatest difference between a number and those of a range."""
    return F.greatest(low - at, at - high, F.lit(0.0)), F.greatest(high - at, at - low)


def _bounds(west: Column, south: Column, side: Column) -> tuple[Column, Column]:
    """Least and greatest distance from a spot to a square's places, in km."""
    lon, lat = (F.col(name).cast("double") for name in SPOT)
    east_near, east_far = _off(lon, west, west + side)
    north_near, north_far = _off(lat, south, south + side)
    # Distances east shrink by the cosine of the place's latitude.
    level, steepest = _off(F.lit(0.0), south, south + side)
    narrow = F.greatest(F.lit(0.0), F.cos(F.radians(F.least(F.lit(90.0), steepest))))
    wide = F.cos(F.radians(F.least(F.lit(90.0), level)))
    return DEGREE_KM * F.hypot(north_near, east_near * narrow), DEGREE_KM * F.hypot(north_far, east_far * wide)


def _cut_cells(found: DataFrame, depth: int, few: int) -> tuple[int, list[tuple[DataFrame, int]]]:
    """How many places there are, and by level the cells that are cut, and their number.

    A cell that is cut comes with the cells inside it that have places, ``kids__``.
    """
    counts = found.groupBy(F.col("fx__").alias("x__"), F.col("fy__").alias("y__")).agg(
        F.count(F.lit(1)).alias("n__")
    )
    counts, cut = written(counts, "cells"), []
    up = [F.shiftright(name, 2).alias(f"p{name}") for name in ("x__", "y__")]
    for level in range(depth - 1, -1, -1):
        inside = counts.select("*", *up)
        parents = inside.groupBy("px__", "py__").agg(F.sum("n__").alias("n__"))
        parents = written(parents, "cells")
        large = parents.where(F.col("n__") > few).select("px__", "py__")
        if (count := large.count()) > 0:
            large = F.broadcast(large) if count <= FEW_BARE else large
            kid = F.struct(F.col("x__").alias("x"), F.col("y__").alias("y"), F.col("n__").alias("n"))
            cells = inside.join(large, ["px__", "py__"]).groupBy("px__", "py__").agg(F.collect_list(kid).alias("kids__"))
            cells = cells.select(
                F.lit(level).alias("level__"), F.col("px__").alias("x__"), F.col("py__").alias("y__"), "kids__"
            )
            cut.insert(0, (written(cells, "cut"), count))
        counts = parents.select(F.col("px__").alias("x__"), F.col("py__").alias("y__"), "n__")
    return sum(row["n__"] for row in counts.collect()), cut


def nearest(
    points: DataFrame,
    places: DataFrame,
    k: int,
    point: str,
    place: str,
    lon: str = "lon",
    lat: str = "lat",
    finest: float = 1e-4,
    few: int = 64,
) -> DataFrame:
    """The ``k`` nearest places of each point: ``point, place, distance, rank``.

    ``point`` and ``place`` name the keys, ``lon`` and ``lat`` the coordinates on both
    sides, taken as float degrees. Distances are those of ``distance_km`` in km, to
    six decimals; places as far are ranked by key. With fewer than ``k`` places a
    point has them all. Rows without finite coordinates are left out. A repeated
    point has its rows again, a repeated place counts again.

    Cells with more than ``few`` places are cut until they are ``finest`` degrees wide.
    Of places at one spot the ``k`` of least key are enough, and points at one spot go
    down once, so neither makes a large cell. Places, counts of cells, leaves and bounds
    are written; cells that are cut are broadcast where they are few.
    """
    if k < 1:
        raise ValueError("k must be 1 or more")
    asked = _located(points, lon, lat).select(F.col(point), *SPOT)
    found = _located(places, lon, lat).select(F.col(place), *SPOT)
    west, east, south, north = found.agg(
        F.min("lon__"), F.max("lon__"), F.min("lat__"), F.max("lat__")
    ).first()
    if west is None:
        west = east = south = north = 0.0
    span = max(east - west, north - south, finest) * (1 + 1e-9)
    depth = min(DEEPEST, max(1, math.ceil(math.log(span / finest, 4))))
    last = 4**depth - 1

    def cell(axis: str, low: float) -> Column:
        steps = F.floor((F.col(axis).cast("double") - low) / (span / 4**depth))
        return F.greatest(F.lit(0), F.least(F.lit(last), steps)).cast("bigint")

    def bounds(level: int, x: Column, y: Column) -> tuple[Column, Column]:
        side = F.lit(span / 4**level)
        return _bounds(west + x * side, south + y * side, side)

    first = Window.partitionBy(*SPOT).orderBy(place)
    found = found.withColumn("at__", F.row_number().over(first)).where(F.col("at__") <= k).drop("at__")
    found = written(found.withColumns({"fx__": cell("lon__", west), "fy__": cell("lat__", south)}), "places")
    total, cut = _cut_cells(found, depth, few)

    # Places by their leaves.
    # From the one cell of level 0; its place is worked out, as a join on fixed values is none.
    root = [F.shiftright(cell(*axis), 2 * depth) for axis in (("lon__", west), ("lat__", south))]
    top = [F.lit(0).alias("level__"), root[0].alias("x__"), root[1].alias("y__")]
    held = found.select("*", *top)
    for level, (cells, count) in enumerate(cut):
        bare = cells.select(*CELL, F.lit(True).alias("cut__"))
        held = held.join(F.broadcast(bare) if count <= FEW_BARE else bare, CELL, "left")
        up = 2 * (depth - level - 1)
        below = {"level__": F.lit(level + 1), "x__": F.shiftright("fx__", up), "y__": F.shiftright("fy__", up)}
        held = held.withColumns(
            {name: F.when(F.col("cut__"), value).otherwise(F.col(name)) for name, value in below.items()}
        ).drop("cut__")
    spot = F.struct(F.col("lon__").alias("lon"), F.col("lat__").alias("lat"), F.col(place).alias("place"))
    leaves = held.select(*CELL, spot.alias("spot__")).repartition(*CELL)
    leaves = written(leaves.groupBy(*CELL).agg(F.collect_list("spot__").alias("spots__")), "leaves")

    def length(to: Column) -> Column:
        return F.round(distance_km(F.col("lon__"), F.col("lat__"), to["lon"], to["lat"]), 6)

    def opened(rows: DataFrame, level: int) -> DataFrame:
        cells, count = cut[level]
        return rows.join(F.broadcast(cells) if count <= FEW_FULL else cells, CELL, "left")

    # Down to the nearest of the cells inside, to one leaf.
    _, most = bounds(0, F.lit(0), F.lit(0))
    most = most if total >= k else F.lit(math.inf)
    down = asked.select(*SPOT).distinct().select(*SPOT, most.alias("most__"), *top)
    for level in range(len(cut)):

        def seen(kid: Column) -> Column:
            near, far = bounds(level + 1, kid["x"], kid["y"])
            return F.struct(near.alias("near"), far.alias("far"), kid["x"].alias("x"), kid["y"].alias("y"), kid["n"].alias("n"))

        down = opened(down, level).withColumn("kid__", F.array_min(F.transform("kids__", seen)))
        down = down.select(
            *SPOT,
            F.least("most__", F.when(F.col("kid__.n") >= k, F.col("kid__.far"))).alias("most__"),
            F.when(F.col("kid__").isNotNull(), level + 1).otherwise(F.col("level__")).alias("level__"),
            *[F.coalesce(f"kid__.{axis}", f"{axis}__").alias(f"{axis}__") for axis in ("x", "y")],
        )
    kth = F.get(F.sort_array(F.transform("spots__", length)), k - 1)
    bounded = down.join(leaves, CELL, "left").select(*SPOT, F.least("most__", kth).alias("most__"))
    reached = written(bounded, "bounds").select("*", *top)

    # Down to all leaves within the bound. A little more than it: distances are rounded,
    # differences are floats.
    for level in range(len(cut)):

        def within(kid: Column) -> Column:
            near, _ = bounds(level + 1, kid["x"], kid["y"])
            return near <= F.col("most__") * (1 + 1e-6) + 1e-5

        def inner(kid: Column) -> Column:
            return F.struct(F.lit(level + 1).alias("level__"), kid["x"].alias("x__"), kid["y"].alias("y__"))

        inside = F.transform(F.filter("kids__", within), inner)
        cells = F.when(F.col("kids__").isNull(), F.array(F.struct(*CELL))).otherwise(inside)
        reached = opened(reached, level).select(*SPOT, "most__", F.inline_outer(cells)).where("x__ IS NOT NULL")

    near_spots = F.sort_array(
        F.transform("spots__", lambda to: F.struct(length(to).alias("distance"), to["place"].alias(place)))
    )
    met = reached.join(leaves, CELL).select(*SPOT, F.slice(near_spots, 1, k).alias("near__"))
    met = met.select(*SPOT, F.inline_outer("near__"))
    order = Window.partitionBy(*SPOT).orderBy("distance", place)
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return asked.join(ranked, SPOT).select(point, place, "distance", "rank")
