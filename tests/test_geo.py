import math
import random

import pytest
from pyspark.sql import functions as F

from wayfare.functions import geo
from wayfare.plans import rides as plans

POINTS = "start_lon float, start_lat float, end_lon float, end_lat float"


def test_box_edges_nan_and_null(spark):
    # As floats, -74.05 and -73.7 lie just outside; 40.5 and 41.0 are exact.
    data = [(-73.9, 40.7), (-74.0499, 40.5), (-73.701, 41.0), (-74.05, 40.7), (-73.7, 40.7), (-73.69, 40.7),
            (-73.9, 41.001), (float("nan"), 40.7), (None, 40.7), (-73.9, float("nan"))]
    df = spark.createDataFrame(data, "lon float, lat float")
    found = [r[0] for r in df.select(geo.in_city(F.col("lon"), F.col("lat"))).collect()]
    assert [bool(x) for x in found] == [True] * 3 + [False] * 7


def test_both_ends_must_be_in_the_city(spark):
    inside, outside = (-73.9, 40.7), (-75.0, 40.7)
    df = spark.createDataFrame([(*inside, *inside), (*inside, *outside), (*outside, *inside)], POINTS)
    assert plans.rides_in_city(df).count() == 1


def test_cells_and_their_centres(spark):
    df = spark.createDataFrame([(-74.0493, 40.9994), (-73.9, 40.7)], "lon float, lat float")
    cells = df.select(geo.grid_cell(F.col("lon"), F.col("lat")).alias("cell"))
    assert [r[0] for r in cells.collect()] == [0, 107 + 239 * 250]
    centres = cells.select(
        geo.cell_centre_lon(F.col("cell")).alias("lon"), geo.cell_centre_lat(F.col("cell")).alias("lat")
    )
    back = centres.select(geo.grid_cell(F.col("lon"), F.col("lat")))
    assert [r[0] for r in back.collect()] == [0, 107 + 239 * 250]


def ways(spark, ends):
    lon = lambda x: -(74.05 - (x + 0.5) * geo.DELTA_LON)
    lat = lambda y: 41.0 - (y + 0.5) * geo.DELTA_LAT
    df = spark.createDataFrame(
        [(i, lon(a), lat(b), lon(c), lat(d)) for i, (a, b, c, d) in enumerate(ends)],
        f"id int, {POINTS}",
    )
    found = {}
    for row in geo.route_cells(df, "start_lon", "start_lat", "end_lon", "end_lat").collect():
        cell = row["cell"]
        found.setdefault(row["id"], []).append((cell % geo.GRID_WIDTH, cell // geo.GRID_WIDTH))
    return [found[i] for i in range(len(ends))]


def test_geometry_of_ways(spark):
    chance = random.Random(3)
    ends = [(0, 0, 0, 0), (0, 0, 5, 5), (0, 5, 5, 0), (3, 0, 3, 9), (3, 9, 3, 0), (0, 4, 9, 4), (9, 9, 0, 0)]
    ends += [tuple(chance.randrange(n) for n in (250, 400, 250, 400)) for _ in range(300)]
    there, back = ways(spark, ends), ways(spark, [(c, d, a, b) for a, b, c, d in ends])
    for (x1, y1, x2, y2), cells, other in zip(ends, there, back):
        assert len(set(cells)) == len(cells) and set(cells) == set(other)
        assert {(x1, y1), (x2, y2)} <= set(cells)
        assert all(min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2) for x, y in cells)
        # From west to east, each cell touches the one before.
        turn = 1 if (y2 - y1) * (x2 - x1) >= 0 else -1
        steps = sorted(cells, key=lambda cell: (cell[0], turn * cell[1]))
        assert all(0 <= c - a <= 1 and abs(d - b) <= 1 for (a, b), (c, d) in zip(steps, steps[1:]))
        # No cell's middle is further from the line than a cell's diagonal.
        length = math.hypot(x2 - x1, y2 - y1)
        for x, y in cells:
            off = abs((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)) / length if length else 0
            assert off <= math.sqrt(2)


def test_ways_outside_the_city_are_left_out(spark):
    df = spark.createDataFrame([(-75.0, 40.7, -73.9, 40.7), (float("nan"), 40.7, -73.9, 40.7)], POINTS)
    assert geo.route_cells(df, "start_lon", "start_lat", "end_lon", "end_lat").count() == 0


def test_distance_and_its_old_fault(spark):
    df = spark.createDataFrame([(-74.0, 40.5, -73.75, 40.75)], POINTS)
    args = [F.col(c) for c in ("start_lon", "start_lat", "end_lon", "end_lat")]
    right, old = df.select(geo.distance_km(*args), geo.distance_km(*args, compat=True)).first()
    assert right == pytest.approx(110.25 * math.hypot(0.25, 0.25 * math.cos(math.radians(40.75))))
    assert old == pytest.approx(110.25 * math.hypot(0.25, 0.25 * math.cos(40.75)))


@pytest.mark.parametrize(
    ("east", "north", "degrees"), [(0.1, 0.0, 179), (0.0, 0.1, 269), (0.0, -0.1, 89), (-0.1, 0.0, 359)]
)
def test_direction(spark, east, north, degrees):
    df = spark.createDataFrame([(-73.9, 40.5, -73.9 + east, 40.5 + north)], POINTS)
    args = [F.col(c) for c in ("start_lon", "start_lat", "end_lon", "end_lat")]
    assert df.select(geo.direction_degrees(*args)).first()[0] == degrees


def test_distance_to_a_point_uses_the_place_of_the_event(spark):
    df = spark.createDataFrame(
        [(True, -73.9, 40.5, -73.8, 40.75), (False, -73.9, 40.5, -73.8, 40.75)], f"is_start boolean, {POINTS}"
    )
    found = [r["distance"] for r in plans.distance_to_point(df, -73.9, 40.5).collect()]
    assert found[0] == 0 and found[1] > 20
