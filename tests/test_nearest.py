import math
import random
from unittest import mock

import numpy as np
import pytest

from wayfare.operators import nearest as operator
from wayfare.operators.nearest import nearest
from wayfare.session import written

POINT, PLACE = "p bigint, lon double, lat double", "q bigint, lon double, lat double"


def km(a, b):
    """Flat distance in km; differences are floats, as in the library."""
    north = float(np.float32(a[1]) - np.float32(b[1]))
    east = float(np.float32(a[0]) - np.float32(b[0])) * math.cos(math.radians(float(np.float32(b[1]))))
    return 110.25 * math.sqrt(north * north + east * east)


def brute(points, places, k):
    finite = lambda row: row[1] is not None and row[2] is not None and math.isfinite(row[1] + row[2])
    rows = []
    for p in filter(finite, points):
        ranked = sorted((round(km(p[1:], q[1:]), 6), q[0]) for q in filter(finite, places))
        rows += [(p[0], q, distance, rank) for rank, (distance, q) in enumerate(ranked[:k], 1)]
    return sorted(rows)


def check(spark, points, places, k, **how):
    found = nearest(
        spark.createDataFrame(points, POINT), spark.createDataFrame(places, PLACE), k, "p", "q", **how
    )
    assert found.columns == ["p", "q", "distance", "rank"]
    got = sorted(tuple(row) for row in found.collect())
    want = brute(points, places, k)
    assert [(p, q, rank) for p, q, _, rank in got] == [(p, q, rank) for p, q, _, rank in want]
    assert [row[2] for row in got] == pytest.approx([row[2] for row in want], abs=2e-6)


def scattered(seed, count, west=-74.1, south=40.4, width=0.6, height=0.7):
    random.seed(seed)
    return [(n, west + random.random() * width, south + random.random() * height) for n in range(count)]


@pytest.mark.parametrize("k,few", [(1, 1), (5, 4), (7, 64)])
def test_against_brute_force(spark, k, few):
    check(spark, scattered(1, 60), scattered(2, 700), k, few=few)


def test_far_points_clusters_and_a_hot_spot(spark):
    cluster = [(n, -73.95 + (n % 20) * 1e-5, 40.75 + (n // 20) * 1e-5) for n in range(300)]
    hot = [(1000 + n, -73.9, 40.7) for n in range(400)]
    far = [(2000, -10.0, -60.0), (2001, 100.0, 89.0), (2002, -73.0, 40.0)]
    points = [*scattered(3, 10), (50, -73.9, 40.7), (51, 10.0, 0.0), (52, -73.95, 40.75), (53, -179.0, -89.0)]
    check(spark, points, cluster + hot + far, 4, few=8)


def test_nulls_repeats_and_few_places(spark):
    nan = float("nan")
    places = [(1, -73.9, 40.7), (1, -73.9, 40.7), (2, None, 40.7), (3, nan, 40.7), (4, -73.8, float("inf"))]
    points = [(7, -73.9, 40.7), (7, -73.9, 40.7), (8, nan, 40.0), (9, -73.0, None), (None, -70.0, 41.0)]
    found = nearest(
        spark.createDataFrame(points, POINT), spark.createDataFrame(places, PLACE), 3, "p", "q"
    ).collect()
    assert sorted((str(r.p), r.q, r["rank"]) for r in found) == sorted(
        [("7", 1, 1), ("7", 1, 2)] * 2 + [("None", 1, 1), ("None", 1, 2)]
    )


def test_empty_tables_and_refusal(spark):
    none, some = spark.createDataFrame([], PLACE), spark.createDataFrame([(1, -73.9, 40.7)], POINT)
    assert nearest(some, none, 2, "p", "q").collect() == []
    assert nearest(some.limit(0), some.withColumnRenamed("p", "q"), 2, "p", "q").collect() == []
    with pytest.raises(ValueError, match="1 or more"):
        nearest(some, none, 0, "p", "q")


def test_no_pair_of_all_points_and_places(spark, plan):
    points = spark.createDataFrame(scattered(4, 50), POINT)
    found = nearest(points, spark.createDataFrame(scattered(5, 900), PLACE), 2, "p", "q", few=4)
    text = plan(found, run=True)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_a_point_is_written_once_not_with_each_cell_and_level(spark):
    points, places = (spark.createDataFrame(scattered(n, 2000), schema) for n, schema in ((6, POINT), (7, PLACE)))
    made = []

    def kept(df, label):
        made.append(written(df, label))
        return made[-1]

    with mock.patch.object(operator, "written", kept):
        found = nearest(points, places, 3, "p", "q", few=16)
    with_points = [df for df in made if "lon__" in df.columns and "fx__" not in df.columns]
    assert sum(df.count() for df in with_points) == 2000
    assert found.count() == 6000


def test_leaves_of_all_sizes_and_points_outside(spark):
    dense = [(n, -73.95 + (n % 25) * 2e-4, 40.75 + (n // 25) * 2e-4) for n in range(500)]
    thin = [(9000 + n, lon, lat) for n, (_, lon, lat) in enumerate(scattered(8, 12, -75, 39, 3, 3))]
    points = scattered(9, 40, -75.5, 38.5, 4, 4) + [(100 + n, -73.9525 + n * 1e-3, 40.7495) for n in range(12)]
    for k, few in ((1, 2), (3, 40), (20, 6), (600, 8)):
        check(spark, points, dense + thin, k, few=few)
