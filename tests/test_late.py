"""Late rows as rows."""

from datetime import datetime, timedelta

import pytest

from wayfare.session import settings
from wayfare.sinks.late import LateSplit

SCHEMA = "id bigint, event_time timestamp"
T0 = datetime(2020, 1, 1)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    with settings(spark, {"spark.sql.shuffle.partitions": "2"}):
        yield


def batch(spark, *rows):
    return spark.createDataFrame([(k, at and T0 + timedelta(seconds=at)) for k, at in rows], SCHEMA)


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("replayed", [False, True])
def test_each_batch_meets_the_watermark_of_those_before(spark, folder, replayed):
    split = LateSplit(folder, SCHEMA, delay="10 seconds")
    batches = [
        [(1, 100), (2, 5)],
        [(3, 90), (4, 91), (5, None), (6, 200)],
        [],
        [(7, 190), (8, 191)],
        [(9, 190), (10, 191)],
        [(11, 500), (12, 180)],
        [(13, 490), (14, 489.999)],
    ]
    for n, rows in enumerate(batches):
        for _ in range(1 + replayed):
            split = LateSplit(folder, SCHEMA, delay="10 seconds")
            split.write(batch(spark, *rows), n)
    assert ids(split.late(spark)) == [3, 7, 9, 12, 13, 14]
    assert ids(split.on_time(spark)) == [1, 2, 4, 5, 6, 8, 10, 11]


def test_rows_of_an_open_window_are_in_time(spark, folder):
    split = LateSplit(folder, SCHEMA, size="1 minute")
    split.write(batch(spark, (1, 130)), 0)
    split.write(batch(spark, (2, 121), (3, 119.9)), 1)
    assert (ids(split.late(spark)), ids(split.on_time(spark))) == ([3], [1, 2])


def test_empty(spark, folder):
    split = LateSplit(folder, SCHEMA)
    split.write(batch(spark), 0)
    split.write(batch(spark, (1, 5)), 1)
    assert (ids(split.late(spark)), ids(split.on_time(spark))) == ([], [1])
