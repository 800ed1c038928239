from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wayfare.operators.joins import rollup_by_dimension
from wayfare.plans import marts
from wayfare.schemas import TRIP, ZONE, conform
from wayfare.sources.tables import rows, view

# Zones per borough and service zone of the city's zone file.
ZONE_FILE = {
    ("Bronx", "BORO"): 43,
    ("Brooklyn", "BORO"): 60,
    ("Brooklyn", "Boro"): 1,
    ("EWR", "EWR"): 1,
    ("Manhattan", "YELLOW"): 53,
    ("Manhattan", "BORO"): 14,
    ("Manhattan", "yeLLow"): 2,
    ("Queens", "BORO"): 66,
    ("Queens", "AIRPORTS"): 2,
    ("Queens", "bOrO"): 1,
    ("Staten Island", "BORO"): 20,
    ("Unknown", "N/A"): 2,
}


def trip(pickup="2018-01-25 10:00:00", origin=1, distance=1.0, destination=2):
    return (datetime.fromisoformat(pickup), origin, distance, destination)


TRIPS = "tpep_pickup_datetime timestamp, PULocationID int, trip_distance double, DOLocationID int"
ZONES = [(1, "Queens", "A", "BORO"), (2, "Bronx", "B", "BORO"), (3, "Queens", "C", "BORO")]


@pytest.fixture
def zones(spark):
    return rows(spark, ZONES, ZONE)


def test_zone_counts_of_the_zone_file(spark):
    expanded = [
        (n, borough, f"zone {n}", service)
        for n, (borough, service) in enumerate(
            key for key, count in ZONE_FILE.items() for _ in range(count)
        )
    ]
    assert len(expanded) == 265
    counts = marts.zones_per_borough(rows(spark, expanded, ZONE))
    assert {r["Borough"]: r["count"] for r in counts.collect()} == {
        "Bronx": 43, "Brooklyn": 60, "EWR": 1, "Manhattan": 67,
        "Queens": 68, "Staten Island": 20, "Unknown": 2,
    }


def test_popularity_drops_unknown_zones_and_breaks_ties(spark, zones):
    trips = rows(spark, [trip(origin=o) for o in (1, 3, 2, 2, 99, None)], TRIPS)
    found = marts.borough_popularity(trips, zones).collect()
    assert [tuple(r) for r in found] == [("Bronx", 2), ("Queens", 2)]


def test_distances(spark, zones):
    trips = rows(
        spark,
        [trip(origin=1, distance=d) for d in (0.005, 2.0, None)]
        + [trip(origin=2, distance=None), trip(origin=99, distance=7.0)],
        TRIPS,
    )
    inner = marts.distance_by_borough(trips, zones)
    assert [tuple(r) for r in inner.collect()] == [
        ("Queens", 3, 0.005, 1.0, 2.0), ("Bronx", 1, None, None, None),
    ]
    left = marts.distance_by_borough(
        trips, zones, how="left"
    ).collect()
    assert {r["Borough"]: r["total_trips"] for r in left} == {"Queens": 3, "Bronx": 1, None: 1}


def test_repeated_zone_ids_multiply_as_in_a_plain_join(spark):
    trips = rows(spark, [trip(origin=1)] * 3, TRIPS)
    twice = rows(spark, [ZONES[0], (1, "Bronx", "B", "BORO")], ZONE)
    found = rollup_by_dimension(
        trips, twice, "PULocationID", "LocationID", "Borough"
    )
    assert {r["Borough"]: r["n"] for r in found.collect()} == {"Queens": 3, "Bronx": 3}


def test_sql_form_equals_the_left_join(spark, zones):
    trips = rows(spark, [trip(origin=o, distance=float(o)) for o in (1, 1, 2, 99)], TRIPS)
    by_sql = marts.distance_by_borough_sql(spark, view(trips, "f_sql"), view(zones, "z_sql"))
    by_frame = marts.distance_by_borough(trips, zones, how="left")
    assert sorted(map(str, by_sql.select(by_frame.columns).collect())) == sorted(
        map(str, by_frame.collect())
    )


def test_known_destination_drops_zero_and_null(spark):
    trips = rows(spark, [trip(destination=d) for d in (0, 1, None)], TRIPS)
    assert marts.with_known_destination(trips).count() == 1


def test_hours(spark):
    pickups = ["2018-01-25 23:59:59", "2018-01-25 00:00:00", "2018-01-26 00:30:00",
               "2018-01-25 07:00:00"]
    trips = rows(spark, [trip(p) for p in pickups], TRIPS)
    hours = marts.trips_per_hour(trips)
    assert [tuple(r) for r in hours.collect()] == [("00", 2), ("07", 1), ("23", 1)]
    assert [r[0] for r in marts.hour_lines(hours).collect()] == ["00 2", "07 1", "23 1"]
    as_text = trips.withColumn(
        "tpep_pickup_datetime", F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss")
    )
    assert marts.trips_per_hour(as_text).collect() == hours.collect()


@pytest.mark.parametrize(
    ("values", "want"),
    [
        ([1.0, 2.0, 3.0], (3, 2.0, 1.0, 1.0, 3.0)),
        ([5.0], (1, 5.0, None, 5.0, 5.0)),
        ([None, None], (2, None, None, None, None)),
        ([-1.0, 1.0, None], (3, 0.0, pytest.approx(1.4142135623), -1.0, 1.0)),
    ],
)
def test_distribution(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "distance double")
    assert tuple(marts.distribution(df).first()) == want


def test_typed_view_widens_but_never_narrows(spark):
    df = spark.range(2).selectExpr("CAST(id AS INT) AS account_id", "CAST(1 AS INT) AS amount",
                                   "CURRENT_TIMESTAMP() AS log_ts")
    typed = conform(df, "account_id bigint, log_ts timestamp, amount bigint")
    assert typed.dtypes == [("account_id", "bigint"), ("log_ts", "timestamp"), ("amount", "bigint")]
    with pytest.raises(Exception, match="amount"):
        conform(df.withColumn("amount", F.lit(1.5)), "account_id bigint, amount int")
    with pytest.raises(Exception, match="VendorID"):
        conform(df, TRIP)
