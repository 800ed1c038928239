"""What reaches the scan, and what a cache serves."""

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from wayfare.functions.codec import decode_transactions
from wayfare.functions.text import register_strlen
from wayfare.plans import clicks, marts, rides, selection
from wayfare.schemas import RIDE, ZONE
from wayfare.sinks import files as sink
from wayfare.sources import files
from wayfare.sources.tables import rows, view


@pytest.fixture
def trips(spark, folder):
    df = spark.range(1000).selectExpr(
        "CAST(id % 5 AS INT) AS PULocationID", "CAST(id % 7 AS INT) AS DOLocationID",
        "CAST(id AS DOUBLE) AS trip_distance", "CAST(id % 2 AS INT) AS VendorID",
        "CAST(id % 20 AS DOUBLE) AS total_amount", "md5(CAST(id AS STRING)) AS unused",
    )
    sink.parquet(df, f"{folder}/trips")
    return files.parquet(spark, f"{folder}/trips")


def test_filter_and_columns_reach_the_scan(spark, trips, plan):
    zones = rows(spark, [(1, "Queens", "A", "BORO")], ZONE)
    text = plan(marts.distance_by_borough(marts.with_known_destination(trips), zones))
    assert "Not(EqualTo(DOLocationID,0))" in text
    assert "ReadSchema: struct<PULocationID:int,DOLocationID:int,trip_distance:double>" in text


def test_order_of_filter_and_projection_does_not_matter(trips, plan):
    first = trips.where(F.col("total_amount") > 10).select("VendorID", "total_amount")
    second = selection.amounts_over(trips)
    assert sorted(first.collect()) == sorted(second.collect())
    for df in (first, second):
        assert "GreaterThan(total_amount,10.0)" in plan(df)
        assert "ReadSchema: struct<VendorID:int,total_amount:double>" in plan(df)


def test_equal_plans_hit_the_cache_and_others_do_not(trips, plan):
    with selection.kept(selection.amounts_over(trips), StorageLevel.DISK_ONLY) as cached:
        assert cached.storageLevel.useDisk
        assert "InMemoryTableScan" in plan(selection.amounts_over(trips))
        assert "InMemoryTableScan" not in plan(selection.amounts_over(trips, 4))
        other_shape = trips.where(F.col("total_amount") > 10).select("VendorID", "total_amount")
        assert "InMemoryTableScan" not in plan(other_shape)
    assert "InMemoryTableScan" not in plan(selection.amounts_over(trips))


def test_cached_table_in_sql(spark, trips):
    cached = selection.cache_table(spark, "trip_cache", f"SELECT * FROM {view(trips, 'cars')}")
    assert cached.limit(3).count() == 3
    assert spark.catalog.isCached("trip_cache")
    spark.sql("UNCACHE TABLE trip_cache")


def test_city_box_reaches_the_scan(spark, folder, plan):
    sink.parquet(spark.createDataFrame([], RIDE), f"{folder}/rides")
    text = plan(rides.rides_in_city(files.parquet(spark, f"{folder}/rides")))
    for column in ("start_lon", "start_lat", "end_lon", "end_lat"):
        assert f"IsNotNull({column})" in text
    assert "cast(start_lon" not in text


def test_messages_are_decoded_once(spark, folder, plan):
    body = '{"timestamp":"01-01-1970 01:00:00:015","page":"/help","userId":1,"duration":100}'
    sink.text(spark.createDataFrame([(body,)], "value string"), f"{folder}/clicks")
    counts = clicks.page_counts(clicks.clicks(spark.read.text(f"{folder}/clicks")))
    assert plan(counts).count("from_json") == 1
    assert counts.first()["count"] == 1


def test_transactions_and_lengths_are_worked_out_once(spark, folder, plan):
    sink.text(spark.createDataFrame([("1, 5, 2020-01-01 00:00:00",)], "value string"), f"{folder}/spent")
    spent = decode_transactions(spark.read.text(f"{folder}/spent")).where("amount > 1 AND account_id < 9")
    assert plan(spent).count("from_csv") == 1
    register_strlen(spark)
    names = rows(spark, [(1, "Queens", "A zone with a long name", "BORO"), (2, "Queens", "short", "BORO")], ZONE)
    long = selection.long_names_sql(spark, view(names, "named"))
    assert plan(long).count("ArrowEvalPython") == 1
    assert [r["name_length"] for r in long.collect()] == [23]


def test_long_rides_are_one_hash_aggregate(spark, folder, plan):
    sink.parquet(spark.createDataFrame([], RIDE), f"{folder}/rides")
    text = plan(rides.long_rides(files.parquet(spark, f"{folder}/rides")))
    assert "SortAggregate" not in text and "Join" not in text
    assert text.count("Exchange hashpartitioning(ride_id") == 1


def test_layout_does_not_change_results(trips):
    want = sorted(map(tuple, trips.groupBy("VendorID").count().collect()))
    for laid_out in (trips.repartition(3), trips.coalesce(1), trips.repartition(4, "VendorID")):
        assert sorted(map(tuple, laid_out.groupBy("VendorID").count().collect())) == want
