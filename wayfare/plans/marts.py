"""Trip marts: trips joined with zones, counted and measured.

Column names default to those of the trip and zone schemas. No function
opens a session, caches, prints or writes; see ``wayfare.sinks`` for that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.clock import hour_of_text, hour_text
from wayfare.functions.text import is_upper_case
from wayfare.operators.joins import rollup_by_dimension


def borough_popularity(
    trips: DataFrame,
    zones: DataFrame,
    trip_zone: str = "PULocationID",
    zone_id: str = "LocationID",
    borough: str = "Borough",
) -> DataFrame:
    """Trips per borough, most popular first. Trips with an unknown zone are left out."""
    counts = rollup_by_dimension(trips, zones, trip_zone, zone_id, borough)
    return counts.select(borough, F.col("n").alias("total_trips")).orderBy(
        F.desc("total_trips"), borough
    )


def distance_by_borough(
    trips: DataFrame,
    zones: DataFrame,
    trip_zone: str = "PULocationID",
    zone_id: str = "LocationID",
    borough: str = "Borough",
    distance: str = "trip_distance",
    how: str = "inner",
) -> DataFrame:
    """Trips per borough with least, mean (2 places) and greatest distance.

    ``how="left"`` keeps trips with an unknown zone under a null borough.
    Trips without a distance count as trips only.
    """
    rolled = rollup_by_dimension(trips, zones, trip_zone, zone_id, borough, distance, how)
    return rolled.select(
        borough,
        F.col("n").alias("total_trips"),
        F.col("low").alias("min_distance"),
        F.round(F.try_divide("total", "measured"), 2).alias("mean_distance"),
        F.col("high").alias("max_distance"),
    ).orderBy(F.desc("total_trips"), borough)


def with_known_destination(trips: DataFrame, destination: str = "DOLocationID") -> DataFrame:
    """Trips whose destination is not 0 (a plain predicate, pushed into the scan)."""
    return trips.where(F.col(destination) != 0)


DISTANCE_BY_BOROUGH_SQL = """
WITH per_zone AS (
  SELECT PULocationID AS zone, count(*) AS n, min(trip_distance) AS low,
         max(trip_distance) AS high, sum(trip_distance) AS total,
         count(trip_distance) AS measured
  FROM {facts} GROUP BY PULocationID
)
SELECT tz.Borough, sum(n) AS total_trips, min(low) AS min_distance,
       round(try_divide(sum(total), sum(measured)), 2) AS mean_distance,
       max(high) AS max_distance
FROM per_zone LEFT JOIN {zones} tz ON tz.LocationID = per_zone.zone
GROUP BY tz.Borough
ORDER BY total_trips DESC, tz.Borough
"""


def distance_by_borough_sql(
    spark: SparkSession, facts_view: str = "taxi_facts", zones_view: str = "taxi_zones"
) -> DataFrame:
    """The left-join form as SQL over two views or catalog tables."""
    return spark.sql(DISTANCE_BY_BOROUGH_SQL.format(facts=facts_view, zones=zones_view))


def distribution(df: DataFrame, column: str = "distance") -> DataFrame:
    """Count, mean, sample deviation, least and greatest of one column, in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("stddev"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )


def trips_per_hour(trips: DataFrame, pickup: str = "tpep_pickup_datetime") -> DataFrame:
    """Trips per hour of day (two digits), busiest first.

    A pickup time held as ``yyyy-MM-dd HH:mm:ss`` text is cut by position.
    """
    is_text = trips.schema[pickup].dataType.simpleString() == "string"
    hour = hour_of_text(F.col(pickup)) if is_text else hour_text(F.col(pickup))
    return (
        trips.groupBy(hour.alias("hour"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .orderBy(F.desc("trips"), "hour")
    )


def hour_lines(per_hour: DataFrame) -> DataFrame:
    """``HH count`` text lines, busiest hour first."""
    return per_hour.orderBy(F.desc("trips"), "hour").select(
        F.concat_ws(" ", "hour", "trips").alias("value")
    )


def zones_per_borough(
    zones: DataFrame, borough: str = "Borough", service: str = "service_zone"
) -> DataFrame:
    """Zones per borough, of those whose service zone is all upper case."""
    return (
        zones.where(is_upper_case(F.col(service)))
        .groupBy(borough)
        .agg(F.count(F.lit(1)).alias("count"))
    )


def top(df: DataFrame, n: int, *order) -> DataFrame:
    """The first ``n`` rows in a total order (kept per task, then merged)."""
    return df.orderBy(*order).limit(n)
