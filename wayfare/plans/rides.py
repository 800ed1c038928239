"""Ride and fare reports. Inputs have the ride and fare schemas.

Each function takes batch or streaming tables unless it says otherwise. A
streaming input carries its watermark (``wayfare.streaming.time``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.clock import event_time, iso_instant, start_or_end
from wayfare.functions.geo import (
    direction_degrees,
    distance_km,
    grid_cell,
    in_city,
    route_cells,
    cell_centre_lat,
    cell_centre_lon,
)
from wayfare.functions.text import joined
from wayfare.operators.slicing import By, with_positions

ALARM_AFTER = "2 hours"

RIDE_FIELDS = """ride_id is_start start_time end_time start_lon start_lat end_lon end_lat
    passenger_cnt taxi_id driver_id""".split()
FARE_FIELDS = "ride_id taxi_id driver_id start_time payment_type tip tolls total_fare".split()


def with_event_time(rides: DataFrame) -> DataFrame:
    return rides.withColumn(
        "event_time",
        event_time(F.col("is_start"), F.col("start_time"), F.col("end_time")),
    )


def rides_in_city(rides: DataFrame) -> DataFrame:
    """Rides that start and end in the city."""
    return rides.where(
        in_city(F.col("start_lon"), F.col("start_lat"))
        & in_city(F.col("end_lon"), F.col("end_lat"))
    )


def start_events(rides: DataFrame) -> DataFrame:
    return rides.where(F.col("is_start"))


def ride_text(side: str = "") -> Column:
    """A ride as comma-separated text."""
    c = lambda name: F.col(f"{side}{name}")
    return joined(
        ",",
        c("ride_id"),
        start_or_end(c("is_start")),
        iso_instant(c("start_time")),
        iso_instant(c("end_time")),
        c("start_lon"),
        c("start_lat"),
        c("end_lon"),
        c("end_lat"),
        c("passenger_cnt"),
        c("taxi_id"),
        c("driver_id"),
    )


def fare_text(side: str = "") -> Column:
    """A fare as comma-separated text."""
    c = lambda name: F.col(f"{side}{name}")
    return joined(
        ",",
        c("ride_id"),
        c("taxi_id"),
        c("driver_id"),
        iso_instant(c("start_time")),
        c("payment_type"),
        c("tip"),
        c("tolls"),
        c("total_fare"),
    )


def rides_with_fares(
    rides: DataFrame,
    fares: DataFrame,
    size: str = "2 milliseconds",
    ride_time: str = "start_time",
    fare_time: str = "start_time",
) -> DataFrame:
    """Pairs of START and fare of one ride that fall in the same window.

    Inner join on ride and window: ``ride_id, window_end, pair`` with the two
    records as one text.
    """
    left = start_events(rides).select(
        "ride_id",
        F.window(ride_time, size).alias("window"),
        F.struct(*RIDE_FIELDS).alias("ride"),
    )
    right = fares.select(
        "ride_id",
        F.window(fare_time, size).alias("window"),
        F.struct(*FARE_FIELDS).alias("fare"),
    )
    # The texts are longer than the records: they are made after the shuffle.
    return left.join(right, ["ride_id", "window"]).select(
        "ride_id",
        F.col("window.end").alias("window_end"),
        F.concat_ws(",", ride_text("ride."), fare_text("fare.")).alias("pair"),
    )


def long_rides(rides: DataFrame, after: str = ALARM_AFTER) -> DataFrame:
    """STARTs of rides without an END within ``after``, one per ride (batch).

    A ride counts once the latest event of the table is at or past its deadline.
    An END that lies before its own start is no END.
    One aggregate per ride: its first START and its first END, so copies of an
    event are combined before the shuffle.
    """
    events = with_event_time(rides)
    started_at = F.when(F.col("is_start"), F.col("event_time"))
    timely_end = ~F.col("is_start") & (F.col("end_time") >= F.col("start_time"))
    # Field by field, as a hash aggregate holds numbers but no structs. STARTs
    # of one ride are equal but for copies at another time.
    details = [
        F.min_by(name, started_at).alias(name) for name in rides.columns if name != "ride_id"
    ]
    per_ride = events.groupBy("ride_id").agg(
        F.min(started_at).alias("started__"),
        F.min(F.when(timely_end, F.col("event_time"))).alias("ended__"),
        *details,
    )
    deadline = F.col("started__") + F.expr(f"INTERVAL {after}")
    now = events.agg(F.max("event_time"))
    late = per_ride.where(
        F.col("started__").isNotNull()
        & (F.col("ended__").isNull() | (F.col("ended__") > deadline))
        & (deadline <= now.scalar())
    )
    return late.select(*rides.columns)


def event_log(rides: DataFrame) -> DataFrame:
    """Number the ride events in log order: event time, START before END (batch)."""
    ordered = with_event_time(rides).withColumn(
        "is_end", F.when(F.col("is_start"), F.lit(0)).otherwise(F.lit(1))
    )
    order = [By("event_time"), By("is_end"), By("ride_id")]
    return with_positions(ordered, [], order).drop("is_end")


def pickup_heatmap(rides: DataFrame) -> DataFrame:
    """Pickups per grid cell of the city, with the cell centre."""
    cells = (
        start_events(rides)
        .where(in_city(F.col("start_lon"), F.col("start_lat")))
        .groupBy(grid_cell(F.col("start_lon"), F.col("start_lat")).alias("cell"))
        .agg(F.count(F.lit(1)).alias("pickups"))
    )
    return with_cell_centres(cells)


def with_cell_centres(cells: DataFrame, cell: str = "cell") -> DataFrame:
    return cells.withColumn("centre_lon", cell_centre_lon(F.col(cell))).withColumn(
        "centre_lat", cell_centre_lat(F.col(cell))
    )


def route_coverage(rides: DataFrame) -> DataFrame:
    """Rides per grid cell they pass on the straight way from start to end."""
    ends = start_events(rides).select("start_lon", "start_lat", "end_lon", "end_lat")
    return (
        route_cells(ends, "start_lon", "start_lat", "end_lon", "end_lat", keep=[])
        .groupBy("cell")
        .agg(F.count(F.lit(1)).alias("rides"))
    )


def trip_lengths(rides: DataFrame, compat: bool = False) -> DataFrame:
    """Each ride with the straight distance between its ends, in km."""
    length = distance_km(
        F.col("start_lon"), F.col("start_lat"), F.col("end_lon"), F.col("end_lat"), compat
    )
    return start_events(rides).select("ride_id", length.alias("distance"))


def distance_to_point(
    rides: DataFrame, lon: float, lat: float, compat: bool = False
) -> DataFrame:
    """Distance from a fixed point to the place of each event, in km."""
    place = lambda axis: F.when(F.col("is_start"), F.col(f"start_{axis}")).otherwise(
        F.col(f"end_{axis}")
    )
    point = [F.lit(lon).cast("float"), F.lit(lat).cast("float")]
    return rides.withColumn("distance", distance_km(*point, place("lon"), place("lat"), compat))


def direction_histogram(
    rides: DataFrame, width: int = 30, compat: bool = False
) -> DataFrame:
    """Rides per direction of travel, in buckets of ``width`` degrees."""
    degrees = direction_degrees(
        F.col("start_lon"), F.col("start_lat"), F.col("end_lon"), F.col("end_lat"), compat
    )
    bucket = (F.floor(degrees / width) * width).cast("int")
    return (
        start_events(rides)
        .groupBy(bucket.alias("direction"))
        .agg(F.count(F.lit(1)).alias("rides"))
    )
