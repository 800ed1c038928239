"""Event time for streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.plans.rides import with_event_time

# How far clicks may be out of order; rides and fares are not.
CLICK_DELAY = "200 milliseconds"
NO_DELAY = "0 seconds"


def timed(df: DataFrame, column: str = "event_time", delay: str = NO_DELAY) -> DataFrame:
    """Watermark a stream by a timestamp column. Zone-less times are taken as UTC."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def timed_clicks(
    clicks: DataFrame, use_event_time: bool = True, delay: str = CLICK_DELAY
) -> DataFrame:
    """Watermark clicks by their own time, or by their time of arrival."""
    if not use_event_time:
        clicks = clicks.withColumn("event_time", F.current_timestamp())
    return timed(clicks, "event_time", delay)


def timed_rides(rides: DataFrame, delay: str = NO_DELAY) -> DataFrame:
    """Watermark ride events by the time they happen at (START or END)."""
    return timed(with_event_time(rides), "event_time", delay)


def timed_fares(fares: DataFrame, delay: str = NO_DELAY) -> DataFrame:
    return timed(fares, "start_time", delay)
