"""Click reports. Inputs have the click schema or an event-time column added."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.clock import CONSUMER_CLOCK, parsed, time_of_day
from wayfare.functions.codec import as_messages, decode_json
from wayfare.operators.collections import drop_repeats, latest_per_key
from wayfare.operators.slicing import By
from wayfare.schemas import CLICK, CLICK_NARROW, USER_DEVICES


def click_times(messages: DataFrame, clock: str = CONSUMER_CLOCK) -> DataFrame:
    """JSON click messages to time of day and page; unreadable ones to nulls."""
    clicks = decode_json(messages, CLICK_NARROW)
    return clicks.select(time_of_day(F.col("timestamp"), clock).alias("time"), "page")


def clicks(
    messages: DataFrame,
    strict: bool = True,
    clock: str = CONSUMER_CLOCK,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """JSON click messages to click records with an ``event_time``.

    ``keep`` names message columns to carry along, such as the offset.
    """
    return decode_json(messages, CLICK, strict=strict, keep=keep).withColumn(
        "event_time", parsed(F.col("timestamp"), clock)
    )


def narrow_clicks(clicks: DataFrame) -> DataFrame:
    """Only time and page."""
    return clicks.select(F.col("event_time").alias("timestamp"), "page")


def click_row(clicks: DataFrame) -> DataFrame:
    """The columns of the click table, in its order."""
    return clicks.select("userId", "page", "duration", "timestamp")


def average_duration(clicks: DataFrame) -> DataFrame:
    """Average duration per page over all clicks so far (batch or update mode)."""
    total, count = F.sum("duration"), F.count("duration")
    return clicks.groupBy("page").agg((total / count).alias("average_duration"))


def page_counts(
    clicks: DataFrame, size: str = "15 seconds", time: str = "event_time"
) -> DataFrame:
    """Clicks per page and window."""
    return (
        clicks.groupBy(F.window(time, size).alias("window"), "page")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            F.col("window.start").alias("windowStart"),
            F.col("window.end").alias("windowEnd"),
            "page",
            "count",
        )
    )


def statistics_messages(counts: DataFrame) -> DataFrame:
    """Page counts as JSON messages for a topic."""
    return as_messages(counts, ["windowStart", "windowEnd", "page", "count"])


def click_messages(clicks: DataFrame) -> DataFrame:
    """Clicks as JSON messages for a topic, times in the producer's form."""
    return as_messages(
        clicks, [F.col("event_time").alias("timestamp"), "page", "userId", "duration"]
    )


def latest_clicks(clicks: DataFrame, version: list[str]) -> DataFrame:
    """The last click of each user."""
    return latest_per_key(clicks, ["userId"], version)


def page_changes(clicks: DataFrame, order: list[By]) -> DataFrame:
    """Clicks that lead a user to another page than the click before."""
    return drop_repeats(clicks, ["userId"], "page", order)


def user_devices(messages: DataFrame, strict: bool = True) -> DataFrame:
    """Nested JSON users, one row per device; a user without devices keeps one row."""
    users = decode_json(messages, USER_DEVICES, strict=strict)
    return users.select("name", F.explode_outer("devices").alias("device")).select(
        "name", F.col("device.id").alias("device_id"), F.col("device.model").alias("model")
    )
