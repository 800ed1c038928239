"""Time expressions. The session time zone must be UTC (see ``wayfare.session``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms of times in click messages. The producer's form
# has a 12-hour clock without AM/PM, so the two agree before 1 pm only.
CONSUMER_CLOCK = "dd-MM-yyyy HH:mm:ss:SSS"
PRODUCER_CLOCK = "dd-MM-yyyy hh:mm:ss:SSS"
TIME_OF_DAY = "HH:mm:ss:SSS"
TRANSACTION_CLOCK = "yyyy-MM-dd HH:mm:ss"


def hour_text(ts: Column) -> Column:
    """The hour of a timestamp as two digits."""
    return F.date_format(ts, "HH")


def hour_of_text(text: Column) -> Column:
    """The hour of a ``yyyy-MM-dd HH:mm:ss`` text, by position."""
    return F.substring(text, 12, 2)


def parsed(text: Column, pattern: str = CONSUMER_CLOCK) -> Column:
    """Text to timestamp; null where it does not fit the pattern."""
    return F.try_to_timestamp(text, F.lit(pattern))


def time_of_day(text: Column, pattern: str = CONSUMER_CLOCK) -> Column:
    """Click time text to ``HH:mm:ss:SSS``; null where it does not fit."""
    return F.date_format(parsed(text, pattern), TIME_OF_DAY)


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def event_time(is_start: Column, start: Column, end: Column) -> Column:
    """A ride event happens at its start if it is a START, else at its end."""
    return F.when(is_start, start).otherwise(end)


def start_or_end(is_start: Column) -> Column:
    return F.when(is_start, F.lit("START")).otherwise(F.lit("END"))


def iso_instant(ts: Column) -> Column:
    """ISO-8601 text in UTC with no, three or six fraction digits, as needed."""
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return (
        F.when(micros == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(micros % 1000 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )
