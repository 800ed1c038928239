"""Alarm for rides without an END within two hours, on a stream of ride events.

Rule: alarm if there is no END with ``end <= start + 2 hours`` and the
watermark has reached ``start + 2 hours``. Events may come in any order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wayfare.plans.rides import ALARM_AFTER
from wayfare.streaming.time import NO_DELAY, timed_rides

ALARM_MICROS = 2 * 60 * 60 * 1_000_000


def long_rides_stream(
    rides: DataFrame, after: str = ALARM_AFTER, delay: str = NO_DELAY
) -> DataFrame:
    """The STARTs to raise an alarm for, from built-in operators.

    A left outer join of STARTs with ENDs in time gives a START without END
    once the watermark is past its deadline (not yet when it is at it). A source may
    repeat events: copies of a START have one deadline and so leave the join in one batch,
    where one of them is kept. That state holds alarms only, not rides.
    """
    events = timed_rides(rides, delay)
    # Both sides must see the watermark of all events, so the conditions read
    # the event time, which keeps them above the watermark in the plan.
    is_start = F.when(F.col("event_time").isNotNull(), F.col("is_start"))
    starts = events.where(is_start)
    ends = events.where(~is_start).select(
        F.col("ride_id").alias("ended_ride"), F.col("event_time").alias("ended_at")
    )
    in_time = (
        (F.col("ride_id") == F.col("ended_ride"))
        & (F.col("ended_at") >= F.col("event_time"))
        & (F.col("ended_at") <= F.col("event_time") + F.expr(f"INTERVAL {after}"))
    )
    return (
        starts.join(ends, in_time, "left_outer")
        .where(F.col("ended_ride").isNull())
        .dropDuplicates(["ride_id", "event_time"])
        .select(*rides.columns)
    )


PLACE = "start_lon float, start_lat float, end_lon float, end_lat float"
PARTY = "passenger_cnt smallint, taxi_id bigint, driver_id bigint"
PACKED = f"ride_id bigint, start_us bigint, end_us bigint, {PLACE}, {PARTY}"
DETAILS = [part.split()[0] for part in f"{PLACE}, {PARTY}".split(", ")]
#: The bucket of events without a ride's id, which are taken as one ride.
NO_RIDE_ID = -1


def combine_rides(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per ride and Arrow batch: its first START and its first END.

    All rides go on, also those that ended in time inside the batch: the state
    must hear of them, as a source may repeat their START later.
    """
    for batch in batches:
        starts = batch[batch["is_start"]].sort_values("event_us")
        starts = starts.drop_duplicates("ride_id").set_index("ride_id")
        ended = batch[~batch["is_start"]].groupby("ride_id")["event_us"].min()
        rides = starts[["event_us", *DETAILS]].join(ended.rename("end_us"), how="outer")
        rides = rides.rename(columns={"event_us": "start_us"}).reset_index()
        rides = rides.convert_dtypes(convert_floating=False)
        for name in ("start_us", "end_us", "passenger_cnt", "taxi_id", "driver_id"):
            rides[name] = rides[name].astype("Int64")
        yield rides[["ride_id", "start_us", "end_us", *DETAILS]]


# What the state holds of a ride, and how pandas has its numbers, which may be missing.
_RIDES = pa.schema(
    [
        ("ride_id", pa.int64()), ("start_us", pa.int64()), ("end_us", pa.int64()),
        *[(name, pa.float32()) for name in DETAILS[:4]],
        ("passenger_cnt", pa.int16()), ("taxi_id", pa.int64()), ("driver_id", pa.int64()),
    ]
)
_NUMBERS = {pa.int64(): pd.Int64Dtype(), pa.int16(): pd.Int16Dtype()}


def _batch(rides: pd.DataFrame) -> pa.RecordBatch:
    return pa.RecordBatch.from_pandas(rides[_RIDES.names], _RIDES, preserve_index=False)


def _unpacked(state: bytes) -> pa.RecordBatch:
    return pa.ipc.read_record_batch(pa.py_buffer(state), _RIDES)


def _frame(batches: list[pa.RecordBatch]) -> pd.DataFrame:
    return pa.Table.from_batches(batches, _RIDES).to_pandas(types_mapper=_NUMBERS.get)


def _merged(rides: pd.DataFrame) -> pd.DataFrame:
    """One row per ride: its first START with that one's details, and its first END.

    Of equal STARTs the one above stays.
    """
    ended = rides.groupby("ride_id")["end_us"].min()
    first = rides.sort_values("start_us", kind="stable").drop_duplicates("ride_id")
    return first.assign(end_us=first["ride_id"].map(ended).astype("Int64"))


def _timers(rides: pd.DataFrame) -> pd.Series:
    """When to give up waiting, in milliseconds: a START at its deadline, an END at its
    own time, as no START can come after it."""
    return (rides["start_us"] + ALARM_MICROS).fillna(rides["end_us"]) // 1000


class LongRideAlarm(StatefulProcessor):
    """Keeps the first START and END of each ride of a bucket until the START's deadline.

    The rides of a bucket are one value, worked on as columns, and have one timer, that
    of the first ride to give up. A ride that ended in time is kept as well, so that a
    repeated event finds it. A START whose deadline the watermark has passed is late
    and ignored.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bucket = handle.getValueState("bucket", "timer bigint, rides binary")

    def _keep(self, rides: pd.DataFrame) -> None:
        timer = int(_timers(rides).min())
        self.bucket.update((timer, _batch(rides).serialize().to_pybytes()))
        self.handle.registerTimer(timer)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        late = timerValues.getCurrentWatermarkInMs() * 1000
        new = _frame([_batch(part) for part in rows])
        new["start_us"] = new["start_us"].where((new["start_us"] >= late).fillna(False).astype(bool))
        new = new[new["start_us"].notna() | new["end_us"].notna()]
        if len(new):
            if self.bucket.exists():
                timer, held = self.bucket.get()
                self.handle.deleteTimer(timer)
                new = _frame([_unpacked(held), _batch(new)])
            self._keep(_merged(new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.bucket.exists():
            return
        rides = _frame([_unpacked(self.bucket.get()[1])])
        due = (_timers(rides) <= timerValues.getCurrentWatermarkInMs()).astype(bool)
        if due.all():
            self.bucket.clear()
        else:
            self._keep(rides[~due])
        gone = rides[due & rides["start_us"].notna()]
        alarms = gone[(gone["end_us"].isna() | (gone["end_us"] > gone["start_us"] + ALARM_MICROS)).astype(bool)]
        if len(alarms):
            none = pd.array([None] * len(alarms), "Int64")
            ride_id = none if key[0] == NO_RIDE_ID else alarms["ride_id"]
            yield alarms.assign(ride_id=ride_id, end_us=none)

    def close(self) -> None:
        pass


def long_rides_stateful(
    rides: DataFrame, delay: str = NO_DELAY, buckets: int = 1024
) -> DataFrame:
    """The same alarms from keyed state and event-time timers of our own.

    Needs the RocksDB state store. ``long_rides_stream`` is faster; this form is
    for rules a join cannot say. Each call of Python for a key, its state or its timer
    costs far more than a row, so rides are kept by ``buckets`` of their ids: a batch
    asks for the state of each bucket once, however many rides it has, and a task holds
    the open rides of one bucket. Their number must stay the same while a checkpoint
    is in use.
    """
    events = timed_rides(rides, delay)
    narrow = events.where(
        F.col("is_start") | (F.col("end_time") >= F.col("start_time"))
    ).select(
        "ride_id", "is_start", "event_time",
        F.unix_micros("event_time").alias("event_us"), *DETAILS,
    )
    parts = narrow.mapInPandas(combine_rides, PACKED)
    bucket = F.when(F.col("ride_id").isNull(), NO_RIDE_ID).otherwise(
        F.pmod(F.xxhash64("ride_id"), F.lit(buckets)).cast("int")
    )
    # Without nulls, ids of rides stay whole numbers in pandas.
    parts = parts.withColumns({"bucket": bucket, "ride_id": F.coalesce("ride_id", F.lit(0))})
    alarms = parts.groupBy("bucket").transformWithStateInPandas(
        LongRideAlarm(), PACKED, "Append", "EventTime"
    )
    return alarms.select(
        "ride_id",
        F.lit(True).alias("is_start"),
        F.timestamp_micros("start_us").alias("start_time"),
        F.timestamp_micros(F.lit(0)).alias("end_time"),
        *DETAILS,
    )
