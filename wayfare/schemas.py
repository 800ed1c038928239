"""Declared record schemas (DDL text), so that no reader has to infer one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TRIP = """
    VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp,
    passenger_count int, trip_distance double, RatecodeID int, store_and_fwd_flag string,
    PULocationID int, DOLocationID int, payment_type int, fare_amount double, extra double,
    mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double,
    total_amount double"""

ZONE = "LocationID int, Borough string, Zone string, service_zone string"

ZONE_STRINGS = "LocationID string, Borough string, Zone string, service_zone string"

RIDE = """
    ride_id bigint, is_start boolean, start_time timestamp, end_time timestamp,
    start_lon float, start_lat float, end_lon float, end_lat float,
    passenger_cnt smallint, taxi_id bigint, driver_id bigint"""

FARE = """
    ride_id bigint, taxi_id bigint, driver_id bigint, start_time timestamp,
    payment_type string, tip float, tolls float, total_fare float"""

CLICK = "timestamp string, page string, userId bigint, duration bigint"

CLICK_NARROW = "timestamp string, page string"

PAGE_STATISTICS = "windowStart timestamp, windowEnd timestamp, page string, count bigint"

TRANSACTION = "account_id bigint, amount int, ts timestamp"

SPEND_REPORT = "account_id bigint, log_ts timestamp, amount bigint"

EMPLOYEE = "employee_name string, department string, salary int"

PERSON_TITLE = "last_name string, title string"

USER_DEVICES = "name string, devices array<struct<id: int, model: string>>"


# Each may become any of those after it without failing.
_WIDENING = ["tinyint", "smallint", "int", "bigint", "float", "double"]


def _widens(have: str, want: str) -> bool:
    if have == want or want == "string":
        return True
    if have in _WIDENING and want in _WIDENING:
        return _WIDENING.index(have) < _WIDENING.index(want)
    return (have, want) == ("date", "timestamp")


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The typed view of ``df``: columns by name, widening only.

    A missing column is an error, and so is a cast that could lose data.
    """
    wanted = T.StructType.fromDDL(schema)
    have = dict(df.dtypes)
    missing = [name for name in wanted.names if name not in have]
    if missing:
        raise TypeError(f"no column {', '.join(missing)}")
    narrowed = [
        f"{field.name} ({have[field.name]} to {field.dataType.simpleString()})"
        for field in wanted
        if isinstance(field.dataType, T.AtomicType)
        and not _widens(have[field.name], field.dataType.simpleString())
    ]
    if narrowed:
        raise TypeError(f"cannot widen {', '.join(narrowed)}")
    return df.to(wanted)
