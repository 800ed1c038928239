"""Account spending."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_fares(
    fares: DataFrame,
    size: str = "1 hour",
    time: str = "start_time",
    scale: int | None = None,
) -> DataFrame:
    """Fares per driver and window, with the end of the window.

    Sums are in double. With ``scale`` they are sums of decimals with that many
    places, which no order of addition changes.
    """
    fare = F.col("total_fare")
    if scale is not None:
        fare = fare.cast(f"decimal(18,{scale})")
    return (
        fares.groupBy(F.window(time, size).alias("window"), "driver_id")
        .agg(F.sum(fare).cast("double").alias("total_fare"))
        .select(F.col("window.end").alias("window_end"), "driver_id", "total_fare")
    )


def spend_by_account(report: DataFrame, stamped: bool = False) -> DataFrame:
    """Amount per account, with the account as text; ``stamped`` adds the time now."""
    spend = report.groupBy("account_id").agg(F.sum("amount").alias("value"))
    columns = [F.col("account_id").cast("string").alias("metric"), "value"]
    if stamped:
        columns.insert(0, F.current_timestamp().alias("time"))
    return spend.select(*columns)


def mean_spend(spend: DataFrame) -> DataFrame:
    """The mean over the accounts, in one row."""
    return spend.agg(F.avg("value").alias("mean_value"))
