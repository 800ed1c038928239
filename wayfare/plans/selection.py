"""Threshold and text-length selections, and reuse of a selection by caching."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.text import length_or_zero


def amounts_over(
    trips: DataFrame,
    threshold: float = 10,
    columns: tuple[str, ...] = ("VendorID", "total_amount"),
    amount: str = "total_amount",
) -> DataFrame:
    """The given columns of trips above an amount.

    Projected first and filtered second; a cached result is found again by
    plans built the same way with the same threshold.
    """
    return trips.select(*columns).where(F.col(amount) > threshold)


def long_names(
    zones: DataFrame,
    borough_value: str = "Queens",
    longer_than: int = 15,
    borough: str = "Borough",
    zone: str = "Zone",
) -> DataFrame:
    """Zones of one borough with a long name, and the length of the name."""
    length = length_or_zero(F.col(zone))
    return zones.where(
        (F.col(borough) == borough_value) & F.col(borough).isNotNull() & (length > longer_than)
    ).select(borough, zone, length.cast("bigint").alias("name_length"))


def long_names_sql(
    spark: SparkSession,
    view: str,
    borough_value: str = "Queens",
    longer_than: int = 15,
    borough: str = "Borough",
    zone: str = "Zone",
    function: str = "strlen",
) -> DataFrame:
    """The same in SQL with a registered function for the length."""
    # The length comes through a generator, so that the condition on it is not
    # pushed below and the function called again there.
    return spark.sql(
        f"""
        SELECT {borough}, {zone}, name_length
        FROM {view} LATERAL VIEW explode(array(CAST({function}({zone}) AS BIGINT))) AS name_length
        WHERE {borough} = :borough AND {borough} IS NOT NULL AND name_length > :longer_than
        """,
        args={"borough": borough_value, "longer_than": longer_than},
    )


@contextmanager
def kept(
    df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    """Cache ``df`` for a block. Equal plans inside the block read the cache."""
    cached = df.persist(level)
    try:
        yield cached
    finally:
        cached.unpersist()


def cache_table(
    spark: SparkSession, name: str, query: str, level: str = "DISK_ONLY", lazy: bool = True
) -> DataFrame:
    """``CACHE TABLE`` for a query; drop it with ``UNCACHE TABLE``."""
    mode = "LAZY " if lazy else ""
    spark.sql(f"CACHE {mode}TABLE {name} OPTIONS ('storageLevel' '{level}') {query}")
    return spark.table(name)
