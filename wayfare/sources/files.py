"""File readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.text import field
from wayfare.schemas import FARE, RIDE, ZONE, ZONE_STRINGS


def parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def csv(spark: SparkSession, path: str, schema: str = ZONE, header: bool = True) -> DataFrame:
    """CSV with a declared schema, so that no pass over the data infers one."""
    return spark.read.schema(schema).option("header", header).csv(path)


def csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV whose types are found by a pass over the data; for exploring files."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def csv_strings(spark: SparkSession, path: str, schema: str = ZONE_STRINGS) -> DataFrame:
    """CSV with every column as text."""
    return csv(spark, path, schema)


def text_fields(
    spark: SparkSession, path: str, names: list[str], separator: str = ","
) -> DataFrame:
    """Raw lines cut at every separator, fields by position.

    Quotes stay in the values and a header line is a row like any other.
    """
    lines = spark.read.text(path)
    return lines.select(
        *[field(F.col("value"), i, separator).alias(name) for i, name in enumerate(names)]
    )


def _stream(spark: SparkSession, path: str, schema: str, files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(path)


def file_stream(
    spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None
) -> DataFrame:
    """New parquet files of a folder (or glob) as a stream."""
    return _stream(spark, path, schema, files_per_batch)


def ride_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Ride events as a stream; an END may come before its START."""
    return _stream(spark, path, RIDE, files_per_batch)


def fare_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Fare events as a stream, one per ride."""
    return _stream(spark, path, FARE, files_per_batch)
