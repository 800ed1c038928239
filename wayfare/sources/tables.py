"""In-memory rows, views and catalog tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from wayfare.schemas import EMPLOYEE


def rows(
    spark: SparkSession, values: Iterable[Sequence], schema: str = EMPLOYEE
) -> DataFrame:
    """A few literal rows with a declared schema."""
    return spark.createDataFrame([tuple(value) for value in values], schema)


def view(df: DataFrame, name: str) -> str:
    """Register ``df`` under a name for SQL; gives the name back."""
    df.createOrReplaceTempView(name)
    return name


def table(spark: SparkSession, name: str) -> DataFrame:
    """A view or catalog table."""
    return spark.table(name)
