"""Text expressions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType


def is_upper_case(column: Column) -> Column:
    """True where the text equals its upper-case form."""
    return F.upper(column) == column


def length_or_zero(column: Column) -> Column:
    """Length in code points, 0 for null."""
    return F.coalesce(F.length(column), F.lit(0))


def register_strlen(spark: SparkSession, name: str = "strlen") -> None:
    """Register ``length_or_zero`` as a SQL function run in Python (Arrow batches).

    The extension point for functions Spark lacks. Where the built-in form
    does, it is faster and can be pushed into scans.
    """

    @F.pandas_udf(LongType())
    def strlen(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.str.len().fillna(0).astype("int64")

    spark.udf.register(name, strlen)


def joined(separator: str, *columns: Column) -> Column:
    """Values as text with a separator; a null gives the text ``null``."""
    return F.concat_ws(
        separator, *[F.coalesce(c.cast("string"), F.lit("null")) for c in columns]
    )


def field(line: Column, position: int, separator: str = ",") -> Column:
    """The field of a separated line by position; quotes stay in the value."""
    return F.get(F.split(line, separator), position)
