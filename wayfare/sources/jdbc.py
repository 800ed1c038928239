"""Relational databases over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Connection:
    """Where a database is and how to log in."""

    url: str
    properties: dict[str, str] = field(default_factory=dict, repr=False)

    @classmethod
    def from_conf(cls, spark: SparkSession, prefix: str = "spark.wayfare.jdbc") -> Connection:
        """From ``<prefix>.url``, ``.user``, ``.password`` and ``.driver``.

        These come from the cluster's configuration, never from code.
        """
        names = ("user", "password", "driver")
        found = {name: spark.conf.get(f"{prefix}.{name}", None) for name in names}
        return cls(
            spark.conf.get(f"{prefix}.url"),
            {name: value for name, value in found.items() if value is not None},
        )


@dataclass(frozen=True)
class Ranges:
    """Read in ``partitions`` range queries over a numeric or time column."""

    column: str
    lower: str
    upper: str
    partitions: int


def subquery(sql: str, name: str = "result") -> str:
    """A query in the form the reader takes in place of a table name."""
    return f"({sql.strip()}) as {name}"


def read(
    spark: SparkSession,
    connection: Connection,
    table: str,
    ranges: Ranges | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table, or a ``subquery`` that the database runs (joins included).

    Without ``ranges`` one task reads everything; give them for large tables.
    An ORDER BY inside a subquery does not order the DataFrame.
    """
    reader = spark.read.format("jdbc").options(**connection.properties)
    reader = reader.option("url", connection.url).option("dbtable", table)
    reader = reader.option("fetchsize", fetch_size)
    if ranges is not None:
        reader = reader.options(
            partitionColumn=ranges.column,
            lowerBound=ranges.lower,
            upperBound=ranges.upper,
            numPartitions=ranges.partitions,
        )
    return reader.load()


def joined_query(
    left: str, right: str, key: str, columns: tuple[str, ...], order: str | None = None
) -> str:
    """A join of two tables on one key, for the database to run."""
    sql = f"SELECT {', '.join(columns)} FROM {left} JOIN {right} USING ({key})"
    return subquery(sql + (f" ORDER BY {order}" if order else ""))
