"""File, table and database writers for batch results."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter

from wayfare.sources.jdbc import Connection


def _writer(df: DataFrame, mode: str, files: int | None) -> DataFrameWriter:
    return (df if files is None else df.coalesce(files)).write.mode(mode)


def parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    files: int | None = None,
    partition_by: tuple[str, ...] = (),
) -> None:
    """Parquet files. ``files=1`` is for marts of a few rows only."""
    _writer(df, mode, files).partitionBy(*partition_by).parquet(path)


def text(lines: DataFrame, path: str, mode: str = "errorifexists", files: int | None = None) -> None:
    """One text column as lines."""
    _writer(lines, mode, files).text(path)


def jdbc(
    df: DataFrame,
    connection: Connection,
    table: str,
    mode: str = "overwrite",
    keep_definition: bool = False,
    *,
    connections: int,
) -> None:
    """A database table. Overwriting drops and makes it anew, unless told to
    keep its definition and only empty it. ``connections`` tasks write at once;
    the rows are dealt to them, so the work before keeps its own tasks."""
    (
        df.repartition(connections)
        .write.format("jdbc")
        .options(**connection.properties)
        .option("url", connection.url)
        .option("dbtable", table)
        .option("truncate", keep_definition)
        .mode(mode)
        .save()
    )


def managed_table(df: DataFrame, name: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).saveAsTable(name)


def show(df: DataFrame, rows: int = 20) -> None:
    """The first rows on the console."""
    df.show(rows, truncate=False)
