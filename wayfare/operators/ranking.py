"""Rank rows by a value within a partition, without sorting whole partitions.

A rank depends on the distinct values of a partition and how often each
occurs. So the values are counted first (combined before the shuffle), the
values are ranked, and the ranks are joined back on (partition, value). The
rows themselves are never gathered by partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.operators.joins import join_back
from wayfare.operators.slicing import By, ordered_window, with_positions


def ranks_of_values(
    df: DataFrame, partition: Sequence[str], by: By, kind: str = "dense_rank", name: str = "rank"
) -> DataFrame:
    """The distinct values of each partition with their rank."""
    if kind not in ("dense_rank", "rank"):
        raise ValueError(f"unknown kind of rank: {kind}")
    values = df.groupBy(*partition, by.column).agg(F.count(F.lit(1)).alias("rows__"))
    placed = with_positions(values, partition, [by], "rows__")
    rank = F.col("position") if kind == "dense_rank" else F.col("weight_before") + 1
    return placed.select(*partition, by.column, rank.alias(name))


def with_rank(
    df: DataFrame,
    partition: Sequence[str],
    by: By,
    kind: str = "dense_rank",
    name: str = "rank",
) -> DataFrame:
    """Add ``dense_rank()`` or ``rank()`` over (partition order by ``by``)."""
    ranks = ranks_of_values(df, partition, by, kind, name)
    return join_back(df, ranks, [*partition, by.column])


def nth_distinct(df: DataFrame, partition: Sequence[str], by: By, n: int) -> DataFrame:
    """The rows of each partition that hold its n-th distinct value.

    The distinct values are cut to n per partition before their shuffle (the
    planner's window group limit), and a partition has one n-th value, so only
    a row per partition is joined back.
    """
    rank = F.dense_rank().over(ordered_window(partition, [by]))
    chosen = (
        df.select(*partition, by.column)
        .distinct()
        .withColumn("rank__", rank)
        .where(F.col("rank__") == n)
        .drop("rank__")
    )
    return join_back(df, chosen, [*partition, by.column])
