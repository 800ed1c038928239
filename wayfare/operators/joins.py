"""Equi-joins shaped for facts with hot keys.

No side is marked for broadcast: the planner and adaptive execution choose by the
session's threshold and by sizes measured while running.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.operators.slicing import same_keys


def join_keys(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner"
) -> DataFrame:
    """Equi-join on differently named keys; the right side is the dimension."""
    return left.join(right, left[left_key] == right[right_key], how)


def join_using(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Inner join on same-named columns; each key comes out once."""
    return left.join(right, keys if isinstance(keys, str) else list(keys))


def join_back(df: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join rows with facts found about their ``keys`` (one row per key, nulls equal)."""
    renamed = found.select(
        *[F.col(key).alias(f"found_{key}") for key in keys],
        *[F.col(name) for name in found.columns if name not in keys],
    )
    pairs = [(key, f"found_{key}") for key in keys]
    joined = df.join(renamed, same_keys(df, renamed, pairs))
    return joined.drop(*[right for _, right in pairs])


def rollup_by_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    group: str,
    measure: str | None = None,
    how: str = "inner",
) -> DataFrame:
    """Count (and measure) facts per ``group`` of the dimension they point to.

    Facts are combined per key where they are read, so that a hot key is one row
    when it meets the dimension and the join moves keys instead of facts. A left
    join keeps facts with an unknown key under a null group.

    Returns ``group, n`` and, with a measure, ``low, high, total, measured``.
    """
    names = dimension.select(dimension_key, group)
    counted: list[Column] = [F.count(F.lit(1)).alias("n")]
    summed: list[Column] = [F.sum("n").alias("n")]
    if measure is not None:
        counted += [
            F.min(measure).alias("low"),
            F.max(measure).alias("high"),
            F.sum(measure).alias("total"),
            F.count(measure).alias("measured"),
        ]
        summed += [
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.sum("total").alias("total"),
            F.sum("measured").alias("measured"),
        ]
    per_key = facts.groupBy(fact_key).agg(*counted)
    return per_key.join(names, per_key[fact_key] == names[dimension_key], how).groupBy(
        group
    ).agg(*summed)
