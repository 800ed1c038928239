"""Ordered work on groups too big for one task.

A window function sends each group to one task. Where a group may hold a third
of all rows, the rows are first range-partitioned by the group's keys and the
sort columns, so a large group spreads over many parts, and written once. Each
part is then worked on by itself, and one row per part and group (its length, its
last value) is handed on. A part has at most one group that began in an earlier
one, so what is handed on is never more than a row per part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wayfare.session import written

PART, PLACE = "part__", "place__"


@dataclass(frozen=True)
class By:
    """One sort column; nulls sort as the smallest value."""

    column: str
    desc: bool = False

    def expr(self) -> Column:
        column = F.col(self.column)
        return column.desc_nulls_last() if self.desc else column.asc_nulls_first()


def same_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality of the named columns."""
    condition = F.lit(True)
    for position, (a, b) in enumerate(pairs):
        equal = left[a].eqNullSafe(right[b])
        condition = equal if position == 0 else condition & equal
    return condition


def ordered_window(keys: Sequence[str], order: Sequence[By]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*[by.expr() for by in order])


def in_parts(df: DataFrame, keys: Sequence[str], order: Sequence[By]) -> DataFrame:
    """``df`` cut along keys and order, with the part and the place of each row.

    Places rise through the parts in sort order. The sort is Spark's own, so
    nulls, NaN, text and zone-less times are cut as they sort. Rows that tie in
    all columns are cut by where they came from. The table is written to the shared
    folder, so that all branches of a plan, and retries, see one cut.
    """
    tie = "tie__"
    along = [F.col(key).asc_nulls_first() for key in keys]
    along += [*[by.expr() for by in order], F.col(tie)]
    cut = (
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(*along)
        .sortWithinPartitions(*along)
        .drop(tie)
        .withColumn(PLACE, F.monotonically_increasing_id())
    )
    # The upper bits of the id are the number of the partition.
    return written(cut, "parts").withColumn(PART, F.shiftright(PLACE, 33))


def in_place(keys: Sequence[str]) -> WindowSpec:
    """The rows of a group within a part, in order."""
    return Window.partitionBy(PART, *keys).orderBy(PLACE)


def handed_on(
    placed: DataFrame, by_part: DataFrame, keys: Sequence[str], value: str
) -> DataFrame:
    """Left-join rows with what the parts before hand to their group.

    ``by_part`` has a row per part and group with a non-null ``value``; there is at
    most one row per part, which bounds what is broadcast.
    """
    few = by_part.where(F.col(value).isNotNull()).select(
        *[F.col(name).alias(f"at_{name}") for name in (PART, *keys)],
        *[name for name in by_part.columns if name not in (PART, *keys)],
    )
    pairs = [(name, f"at_{name}") for name in (PART, *keys)]
    joined = placed.join(F.broadcast(few), same_keys(placed, few, pairs), "left")
    return joined.drop(*[right for _, right in pairs])


def with_positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[By], weight: str | None = None
) -> DataFrame:
    """Number the rows of each group from 1 in sort order, as ``position``.

    With ``weight``, ``weight_before`` is the sum of that column over the rows
    before. Without ``keys`` the whole table is one group. ``order`` should
    name a total order, or equal rows are numbered in any order.
    """
    cut = in_parts(df, keys, order)
    local = in_place(keys)
    before = local.rowsBetween(Window.unboundedPreceding, -1)
    weighed = F.col(weight) if weight else F.lit(0)
    placed = cut.withColumns(
        {
            "position": F.row_number().over(local).cast("bigint"),
            "weight_before": F.coalesce(F.sum(weighed).over(before), F.lit(0)).cast("bigint"),
        }
    )
    totals = cut.groupBy(PART, *keys).agg(
        F.count(F.lit(1)).alias("rows__"), F.sum(weighed).alias("weight__")
    )
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumns(
        {"rows_handed__": F.sum("rows__").over(earlier), "weight_handed__": F.sum("weight__").over(earlier)}
    )
    joined = handed_on(placed, totals.drop("rows__", "weight__"), keys, "rows_handed__")
    shifted = {
        name: (F.col(name) + F.coalesce(more, F.lit(0))).cast("bigint")
        for name, more in (("position", "rows_handed__"), ("weight_before", "weight_handed__"))
    }
    names = [*df.columns, "position", *(["weight_before"] if weight else [])]
    return joined.withColumns(shifted).select(*names)
