"""What several of these operators share: words, local names for values, numbering."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.session import written

# Words are runs of anything but these six; fixed by the operators' contracts.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often it is used.

    Without this the planner may copy an expression into a lambda, where it
    would run again for each element.
    """
    return F.get(F.transform(F.array(value), body), 0)


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(
        F.array().cast("array<string>")
    )


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def with_row_numbers(
    rows: DataFrame, order: Sequence[Column], name: str, label: str = "numbered"
) -> tuple[DataFrame, int]:
    """Number ``rows`` from 0 along ``order``, and their count.

    Rows are range-partitioned and sorted, and written once to the shared
    folder together with their place in their partition, so that counts and
    numbers come from the same cut. Where rows tie, the place in the input cuts
    them, so equal keys do not meet in one task; which of two tied rows comes
    first is open. The offsets, one row per partition, are broadcast.
    """
    tie, place = f"{name}__tie", f"{name}__place"
    keys = [*order, F.col(tie)]
    cut = written(
        rows.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop(tie)
        .withColumn(place, F.monotonically_increasing_id()),
        label,
    )
    # The upper bits of a place are its partition, the lower 33 the row in it.
    part, inside = F.shiftright(place, 33), F.col(place).bitwiseAND((1 << 33) - 1)
    counts = cut.groupBy(part.alias(tie)).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy(tie).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(tie, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(name))
    total = counts.agg(F.sum("rows")).first()[0] or 0
    numbered = (
        cut.withColumn(tie, part)
        .withColumn(place, inside)
        .join(F.broadcast(offsets), tie)
        .withColumn(name, F.col(name) + F.col(place))
        .drop(tie, place)
    )
    return numbered, int(total)
