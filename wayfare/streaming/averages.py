"""The running average per page as a state update function of our own.

``wayfare.plans.clicks.average_duration`` in update mode gives the same from
the built-in aggregate and is the one to use; this shows the extension point.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def combine_clicks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Clicks to one (page, count, total) row per page and Arrow batch."""
    for batch in batches:
        grouped = pa.Table.from_batches([batch]).group_by("page")
        sums = grouped.aggregate([("duration", "count"), ("duration", "sum")])
        combined = pa.table(
            {
                "page": sums["page"].cast(pa.string()),
                "count": sums["duration_count"].cast(pa.int64()),
                "total": sums["duration_sum"].cast(pa.int64()),
            }
        )
        yield from combined.to_batches()


def update_average(
    key: tuple[str], parts: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    """Add the batch to the page's count and total; give its new average."""
    count, total = state.get if state.exists else (0, 0)
    for part in parts:
        count += int(part["count"].sum())
        total += int(part["total"].sum())
    state.update((count, total))
    average = total / count if count else None
    yield pd.DataFrame({"page": [key[0]], "average_duration": [average]})


def average_duration_stateful(clicks: DataFrame) -> DataFrame:
    """Average duration per page seen in the batch, over all clicks so far.

    The clicks are combined before the shuffle, so even a page with most of
    the clicks reaches its state as a few rows.
    """
    parts = clicks.select("page", "duration").mapInArrow(
        combine_clicks, "page string, count bigint, total bigint"
    )
    return parts.groupBy("page").applyInPandasWithState(
        update_average,
        "page string, average_duration double",
        "count bigint, total bigint",
        "update",
        GroupStateTimeout.NoTimeout,
    )
