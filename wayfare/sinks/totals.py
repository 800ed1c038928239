"""Sums over a keyed table that are kept up to date at the cost of a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.sinks.keyed import KeyedTable


class RunningTotals:
    """A keyed table, and the sum of one of its columns per group.

    A batch may bring new keys and replace old rows. What it takes away and what it adds
    are summed per group, and only the groups touched are written: neither
    the table nor the totals are summed again. Both are worked out against the state
    before the batch, so a batch that is handed over again gives the same totals,
    also where the first attempt died halfway.

    ``path`` gets the totals. Sums are of type ``kind``; null amounts count as 0. A group
    without rows is left out. The group of a key may change.
    """

    def __init__(
        self, table: KeyedTable, path: str, group: str, amount: str, group_type: str, kind: str = "bigint"
    ) -> None:
        self.table, self.group, self.amount, self.kind = table, group, amount, kind
        schema = f"`group` {group_type}, value {kind}, rows bigint"
        self.totals = KeyedTable(path, schema, ["group"], buckets=table.buckets, fold_after=table.fold_after)

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Store a batch and bring the totals up to date; for ``to_batches``."""
        moved = self.moved(batch, batch_id)
        held = self.totals.before(batch.sparkSession, batch_id, moved)
        held = held.select(F.col("group").alias("of"), F.col("value").alias("was"), F.col("rows").alias("had"))
        touched = moved.join(held, F.col("group").eqNullSafe(F.col("of")), "left").select(
            "group",
            (F.coalesce("was", F.lit(0)) + F.col("value")).cast(self.kind).alias("value"),
            (F.coalesce("had", F.lit(0)) + F.col("rows")).alias("rows"),
        )
        self.totals.upsert(touched, batch_id)
        self.table.upsert(batch, batch_id)

    def moved(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """What a batch adds to each group, less what it takes back."""
        changes = self.table.changes(batch, batch_id)
        sides = [
            changes.where(F.col(side).isNotNull()).select(
                F.col(f"{side}.`{self.group}`").alias("group"),
                (F.coalesce(F.col(f"{side}.`{self.amount}`"), F.lit(0)) * sign).alias("value"),
                F.lit(sign).alias("rows"),
            )
            for side, sign in (("old", -1), ("new", 1))
        ]
        return sides[0].unionAll(sides[1]).groupBy("group").agg(
            F.sum("value").cast(self.kind).alias("value"), F.sum("rows").alias("rows")
        )

    def current(self, spark: SparkSession) -> DataFrame:
        """``group`` and ``value`` as they stand."""
        return self.totals.current(spark).where("rows > 0").select("group", "value")
