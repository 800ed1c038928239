"""Late rows kept as rows, beside those that came in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.sinks.pointer import Pointer

NOTHING: dict = {"marks": {}}
#: A stream hands over no batch again but the newest.
MARKS_KEPT = 4


class LateSplit:
    """Each micro-batch split in two: rows in time, and rows behind the watermark.

    Operators of a stream drop rows behind the watermark and count them at most. Here the
    watermark is the greatest ``time`` of all batches before, less ``delay``; a row
    is late if its time, or the end of its window of ``size``, is not after it.
    Rows without a time are in time. A batch is written once, to a folder of its own;
    its greatest time is noted afterwards. So a batch handed over
    again, also after a restart, meets the watermark that it met before.
    """

    def __init__(
        self, path: str, schema: str, time: str = "event_time", delay: str = "0 seconds", size: str | None = None
    ) -> None:
        self.path, self.schema, self.time, self.delay, self.size = path, schema, time, delay, size
        self._pointer = Pointer(f"{path}/marks.json")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Store a batch; for ``to_batches``."""
        spark = batch.sparkSession
        marks = {int(k): v for k, v in self._pointer.read(spark, NOTHING)["marks"].items()}
        earlier = [mark for number, mark in marks.items() if number < batch_id and mark is not None]
        until = F.col(self.time).cast("timestamp")
        if self.size:
            until = F.window(until, self.size)["end"]
        late = F.lit(False)
        if earlier:
            mark = F.timestamp_micros(F.lit(max(earlier))) - F.expr(f"INTERVAL {self.delay}")
            late = F.coalesce(until <= mark, F.lit(False))
        place = f"{self.path}/rows/batch_id={batch_id}"
        batch.withColumn("late", late).write.partitionBy("late").mode("overwrite").parquet(place)
        stored = spark.read.schema(f"{self.schema}, late boolean").parquet(place)
        newest = stored.agg(F.max(F.unix_micros(F.col(self.time).cast("timestamp")))).first()[0]
        marks[batch_id] = max([mark for mark in (*earlier, newest) if mark is not None], default=None)
        kept = sorted(marks)[-MARKS_KEPT:]
        self._pointer.replace(spark, {"marks": {str(k): marks[k] for k in kept}})

    def on_time(self, spark: SparkSession) -> DataFrame:
        return self.rows(spark).where("NOT late").drop("late")

    def late(self, spark: SparkSession) -> DataFrame:
        return self.rows(spark).where("late").drop("late")

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows, with ``batch_id`` and whether they were ``late``."""
        schema = f"{self.schema}, batch_id bigint, late boolean"
        return spark.read.schema(schema).parquet(f"{self.path}/rows")
