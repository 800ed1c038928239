"""Start streaming queries. Every sink that keeps results wants a checkpoint."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.readwriter import DataStreamWriter

from wayfare.sinks.keyed import KeyedTable


def every(interval: str) -> dict[str, str]:
    """A trigger that fires at an interval, such as ``2 seconds``."""
    return {"processingTime": interval}


# Take in what is there now, then stop.
ONCE: dict[str, bool] = {"availableNow": True}


def _writer(
    df: DataFrame, mode: str, trigger: dict | None, checkpoint: str | None
) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode)
    if trigger:
        writer = writer.trigger(**trigger)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer


def to_console(
    df: DataFrame, mode: str = "append", trigger: dict | None = None
) -> StreamingQuery:
    """Print each micro-batch, by default every 2 seconds."""
    return _writer(df, mode, trigger or every("2 seconds"), None).format("console").start()


def to_parquet(
    df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append to parquet files, each row once."""
    return _writer(df, "append", trigger, checkpoint).format("parquet").start(path)


def to_batches(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hand each micro-batch to ``write(batch, batch_id)``; after a failure the
    same batch may be handed over again."""
    return _writer(df, mode, trigger, checkpoint).foreachBatch(write).start()


def to_keyed_table(
    df: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    mode: str = "update",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Upsert each micro-batch into a keyed table."""
    return to_batches(df, table.upsert, checkpoint, mode, trigger)


def to_topic(
    messages: DataFrame,
    servers: str,
    name: str,
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Send a ``value`` column to a Kafka topic."""
    return (
        _writer(messages, mode, trigger, checkpoint)
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", name)
        .start()
    )


class LateRows(StreamingQueryListener):
    """Counts the rows that stateful operators drop behind the watermark.

    Register it with ``spark.streams.addListener`` before the queries start. It hears of
    every batch, whereas a query itself remembers its last reports only.
    """

    def __init__(self) -> None:
        self._dropped: Counter[str] = Counter()

    def of(self, query: StreamingQuery) -> int:
        """Rows dropped so far; the last batch may take a moment to be reported."""
        return self._dropped[str(query.runId)]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self._dropped[str(progress.runId)] += sum(
            operator.numRowsDroppedByWatermark for operator in progress.stateOperators
        )

    def onQueryTerminated(self, event) -> None:
        pass
