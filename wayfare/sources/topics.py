"""Kafka topics. The connector package must be on the session's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def topic_options(
    servers: str,
    name: str,
    start: str = "latest",
    group: str | None = None,
    rows_per_batch: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": name,
        "startingOffsets": start,
    }
    if group is not None:
        options["kafka.group.id"] = group
    if rows_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(rows_per_batch)
    return options


def topic(spark: SparkSession, servers: str, name: str, **how) -> DataFrame:
    """A topic as a stream; the message body is the binary column ``value``."""
    return spark.readStream.format("kafka").options(**topic_options(servers, name, **how)).load()
