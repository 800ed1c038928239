"""Message decoding and encoding: JSON and CSV in a ``value`` column.

Every decoder works on batch and streaming tables alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.clock import PRODUCER_CLOCK, TRANSACTION_CLOCK
from wayfare.schemas import TRANSACTION

CORRUPT = "corrupt_record__"


def message_text(value: str = "value") -> Column:
    """The message body as text (bytes are UTF-8)."""
    return F.col(value).cast("string")


def decode_json(
    df: DataFrame,
    schema: str,
    value: str = "value",
    strict: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The fields of a JSON message, after the columns to ``keep``.

    A malformed message gives null fields, or with ``strict`` fails the job.
    Unknown fields are ignored.
    """
    options = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    record = F.from_json(message_text(value), schema, options)
    # Through a generator, so that conditions on the fields stay above the
    # decoding: pushed below it they would decode each message once more.
    return df.select(*keep, F.inline_outer(F.array(record)))


def split_json(
    df: DataFrame, schema: str, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Good records and dead letters (the unreadable texts, in ``value``)."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    record = F.from_json(message_text(value), f"{schema}, {CORRUPT} string", options)
    parsed = df.select(message_text(value).alias("text__"), F.inline_outer(F.array(record)))
    broken = F.col("text__").isNull() | F.col(CORRUPT).isNotNull()
    good = parsed.where(~broken).drop(CORRUPT, "text__")
    return good, parsed.where(broken).select(F.col("text__").alias("value"))


def encode_json(
    columns: Sequence[str | Column], clock: str = PRODUCER_CLOCK
) -> Column:
    """A JSON text with the given fields; timestamps in the producer's form."""
    return F.to_json(F.struct(*columns), {"timestampFormat": clock})


def as_messages(
    df: DataFrame, columns: Sequence[str | Column], clock: str = PRODUCER_CLOCK
) -> DataFrame:
    """Rows to JSON messages: one ``value`` column, as a topic sink takes it."""
    return df.select(encode_json(columns, clock).alias("value"))


def decode_transactions(
    df: DataFrame, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """``account, amount, time`` CSV messages to typed transactions."""
    options = {"ignoreLeadingWhiteSpace": "true", "timestampFormat": TRANSACTION_CLOCK}
    record = F.from_csv(message_text(value), F.lit(TRANSACTION), options)
    # Through a generator for the same reason as in decode_json.
    return df.select(*keep, F.inline_outer(F.array(record)))


def encode_transaction(account: Column, amount: Column, ts: Column) -> Column:
    """A transaction as ``account, amount, time`` text."""
    return F.concat_ws(", ", account, amount, F.date_format(ts, TRANSACTION_CLOCK))
