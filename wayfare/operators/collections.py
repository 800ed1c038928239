"""Jobs over runs of equal values and over key/value rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.operators.slicing import PART, By, handed_on, in_parts, in_place, same_keys


def drop_repeats(
    df: DataFrame, keys: Sequence[str], value: str, order: Sequence[By]
) -> DataFrame:
    """Keep a row if its value differs from the row before it in its group.

    The first row of a group is kept always. ``order`` must be a total order.
    """
    local = in_place(keys)
    flagged = in_parts(df, keys, order).withColumns(
        {
            "first__": F.row_number().over(local) == 1,
            "before__": F.lag(value).over(local),
            "last__": F.lead(F.lit(True)).over(local).isNull(),
        }
    )
    # The first row of a part is compared with the group's last value before it.
    last = flagged.where("last__").select(PART, *keys, F.struct(value).alias("handed__"))
    walk = Window.partitionBy(*keys).orderBy(PART)
    last = last.withColumn("handed__", F.lag("handed__").over(walk))
    joined = handed_on(flagged, last, keys, "handed__")
    kept = F.when(
        F.col("first__"),
        F.col("handed__").isNull() | ~F.col(value).eqNullSafe(F.col(f"handed__.{value}")),
    ).otherwise(~F.col(value).eqNullSafe(F.col("before__")))
    return joined.where(kept).select(*df.columns)


def records_from_pairs(
    df: DataFrame, identity: str, key: str, value: str, fields: Sequence[str]
) -> DataFrame:
    """Key/value rows to one row per identity with a column per field.

    A missing key gives an empty string and unknown keys are ignored. If a key
    occurs twice, the greater value wins.
    """
    chosen = [
        F.coalesce(F.max(F.when(F.col(key) == name, F.col(value))), F.lit("")).alias(name)
        for name in fields
    ]
    return df.groupBy(identity).agg(*chosen)


# Types of which a hash aggregate can keep the greatest value in place.
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """The last row of each key in ``version`` order (a total order), nulls first.

    Rows are not sorted or carried through an aggregate: the last versions
    are found by hash aggregates over keys and versions alone, and the rows that have
    them are kept. So ``df`` is read twice and must give the same rows both
    times; `latest_in_one_pass` reads it once. Rows that repeat each
    other wholly are one. Other rows of equal version are all kept.

    A version that is not of fixed width (text) cannot be kept in a hash aggregate,
    nor can maps be compared; then it is one pass as well.
    """
    types = {field.name: field.dataType for field in df.schema}
    fixed = all(isinstance(types[name], FIXED_WIDTH) for name in version)
    if not fixed or any("map<" in kind.simpleString() for kind in types.values()):
        return latest_in_one_pass(df, keys, version)
    return rows_at(df, latest_versions(df, keys, version), [*keys, *version]).distinct()


def latest_versions(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The greatest ``version`` of each key, columns compared from the left, nulls first.

    From the last column to the first: its greatest value for each value of the
    columns before, and with it what was found for the columns behind.
    """
    best = df.select(*keys, *version)
    for k in reversed(range(len(version))):
        name, behind = version[k], version[k + 1 :]
        # Each value of ``name`` has one row by now, so a null has nobody beside it
        # if it is the greatest.
        found = [
            F.when(F.max(name).isNull(), F.max(other)).otherwise(F.max_by(other, name)).alias(other)
            for other in behind
        ]
        best = best.groupBy(*keys, *version[:k]).agg(F.max(name).alias(name), *found)
    return best


def rows_at(df: DataFrame, places: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows whose ``columns`` equal those of a row of ``places``, null-safe."""
    renamed = places.select(*[F.col(name).alias(f"at_{name}__") for name in columns])
    pairs = [(name, f"at_{name}__") for name in columns]
    return df.join(renamed, same_keys(df, renamed, pairs), "left_semi")


def latest_in_one_pass(
    df: DataFrame, keys: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """The last row of each key, for rows that can be read once only, such as a
    batch of a stream.

    An aggregate, not a window: each task sends at most one row per key. As whole
    rows are carried, a task sorts them by key.
    """
    rest = [name for name in df.columns if name not in (*keys, *version)]
    row = F.struct(*version, *rest)
    last = df.groupBy(*keys).agg(F.max_by(row, F.struct(*version)).alias("row__"))
    taken = {name: F.col(f"row__.`{name}`") for name in (*version, *rest)}
    return last.select(
        *[taken[name].alias(name) if name in taken else F.col(name) for name in df.columns]
    )
