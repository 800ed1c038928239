"""Keyed tables: the last write of a key replaces the ones before."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.operators.collections import latest_in_one_pass, latest_per_key
from wayfare.sinks.pointer import Pointer, children, remove

BATCH, BUCKET = "batch_id", "bucket__"
NOTHING: dict[str, Any] = {"folded": None, "bases": {}, "batches": []}


class KeyedTable:
    """Parquet dealt to buckets by key, read as last-row-per-key.

    Each micro-batch is a folder with a file for each bucket it touches, so a write
    costs the size of the batch. Before every ``fold_after``-th batch the ones
    before are folded: the buckets that they touch are written anew with their last rows.
    So a reader opens a base and at most ``fold_after`` batches of a bucket,
    whatever the age of the table, and a fold costs the touched buckets once in
    ``fold_after`` batches.

    What is valid stands in a pointer file that is replaced as a whole, after what it
    names is written. A run that dies before that leaves a folder behind that nobody
    reads and the next run replaces. The newest batch is never folded, as a stream may hand
    it over again; writing it again replaces its folder. Folders that are no
    longer valid stay until `vacuum`, for readers that began earlier.

    The last row of a key is the one with the greatest ``version``; then the later
    batch wins. Without a version a batch must bring a key once. Nulls are
    stored like any value. One stream at a time may write.
    """

    def __init__(
        self,
        path: str,
        schema: str,
        keys: Sequence[str],
        version: Sequence[str] = (),
        buckets: int = 16,
        fold_after: int = 8,
    ) -> None:
        self.path = path
        self.schema = schema
        self.keys = list(keys)
        self.version = list(version)
        self.buckets = buckets
        self.fold_after = fold_after
        self._pointer = Pointer(f"{path}/pointer.json")

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Store one micro-batch; fold the ones before if there are enough."""
        spark = batch.sparkSession
        state = self._pointer.read(spark, NOTHING)
        if state["folded"] is not None and batch_id <= state["folded"]:
            raise ValueError(f"batch {batch_id} is folded already; is this another stream?")
        before = [n for n in state["batches"] if n < batch_id]
        if len(before) >= self.fold_after:
            state = self._fold(spark, state, before)
        rows = self._shaped(batch).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        self._write(rows, f"batch-{batch_id}")
        if batch_id not in state["batches"]:
            self._pointer.replace(spark, {**state, "batches": sorted([*state["batches"], batch_id])})

    def current(self, spark: SparkSession) -> DataFrame:
        """The table as it stands."""
        return self._resolved(spark, self._folders(self._pointer.read(spark, NOTHING)))

    def before(self, spark: SparkSession, batch_id: int, keys_of: DataFrame | None = None) -> DataFrame:
        """The table as it stood before a batch, which may be stored already.

        With ``keys_of`` the buckets of its keys only, so that all of their rows are there.
        """
        state = self._pointer.read(spark, NOTHING)
        state = {**state, "batches": [n for n in state["batches"] if n < batch_id]}
        if keys_of is None:
            return self._resolved(spark, self._folders(state))
        # A number for each bucket at most.
        touched = [row[0] for row in keys_of.select(self._bucket()).distinct().collect()]
        return self._resolved(spark, self._folders_of(spark, state, touched))

    def lookup(self, spark: SparkSession, *key: Any) -> DataFrame:
        """The row of one key; only its bucket is read."""
        fields = self._fields(self.keys)
        wanted = spark.createDataFrame([key], T.StructType(fields))
        bucket = wanted.select(self._bucket()).first()[0]
        folders = self._folders_of(spark, self._pointer.read(spark, NOTHING), [bucket])
        same = F.lit(True)
        for field, value in zip(fields, key):
            same &= F.col(field.name).eqNullSafe(F.lit(value).cast(field.dataType))
        return self._resolved(spark, folders, same)

    def changes(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """What a batch does to the table: each touched key's row ``old`` and ``new``.

        ``old`` is null for a new key. A key whose row stays the same, as its version is
        later, is left out. Ask before or after the batch is stored; the answer is the same.
        """
        names = [field.name for field in self._fields()]
        batch = self._shaped(batch)
        come = batch.select(F.struct(*names).alias("come"))
        held = self.before(batch.sparkSession, batch_id, batch).select(F.struct(*names).alias("old"))
        condition = F.lit(True)
        for key in self.keys:
            condition &= F.col(f"come.`{key}`").eqNullSafe(F.col(f"old.`{key}`"))
        both = come.join(held, condition, "left")
        wins = F.lit(True)
        if self.version:
            wins = F.col("old").isNull() | (self._order("come") >= self._order("old"))
        changed = both.where(wins & ~F.col("come").eqNullSafe(F.col("old")))
        return changed.select(*[F.col(f"come.`{key}`").alias(key) for key in self.keys], "old", F.col("come").alias("new"))

    def fold_into(self, other: KeyedTable, spark: SparkSession, batch_id: int = 0) -> None:
        """Write the current rows as one batch of another table."""
        other.upsert(self.current(spark), batch_id)

    def vacuum(self, spark: SparkSession) -> int:
        """Delete what the pointer does not name; returns how many folders.

        A reader that began before the last fold may fail.
        """
        state = self._pointer.read(spark, NOTHING)
        valid = set(self._folders(state))
        gone = 0
        for name in children(spark, f"{self.path}/rows"):
            if name in valid:
                continue
            kept = False
            for part in children(spark, f"{self.path}/rows/{name}"):
                if f"{name}/{part}" in valid:
                    kept = True
                elif part.startswith(BUCKET):
                    remove(spark, f"{self.path}/rows/{name}/{part}")
                    gone += 1
            if not kept:
                remove(spark, f"{self.path}/rows/{name}")
        return gone

    def _fold(self, spark: SparkSession, state: dict, batches: list[int]) -> dict:
        touched = {
            part.partition("=")[2]
            for n in batches
            for part in children(spark, f"{self.path}/rows/batch-{n}")
            if part.startswith(f"{BUCKET}=")
        }
        bases = [f"{base}/{BUCKET}={k}" for k, base in state["bases"].items() if k in touched]
        rows = self._read(spark, [*bases, *[f"batch-{n}" for n in batches]])
        name = f"fold-{batches[-1]}"
        self._write(latest_per_key(rows, self.keys, [*self.version, BATCH]), name)
        folded = {
            "folded": batches[-1],
            "bases": {**state["bases"], **{k: name for k in touched}},
            "batches": [n for n in state["batches"] if n > batches[-1]],
        }
        self._pointer.replace(spark, folded)
        return folded

    def _fields(self, names: Sequence[str] | None = None) -> list[T.StructField]:
        fields = T.StructType.fromDDL(self.schema).fields
        by_name = {field.name: field for field in fields}
        return fields if names is None else [by_name[name] for name in names]

    def _order(self, row: str) -> Column:
        return F.struct(*[F.col(f"{row}.`{name}`") for name in self.version])

    def _bucket(self) -> Column:
        # The hash depends on the type, so the key is hashed as it is stored.
        keys = [F.col(f"`{field.name}`").cast(field.dataType) for field in self._fields(self.keys)]
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def _shaped(self, batch: DataFrame) -> DataFrame:
        """A batch's last rows in the table's columns and types."""
        columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self._fields()]
        rows = batch.select(*columns)
        return latest_in_one_pass(rows, self.keys, self.version) if self.version else rows

    def _write(self, rows: DataFrame, name: str) -> None:
        bucketed = rows.withColumn(BUCKET, self._bucket())
        # All rows of a bucket are in one task, so a bucket is one file.
        bucketed.repartition(self.buckets, BUCKET).write.partitionBy(BUCKET).mode("overwrite").parquet(
            f"{self.path}/rows/{name}"
        )

    def _folders(self, state: dict) -> list[str]:
        bases = [f"{base}/{BUCKET}={k}" for k, base in sorted(state["bases"].items())]
        return [*bases, *[f"batch-{n}" for n in state["batches"]]]

    def _folders_of(self, spark: SparkSession, state: dict, buckets: Sequence[int]) -> list[str]:
        names = {f"{BUCKET}={k}" for k in buckets}
        bases = [f for f in self._folders({**state, "batches": []}) if f.partition("/")[2] in names]
        found = {n: children(spark, f"{self.path}/rows/batch-{n}") for n in state["batches"]}
        return [*bases, *[f"batch-{n}/{part}" for n, parts in found.items() for part in parts if part in names]]

    def _read(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        schema = f"{self.schema}, {BATCH} bigint"
        if not folders:
            return spark.createDataFrame([], schema)
        reader = spark.read.schema(schema).option("recursiveFileLookup", True)
        return reader.parquet(*[f"{self.path}/rows/{name}" for name in folders])

    def _resolved(self, spark: SparkSession, folders: list[str], where: Column | None = None) -> DataFrame:
        rows = self._read(spark, folders)
        if where is not None:
            rows = rows.where(where)
        return latest_per_key(rows, self.keys, [*self.version, BATCH]).drop(BATCH)


def to_format(
    source: str, options: dict[str, str], keys: Sequence[str], version: Sequence[str]
) -> Callable[[DataFrame, int], None]:
    """A batch writer for a store that upserts by its own primary key.

    The last row per key is chosen first, so that the order in which tasks
    write does not matter.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        latest_in_one_pass(batch, keys, version).write.format(source).options(**options).mode(
            "append"
        ).save()

    return write


def cassandra(
    keyspace: str, table: str, keys: Sequence[str], version: Sequence[str]
) -> Callable[[DataFrame, int], None]:
    """Upserts into a Cassandra table; the connector must be on the class path.
    Null fields overwrite."""
    options = {
        "keyspace": keyspace,
        "table": table,
        "spark.cassandra.output.ignoreNulls": "false",
    }
    return to_format("org.apache.spark.sql.cassandra", options, keys, version)
