"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_STATE = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Row-level joins rely on this to split a hot key over many tasks.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # State larger than the heap, incremental checkpoints, event-time timers.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_STATE,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str = "wayfare", master: str | None = None, **conf: str
) -> SparkSession:
    """A session with this package's settings.

    The number of shuffle partitions is left to the cluster: pass
    ``**{"spark.sql.shuffle.partitions": ...}`` to set it. Adaptive execution
    merges small partitions, so a high number is the safe choice.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Set runtime SQL options for a block and put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Where the session names none, one is made only if driver and executors are
    one process; on a cluster that is an error, as each machine would write to
    a disk of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        named = _local_folder()
    return named.rstrip("/")


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="wayfare-")


_paths: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("paths", default=None)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end of the block what was written to the shared folder in it.

    For a caller that has stored its results by then; without it the intermediate
    tables stay until the folder is cleared.
    """
    made: list[str] = []
    token = _paths.set(made)
    try:
        yield
    finally:
        _paths.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for name in made:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path of its own below the shared folder; nothing is created yet."""
    path = f"{shared_folder(spark)}/wayfare/{label}-{uuid.uuid4().hex}"
    if (made := _paths.get()) is not None:
        made.append(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    planner the true size of what was written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
