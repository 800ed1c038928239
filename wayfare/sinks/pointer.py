"""A small file that names what is valid, replaced as a whole."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


def children(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder; none if there is no such folder."""
    path, system = _opened(spark, folder)
    if not system.exists(path):
        return []
    return [status.getPath().getName() for status in system.listStatus(path)]


def remove(spark: SparkSession, folder: str) -> None:
    path, system = _opened(spark, folder)
    system.delete(path, True)


class Pointer:
    """JSON under a fixed name. A reader sees the old content or the new one.

    New content is written beside it and renamed over it, which a file system does
    in one step. One writer at a time is expected.
    """

    def __init__(self, path: str) -> None:
        self.path = path

    def read(self, spark: SparkSession, default: Any) -> Any:
        path, system = _opened(spark, self.path)
        if not system.exists(path):
            return default
        stream = system.open(path)
        try:
            return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def replace(self, spark: SparkSession, content: Any) -> None:
        jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        path, system = _opened(spark, self.path)
        beside, _ = _opened(spark, f"{self.path}.{uuid.uuid4().hex}")
        stream = system.create(beside)
        try:
            stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            stream.close()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            system.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
        )
        context.rename(system.makeQualified(beside), system.makeQualified(path), options)


def _opened(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
