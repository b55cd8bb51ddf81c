"""Staged tables: written once, read back as plain Parquet.

Several operators pass over the same candles (row counts, carries, the rows
themselves).  Staging the candles first means the trades behind them are read
and shuffled once, lost executors never rebuild them, and Catalyst knows the
real size of the table when it picks a join.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only for a local master."""
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tickloom-")
    return _local_folders[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _written(df: DataFrame, label: str) -> tuple[str, DataFrame]:
    path = fresh_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and returns the written table."""
    return _written(df, label)[1]


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``stage`` for as long as the block runs; the copy is deleted after it, so nothing may read it later."""
    path, written = _written(df, label)
    try:
        yield written
    finally:
        _delete(df.sparkSession, path)


class Scratch:
    """Staged tables of one job: each can be dropped once nothing reads it, the others go at the end of the block.

    What the block returns must not read them.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[str, DataFrame]] = {}

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        path, written = _written(df, label)
        self.paths[id(written)] = path, written
        return written

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path, _ = self.paths.pop(id(table), (None, None))
            if path:
                _delete(self.spark, path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure) -> None:
        self.drop(*(table for _, table in self.paths.values()))
