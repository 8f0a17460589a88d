"""Storing an intermediate table, to cut lineage and to stop work from running twice."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Tables this process has stored and not yet dropped.
_STORED: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` where the session has one, else a folder in the warehouse; never one of a single machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stored"


def new_path(spark: SparkSession, label: str = "stored") -> str:
    """A new folder for an intermediate table, which drop_stored() will delete."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _STORED.append(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """The same rows, computed once, written as Parquet and read back, so that readers prune columns and filters."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _drop(spark: SparkSession, keep: int) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while len(_STORED) > keep:
        path = jvm.org.apache.hadoop.fs.Path(_STORED.pop())
        path.getFileSystem(conf).delete(path, True)


def drop_stored(spark: SparkSession) -> None:
    """Delete all tables that stored() has written; for the job that owns them, once its results are written."""
    _drop(spark, 0)


@contextmanager
def stored_until_done(spark: SparkSession) -> Iterator[None]:
    """Delete what was stored inside, at the end; for jobs that write their results."""
    had = len(_STORED)
    try:
        yield
    finally:
        _drop(spark, had)
