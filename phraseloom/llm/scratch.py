"""Written intermediate tables in the shared folder of the session."""

from __future__ import annotations

import sys
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` where the cluster names one, else a folder in the warehouse, which is shared too."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


class Scratch:
    """Tables of one operator call. A written table cuts lineage, survives lost executors and is read by every task.

    The caller drops a table once what was made from it is written; what the result still reads stays until the
    owner of the shared folder clears it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(conf).delete(path, True)


def process_cache() -> dict:
    """A dictionary of this Python process. Task code travels by value, so a module global would be new for each task."""
    return sys.__dict__.setdefault("_phraseloom_llm_cache", {})


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
