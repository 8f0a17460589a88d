"""Readers of processed tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from phraseloom import schemas as S
from phraseloom.operators.ordering import file_order
from phraseloom.sources.landed import csv_by_header


def read_if_exists(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet") -> DataFrame | None:
    """A stored table, or None if it is not there."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        if fmt == "csv" and schema is not None:
            return csv_by_header(spark, path, schema).select(*schema.names)
        if fmt == "csv":
            reader = reader.options(header=True, multiLine=True, escape='"')
        return reader.load(path)
    except AnalysisException:
        return None


def read_table(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    df = read_if_exists(spark, path, schema, fmt)
    if df is None:
        raise FileNotFoundError(f"{path} not found")
    return df


def read_split(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One split of the stored detection set; the folder per split is the only one read."""
    return read_table(spark, path).filter(F.col("split") == name)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The stored retrieval index; raises if it has not been built."""
    df = read_if_exists(spark, path, S.INDEX)
    if df is None:
        raise FileNotFoundError(f"{path}: there is no index; build it first")
    return df.select(*S.INDEX.names)


def read_generator_test(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Evaluation pairs with their file order."""
    if fmt == "csv":
        return csv_by_header(spark, path, S.GENERATOR_TEST)
    return read_table(spark, path, S.GENERATOR_TEST, fmt).select("*", file_order(fmt).alias("row_ord"))
