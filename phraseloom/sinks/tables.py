"""Writers. Tables split by a column are rebalanced on it first, so that a small value gives one
file and a value with a third of all rows is cut into several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from phraseloom.operators.filters import labelled_only, with_target
from phraseloom.operators.metrics import classification_report, confusion_matrix
from phraseloom.schemas import UNIFIED


def write_table(df: DataFrame, path: str, partition: str | None = None, fmt: str = "parquet") -> None:
    if partition is not None:
        df = df.hint("rebalance", partition)
    if fmt == "csv":
        df = df.drop("row_ord")
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, escape='"')
    if partition is not None:
        writer = writer.partitionBy(partition)
    writer.save(path)


def write_unified(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    keep = [*UNIFIED.names, *(["row_ord"] if "row_ord" in df.columns else [])]
    write_table(df.select(*keep), path, fmt=fmt)


def write_detection_subset(unified: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_table(labelled_only(unified), path, fmt=fmt)


def write_cross_lingual(unified: DataFrame, path: str, fmt: str = "parquet") -> None:
    # CSV stays one flat table with all its columns; Parquet gets a folder per target language.
    write_table(with_target(unified), path, None if fmt == "csv" else "target_lang", fmt)


def write_parallel_pairs(pairs: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_table(pairs, path, fmt=fmt)


def write_splits(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_table(df, path, "split", fmt)


def write_index(df: DataFrame, path: str) -> None:
    write_table(df, path, "target_lang")


def index_manifest(index: DataFrame, model_name: str) -> DataFrame:
    """One row: model name, rows, vector length, sorted languages."""
    return index.agg(
        F.lit(model_name).alias("model_name"),
        F.count(F.lit(1)).alias("rows_indexed"),
        F.max(F.size("embedding")).alias("embedding_dim"),
        F.sort_array(F.collect_set("source_lang")).alias("source_langs"),
        F.sort_array(F.collect_set("target_lang")).alias("target_langs"),
    )


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """A small report table as one file."""
    df.coalesce(1).write.mode("overwrite").format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(path)


def write_detection_report(scored: DataFrame, path: str) -> None:
    """Class report and confusion matrix of rows (actual, predicted)."""
    write_report(classification_report(scored), f"{path}/class_report")
    write_report(confusion_matrix(scored), f"{path}/confusion")


def write_translation_report(report: DataFrame, path: str) -> None:
    write_report(report, path)


def write_index_manifest(index: DataFrame, path: str, model_name: str) -> None:
    write_report(index_manifest(index, model_name), path)
