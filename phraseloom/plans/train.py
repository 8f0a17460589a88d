"""Train the detector on the stored splits and report on the test split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from phraseloom.operators.detector import fit_detector, load_model, predict, save_model
from phraseloom.operators.metrics import macro_metrics
from phraseloom.sinks.tables import write_detection_report, write_table
from phraseloom.sources.tables import read_split, read_table


def evaluate_detector(spark: SparkSession, splits_path: str, model_path: str, out: str) -> DataFrame:
    """Score the test split once, write predictions, class report and confusion matrix; return the metrics."""
    scored = predict(read_split(spark, splits_path, "test"), load_model(model_path)).select(
        "text",
        F.col("label").alias("actual"),
        F.col("detection.is_idiomatic").cast("int").alias("predicted"),
        F.col("detection.confidence").alias("confidence"),
    )
    write_table(scored, f"{out}/predictions")
    scored = read_table(spark, f"{out}/predictions")
    write_detection_report(scored, out)
    return macro_metrics(scored)


def train_and_evaluate(spark: SparkSession, splits_path: str, model_path: str, out: str) -> DataFrame:
    model, _ = fit_detector(read_split(spark, splits_path, "train"), read_split(spark, splits_path, "val"))
    save_model(model, model_path)
    return evaluate_detector(spark, splits_path, model_path, out)
