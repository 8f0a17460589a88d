"""Evaluate translations of a stored test set and write the report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from phraseloom.operators.evaluate import evaluate_translations
from phraseloom.sinks.tables import write_translation_report
from phraseloom.sources.tables import read_generator_test, read_index, read_table
from phraseloom.storage import stored_until_done


def run_evaluation(
    spark: SparkSession, test_path: str, processed: str, detector, language: str, n: int | None = None, fmt: str = "csv", **how
) -> DataFrame:
    """Translate the test pairs of a language, all or the first n, against the stored index; write and return the report.

    The report goes to `processed`/translation_report/<language>.
    """
    out = f"{processed}/translation_report/{language.lower()}"
    with stored_until_done(spark):
        test = read_generator_test(spark, test_path, fmt)
        report = evaluate_translations(test, read_index(spark, f"{processed}/index"), detector, language, n, **how)
        write_translation_report(report, out)
    return read_table(spark, out, report.schema, "json")
