"""Clean the detection set and split it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from phraseloom.operators.dedup import dedup_clean
from phraseloom.operators.filters import clean_column, dropped_counts, min_tokens, nonempty_text, to_detection_columns
from phraseloom.operators.profile import imbalance_check, split_stats
from phraseloom.operators.sampling import require_rows
from phraseloom.operators.splitting import split_by_class_or_random
from phraseloom.schemas import DETECTION_SET
from phraseloom.sinks.tables import write_splits
from phraseloom.sources.tables import read_table
from phraseloom.storage import stored


def clean_detection(detection: DataFrame) -> DataFrame:
    """Drop empty and short text, clean, keep the first of each (text, label).

    The filters run on raw text, where they give the same rows, so that dropped rows are never cleaned.
    """
    long_enough = min_tokens(nonempty_text(to_detection_columns(detection)))
    return dedup_clean(clean_column(long_enough))


def run_preprocessing(spark: SparkSession, detection_path: str, out: str) -> dict[str, DataFrame]:
    """Write the split table; return the reports drops, imbalance and split_stats."""
    detection = read_table(spark, detection_path)
    # Stored once: the guards, the cut search and the write all read it.
    kept = stored(clean_detection(detection).select(*DETECTION_SET.names))
    require_rows(kept)
    write_splits(split_by_class_or_random(kept), f"{out}/splits")
    splits = read_table(spark, f"{out}/splits")
    return {
        "drops": dropped_counts(clean_column(to_detection_columns(detection))),
        "imbalance": imbalance_check(kept),
        "split_stats": split_stats(splits),
    }
