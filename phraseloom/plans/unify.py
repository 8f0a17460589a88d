"""Build the unified corpus and its three subsets from landed sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from phraseloom.functions import fixed_values as V
from phraseloom.operators.dedup import concat_sources, dedup_unified
from phraseloom.operators.filters import labelled_only
from phraseloom.operators.profile import label_distribution
from phraseloom.schemas import UNIFIED_ORDERED
from phraseloom.sinks import tables as sinks
from phraseloom.sources import landed
from phraseloom.sources.tables import read_table
from phraseloom.storage import stored_until_done

# Order of concatenation; "first" in the deduplication means first in this order.
ORDER = ["labelled", "tagged", "multilingual", "parallel", "malayalam", "telugu", "hindi"]


def read_sources(
    spark: SparkSession, raw: str, fallbacks: dict[str, str] | None = None, sample_n: int | None = V.PARALLEL_SAMPLE
) -> dict[str, DataFrame]:
    """The seven sources below one folder, each stored; what cannot be read is replaced by its fallback CSV or left out.

    `sample_n` rows of the parallel corpus are sampled; None takes all.
    """
    fallbacks = fallbacks or {}
    readers = {
        "labelled": (landed.read_labelled_sentences, f"{raw}/labelled"),
        "tagged": (landed.read_tagged_tokens, f"{raw}/tagged"),
        "multilingual": (landed.read_multilingual_map, f"{raw}/multilingual"),
        "parallel": (lambda s, p: landed.read_parallel_corpus(s, p, sample_n), f"{raw}/parallel"),
        "malayalam": (lambda s, p: landed.read_idiom_json(s, p, "ml"), f"{raw}/malayalam.json"),
        "telugu": (lambda s, p: landed.read_idiom_json(s, p, "te"), f"{raw}/telugu.json"),
        "hindi": (lambda s, p: landed.read_idiom_json(s, p, "hi"), f"{raw}/hindi.json"),
    }
    return {
        name: landed.read_or_fallback(spark, reader, path, fallbacks.get(name))
        for name, (reader, path) in readers.items()
    }


def unify(sources: dict[str, DataFrame]) -> DataFrame:
    """Concatenate in the fixed order and keep the first row of each key."""
    return dedup_unified(concat_sources([sources[name] for name in ORDER if name in sources]))


def build_unified_dataset(
    spark: SparkSession,
    raw: str,
    out: str,
    fallbacks: dict[str, str] | None = None,
    fmt: str = "parquet",
    sample_n: int | None = V.PARALLEL_SAMPLE,
) -> DataFrame:
    """Write unified, detection_only, cross_lingual and hindi_pairs; return the label distribution.

    Nothing is overwritten before there is something to write: without any row the stored tables stay as they
    are, and without parallel rows the stored pairs do. The unified table is written once, and the subsets are
    scans of it.
    """
    with stored_until_done(spark):
        # Every source is stored by the one read of it.
        sources = read_sources(spark, raw, fallbacks, sample_n)
        if all(source.isEmpty() for source in sources.values()):
            raise ValueError("none of the sources holds a row; the stored tables were left as they are")
        # Pairs are saved before the deduplication over all sources.
        if not sources["parallel"].isEmpty():
            sinks.write_parallel_pairs(sources["parallel"], f"{out}/hindi_pairs", fmt)
        sinks.write_unified(unify(sources), f"{out}/unified_idioms")
    unified = read_table(spark, f"{out}/unified_idioms", UNIFIED_ORDERED)
    if fmt != "parquet":
        sinks.write_unified(unified, f"{out}/unified_idioms_{fmt}", fmt)
    sinks.write_detection_subset(unified, f"{out}/detection_only", fmt)
    sinks.write_cross_lingual(unified, f"{out}/cross_lingual", fmt)
    return label_distribution(labelled_only(unified))
