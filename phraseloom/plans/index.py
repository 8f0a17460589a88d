"""Build the retrieval index: pairs, normalisation, deduplication, vectors, store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from phraseloom.functions import fixed_values as V
from phraseloom.operators.dedup import concat_sources, dedup_pairs
from phraseloom.operators.encode import encode_text
from phraseloom.operators.filters import PAIR_KEYS, complete_pairs, exclude_source, language_filter, normalize_pairs, require_columns
from phraseloom.operators.ordering import dense_position
from phraseloom.schemas import INDEX, UNIFIED_ORDERED
from phraseloom.sinks.tables import write_index, write_index_manifest
from phraseloom.sources import landed
from phraseloom.sources.tables import read_if_exists, read_index
from phraseloom.storage import stored, stored_until_done

BUILTIN_MODEL = "char-3gram-hash"


def read_pairs(spark: SparkSession, processed: str, raw: str, data_path: str | None = None) -> DataFrame:
    """Stored pairs, curated CSV files and the dictionary files, in this order; each may be missing.

    With `data_path`, that CSV file is the only input.
    """
    if data_path is not None:
        return concat_sources([landed.read_pair_csv(spark, data_path)])
    frames = []
    cross = read_if_exists(spark, f"{processed}/cross_lingual", UNIFIED_ORDERED)
    if cross is not None:
        frames.append(_one_source_order(cross))
    readers = [lambda: landed.read_pair_csv(spark, f"{raw}/*_idioms.csv")]
    readers += [
        lambda name=name: landed.read_meaning_json_pairs(spark, [f"{raw}/{name}"]) for name in V.DICTIONARY_LANGUAGES
    ]
    for reader in readers:
        try:
            frames.append(reader())
        except AnalysisException:
            continue
    if not frames:
        raise FileNotFoundError("no pairs: neither stored ones, nor CSV files, nor dictionaries")
    return concat_sources(frames)


def _one_source_order(stored: DataFrame) -> DataFrame:
    """Keep the source priority of a stored table inside its own order, below the new priority."""
    order = F.col("row_ord")
    file = F.concat_ws("|", F.lpad(order["priority"].cast("string"), 6, "0"), order["file"])
    return stored.withColumn("row_ord", order.withField("file", file))


def index_pairs(pairs: DataFrame, source_lang: str | None = None, target_lang: str | None = None) -> DataFrame:
    """Normalised, complete, deduplicated pairs without the generic parallel corpus."""
    require_columns(pairs, PAIR_KEYS)
    if "source" not in pairs.columns:
        pairs = pairs.withColumn("source", F.lit(None).cast("string"))
    kept = dedup_pairs(normalize_pairs(exclude_source(complete_pairs(pairs))))
    return language_filter(kept, source_lang, target_lang)


def number_rows(pairs: DataFrame) -> DataFrame:
    """row_id = position in the order of the pairs; a chunk is one file block.

    Rows of a source without order, and rows at one place, stand in the order of a hash of the pair, and a chunk of
    such rows is cut by that hash, so that none is larger than a block of a file.
    """
    place = pairs.withColumns({f"_{c}": F.col(f"row_ord.{c}") for c in ("priority", "file", "block")})
    pair = F.sha2(F.concat_ws("\x00", *[F.coalesce(c, F.lit("")) for c in PAIR_KEYS]), 256)
    part = F.when(F.col("row_ord.row").isNull(), F.substring(pair, 1, 4))
    place = place.withColumns({"_part": part, "_pair": pair})
    chunk = ["_priority", "_file", "_block", "_part"]
    return dense_position(place, chunk, ["row_ord", "_pair"], "row_id").drop(*chunk, "_pair")


def index_rows(pairs: DataFrame, encoder: Callable[[Column], Column] | None = None) -> DataFrame:
    """The index table from deduplicated pairs."""
    encoded = encode_text(number_rows(pairs), "source_idiom", encoder)
    return encoded.select(*INDEX.names)


def build_index(
    spark: SparkSession,
    pairs: DataFrame,
    out: str,
    source_lang: str | None = None,
    target_lang: str | None = None,
    encoder: Callable[[Column], Column] | None = None,
    model_name: str = BUILTIN_MODEL,
) -> DataFrame:
    """Write the index and its manifest; return the stored index. A build without pairs leaves a stored one alone."""
    with stored_until_done(spark):
        kept = stored(index_pairs(pairs, source_lang, target_lang))
        if kept.isEmpty():
            raise ValueError("no pair is left in these languages; the stored index was left as it is")
        write_index(index_rows(kept, encoder), f"{out}/index")
    index = read_index(spark, f"{out}/index")
    write_index_manifest(index, f"{out}/manifest", model_name)
    return index
