"""Concatenation of sources and keep-first deduplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from phraseloom.schemas import ROW_ORD

UNIFIED_KEY = ["source_idiom", "source_lang", "label"]
CLEAN_KEY = ["text", "label"]
PAIR_KEY = ["source_idiom", "source_lang", "target_idiom", "target_lang"]


def concat_sources(frames: list[DataFrame]) -> DataFrame:
    """Union by name with the union of all columns; the list order becomes the source priority."""
    if not frames:
        raise ValueError("no source to concatenate")
    ranked = []
    for i, df in enumerate(frames):
        if "row_ord" in df.columns:
            ranked.append(df.withColumn("row_ord", F.col("row_ord").withField("priority", F.lit(i))))
        else:
            empty_order = F.struct(F.lit(i).alias("priority"), *[F.lit(None).alias(f) for f in ROW_ORD.names[1:]])
            ranked.append(df.withColumn("row_ord", empty_order.cast(ROW_ORD)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by the order columns, all columns kept.

    min() over (order, other columns) is an aggregate with a map-side step: a key that holds a third
    of all rows shrinks to one row per task before the shuffle. The other columns follow the order, so
    that rows equal in the order still give one answer.
    """
    ranked = [*order, *[c for c in df.columns if c not in key and c not in order]]
    if not ranked:
        return df.distinct()
    first = df.groupBy(*key).agg(F.min(F.struct(*ranked)).alias("_first"))
    return first.select(*[c if c in key else F.col(f"_first.{c}").alias(c) for c in df.columns])


def dedup_unified(df: DataFrame) -> DataFrame:
    """First row of each (source_idiom, source_lang, label); the target is not part of the key."""
    return keep_first(df, UNIFIED_KEY, ["row_ord"])


def dedup_clean(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """First row of each (text, label)."""
    return keep_first(df, CLEAN_KEY, _order(df, order))


def dedup_pairs(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """First row of each (source_idiom, source_lang, target_idiom, target_lang)."""
    return keep_first(df, PAIR_KEY, _order(df, order))


def _order(df: DataFrame, order: list[str] | None) -> list[str]:
    if order is not None:
        return order
    return ["row_ord"] if "row_ord" in df.columns else []
