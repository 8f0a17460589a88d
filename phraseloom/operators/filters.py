"""Row filters and the column prune of the detection set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from phraseloom.functions import fixed_values as V
from phraseloom.functions.text import clean_text, is_blank, normalize_text, token_count


def to_detection_columns(df: DataFrame) -> DataFrame:
    """Unified table -> text, label, idiom_string, source; keeps the row order if there is one."""
    extra = ["row_ord"] if "row_ord" in df.columns else []
    return df.select(F.col("source_idiom").alias("text"), "label", "idiom_string", "source", *extra)


def labelled_only(df: DataFrame) -> DataFrame:
    """Rows of the two classes."""
    return df.filter(F.col("label").isin(0, 1))


def with_target(df: DataFrame) -> DataFrame:
    """Rows with a target phrase."""
    return df.filter(~is_blank("target_idiom"))


PAIR_KEYS = ["source_idiom", "source_lang", "target_idiom", "target_lang"]


def normalize_pairs(df: DataFrame) -> DataFrame:
    return df.withColumns({c: normalize_text(c) for c in PAIR_KEYS})


def complete_pairs(df: DataFrame) -> DataFrame:
    """Rows whose two phrases and two languages are all present."""
    keep = F.lit(True)
    for c in PAIR_KEYS:
        keep = keep & ~is_blank(c)
    return df.filter(keep)


def exclude_source(df: DataFrame, source: str = V.SOURCE_PARALLEL) -> DataFrame:
    """Drop one source, in any case; rows without a source stay."""
    return df.filter(F.lower(F.coalesce(F.col("source"), F.lit(""))) != source.lower())


def clean_column(df: DataFrame, col: str = "text") -> DataFrame:
    return df.withColumn(col, clean_text(col))


def nonempty_text(df: DataFrame, col: str = "text") -> DataFrame:
    return df.filter(~is_blank(col))


def min_tokens(df: DataFrame, n: int = V.MIN_TOKENS, col: str = "text") -> DataFrame:
    """Rows with at least n tokens. Cleaning changes no token count, so this may run on raw text."""
    return df.filter(token_count(col) >= n)


def dropped_counts(cleaned: DataFrame, n: int = V.MIN_TOKENS) -> DataFrame:
    """One row: rows in, blank, too short, repeated, kept.

    `cleaned` holds cleaned text before any filter. Only a 128-bit digest of the text is shuffled, and
    copies of a hot text merge before that.
    """
    digests = cleaned.select(
        "label", F.unhex(F.md5("text")).alias("digest"), token_count("text").alias("tokens")
    )
    groups = digests.groupBy("digest", "label").agg(
        F.count(F.lit(1)).alias("copies"), F.max("tokens").alias("tokens")
    )
    blank = F.col("tokens") == 0
    short = ~blank & (F.col("tokens") < n)
    kept = ~(blank | short)

    def total(cond: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("bigint")

    copies = F.col("copies")
    return groups.agg(
        total(F.lit(True), copies).alias("rows_in"),
        total(blank, copies).alias("blank_dropped"),
        total(short, copies).alias("short_dropped"),
        total(kept, copies - 1).alias("duplicates_removed"),
        total(kept, F.lit(1)).alias("rows_kept"),
    )


def language_filter(df: DataFrame, source_lang: str | None = None, target_lang: str | None = None) -> DataFrame:
    """Optional equality on either language; on a table partitioned by target_lang it prunes folders."""
    if source_lang:
        df = df.filter(F.col("source_lang") == source_lang)
    if target_lang:
        df = df.filter(F.col("target_lang") == target_lang)
    return df


def idiomatic_only(df: DataFrame) -> DataFrame:
    """Gate: only rows detected as idiomatic go on to the costly stages."""
    return df.filter(F.col("detection.is_idiomatic"))


def split_blank(df: DataFrame, col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows with text, rejected rows with an error text)."""
    rejected = df.filter(is_blank(col)).withColumn("error", F.lit(V.MESSAGE_BLANK))
    return df.filter(~is_blank(col)), rejected


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Raise before any job runs if a column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"these columns are not there: {missing}")
    return df
