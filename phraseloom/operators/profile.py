"""Counts, balances, length statistics and the leakage check. Each is one grouped aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from phraseloom.functions import fixed_values as V
from phraseloom.functions.text import label_name, token_count


def _rows(weight: str | None) -> Column:
    """Number of rows, or of the rows that stand behind a table of counts with that column."""
    return (F.count(F.lit(1)) if weight is None else F.coalesce(F.sum(weight), F.lit(0))).alias("n")


def row_count(df: DataFrame, weight: str | None = None) -> DataFrame:
    return df.agg(_rows(weight))


def counts_by(df: DataFrame, *cols: str, weight: str | None = None) -> DataFrame:
    return df.groupBy(*cols).agg(_rows(weight))


def label_distribution(df: DataFrame) -> DataFrame:
    """Rows per class of the detection set, by class name."""
    return counts_by(df, "label").select(label_name("label").alias("label_name"), "n")


def class_balance(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows, percent to one place and a bar of up to 30 characters per class."""
    share = F.col("n") / F.sum("n").over(Window.partitionBy())
    bar = F.repeat(F.lit("█"), F.floor(F.lit(V.BAR_CHARS) * share).cast("int"))
    return counts_by(df, "label", weight=weight).select(
        label_name("label").alias("label_name"),
        "n",
        F.round(100 * share, 1).alias("pct"),
        bar.alias("bar"),
    )


def split_stats(df: DataFrame) -> DataFrame:
    """Rows and percent of each class within each split."""
    total = F.sum("n").over(Window.partitionBy("split"))
    return counts_by(df, "split", "label").select(
        "split", label_name("label").alias("label_name"), "n", F.round(100 * F.col("n") / total, 1).alias("pct")
    )


def imbalance_check(df: DataFrame, threshold: float = V.IMBALANCE_THRESHOLD) -> DataFrame:
    """Smallest class over largest class; flagged below the threshold; 0 and no flag for no rows."""
    ratio = F.coalesce(F.min("n") / F.max("n"), F.lit(0.0))
    return (
        counts_by(df.filter(F.col("label").isNotNull()), "label")
        .agg(
            F.coalesce(F.min("n"), F.lit(0)).alias("minority"),
            F.coalesce(F.max("n"), F.lit(0)).alias("majority"),
            ratio.alias("ratio"),
        )
        .withColumn("imbalanced", (F.col("ratio") < threshold) & (F.col("majority") > 0))
    )


def length_counts(df: DataFrame, col: str = "text", *by: str) -> DataFrame:
    """Rows per token count (null for no text) and more columns: a small table, whatever the number of rows."""
    return df.groupBy(*by, token_count(col).alias("tokens")).agg(F.count(F.lit(1)).alias("n"))


def token_length_stats(df: DataFrame, col: str = "text") -> DataFrame:
    """Minimum, maximum, mean to one place and exact median of the token counts."""
    return length_stats(length_counts(df, col))


def length_stats(counts: DataFrame) -> DataFrame:
    """The same from a table of length_counts()."""
    known = counts.filter("tokens IS NOT NULL").groupBy("tokens").agg(F.sum("n").alias("n"))
    return known.agg(
        F.min("tokens").alias("min_tokens"),
        F.max("tokens").alias("max_tokens"),
        F.round(F.sum(F.col("tokens") * F.col("n")) / F.sum("n"), 1).alias("mean_tokens"),
        F.percentile("tokens", 0.5, F.col("n")).alias("median_tokens"),
    )


def token_length_histogram(df: DataFrame, col: str = "text") -> DataFrame:
    return length_histogram(length_counts(df, col))


def length_histogram(counts: DataFrame) -> DataFrame:
    """Rows per length bucket, empty buckets with 0; the last bucket is open and has no upper bound."""
    buckets = list(zip(V.LENGTH_BOUNDS, [*V.LENGTH_BOUNDS[1:], None]))
    # Conditional sums and not a filter on the bucket: a filter would be pushed below the count and
    # would split every text once per bound.
    sums = [
        F.sum(F.when((F.col("tokens") >= lo) & (F.lit(True) if hi is None else F.col("tokens") < hi), F.col("n"))).alias(f"from{lo}")
        for lo, hi in buckets
    ]
    rows = [
        F.struct(
            F.lit(lo).alias("lo"),
            F.lit(hi).cast("int").alias("hi"),
            F.coalesce(F.col(f"from{lo}"), F.lit(0)).cast("bigint").alias("n"),
        )
        for lo, hi in buckets
    ]
    return counts.agg(*sums).select(F.inline(F.array(*rows)))


def source_breakdown(df: DataFrame, weight: str | None = None) -> DataFrame:
    return counts_by(df.filter(F.col("source").isNotNull()), "source", weight=weight).orderBy(F.desc("n"), "source")


def language_counts(df: DataFrame, weight: str | None = None) -> DataFrame:
    return counts_by(df.filter(F.col("source_lang").isNotNull()), "source_lang", weight=weight).orderBy(F.desc("n"), "source_lang")


def pair_coverage(df: DataFrame, top: int = V.PAIR_REPORT_ROWS, weight: str | None = None) -> DataFrame:
    """The most frequent language pairs; a pair with a missing language does not count."""
    pair = F.concat(F.col("source_lang"), F.lit(" → "), F.col("target_lang"))
    return (
        df.withColumn("pair", pair)
        .filter(F.col("pair").isNotNull())
        .groupBy("pair")
        .agg(_rows(weight))
        .orderBy(F.desc("n"), "pair")
        .limit(top)
    )


def distinct_languages(df: DataFrame) -> DataFrame:
    return df.agg(
        F.sort_array(F.collect_set("source_lang")).alias("source_langs"),
        F.sort_array(F.collect_set("target_lang")).alias("target_langs"),
    )


def leakage_check(df: DataFrame) -> DataFrame:
    """Distinct texts shared by two splits, from one shuffle on a 128-bit digest of the text.

    No row comes out if a split is empty, since there is nothing to compare then.
    """
    bit = F.when(F.col("split") == "train", 1).when(F.col("split") == "val", 2).when(F.col("split") == "test", 4)
    seen = df.groupBy(F.unhex(F.md5("text")).alias("digest")).agg(F.bit_or(bit).alias("m"))

    def having(mask: int) -> Column:
        return F.count_if(F.col("m").bitwiseAND(mask) == mask)

    counts = seen.agg(
        having(3).alias("train_val"),
        having(5).alias("train_test"),
        having(6).alias("val_test"),
        F.bit_or("m").alias("_any"),
    )
    clean = (F.col("train_val") + F.col("train_test") + F.col("val_test")) == 0
    return counts.filter(F.col("_any") == 7).drop("_any").withColumn("clean", clean)
