"""One long table of all profile numbers: (table_name, metric, item, value)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from phraseloom.functions import fixed_values as V
from phraseloom.functions.text import label_name, token_count
from phraseloom.operators import profile as P
from phraseloom.operators.sampling import sample_rows
from phraseloom.storage import stored

SPLITS = ("train", "val", "test")
COUNTED = ["table_name", "a", "b", "tokens"]


def _long(table: str, metric: str, item: Column, value: Column) -> list[Column]:
    return [F.lit(table).alias("table_name"), F.lit(metric).alias("metric"), item.cast("string").alias("item"), value.cast("string").alias("value")]


def _counted(df: DataFrame, table: str | Column, a: Column | None = None, b: Column | None = None, tokens: Column | None = None) -> DataFrame:
    """What the report counts of a row: up to two names, or a name and a length."""
    table = F.lit(table) if isinstance(table, str) else table
    values = [table, *[F.lit(None) if c is None else c for c in (a, b, tokens)]]
    kinds = ["string", "string", "string", "bigint"]
    return df.select(*[v.cast(k).alias(c) for v, k, c in zip(values, kinds, COUNTED)], F.lit(1).alias("w"))


def _facets() -> Column:
    """The grouping sets of a row of counts: (metric, item) by table."""

    def facet(metric: str, item: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), item.alias("item"))

    rows = facet("n", F.lit(""))
    table = F.col("table_name")
    return (
        F.when(table == "unified", F.array(rows, facet("source", F.col("a")), facet("language", F.col("b"))))
        .when(table == "cross_lingual", F.array(rows, facet("pair", F.col("a"))))
        .otherwise(F.array(rows, facet("class", F.col("a"))))
    )


def _lengths(counts: DataFrame) -> DataFrame:
    """Length statistics and histogram of every table with texts, from one aggregate."""
    n, tokens = F.col("n"), F.col("tokens")
    known = F.when(tokens.isNotNull(), n)
    buckets = list(zip(V.LENGTH_BOUNDS, [*V.LENGTH_BOUNDS[1:], None]))
    stats = {
        "min_tokens": F.min("tokens"),
        "max_tokens": F.max("tokens"),
        "mean_tokens": F.round(F.sum(tokens * n) / F.sum(known), 1),
        "median_tokens": F.percentile("tokens", 0.5, n),
    }
    sums = [
        F.coalesce(F.sum(F.when((tokens >= lo) & (F.lit(True) if hi is None else tokens < hi), n)), F.lit(0)).alias(f"from{lo}") for lo, hi in buckets
    ]
    one = counts.groupBy("table_name").agg(*[c.alias(name) for name, c in stats.items()], *sums)

    def number(metric: str, item: str, column: str) -> Column:
        return F.struct(F.lit(metric).alias("metric"), F.lit(item).alias("item"), F.col(column).cast("string").alias("value"))

    numbers = [number(name, "", name) for name in stats] + [number("length_from", str(lo), f"from{lo}") for lo, _ in buckets]
    return one.select("table_name", F.inline(F.array(*numbers)))


def profile_report(
    unified: DataFrame | None = None,
    detection: DataFrame | None = None,
    splits: DataFrame | None = None,
    cross_lingual: DataFrame | None = None,
) -> DataFrame:
    """Profile of the tables at hand; a missing table is left out.

    All tables are counted in one pass and one shuffle by the columns that the report needs. That small table is
    stored; its grouping sets give the counts, and one aggregate the lengths. Only the sample and the leakage check
    read texts once more.
    """
    rows: list[DataFrame] = []
    parts: list[DataFrame] = []
    tables: list[str] = []
    if unified is not None:
        tables.append("unified")
        rows.append(_counted(unified, "unified", F.col("source"), F.col("source_lang")))
    if detection is not None:
        col = "source_idiom" if "source_idiom" in detection.columns else "text"
        tables.append("detection")
        rows.append(_counted(detection, "detection", label_name("label"), tokens=token_count(col)))
        parts.append(sample_rows(detection, col=col).select(*_long("detection", "sample", F.col("label_name"), F.col("sample_text"))))
    if splits is not None:
        tables += SPLITS
        rows.append(_counted(splits.filter(F.col("split").isin(*SPLITS)), F.col("split"), label_name("label"), tokens=token_count("text")))
        leaks = P.leakage_check(splits)
        parts += [leaks.select(*_long("splits", c, F.lit(""), F.col(c))) for c in leaks.columns]
    if cross_lingual is not None:
        tables.append("cross_lingual")
        rows.append(_counted(cross_lingual, "cross_lingual", F.concat("source_lang", F.lit(" → "), "target_lang")))
    if not rows:
        raise ValueError("no table to profile")
    spark = rows[0].sparkSession
    # A row of weight 0 keeps a table without rows in the report.
    empty = spark.createDataFrame([(t, None, None, None, 0) for t in tables], "table_name string, a string, b string, tokens bigint, w int")
    counts = reduce(lambda x, y: x.unionByName(y), rows + [empty]).groupBy(*COUNTED).agg(F.sum("w").alias("n"))
    counts = stored(counts)

    sets = counts.select("table_name", F.inline(_facets()), "n").groupBy("table_name", "metric", "item").agg(F.sum("n").alias("n"))
    sets = sets.filter((F.col("metric") == "n") | ((F.col("n") > 0) & (F.col("item").isNotNull() | (F.col("metric") == "class"))))
    place = F.row_number().over(Window.partitionBy("table_name", "metric").orderBy(F.desc("n"), "item"))
    top = sets.withColumn("_place", place).filter((F.col("metric") != "pair") | (F.col("_place") <= V.PAIR_REPORT_ROWS))
    parts.append(top.select("table_name", "metric", "item", F.col("n").cast("string").alias("value")))
    if texts := [t for t in tables if t not in ("unified", "cross_lingual")]:
        parts.append(_lengths(counts.filter(F.col("table_name").isin(*texts))))
    return reduce(lambda a, b: a.unionByName(b), parts)
