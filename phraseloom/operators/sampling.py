"""Systematic and seeded samples, guards, heads per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from phraseloom.functions import fixed_values as V
from phraseloom.functions.text import as_column, cut, normalize_text
from phraseloom.operators.ordering import block_position, dense_position, position_by_id

# A list of sampled keys below this length is small enough to send to every executor.
BROADCAST_KEYS = 100_000


def seeded_hash(seed: int, c: Column | str) -> Column:
    """Hash of "seed:value", a fixed pseudo-random order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), as_column(c).cast("string")))


def _every_nth(positions: DataFrame, n: int, total: int) -> DataFrame:
    """Rows at 0, step, 2*step, ... with step = max(1, total // n), the first n of them."""
    if n < 1:
        raise ValueError("n must be at least 1")
    step = max(1, total // max(1, min(n, total)))
    return positions.filter((F.col("position") % step == 0) & (F.col("position") < n * step))


def systematic_sample(df: DataFrame, n: int, id_col: str) -> DataFrame:
    """Systematic sample in the order of a unique numeric id.

    Only the id is ranked and shuffled. The at most n chosen ids then pick the rows from the input.
    """
    ids = df.select(id_col)
    total = ids.count()
    chosen = _every_nth(position_by_id(ids, id_col, total=total), n, total).select(id_col)
    if n <= BROADCAST_KEYS:
        chosen = F.broadcast(chosen)
    return df.join(chosen, id_col, "left_semi")


def systematic_sample_by_row_ord(df: DataFrame, n: int) -> DataFrame:
    """Systematic sample in file order, for a frame that carries row_ord.

    Rows as a file read numbers them are counted per block in one pass and picked by position in another; nothing but
    the block counts is written. Rows with other numbers are ranked inside their blocks, and must be the same in both
    passes.
    """
    if (found := block_position(df)) is not None:
        positions, total = found
        return _every_nth(positions, n, total).drop("position")
    place = df.select("row_ord").withColumns({"_file": F.col("row_ord.file"), "_block": F.col("row_ord.block")})
    positions = dense_position(place, ["_file", "_block"], ["row_ord"])
    chosen = _every_nth(positions, n, place.count()).select("row_ord")
    if n <= BROADCAST_KEYS:
        chosen = F.broadcast(chosen)
    return df.join(chosen, "row_ord", "left_semi")


def sample_rows(
    df: DataFrame, n: int = V.SAMPLE_REPORT_ROWS, seed: int = V.SPLIT_SEED, col: str = "text"
) -> DataFrame:
    """Seeded sample of n rows for a report: class name and the first 90 characters."""
    name = F.when(F.col("label") == 1, V.LABEL_NAMES[1]).otherwise(V.LABEL_NAMES[0])
    return (
        df.select(
            name.alias("label_name"),
            cut(normalize_text(col), V.SAMPLE_TEXT_CHARS).alias("sample_text"),
            seeded_hash(seed, F.coalesce(F.col(col), F.lit(""))).alias("_h"),
        )
        .orderBy("_h", "label_name", "sample_text")
        .limit(n)
        .drop("_h")
    )


def head_per_language(
    df: DataFrame, n: int, order: str = "row_ord", lang_col: str = "target_lang"
) -> DataFrame:
    """First n rows of each language; the rank limit also runs before the shuffle."""
    w = Window.partitionBy(lang_col).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def require_rows(df: DataFrame, n: int = V.MIN_ROWS) -> None:
    """Raise if there are fewer than n rows; reads no more than n."""
    if df.limit(n).count() < n:
        raise ValueError(f"{n} rows are needed at least")


def distinct_label_count(df: DataFrame) -> int:
    return df.agg(F.countDistinct("label")).first()[0]
