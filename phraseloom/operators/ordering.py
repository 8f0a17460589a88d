"""Row order without a global sort.

Spark tables have no row order, yet "keep the first" and "every n-th row" need one. The order is
carried as a comparable struct, and dense positions come from per-chunk counts plus a place inside
each chunk, so no task ever sees more than one chunk. The running sum over the counts has two levels:
inside ranges of chunks, and over the ranges.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from phraseloom.schemas import ROW_ORD
from phraseloom.storage import stored


def order_struct(block: Column, row: Column, file: Column | None = None, sub: Column | None = None) -> Column:
    """Order of a row within one source; the source priority is set when sources are concatenated."""
    return F.struct(
        F.lit(0).alias("priority"),
        (F.lit("") if file is None else file).alias("file"),
        block.cast("bigint").alias("block"),
        row.cast("bigint").alias("row"),
        (F.lit(0) if sub is None else sub).alias("sub"),
    ).cast(ROW_ORD)


def file_order(fmt: str = "json") -> Column:
    """Order of a row in its file: path, start of the file block, running number inside the task.

    A task reads a block front to back, so the running number follows file order within a block, without a gap.
    Parquet knows the number of a row in its file. Must be selected directly on top of a file read.
    """
    path = F.col("_metadata.file_path")
    if fmt == "parquet":
        return order_struct(file=path, block=F.lit(0), row=F.col("_metadata.row_index"))
    return order_struct(file=path, block=F.col("_metadata.file_block_start"), row=F.monotonically_increasing_id())


def running_totals(sizes: DataFrame, keys: list[str], size: str = "_size", name: str = "_offset") -> DataFrame:
    """Add the sum of `size` over all rows before, in the order of `keys`.

    The rows are dealt into ranges of the order and stored; sums run inside each range, and the range totals, one
    number per shuffle partition, are added up on the driver.
    """
    spark = sizes.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = sizes.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    # The number has the range in its upper bits.
    ordered = stored(ordered.withColumn("_at", F.monotonically_increasing_id())).withColumn("_range", F.shiftright("_at", 33))
    totals = sorted(ordered.groupBy("_range").agg(F.sum(size)).collect())
    before, total = [], 0
    for number, own in totals:
        before.append((number, total))
        total += own
    firsts = F.broadcast(spark.createDataFrame(before, "_range bigint, _before bigint"))
    inside = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    summed = ordered.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0))).join(firsts, "_range")
    return summed.withColumn(name, F.col("_before") + F.col("_inside")).drop("_at", "_range", "_before", "_inside")


def with_offsets(df: DataFrame, offsets: DataFrame, chunk: list[str], *columns: str) -> DataFrame:
    """Rows beside columns of their chunk; null is a chunk like any other."""
    known = offsets.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(chunk)], *columns)
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(chunk)]
    return df.join(known, same).drop(*[f"_k{i}" for i in range(len(chunk))])


def dense_position(df: DataFrame, chunk: list[str], order: list[str], name: str = "position") -> DataFrame:
    """Add the 0-based position in the order (chunk, order).

    Chunks must be small enough for one task: a file block, or a bucket of an id.
    """
    sizes = df.groupBy(*chunk).agg(F.count(F.lit(1)).alias("_size"))
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*chunk).orderBy(*order)))
    placed = with_offsets(ranked, running_totals(sizes, chunk), chunk, "_offset")
    return placed.withColumn(name, F.col("_offset") + F.col("_rank") - 1).drop("_rank", "_offset")


def block_position(df: DataFrame, name: str = "position") -> tuple[DataFrame, int] | None:
    """Rows that carry row_ord with their 0-based position in it, and their number.

    For rows as a file read numbers them, without a gap inside a block: a position is the rows of all blocks before
    plus the distance from the first number of the block, so nothing is ranked, shuffled or written but a row per
    block. Both reads number alike, as a split of a file is one partition in each. None if the numbers have gaps.
    """
    place = df.withColumns({"_file": F.col("row_ord.file"), "_block": F.col("row_ord.block"), "_row": F.col("row_ord.row")})
    # A read of no column counts lines that are no records, such as blank ones; so a data column takes part.
    data = next((F.col(f"`{c}`") for c in df.columns if c != "row_ord"), F.lit(1))
    every = F.count(data) + F.count_if(data.isNull())
    sizes = place.groupBy("_file", "_block").agg(F.count("_row").alias("_size"), F.min("_row").alias("_first"), F.max("_row").alias("_last"), every.alias("_all"))
    offsets = running_totals(sizes, ["_file", "_block"])
    dense = (F.col("_last") - F.col("_first") + 1 == F.col("_size")) & (F.col("_all") == F.col("_size"))
    total, ok = offsets.agg(F.coalesce(F.sum("_size"), F.lit(0)), F.coalesce(F.bool_and(F.coalesce(dense, F.lit(False))), F.lit(True))).first()
    if not ok:
        return None
    placed = with_offsets(place, offsets, ["_file", "_block"], "_offset", "_first")
    return placed.withColumn(name, F.col("_offset") + F.col("_row") - F.col("_first")).drop("_file", "_block", "_row", "_offset", "_first"), total


SAMPLE_PER_BUCKET = 200
BUCKET_ROWS = 250_000


def id_buckets(df: DataFrame, id_col: str, total: int, buckets: int | None = None, name: str = "_bucket") -> DataFrame:
    """Cut a numeric id into buckets of about equal row count that keep the id order.

    The bounds are quantiles of a small sample of the ids. Any bounds give right positions; these give
    even tasks. At most `buckets` numbers reach the driver; by default there is one per BUCKET_ROWS rows.
    """
    buckets = max(8, -(-total // BUCKET_ROWS)) if buckets is None else buckets
    probs = [i / buckets for i in range(1, buckets)]
    fraction = min(1.0, SAMPLE_PER_BUCKET * buckets / max(1, total))
    some_ids = df.select(id_col).sample(fraction, seed=1) if fraction < 1 else df
    bounds = some_ids.approxQuantile(id_col, probs, 0.1 / buckets) or [0.0]
    splits = [float("-inf"), *sorted(set(bounds)), float("inf")]
    as_double = df.withColumn("_id_double", F.col(id_col).cast("double"))
    cutter = Bucketizer(splits=splits, inputCol="_id_double", outputCol=name, handleInvalid="error")
    return cutter.transform(as_double).withColumn(name, F.col(name).cast("int")).drop("_id_double")


def position_by_id(
    df: DataFrame, id_col: str, name: str = "position", total: int | None = None, buckets: int | None = None
) -> DataFrame:
    """0-based position of each row in the order of a unique numeric id."""
    total = df.count() if total is None else total
    return dense_position(id_buckets(df, id_col, total, buckets), ["_bucket"], [id_col], name).drop("_bucket")
