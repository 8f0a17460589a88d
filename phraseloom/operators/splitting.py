"""Train / val / test splits with exact sizes and without a sort per class.

Rows of a class are ordered by a seeded hash of the text. The first 70 % go to train, the next 15 %
to val. Only the two rows at which the split changes matter, so they are found by counting hash
prefixes first and ranking just the two prefixes that hold a cut. Every row is then assigned by
comparing its hash with the cuts of its class: no shuffle of the rows themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from phraseloom.functions import fixed_values as V
from phraseloom.operators.sampling import distinct_label_count, seeded_hash

TRAIN_PERCENT = 70
TRAIN_VAL_PERCENT = 85
PREFIX_CHARS = 4  # 65,536 prefixes


def _cuts(hashed: DataFrame) -> DataFrame:
    """One row per class: hash of the last train row and of the last train-or-val row.

    Both are blank if that part of the class is empty.
    """
    prefix = F.substring("_h", 1, PREFIX_CHARS)
    sizes = hashed.groupBy("_class", prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_size"))
    running = Window.partitionBy("_class").orderBy("_prefix")
    upto = sizes.select(
        "_class",
        "_prefix",
        "_size",
        F.sum("_size").over(running).alias("_upto"),
        F.sum("_size").over(Window.partitionBy("_class")).alias("_total"),
    )
    targets = F.array(
        *[
            F.struct(F.lit(p).alias("cut"), F.expr(f"_total * {p} div 100").alias("target"))
            for p in (TRAIN_PERCENT, TRAIN_VAL_PERCENT)
        ]
    )
    holders = (
        upto.select("*", F.explode(targets).alias("_t"))
        .filter((F.col("_t.target") > F.col("_upto") - F.col("_size")) & (F.col("_t.target") <= F.col("_upto")))
        .select(
            "_class",
            "_prefix",
            F.col("_t.cut").alias("_cut"),
            (F.col("_t.target") - F.col("_upto") + F.col("_size")).alias("_need"),
        )
    )
    # Equal hashes are counted, not listed, so copies of one text stay one row here.
    ranked = Window.partitionBy("_class", "_cut").orderBy("_h")
    at_cut = (
        hashed.withColumn("_prefix", prefix)
        .join(holders, ["_class", "_prefix"])
        .groupBy("_class", "_cut", "_need", "_h")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_seen", F.sum("_n").over(ranked))
        .filter(F.col("_seen") >= F.col("_need"))
        .groupBy("_class", "_cut")
        .agg(F.min("_h").alias("_at"))
    )
    return (
        at_cut.groupBy("_class")
        .agg(
            F.max(F.when(F.col("_cut") == TRAIN_PERCENT, F.col("_at"))).alias("_cut_train"),
            F.max(F.when(F.col("_cut") == TRAIN_VAL_PERCENT, F.col("_at"))).alias("_cut_val"),
        )
    )


def _split_name(cut_train: Column, cut_val: Column) -> Column:
    return (
        F.when(F.col("_h") <= F.coalesce(cut_train, F.lit("")), "train")
        .when(F.col("_h") <= F.coalesce(cut_val, F.lit("")), "val")
        .otherwise("test")
    )


def stratified_split(df: DataFrame, seed: int = V.SPLIT_SEED, key: str = "text") -> DataFrame:
    """70/15/15 by class in column `split`, exact where `key` is unique within a class.

    Rows of one class with the same key always share a split. The input is read three times, so pass
    a stored table if it is costly to compute.
    """
    klass = F.coalesce(F.col("label"), F.lit(-(2**31)))
    keyed = df.drop("split").withColumns({"_class": klass, "_h": seeded_hash(seed, key)})
    # One row per class; adaptive execution chooses the join by its size.
    cuts = _cuts(keyed.select("_class", "_h"))
    return (
        keyed.join(cuts, "_class", "left")
        .withColumn("split", _split_name(F.col("_cut_train"), F.col("_cut_val")))
        .drop("_class", "_h", "_cut_train", "_cut_val")
    )


def random_split(df: DataFrame, seed: int = V.SPLIT_SEED, key: str = "text") -> DataFrame:
    """70/15/15 over all rows, used when there is only one class. The two cuts are read at once."""
    keyed = df.drop("split").withColumn("_h", seeded_hash(seed, key))
    cuts = _cuts(keyed.select(F.lit(0).alias("_class"), "_h")).first()
    train, val = (cuts["_cut_train"], cuts["_cut_val"]) if cuts else (None, None)
    return keyed.withColumn("split", _split_name(F.lit(train), F.lit(val))).drop("_h")


def split_by_class_or_random(df: DataFrame, seed: int = V.SPLIT_SEED) -> DataFrame:
    return stratified_split(df, seed) if distinct_label_count(df) >= 2 else random_split(df, seed)
