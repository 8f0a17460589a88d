"""A corpus pipeline of the llm operators: every stage works on all that its predecessor kept.

A document is a row, whatever its doc_id. Of rows with equal or linked texts one stays, the one with the smallest id,
null last. Where ids repeat or are null, the later stages work on row numbers in place of ids.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from phraseloom.llm import catalog, exact_dedup, jaccard_join, mixing, piece_fst, quality
from phraseloom.llm.scratch import Scratch

MODEL = "piece_bpe_32k.model"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, accepts."""
    labels = catalog.table(spark, sf_dir, "labels")
    return quality.keep_good(docs, quality.fit_quality(docs, labels, F.lit(True)))


def names_rows(docs: DataFrame) -> bool:
    """Whether every row has a doc_id of its own."""
    return docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1 OR doc_id IS NULL").isEmpty()


def numbered(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows of docs with a number of their own, and the name of that column. Written, so that numbers stay."""
    row = f"row_{uuid.uuid4().hex}"
    return Scratch(spark, "numbered").write(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def first_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, one row: that with the smallest id, null last, and of several the smallest row."""
    index = exact_dedup.DigestIndex(spark, f"digests_{uuid.uuid4().hex}")
    marked = exact_dedup.exact_dedup(docs, index).filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    kept = marked.groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).agg(F.count(F.lit(1)).alias("_copies"))
    kept = Scratch(spark, "first_of_equal").write(kept, "kept")
    digest = f"digest_{uuid.uuid4().hex}"
    rows = docs.withColumn(digest, exact_dedup.text_digest(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col(digest) == F.col("_sha"))
    once = rows.join(kept.filter("_copies = 1"), same, "left_semi").select(docs.columns)
    # Only rows that repeat an id and its text are aggregated whole.
    many = rows.join(kept.filter("_copies > 1"), same, "left_semi").groupBy(digest).agg(F.min(F.struct(*docs.columns)).alias("_row"))
    return once.unionByName(many.select("_row.*"))


def first_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by their shingles, the one with the smallest id, null last."""
    if names_rows(docs):
        kept = jaccard_join.jaccard_components(docs).filter("doc_id = component_id").select("doc_id")
        return docs.join(kept, "doc_id", "left_semi").select(docs.columns)
    rows, row = numbered(spark, docs)
    parts = jaccard_join.jaccard_components(rows.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), "component_id")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", exact_dedup.text_digest(F.col("text")), row).alias("_place")
    ids = rows.select(F.col(row).alias("_row"), place)
    kept = parts.join(ids, "_row").groupBy("component_id").agg(F.min("_place").alias("_place")).select(F.col(f"_place.{row}").alias(row))
    return rows.join(kept, row, "left_semi").select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as came in, with sources nearer to equal shares; a document may come more than once or not at all."""
    if names_rows(docs):
        return mixing.mixed_documents(docs)
    rows, row = numbered(spark, docs)
    readings = mixing.mix(rows.select(F.col(row).alias("doc_id"), "source", "text")).groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("_n"))
    again = rows.join(readings.select(F.col("doc_id").alias(row), "_n"), row)
    return again.withColumn(f"{row}_copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_pieces and round_trip of every reading."""
    return piece_fst.encode_pieces(docs, catalog.tokenizer_path(MODEL))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_documents),
    ("exact dedup", first_of_equal),
    ("n-gram Jaccard join", first_of_near),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding", encoded),
]

# Model scores and merges are not for SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents, each written and read again before the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            scratch.drop(f"stage{k - 1}")
    return docs
