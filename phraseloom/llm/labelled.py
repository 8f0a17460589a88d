"""A bounded sample of labelled rows on the driver, for fitting a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def id_crc32(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, limit: int) -> list[tuple[bytes, int]]:
    """(text, 0 or 1) of at most `limit` labelled rows, those with the smallest hashed ids, in that order.

    Rows without id or label are not used; of several labels of one id the largest holds; of several rows of one id
    each is used, smallest text first. The limit is applied to the rows before they are collected, so it bounds what the
    driver holds; scoring never sees it.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & usable)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text")).join(picked, "doc_id")
    rows = rows.select(F.xxhash64("doc_id").alias("_h"), "doc_id", "_label", "_text")
    got = rows.orderBy("_h", "doc_id", "_text").limit(limit).toArrow()
    order = sorted(range(len(got)), key=lambda i: (got["_h"][i].as_py(), got["doc_id"][i].as_py(), got["_text"][i].as_py()))
    return [(got["_text"][i].as_py().encode(), got["_label"][i].as_py()) for i in order]
