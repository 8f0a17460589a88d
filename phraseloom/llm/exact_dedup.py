"""5. Exact dedup: a persistent digest index, bucketed and sorted by digest. DataFrame operations only.

New rows are reduced to one row per digest, deduplicated against the index by a sort-merge anti-join and appended.
Copies shrink in the map-side step of the aggregate, so a digest with a third of all rows is no hot task there; the
join that hands the kept id to every copy reads two shuffled tables, so adaptive execution can split a hot digest.

Defined results: null text counts as empty and empty texts are equal to each other; texts that differ in white space
runs only are equal; of equal texts the smallest id stays, and an id already in the index goes before all new ones; a
null id never stays before another id; repeated rows count each; other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from phraseloom.llm.scratch import Scratch, partitions, shared_folder

BLANK_RUN = r"[\x20\x09-\x0D]+"


def text_digest(text: Column) -> Column:
    """SHA-256, lowercase hex, of the text with every run of blanks as one space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), BLANK_RUN, " "), 256)


class DigestIndex:
    """(digest, keep_id) of all texts seen so far. `path` makes the table outlive the session's catalogue."""

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, buckets: int | None = None):
        self.spark, self.name, self.path = spark, name, path or f"{shared_folder(spark)}/{name}"
        self.buckets = buckets or partitions(spark)
        if not spark.catalog.tableExists(name):
            spark.sql(
                f"CREATE TABLE {name} (digest STRING, keep_id BIGINT) USING parquet "
                f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
            )
        else:
            described = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Num Buckets'").first()
            self.buckets = int(described["data_type"])

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, digests: DataFrame) -> None:
        """Append the digests of (digest, doc_id) rows that are new. Repeating an interrupted call is safe."""
        # Written before the join: the optimiser would move the anti-join below the aggregate, onto all copies.
        scratch = Scratch(self.spark, "digests")
        first = scratch.write(digests.groupBy("digest").agg(F.min("doc_id").alias("keep_id")), "first")
        new = first.join(self.read().hint("merge"), "digest", "left_anti")
        (
            new.select("digest", "keep_id")
            .repartition(self.buckets, "digest")
            .write.format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .mode("append")
            .option("path", self.path)
            .saveAsTable(self.name)
        )
        scratch.drop("first")


def exact_dedup(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size (within docs), kept, text_sha256. The index grows."""
    scratch = Scratch(docs.sparkSession, "exact_dedup")
    digests = scratch.write(docs.select("doc_id", text_digest(F.col("text")).alias("digest")), "digests")
    index.add(digests)
    sizes = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    groups = scratch.write(index.read().join(sizes, "digest"), "groups")
    return digests.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
