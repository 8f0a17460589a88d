"""12. Importance resampling towards a target distribution, by hashed word n-grams.

A 256-byte table lower-cases A-Z and blanks the separators of the UTF-8 text, so that bytes.split() yields the words. The
crc32 of an n-gram is that of its first n - 1 words, seeded on through a space and the next word. Counters reduce words
to counts before anything is hashed. All documents give counts S, s of features by bucket, all target texts T, t; a
bucket's gain is floor(1000 * ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))), a document's weight the floored mean of
its features' gains. Weight plus a Gumbel number from the hash of the id is the score, and the highest scores are drawn:
a sample without replacement in proportion to exp(weight / 1000).

Tables of `buckets` numbers are all that tasks share. Places in the sample come from a sort by range: rows in a part,
and the rows of all parts before.

Defined results: a null or empty text has no words, no features and weight 0; whole texts count, in pieces of
PIECE_BYTES; rows count each, also where they share an id, and of those with equal scores and ids either may come first;
a row without id has no score and takes no part in the draw, but counts among the features; an empty table gives no rows,
an empty target weighs by rarity alone; other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from phraseloom.llm.scratch import Scratch, partitions

BUCKETS = 10_000
PIECE_BYTES = 1 << 20
WORDS_HELD = 200_000
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

WEIGHTS = "doc_id bigint, n_words bigint, n_features bigint, weight bigint"


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a piece of about PIECE_BYTES at a time; a word is never cut."""
    text, start = text.translate(TABLE), 0
    while start < len(text):
        end = text.find(b" ", start + PIECE_BYTES)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


class Hasher:
    """Buckets of n-grams. Those of single words are kept, up to WORDS_HELD of them."""

    def __init__(self, longest: int, buckets: int):
        self.longest, self.buckets, self.held = longest, buckets, {}

    def counts(self, text: bytes) -> tuple[int, Counter]:
        """Number of words, and features by bucket."""
        n_words, out, tail = 0, Counter(), []
        for words in word_lists(text):
            n_words += len(words)
            for word, n in Counter(words).items():
                out[self._single(word)] += n
            if self.longest > 1:
                # Longer n-grams of the words before this piece go on into it.
                out.update(self._longer(tail + words, len(tail)))
                tail = (tail + words)[1 - self.longest :]
        return n_words, out

    def _single(self, word: bytes) -> int:
        bucket = self.held.get(word)
        if bucket is None:
            if len(self.held) >= WORDS_HELD:
                self.held.clear()
            bucket = self.held[word] = zlib.crc32(word) % self.buckets
        return bucket

    def _longer(self, words: list[bytes], old: int) -> Iterator[int]:
        """Buckets of n-grams of two words and more that end at words[old] or later."""
        spaced = [b" " + w for w in words]
        seeds = [zlib.crc32(w) for w in words]
        for n in range(2, self.longest + 1):
            seeds = [zlib.crc32(w, seed) for seed, w in zip(seeds, spaced[n - 1 :])]  # seeds[i]: words i to i + n - 1
            yield from (seed % self.buckets for seed in seeds[max(0, old - n + 1) :])


def bucket_counts(docs: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket; tasks add theirs up first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = Hasher(longest, buckets), Counter()
        for batch in batches:
            for text in batch.column("text").cast(pa.large_binary()).to_pylist():
                total.update(hasher.counts(text or b"")[1])
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int32()), pa.array(total.values(), pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    table = docs.select("text").mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    s, t, buckets = source.astype(float), target.astype(float), float(len(source))
    return np.floor(1000.0 * np.log((t + 1.0) * (s.sum() + buckets) / ((s + 1.0) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, longest: int) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(gain.tolist())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        hasher = Hasher(longest, len(table))
        for batch in batches:
            rows = []
            for text in batch.column("text").cast(pa.large_binary()).to_pylist():
                n_words, counts = hasher.counts(text or b"")
                n = counts.total()
                rows.append((n_words, n, sum(table[b] * k for b, k in counts.items()) // n if n else 0))
            columns = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(score, WEIGHTS)


def drawn(rows: DataFrame, n: int, scratch: Scratch) -> DataFrame:
    """`row` and rank (from 1) of the n rows of (row, score, doc_id) with the highest scores, ties to the smaller id."""
    sizes = scratch.write(rows.groupBy("score").agg(F.count(F.lit(1)).alias("_n")), "scores")
    # Scores are whole numbers between bounds that the counts set, so this window holds tens of thousands of rows at most.
    above = F.sum("_n").over(Window.orderBy(F.desc("score"))) - F.col("_n")
    least = sizes.select("score", above.alias("_above")).filter(F.col("_above") < n).agg(F.min("score")).first()[0]
    order = [F.desc("score"), F.asc("doc_id"), F.asc("row")]
    best = rows.filter(F.col("score") >= least) if least is not None else rows.limit(0)
    best = best.select("row", "score", "doc_id").repartitionByRange(partitions(scratch.spark), *order).sortWithinPartitions(*order)
    # The number has the part in its upper bits and the place in the part in its lower 33.
    best = scratch.write(best.select("row", F.monotonically_increasing_id().alias("_at")), "best")
    part = F.shiftright("_at", 33)
    parts = best.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = parts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return best.withColumn("_part", part).join(before, "_part").select("row", place.alias("rank")).filter(F.col("rank") <= n)


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, longest: int = 1, least_words: int = 20, buckets: int = BUCKETS, seed: str = "2024") -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of docs; rank is null for rows that are not drawn.

    Of the N rows with an id and `least_words` words, floor(percent * N / 100) are drawn.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "resampling")
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weigh(docs, gain, longest).select(F.monotonically_increasing_id().alias("row"), "*", (F.col("weight") + gumbel).alias("score"))
    scored = scratch.write(scored, "scored")
    able = scored.filter((F.col("n_words") >= least_words) & F.col("score").isNotNull())
    ranks = drawn(able, percent * able.count() // 100, scratch)
    return scored.join(ranks, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
