"""3. Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its words, word pairs and character n-grams, all hashed; a softmax
over two classes follows. Vectors and output weights are trained by stochastic gradient descent in numpy on a bounded
sample of labelled rows. For scoring, the output is linear in the average, so each hashed feature shrinks to one
number, its vector times the difference of the two output columns, and a text's score is a mean of looked-up numbers.

Defined results: a null or empty text holds the end mark only and still gets a score; a table without both classes
gives every text the share of class 1 (one half without labels); whole texts count, however long; repeated rows get
equal scores; null ids are scored and not held out; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from phraseloom.llm.labelled import id_crc32, labelled_sample
from phraseloom.llm.words import BLANKS, Words, text_slices

SAMPLE_ROWS = 4000
BITS = 18
GRAMS = (3, 4)
DIMENSIONS = 12
EPOCHS = 6
LEAST_STEPS = 6000  # small samples are read more often
RATE = 1.0
REPEAT = 2


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashed features, their bounds by text) for words, repeats, word pairs, and each length of character n-grams.

    Feature 0 is the end mark, which every text has once beside these. Pairs of one word twice share the feature
    REPEAT as well; hashed features are odd numbers.
    """
    words = Words(data, offsets, BLANKS, lower=False)
    shift = np.uint64(64 - BITS)
    out = [((words.hash >> shift).astype(np.int64) | 1, words.first)]
    again = np.flatnonzero((words.hash[1:] == words.hash[:-1]) & (words.text[1:] == words.text[:-1]))
    out.append((np.full(len(again), REPEAT, np.int64), np.searchsorted(again, words.first)))
    pairs, inside = words.rolling(2)
    bounds = np.searchsorted(np.flatnonzero(inside), words.first)
    out.append(((pairs[inside] >> shift).astype(np.int64) | 1, bounds))
    letters = ~BLANKS[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets[:-1]] = True
    wide = data.astype(np.uint64)
    for n in GRAMS:
        size = len(data) - n + 1
        if size <= 0:
            continue
        ok = letters[:size].copy()
        key = wide[:size].copy()
        for j in range(1, n):
            ok &= letters[j : size + j]
            ok &= ~begins[j : size + j]
            key |= wide[j : size + j] << np.uint64(8 * j)
        at = np.flatnonzero(ok)
        hashed = (key[at] + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15)
        out.append(((hashed >> shift).astype(np.int64) | 1, np.searchsorted(at, offsets)))
    return out


@dataclass
class QualityModel:
    """`value` of each hashed feature; the score is the logistic function of their mean."""

    value: np.ndarray

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.full(len(offsets) - 1, float(self.value[0]))
        count = np.ones(len(offsets) - 1)
        for hashed, bounds in features(data, offsets):
            sums = np.concatenate([[0.0], np.cumsum(self.value[hashed], dtype=np.float64)])
            total += sums[bounds[1:]] - sums[bounds[:-1]]
            count += np.diff(bounds)
        return 1 / (1 + np.exp(-np.clip(total / count, -700, 700)))


def fit(sample: list[tuple[bytes, int]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> QualityModel:
    labels = np.array([y for _, y in sample], np.int64)
    if len(set(labels.tolist())) < 2:
        share = labels.mean() if len(labels) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return QualityModel(np.full(1 << BITS, np.log(share / (1 - share)), np.float32))
    rows = []
    for text, _ in sample:
        data = np.frombuffer(text, np.uint8)
        parts = [hashed for hashed, _ in features(data, np.array([0, len(data)]))]
        ids, counts = np.unique(np.concatenate([np.zeros(1, np.int64), *parts]), return_counts=True)
        rows.append((ids.astype(np.int32), (counts / counts.sum()).astype(np.float32)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BITS, DIMENSIONS)).astype(np.float32)
    output = np.zeros((DIMENSIONS, 2), np.float32)
    eye = np.eye(2, dtype=np.float32)
    epochs = max(epochs, -(-LEAST_STEPS // len(rows)))
    step, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            ids, share = rows[i]
            mean = share @ vectors[ids]
            logits = mean @ output
            p = np.exp(logits - logits.max())
            error = p / p.sum() - eye[labels[i]]
            lr = rate * (1 - step / steps)
            back = output @ error
            output -= lr * np.outer(mean, error)
            vectors[ids] -= (lr * share)[:, None] * back
            step += 1
    return QualityModel((vectors @ (output[:, 1] - output[:, 0])).astype(np.float32))


def fit_quality(docs: DataFrame, labels: DataFrame, usable: Column, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Learn `quality` from at most `sample_rows` labelled documents for which `usable` holds."""
    return fit(labelled_sample(docs, labels, "quality", usable, sample_rows))


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and the score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [sent.value.scores(data, offsets) for _, _, data, offsets in text_slices(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(parts) if parts else [], pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id bigint, score double")


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of docs, with all their columns, that score 0.5 or more."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, to, data, offsets in text_slices(batch):
                yield batch.slice(row, to - row).filter(pa.array(sent.value.scores(data, offsets) >= 0.5))

    return docs.mapInArrow(keep, docs.schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(id_crc32(doc_id) % 3 == 1, F.lit(False))


def quality_table(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; labels of held-out rows are never used."""
    model = fit_quality(docs, labels, ~held_out(F.col("doc_id")), sample_rows)
    return score_quality(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
