"""8. Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are words, word pairs, pairs with one word between and the first four and five bytes of longer words, hashed;
a feature counts once per text. Each coordinate
has its own learning rate and the L1 term leaves most weights at zero, so the model is a short list of weights whose
length is bounded by the hash width; it is broadcast, and scoring looks features up and sums those that have a weight.

Defined results: a null or empty text gets the score of the intercept; a table without both classes gives every text
the share of class 1 (one half without labels); whole texts count, however long; repeated rows get equal scores; null
ids are scored and not held out; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from phraseloom.llm.labelled import id_crc32, labelled_sample
from phraseloom.llm.words import NOT_ALNUM, Words, mix, text_slices

SAMPLE_ROWS = 10_000
BITS = 20
ALPHA, BETA, L2 = 1.0, 1.0, 0.1
L1_PER_ROOT = 0.08  # the L1 term grows with the root of the number of labelled rows, as noise in a coordinate does
EPOCHS = 5
CALIBRATION, FALSE_ALARM, MOST_MOVE = 4, 1.0, 2.5
STEMS = (4, 5)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashed features from 1 up, index of their text) for words, their beginnings, pairs and skip-grams."""
    words = Words(data, offsets, NOT_ALNUM, lower=True)
    shift, h, text = np.uint64(64 - BITS), words.hash, words.text
    yield (h >> shift).astype(np.int64) | 1, text
    for size in STEMS:
        long = np.flatnonzero(words.end - words.start > size)
        ends = words.start[long] + size
        yield (mix(words.bytes_between(words.start[long], ends) + np.uint64(size)) >> shift).astype(np.int64) | 1, text[long]
    for gap, salt in ((1, 0x51ED270B), (2, 0x2545F491)):
        if len(h) > gap:
            same = np.flatnonzero(text[:-gap] == text[gap:])
            pair = mix(h[same] * np.uint64(3) + h[same + gap] + np.uint64(salt))
            yield (pair >> shift).astype(np.int64) | 1, text[same]


@dataclass
class ToxicityModel:
    """Sorted feature ids with their weights, and the intercept."""

    ids: np.ndarray
    weights: np.ndarray
    intercept: float

    def scores(self, data: np.ndarray, offsets: np.ndarray, dense: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        hits = [np.zeros(0, np.int64)]
        for hashed, text in features(data, offsets):
            at = np.flatnonzero(dense[hashed])
            hits.append(text[at] << BITS | hashed[at])
        hits = np.unique(np.concatenate(hits))
        total = np.bincount(hits >> BITS, dense[hits & (1 << BITS) - 1], n) + self.intercept
        return 1 / (1 + np.exp(-np.clip(total, -700, 700)))

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << BITS)
        table[self.ids] = self.weights
        return table


def fit(sample: list[tuple[bytes, int]], epochs: int = EPOCHS, seed: int = 11) -> ToxicityModel:
    labels = np.array([y for _, y in sample], np.float64)
    if len(set(labels.tolist())) < 2:
        share = min(max(labels.mean() if len(labels) else 0.5, 1e-6), 1 - 1e-6)
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))
    rows = []
    for text, _ in sample:
        data = np.frombuffer(text, np.uint8)
        rows.append(np.unique(np.concatenate([h for h, _ in features(data, np.array([0, len(data)]))] + [np.zeros(1, np.int64)])).astype(np.int32))
    # The intercept is set on rows held back from a first fit, where toxic rows do not yet have their own weights.
    back = np.arange(len(rows)) % CALIBRATION == 0
    w = regress(rows, labels, np.flatnonzero(~back), epochs, seed)
    logits = np.array([w[rows[i]].sum() for i in np.flatnonzero(back)])
    move = threshold(logits, labels[back])
    w = regress(rows, labels, np.arange(len(rows)), epochs, seed)
    kept = np.flatnonzero(w[1:]) + 1
    return ToxicityModel(kept, w[kept], float(w[0] - move))


def threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the cuts that make the fewest errors, a clean row taken for toxic counting FALSE_ALARM times."""
    if len(set(labels.tolist())) < 2:
        return 0.0
    cuts = np.linspace(-MOST_MOVE, MOST_MOVE, 101)
    errors = [FALSE_ALARM * ((logits >= c) & (labels == 0)).sum() + ((logits < c) & (labels == 1)).sum() for c in cuts]
    return float(np.mean(cuts[errors == np.min(errors)]))


def regress(rows: list[np.ndarray], labels: np.ndarray, use: np.ndarray, epochs: int, seed: int) -> np.ndarray:
    """Weights of all coordinates by FTRL-proximal steps over the rows in `use`; coordinate 0 is the intercept."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    l1 = L1_PER_ROOT * np.sqrt(len(use))

    def weights(ids: np.ndarray | slice) -> np.ndarray:
        push = np.where(np.abs(z[ids]) > l1, z[ids] - np.sign(z[ids]) * l1, 0.0)
        return -push / ((BETA + np.sqrt(n[ids])) / ALPHA + L2)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(use):
            ids = rows[i]
            w = weights(ids)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -50, 50))) - labels[i]
            grown = n[ids] + g * g
            z[ids] += g - (np.sqrt(grown) - np.sqrt(n[ids])) / ALPHA * w
            n[ids] = grown
    return weights(slice(None))


def fit_toxicity(docs: DataFrame, labels: DataFrame, usable: Column, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn `toxic` from at most `sample_rows` labelled documents for which `usable` holds."""
    return fit(labelled_sample(docs, labels, "toxic", usable, sample_rows))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and the score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = sent.value.dense()
        for batch in batches:
            parts = [sent.value.scores(data, offsets, dense) for _, _, data, offsets in text_slices(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(parts) if parts else [], pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id bigint, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(id_crc32(doc_id) % 5 == 0, F.lit(False))


def toxicity_table(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; labels of held-out rows are never used."""
    model = fit_toxicity(docs, labels, ~held_out(F.col("doc_id")), sample_rows)
    return score_toxicity(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
