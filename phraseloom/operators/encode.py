"""Phrase vectors. The built-in encoder hashes character 3-grams and needs no model file."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from phraseloom.functions.text import normalize_text
from phraseloom.hooks import encoder as encoder_hook

DIM = 256
# Bucket of a 3-gram with code points a, b, c: (a * A + b * B + c * C) mod P mod DIM.
MULTIPLIERS = (73856093, 19349663, 83492791)
MODULUS = 1_000_003
# Characters whose 3-grams are held at a time; a longer text is taken by itself.
CHARS_AT_ONCE = 1 << 18


def gram_counts(texts: list[str], dim: int = DIM) -> np.ndarray:
    """Counts of hashed character 3-grams, one row per text; a text of under three characters is all zero."""
    sizes = np.array([len(text) for text in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    if len(texts) > 1 and ends[-1] > CHARS_AT_ONCE:
        out, start = np.zeros((len(texts), dim)), 0
        while start < len(texts):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] - sizes[start] + CHARS_AT_ONCE, side="right")))
            out[start:stop] = gram_counts(texts[start:stop], dim)
            start = stop
        return out
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    if len(points) < 3:
        return np.zeros((len(texts), dim))
    a, b, c = (points[k : len(points) - 2 + k] * m for k, m in enumerate(MULTIPLIERS))
    row = np.repeat(np.arange(len(texts)), sizes)
    cell = row[:-2] * dim + (a + b + c) % MODULUS % dim
    inside = row[:-2] == row[2:]
    return np.bincount(cell[inside], minlength=len(texts) * dim).reshape(-1, dim).astype(np.float64)


_builtin = encoder_hook(lambda: gram_counts, batch=1024)


def encode_text(
    df: DataFrame,
    col: str,
    encoder: Callable[[Column], Column] | None = None,
    out: str = "embedding",
    only: Column | None = None,
) -> DataFrame:
    """Add a unit-norm array<float> for a text column; `encoder` is a hook column function.

    Rows outside the condition `only` get no vector and cost no model call. A blank text has no vector
    from the built-in encoder and so no hits.
    """
    text = normalize_text(col)
    if only is not None:
        text = F.when(only, text)
    if encoder is not None:
        return df.withColumn(out, encoder(text))
    # A blank on both sides marks the first and the last word like those inside. A blank text becomes
    # two blanks, too short for a 3-gram.
    padded = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    return df.withColumn(out, _builtin(padded))
