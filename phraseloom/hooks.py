"""The three places where a user plugs in a model. Each hook takes a `load` function that builds the
model once per Python process; it stays there for later tasks and is never shipped with them.

The calls are marked as non-deterministic, so that Spark neither copies a call into a filter on its
result nor moves it: each row meets the model once.

load() of an encoder returns texts -> 2-d float array, of a scorer texts -> 2-d logits, of a
translator (system texts, prompts) -> translations.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from phraseloom.functions import fixed_values as V

ENCODE_BATCH = 64
SCORED = T.StructType([T.StructField("logits", T.ArrayType(T.DoubleType())), T.StructField("error", T.StringType())])


def _loaded(name: str, load: Callable[[], Callable]) -> Callable:
    """The model of a hook in this process. Task code travels by value, so a module global would not last."""
    models = sys.__dict__.setdefault("_phraseloom_models", {})
    if name not in models:
        models[name] = load()
    return models[name]


def _in_batches(fn: Callable[[list[str]], np.ndarray], texts: pd.Series, size: int, finish: Callable) -> pd.Series:
    """One finished vector per text. A null text never reaches the model and stays null."""
    at = np.flatnonzero(texts.notna())
    values = texts.iloc[at].tolist()
    out = np.full(len(texts), None, dtype=object)
    for i in range(0, len(at), size):
        part = values[i : i + size]
        made = np.asarray(fn(part))
        if made.ndim != 2 or len(made) != len(part):
            raise ValueError(f"the model must return one row per text: {len(part)} texts, {made.shape}")
        for where, row in zip(at[i : i + size].tolist(), finish(made)):
            out[where] = row
    return pd.Series(out, index=texts.index)


def encoder(load: Callable[[], Callable[[list[str]], np.ndarray]], batch: int = ENCODE_BATCH) -> Callable[[Column], Column]:
    """Text column -> unit-norm array<float>; a zero vector gives null."""

    name = uuid.uuid4().hex

    def unit(rows: np.ndarray) -> list[np.ndarray | None]:
        norms = np.sqrt(np.einsum("ij,ij->i", rows, rows, dtype=np.float64))
        scaled = (rows / np.where(norms > 0, norms, 1.0)[:, None]).astype(np.float32)
        return [row if norm > 0 else None for row, norm in zip(scaled, norms.tolist())]

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _loaded(name, load)
        for texts in parts:
            yield _in_batches(model, texts, batch, unit)

    return encode.asNondeterministic()


def scorer(load: Callable[[], Callable[[list[str]], np.ndarray]], batch: int = ENCODE_BATCH) -> Callable[[Column], Column]:
    """Text column -> array<double> of class logits. A failing call fails the job.

    Its attribute `guarded` is the same hook as text -> struct(logits, error): where a call fails, each text of the
    batch is tried by itself, and the ones that fail get the error and no logits. A model that cannot be loaded is an
    error of every text.
    """

    name = uuid.uuid4().hex

    def finish(rows: np.ndarray) -> list[np.ndarray]:
        return list(rows.astype(np.float64))

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _loaded(name, load)
        for texts in parts:
            yield _in_batches(model, texts, batch, finish)

    @F.pandas_udf(SCORED)
    def guarded(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def tried(model: Callable, texts: pd.Series) -> tuple[list, list]:
            try:
                return _in_batches(model, texts, batch, finish).tolist(), [None] * len(texts)
            except Exception as error:
                if len(texts) == 1:
                    return [None], [str(error) or type(error).__name__]
            ones = [tried(model, texts.iloc[i : i + 1]) for i in range(len(texts))]
            return [v for o in ones for v in o[0]], [e for o in ones for e in o[1]]

        def broken(error: Exception) -> Callable:
            def model(texts: list[str]) -> np.ndarray:
                raise error

            return model

        try:
            model = _loaded(name, load)
        except Exception as error:
            model = broken(error)
        for texts in parts:
            logits, errors = [], []
            for i in range(0, len(texts), batch):
                made, failed = tried(model, texts.iloc[i : i + batch])
                logits += made
                errors += failed
            yield pd.DataFrame({"logits": pd.Series(logits, dtype=object), "error": pd.Series(errors, dtype=object)})

    hook = score.asNondeterministic()
    hook.guarded = guarded.asNondeterministic()
    return hook


def translator(load: Callable[[], Callable[[list[str], list[str]], list[str]]]) -> Callable[[DataFrame], DataFrame]:
    """Adds `translation` from the columns `system_text` and `prompt`; a row without a prompt makes no call.

    A call that fails gives the fixed failure text for its row; the job goes on. After a failed batch
    each row is tried by itself, so that one bad row does not take the others with it.
    """

    name = uuid.uuid4().hex

    @F.pandas_udf(T.StringType())
    def translate(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = _loaded(name, load)

        def one(system: str, prompt: str) -> str:
            try:
                return str(model([system], [prompt])[0]).strip()
            except Exception:
                return V.TRANSLATION_FAILED

        for all_systems, all_prompts in parts:
            asked = all_prompts.notna()
            systems, prompts = all_systems[asked], all_prompts[asked]
            if not len(prompts):
                yield pd.Series([None] * len(all_prompts), index=all_prompts.index, dtype=object)
                continue
            try:
                texts = [str(t).strip() for t in model(systems.tolist(), prompts.tolist())]
                if len(texts) != len(prompts):
                    raise ValueError("the model must return one text per prompt")
            except Exception:
                texts = [one(s, p) for s, p in zip(systems, prompts)]
            yield pd.Series(texts, index=prompts.index, dtype=object).reindex(all_prompts.index, fill_value=None)

    call = translate.asNondeterministic()
    return lambda df: df.withColumn("translation", call("system_text", "prompt"))


def top_hit_translator(df: DataFrame) -> DataFrame:
    """Default translator without a model: the best hit, or the input text if there is no hit."""
    best = F.try_element_at(F.col("hits"), F.lit(1)).getField("target_idiom")
    return df.withColumn("translation", F.coalesce(best, F.col("text")))
