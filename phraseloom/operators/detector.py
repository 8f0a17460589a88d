"""Two-class text classifier: features, training, batch prediction."""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF, NGram, RegexTokenizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from phraseloom.functions.arrays import detection_struct, softmax
from phraseloom.functions.text import tokens
from phraseloom.operators.metrics import macro_metrics

FEATURES = 1 << 16
GRID = (0.001, 0.01, 0.1)
MAX_ITERATIONS = 25
TRIES_AT_ONCE = 3
# Text of one task; the counts that every fit reads again take several times as much.
TASK_BYTES = 8 * 1024 * 1024


def feature_stages(max_tokens: int | None = None, features: int = FEATURES) -> list:
    """Words and word pairs, hashed and weighted; of the whole text unless `max_tokens` says otherwise."""
    words = [RegexTokenizer(inputCol="text", outputCol="_words", pattern=r"(?U)[^\p{L}\p{M}\p{N}]+")]
    if max_tokens is not None:
        words[0].setOutputCol("_all_words")
        words.append(SQLTransformer(statement=f"SELECT *, slice(_all_words, 1, {int(max_tokens)}) AS _words FROM __THIS__"))
    return [
        *words,
        NGram(n=2, inputCol="_words", outputCol="_pairs"),
        HashingTF(numFeatures=features, inputCol="_words", outputCol="_word_tf"),
        HashingTF(numFeatures=features, inputCol="_pairs", outputCol="_pair_tf"),
        VectorAssembler(inputCols=["_word_tf", "_pair_tf"], outputCol="_tf"),
        IDF(inputCol="_tf", outputCol="features", minDocFreq=1),
    ]


def _with_text(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn("text", F.coalesce(F.col(col), F.lit("")))


def _spread(df: DataFrame) -> DataFrame:
    """Label and text in parts of bounded bytes, since each try reads what one task has counted in one task again."""
    total = df.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    return df.select("label", "text").repartition(max(1, math.ceil(total / TASK_BYTES)))


def fit_detector(
    train: DataFrame, val: DataFrame, grid: tuple[float, ...] = GRID, features: int = FEATURES
) -> tuple[PipelineModel, list[tuple[float, float]]]:
    """Fit one classifier per regularisation strength; keep the best macro F1 on `val`.

    Returns the model and (strength, macro F1) of each try; of equal tries the first is kept. Classes are weighted by
    their share, and every try reads the same stored counts. Only scalars reach the driver.
    """
    literal, idiomatic, total = train.agg(
        F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1), F.count(F.lit(1))
    ).first()
    if not literal or not idiomatic or literal + idiomatic != total:
        raise ValueError(f"training needs the labels 0 and 1 only: {literal} and {idiomatic} of {total} rows")
    weight = F.when(F.col("label") == 0, total / (2.0 * literal)).otherwise(total / (2.0 * idiomatic))

    *counting, idf = feature_stages(features=features)
    count = PipelineModel(stages=counting)
    keep = ["label", "_tf"]
    # Texts are cut into words once per side; weights of terms and all fits come from the stored counts.
    counted = count.transform(_with_text(_spread(train), "text")).select(*keep, weight.alias("_weight")).persist()
    counted_val = count.transform(_with_text(_spread(val), "text")).select(*keep).persist()
    try:
        weights = idf.fit(counted)
        train_features, val_features = weights.transform(counted), weights.transform(counted_val)

        def attempt(strength: float) -> tuple[float, LogisticRegressionModel]:
            lr = LogisticRegression(
                labelCol="label", weightCol="_weight", regParam=strength, maxIter=MAX_ITERATIONS, family="binomial"
            )
            model = lr.fit(train_features)
            scored = model.transform(val_features).select(
                F.col("label").alias("actual"), F.col("prediction").cast("int").alias("predicted")
            )
            return macro_metrics(scored).first()["f1"], model

        # The tries do not depend on each other, and small ones leave tasks free.
        with ThreadPoolExecutor(min(len(grid), TRIES_AT_ONCE)) as pool:
            found = list(pool.map(attempt, grid))
    finally:
        counted.unpersist()
        counted_val.unpersist()
    best = max(found, key=lambda try_: try_[0])[1]
    return PipelineModel(stages=[*counting, weights, best]), [(s, f1) for s, (f1, _) in zip(grid, found)]


def predict(df: DataFrame, model: PipelineModel, col: str = "text") -> DataFrame:
    """Add the struct `detection` of label, confidence and is_idiomatic."""
    columns = df.columns
    scored = model.transform(df.withColumns({"_kept": F.struct(*columns), "text": F.coalesce(F.col(col), F.lit(""))}))
    return scored.select("_kept.*", detection_struct(vector_to_array("probability")).alias("detection"))


def predict_with_scorer(df: DataFrame, scorer: Callable[[Column], Column], col: str = "text") -> DataFrame:
    """The same from a scorer hook that returns logits."""
    logits = df.withColumn("_logits", scorer(F.coalesce(F.col(col), F.lit(""))))
    return logits.withColumn("detection", detection_struct(softmax("_logits"))).drop("_logits")


@dataclass(frozen=True)
class GivenModel:
    """A linear classifier from given coefficients: a text's score is the intercept plus the mean weight of its tokens.

    A token's place among the coefficients is (31 * code point of its first character + 17 * that of its last + its
    length) modulo their number. The score is the log of the odds of class 1. No model file, no fit and no Python.
    """

    coefficients: tuple[float, ...]
    intercept: float = 0.0

    def score(self, text: Column) -> Column:
        table = F.array(*[F.lit(float(c)) for c in self.coefficients])

        def weight(w: Column) -> Column:
            place = F.ascii(w) * 31 + F.ascii(F.right(w, F.lit(1))) * 17 + F.length(w)
            return F.element_at(table, (place % len(self.coefficients) + 1).cast("int"))

        def mean(words: Column) -> Column:
            total = F.aggregate(words, F.lit(0.0), lambda acc, w: acc + weight(w))
            return F.lit(float(self.intercept)) + total / F.greatest(F.size(words), F.lit(1))

        # The words go through a one-element array, so a text is cut once for both the sum and the number.
        return F.transform(F.array(tokens(F.lower(text))), mean).getItem(0)


def predict_given(df: DataFrame, model: GivenModel, col: str = "text") -> DataFrame:
    """The struct `detection` from a model of given coefficients, in built-in functions only.

    A text is scored once: the steps hand on one-element arrays, and the last is exploded, since a column that is only
    projected is computed again in each of its uses and in a filter on it.
    """
    logits = F.array(F.lit(0.0), model.score(F.coalesce(F.col(col), F.lit(""))))
    detections = F.transform(F.transform(F.array(logits), softmax), detection_struct)
    return df.withColumn("detection", F.explode(detections))


def detect(df: DataFrame, detector, col: str = "text") -> DataFrame:
    """Dispatch on a fitted model, given coefficients or a scorer hook."""
    if isinstance(detector, GivenModel):
        return predict_given(df, detector, col)
    if isinstance(detector, PipelineModel):
        return predict(df, detector, col)
    return predict_with_scorer(df, detector, col)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
