"""Detection, then retrieval for idiomatic input only."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType

from phraseloom import schemas as S
from phraseloom.functions import fixed_values as V
from phraseloom.functions.arrays import detection_struct, softmax
from phraseloom.operators.detector import detect, load_model
from phraseloom.operators.encode import encode_text
from phraseloom.operators.retrieval import attach_hits


def failure_detail(error: Exception) -> str:
    """First line of an error, cut; a broken model folder has a fixed text."""
    lines = str(error).splitlines() or [""]
    if V.DETAIL_BAD_MODEL_MARK in lines[0]:
        return V.DETAIL_BAD_MODEL
    return lines[0][: V.FAILURE_DETAIL_CHARS]


def with_hits(
    df: DataFrame,
    index: DataFrame | None,
    k: int,
    target_lang: str | None = None,
    encoder: Callable[[Column], Column] | None = None,
    only: Column | None = None,
    **how,
) -> DataFrame:
    """Add `hits` to rows (query_id, text). Rows outside `only`, or without an index, get an empty list.

    An embedding column is used if there is one, else the text is encoded.
    """
    if index is None:
        return df.drop("embedding").withColumn("hits", F.array().cast(ArrayType(S.HIT)))
    if "embedding" not in df.columns:
        df = encode_text(df, "text", encoder, only=only)
    elif only is not None:
        df = df.withColumn("embedding", F.when(only, F.col("embedding")))
    return attach_hits(df, index, k, target_lang=target_lang, **how)


def failure_message(error: Column) -> Column:
    """The message of a row that the detector could not score, from the text of the error."""
    line = F.substring_index(error, "\n", 1)
    detail = F.when(F.contains(line, F.lit(V.DETAIL_BAD_MODEL_MARK)), V.DETAIL_BAD_MODEL).otherwise(F.substring(line, 1, V.FAILURE_DETAIL_CHARS))
    before, after = V.MESSAGE_NO_DETECTOR.split("{detail}")
    return F.concat(F.lit(before), detail, F.lit(after))


def unavailable() -> Column:
    """The detection of a row without one."""
    return F.struct(
        F.lit(V.LABEL_UNAVAILABLE).alias("label"), F.lit(None).alias("confidence"), F.lit(None).alias("is_idiomatic")
    ).cast(S.DETECTION)


def gate_retrieve(
    detected: DataFrame,
    index: DataFrame | None,
    k: int = V.GATE_HITS,
    target_lang: str | None = None,
    encoder: Callable[[Column], Column] | None = None,
    failure: str | None = None,
    **how,
) -> DataFrame:
    """input, detection, retrieval and message for rows (query_id, text, detection).

    Literal rows are neither encoded nor searched. A row with an error in the column `failure` was not scored: it is
    searched like an idiomatic one and says so.
    """
    idiomatic = F.coalesce(F.col("detection.is_idiomatic"), F.lit(False))
    failed = F.lit(False) if failure is None else F.col(failure).isNotNull()
    message = F.when(failed, F.lit(None) if failure is None else failure_message(F.col(failure))).when(~idiomatic, V.MESSAGE_LITERAL)
    if index is None:
        message = message.otherwise(V.MESSAGE_NO_INDEX)
    found = with_hits(detected, index, k, target_lang, encoder, idiomatic | failed, **how)
    return found.select(
        "query_id",
        F.col("text").alias("input"),
        "detection",
        F.col("hits").alias("retrieval"),
        message.cast("string").alias("message"),
    )


def retrieve_without_detector(
    queries: DataFrame,
    index: DataFrame | None,
    error: Exception,
    k: int = V.GATE_HITS,
    target_lang: str | None = None,
    encoder: Callable[[Column], Column] | None = None,
    **how,
) -> DataFrame:
    """The answer when the detector cannot be loaded: every row is searched."""
    return with_hits(queries, index, k, target_lang, encoder, **how).select(
        "query_id",
        F.col("text").alias("input"),
        unavailable().alias("detection"),
        F.col("hits").alias("retrieval"),
        F.lit(V.MESSAGE_NO_DETECTOR.format(detail=failure_detail(error))).alias("message"),
    )


def detect_guarded(queries: DataFrame, scorer: Callable[[Column], Column], failure: str) -> DataFrame:
    """The rows with `detection`, and in column `failure` the error of those that the scorer hook failed on."""
    scored = queries.withColumn("_scored", scorer.guarded(F.coalesce("text", F.lit(""))))
    error = F.col("_scored.error")
    detection = F.when(error.isNull(), detection_struct(softmax("_scored.logits"))).otherwise(unavailable())
    return scored.withColumns({"detection": detection, failure: error}).drop("_scored")


def retrieve_with_detector(
    queries: DataFrame,
    index: DataFrame | None,
    detector=None,
    model_path: str | None = None,
    k: int = V.GATE_HITS,
    target_lang: str | None = None,
    encoder: Callable[[Column], Column] | None = None,
    **how,
) -> DataFrame:
    """Gate with a given detector or one loaded from a path; blank input must be filtered before.

    A detector that cannot be loaded, and a scorer hook that fails on a row, lead to the search with a message.
    """
    if detector is None:
        try:
            if model_path is None:
                raise OSError("no detector model given")
            detector = load_model(model_path)
        except (OSError, ValueError, RuntimeError, PySparkException, Py4JJavaError) as error:
            return retrieve_without_detector(queries, index, error, k, target_lang, encoder, **how)
    if hasattr(detector, "guarded"):
        failure = "_failure"
        return gate_retrieve(detect_guarded(queries, detector, failure), index, k, target_lang, encoder, failure, **how)
    return gate_retrieve(detect(queries, detector), index, k, target_lang, encoder, **how)
