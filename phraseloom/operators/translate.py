"""Context line, prompt, batch translation and response rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from phraseloom.functions import fixed_values as V
from phraseloom.functions.language import language_code, language_name
from phraseloom.functions.text import as_column, capitalize, is_blank
from phraseloom.hooks import top_hit_translator
from phraseloom.operators.detector import detect
from phraseloom.operators.filters import idiomatic_only, language_filter, nonempty_text
from phraseloom.operators.gate import with_hits

RECORD = ["english_idiom", "detected_confidence", "retrieved_context", "target_language", "translation"]


def context_string(hits: Column | str) -> Column:
    """Target phrases of the hits in rank order, quoted; blank without hits."""
    hits = as_column(hits)
    quoted = F.transform(hits, lambda h: F.concat(F.lit("'"), h["target_idiom"], F.lit("'")))
    line = F.concat(F.lit(V.CONTEXT_PREFIX), F.array_join(quoted, ", "))
    return F.when(F.size(hits) > 0, line).otherwise("")


def _fill(template: str, **parts: Column) -> Column:
    """A text with {name} places as a concat of literals and columns."""
    pieces, rest = [], template
    while "{" in rest:
        before, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        pieces += [F.lit(before), parts[name]]
    return F.concat(*pieces, F.lit(rest))


def system_text(language: Column | str) -> Column:
    return _fill(V.SYSTEM_TEXT, language=capitalize(language))


def prompt_text(text: Column | str, context: Column | str, language: Column | str) -> Column:
    """The user prompt; the context line is there only for a non-empty context."""
    context = as_column(context)
    context_line = F.when(context != "", _fill(V.PROMPT_CONTEXT_LINE, context=context)).otherwise("")
    return F.concat(
        _fill(V.PROMPT_IDIOM_LINE, text=as_column(text)),
        context_line,
        _fill(V.PROMPT_LAST_LINE, language=capitalize(language)),
    )


def translate_rows(
    detected: DataFrame,
    index: DataFrame,
    translator: Callable[[DataFrame], DataFrame] = top_hit_translator,
    encoder: Callable[[Column], Column] | None = None,
    k: int = V.PIPELINE_HITS,
    **how,
) -> DataFrame:
    """All rows (query_id, text, target_language, detection) with retrieved_context, translation and `translated`.

    Blank and literal rows are neither encoded nor searched; their prompt is null, and a translator makes no call for
    such a row. The language name of each row selects its target language; an unknown name searches all.
    """
    todo = ~is_blank("text") & F.coalesce(F.col("detection.is_idiomatic"), F.lit(False))
    rows = detected.withColumns({"want_lang": language_code("target_language"), "translated": todo})
    rows = with_hits(rows, index, k, encoder=encoder, only=F.col("translated"), **how)
    rows = rows.withColumn("retrieved_context", F.when(F.col("translated"), context_string("hits")))
    prompt = prompt_text("text", "retrieved_context", "target_language")
    rows = rows.withColumns({"system_text": system_text("target_language"), "prompt": F.when(F.col("translated"), prompt)})
    done = translator(rows).withColumn("translation", F.when(F.col("translated"), F.col("translation")))
    return done.drop("want_lang", "hits", "system_text", "prompt")


def translate_detected(
    detected: DataFrame,
    index: DataFrame,
    translator: Callable[[DataFrame], DataFrame] = top_hit_translator,
    encoder: Callable[[Column], Column] | None = None,
    k: int = V.PIPELINE_HITS,
    **how,
) -> DataFrame:
    """Translation records of the idiomatic rows; the others leave before encoding, search and translation."""
    todo = idiomatic_only(nonempty_text(detected))
    return translate_rows(todo, index, translator, encoder, k, **how).select(
        "query_id",
        F.col("text").alias("english_idiom"),
        F.col("detection.confidence").alias("detected_confidence"),
        "retrieved_context",
        capitalize("target_language").alias("target_language"),
        "translation",
    )


def translate_batch(
    df: DataFrame,
    index: DataFrame,
    detector,
    language: str | None = None,
    translator: Callable[[DataFrame], DataFrame] = top_hit_translator,
    encoder: Callable[[Column], Column] | None = None,
    **how,
) -> DataFrame:
    """Detect and translate (query_id, text), all into `language` or each into its target_language."""
    if language is not None:
        df = df.withColumn("target_language", F.lit(language))
        if isinstance(index, DataFrame):
            # Rows of other languages are no hits of any row; an unknown language searches all.
            index = language_filter(index, None, V.LANGUAGE_CODES.get(language.lower()))
    return translate_detected(detect(nonempty_text(df), detector), index, translator, encoder, **how)


def requests_with_language(requests: DataFrame) -> DataFrame:
    """Requests (query_id, text, target_lang code) with the language name; a missing code is the default."""
    code = F.coalesce(F.col("target_lang"), F.lit(V.DEFAULT_LANGUAGE_CODE))
    return requests.withColumns({"text": F.coalesce("text", F.lit("")), "target_language": language_name(code)})


def api_response(answered: DataFrame) -> DataFrame:
    """One response per row of translate_rows(): an error for empty text, fixed texts for literal input."""
    empty = F.coalesce("text", F.lit("")) == ""

    def answer(value: str, missing: str, literal: str) -> Column:
        shown = F.when(F.col("translated"), F.coalesce(value, F.lit(missing))).otherwise(literal)
        return F.when(~empty, shown)

    return answered.select(
        "query_id",
        answer("retrieved_context", V.RESPONSE_NO_CONTEXT, V.RESPONSE_LITERAL_CONTEXT).alias("retrieved_context"),
        answer("translation", V.RESPONSE_NO_TRANSLATION, V.RESPONSE_LITERAL_TRANSLATION).alias("generated_translation"),
        F.when(empty, V.RESPONSE_NO_TEXT).alias("error"),
    )


def literal_passthrough(answered: DataFrame) -> DataFrame:
    """Rows of translate_rows() with a prediction: the translation, or the row's own text if it was not translated.

    A null translation counts as an empty prediction, not as a missing one.
    """
    own = F.when(F.col("translated"), F.coalesce("translation", F.lit(""))).otherwise(F.col("text"))
    return answered.withColumn("prediction", own)
