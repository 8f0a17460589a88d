"""Table schemas. Every reader selects onto one of these; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Position of a row in the order "source, file, place in file". It decides which of several
# equal rows is the first one, and it is carried as one extra column next to the unified schema.
ROW_ORD = T.StructType(
    [
        T.StructField("priority", T.IntegerType()),
        T.StructField("file", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("row", T.LongType()),
        T.StructField("sub", T.IntegerType()),
    ]
)

UNIFIED = T.StructType(
    [
        T.StructField("source_idiom", T.StringType()),
        T.StructField("source_lang", T.StringType()),
        T.StructField("target_idiom", T.StringType()),
        T.StructField("target_lang", T.StringType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("idiom_string", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

UNIFIED_ORDERED = T.StructType(UNIFIED.fields + [T.StructField("row_ord", ROW_ORD)])

DETECTION_SET = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("idiom_string", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

INDEX = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("source_idiom", T.StringType()),
        T.StructField("source_lang", T.StringType()),
        T.StructField("target_idiom", T.StringType()),
        T.StructField("target_lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)

DETECTION = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("is_idiomatic", T.BooleanType()),
    ]
)

HIT = T.StructType(
    [
        T.StructField("rank", T.IntegerType()),
        T.StructField("source_idiom", T.StringType()),
        T.StructField("source_lang", T.StringType()),
        T.StructField("target_idiom", T.StringType()),
        T.StructField("target_lang", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)

GENERATOR_TEST = T.StructType(
    [
        T.StructField("input_text", T.StringType()),
        T.StructField("target_text", T.StringType()),
        T.StructField("target_lang", T.StringType()),
    ]
)

REQUEST = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("target_lang", T.StringType()),
    ]
)

# Landed source files.
LABELLED_SENTENCE = T.StructType(
    [
        T.StructField("sentence", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("idiom", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

TAGGED_TOKENS = T.StructType(
    [
        T.StructField("tokens", T.ArrayType(T.StringType())),
        T.StructField("words", T.ArrayType(T.StringType())),
        T.StructField("tags", T.ArrayType(T.IntegerType())),
        T.StructField("ner_tags", T.ArrayType(T.IntegerType())),
        T.StructField("sentence", T.StringType()),
        T.StructField("idiom", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

MULTILINGUAL_MAP = T.StructType(
    [
        T.StructField(
            "languages",
            T.MapType(
                T.StringType(),
                T.StructType([T.StructField("expression", T.StringType())]),
            ),
        ),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

PARALLEL_CORPUS = T.StructType(
    [
        T.StructField(
            "translation",
            T.StructType([T.StructField("en", T.StringType()), T.StructField("hi", T.StringType())]),
        )
    ]
)

IDIOM_DICTIONARY = T.StructType(
    [
        T.StructField("idiom", T.StringType()),
        T.StructField("literal_meaning", T.StringType()),
        T.StructField("figurative_meaning", T.StringType()),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)
