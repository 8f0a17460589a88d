"""Readers of landed source files. Each returns the unified columns plus row_ord."""

from __future__ import annotations

import csv
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from phraseloom import schemas as S
from phraseloom.functions import fixed_values as V
from phraseloom.functions.text import any_nonzero, field, is_blank, join_tokens, strip
from phraseloom.operators.ordering import file_order, order_struct
from phraseloom.operators.sampling import systematic_sample_by_row_ord
from phraseloom.storage import stored


def read_records(spark: SparkSession, path: str, schema: StructType, fmt: str = "json", **options) -> DataFrame:
    """Records of a file or folder with a given schema and their file order."""
    reader = spark.read.format(fmt).schema(schema).option("mode", "PERMISSIVE")
    return reader.options(**options).load(path).select("*", file_order(fmt).alias("row_ord"))


def read_json_lists(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Whole-file JSON in a folder tree: a list of objects, or one object read as a list of one."""
    return read_records(spark, path, schema, multiLine=True, recursiveFileLookup=True, pathGlobFilter="*.json")


def _unreadable(records: DataFrame) -> Column:
    # Spark refuses a query on the corrupt column alone, so the data columns take part in the test.
    data = [c for c in records.columns if c not in ("_corrupt_record", "row_ord")]
    return F.col("_corrupt_record").isNotNull() & reduce(lambda a, b: a & b, [F.col(c).isNull() for c in data])


def corrupt_count(records: DataFrame) -> DataFrame:
    """Number of files or lines that are not valid JSON."""
    return records.agg(F.count_if(_unreadable(records)).alias("n_corrupt"))


def drop_corrupt(records: DataFrame) -> DataFrame:
    """Without the files or lines that are not valid JSON; a format without such a column passes."""
    if "_corrupt_record" not in records.columns:
        return records
    return records.filter(~_unreadable(records)).drop("_corrupt_record")


def empty_unified(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], S.UNIFIED_ORDERED)


def unified_row(
    source_idiom: Column,
    source_lang: Column | str,
    target_idiom: Column,
    target_lang: Column | str,
    label: Column,
    idiom_string: Column,
    split: Column,
    source: str,
) -> list[Column]:
    """The unified columns in order."""

    def as_lit(x: Column | str) -> Column:
        return F.lit(x) if isinstance(x, str) else x

    return [
        source_idiom.alias("source_idiom"),
        as_lit(source_lang).alias("source_lang"),
        target_idiom.alias("target_idiom"),
        as_lit(target_lang).alias("target_lang"),
        label.cast("int").alias("label"),
        idiom_string.alias("idiom_string"),
        split.alias("split"),
        F.lit(source).alias("source"),
    ]


def _split_of_file() -> Column:
    """The split column or folder if there is one, else the file name without its ending."""
    stem = F.regexp_extract(F.col("row_ord.file"), r"([^/]+?)(?:\.[^/]*)?$", 1)
    return F.coalesce(F.col("split"), stem)


def labelled_sentences(records: DataFrame) -> DataFrame:
    """Sentence records -> unified rows. Only the word "idiomatic", in any case, gives label 1."""
    is_idiomatic = F.lower(F.coalesce(F.col("label"), F.lit(""))) == "idiomatic"
    return records.select(
        *unified_row(
            F.coalesce("sentence", "text", F.lit("")),
            "en",
            F.lit(""),
            "",
            is_idiomatic.cast("int"),
            F.coalesce("idiom", F.lit("")),
            _split_of_file(),
            V.SOURCE_LABELLED,
        ),
        "row_ord",
    )


def read_labelled_sentences(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return labelled_sentences(drop_corrupt(read_records(spark, path, S.LABELLED_SENTENCE, fmt)))


def tagged_tokens(records: DataFrame) -> DataFrame:
    """Token records -> unified rows. Label 1 if some tag is non-zero; the text is the joined tokens."""
    toks = F.coalesce("tokens", "words")
    text = F.when(F.size(toks) > 0, join_tokens(toks)).otherwise(F.coalesce("sentence", F.lit("")))
    return records.select(
        *unified_row(
            text,
            "en",
            F.lit(""),
            "",
            any_nonzero(F.coalesce("tags", "ner_tags")),
            F.coalesce("idiom", F.lit("")),
            _split_of_file(),
            V.SOURCE_TAGGED,
        ),
        "row_ord",
    )


def read_tagged_tokens(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return tagged_tokens(drop_corrupt(read_records(spark, path, S.TAGGED_TOKENS, fmt)))


def language_pairs(languages: Column) -> Column:
    """Map of language -> struct(expression) to the array of all ordered pairs i < j in key order.

    A key that occurs twice counts once, at its first place with its last value. The array has one
    element per language pair of this one row.
    """
    entries = F.map_entries(languages)
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))

    def last_expression(k: Column) -> Column:
        value = F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]
        return field(value, "expression")

    present = F.filter(
        F.transform(keys, lambda k: F.struct(k.alias("lang"), last_expression(k).alias("expression"))),
        lambda e: e["expression"] != "",
    )
    # The list enters through a one-element array, so the lambdas below share one computed copy.
    return F.transform(
        F.array(present),
        lambda es: F.flatten(
            F.transform(
                es,
                lambda a, i: F.transform(
                    F.slice(es, i + 2, F.size(es)),
                    lambda b: F.struct(
                        a["expression"].alias("source_idiom"),
                        a["lang"].alias("source_lang"),
                        b["expression"].alias("target_idiom"),
                        b["lang"].alias("target_lang"),
                    ),
                ),
            )
        ),
    ).getItem(0)


def multilingual_map(records: DataFrame) -> DataFrame:
    """Entries with a map of languages -> one unified row per language pair, in one direction."""
    pairs = records.select("row_ord", F.posexplode(language_pairs(F.col("languages"))).alias("_pos", "_p"))
    return pairs.select(
        *unified_row(
            F.col("_p.source_idiom"),
            F.col("_p.source_lang"),
            F.col("_p.target_idiom"),
            F.col("_p.target_lang"),
            F.lit(1),
            F.col("_p.source_idiom"),
            F.lit("unlabeled"),
            V.SOURCE_MULTILINGUAL,
        ),
        F.col("row_ord").withField("sub", F.col("_pos")).alias("row_ord"),
    )


def read_multilingual_map(spark: SparkSession, path: str) -> DataFrame:
    return multilingual_map(drop_corrupt(read_json_lists(spark, path, S.MULTILINGUAL_MAP)))


def parallel_corpus(records: DataFrame) -> DataFrame:
    """Translation records -> unified rows with label -1; both texts trimmed and present."""
    present = records.filter(~is_blank("translation.en") & ~is_blank("translation.hi"))
    en, hi = strip("translation.en"), strip("translation.hi")
    return present.select(
        *unified_row(en, "en", hi, "hi", F.lit(V.PARALLEL_LABEL), F.lit(""), F.lit("train"), V.SOURCE_PARALLEL),
        "row_ord",
    )


def read_parallel_corpus(
    spark: SparkSession, path: str, sample_n: int | None = V.PARALLEL_SAMPLE, fmt: str = "json"
) -> DataFrame:
    """Systematic sample in file order, then the blank filter, so fewer than sample_n rows may stay; None takes all."""
    records = read_records(spark, path, S.PARALLEL_CORPUS, fmt)
    if sample_n is None:
        return parallel_corpus(records)
    return parallel_corpus(systematic_sample_by_row_ord(records, sample_n))


def idiom_dictionary(records: DataFrame, lang: str) -> DataFrame:
    """Dictionary items -> two unified rows each: native to English, and English to native."""
    native = F.coalesce("idiom", F.lit(""))
    meaning = F.coalesce("figurative_meaning", F.lit(""))

    def row(src, src_lang, tgt, tgt_lang, source) -> Column:
        return F.struct(*unified_row(src, src_lang, tgt, tgt_lang, F.lit(1), native, F.lit("train"), source))

    both = F.array(
        row(native, lang, meaning, "en", V.SOURCE_DICTIONARY),
        row(meaning, "en", native, lang, V.SOURCE_DICTIONARY_REVERSE),
    )
    return records.select("row_ord", F.posexplode(both).alias("_pos", "_p")).select(
        "_p.*", F.col("row_ord").withField("sub", F.col("_pos")).alias("row_ord")
    )


def read_idiom_json(spark: SparkSession, path: str, lang: str) -> DataFrame:
    return idiom_dictionary(drop_corrupt(read_json_lists(spark, path, S.IDIOM_DICTIONARY)), lang)


def read_meaning_json_pairs(spark: SparkSession, paths: list[str]) -> DataFrame:
    return meaning_pairs(drop_corrupt(read_json_lists(spark, paths, S.IDIOM_DICTIONARY)))


def meaning_pairs(records: DataFrame) -> DataFrame:
    """English meaning -> native idiom from dictionary items; the file name gives the language."""
    name = F.regexp_extract(F.col("row_ord.file"), r"([^/]+)$", 1)
    table = F.create_map(*[F.lit(x) for kv in V.DICTIONARY_LANGUAGES.items() for x in kv])
    present = records.filter(~is_blank("figurative_meaning") & ~is_blank("idiom"))
    return present.select(
        strip("figurative_meaning").alias("source_idiom"),
        F.lit("en").alias("source_lang"),
        strip("idiom").alias("target_idiom"),
        F.try_element_at(table, name).alias("target_lang"),
        F.concat(F.lit("Raw-"), name).alias("source"),
        "row_ord",
    ).filter(F.col("target_lang").isNotNull())


def files_by_header(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """(column names, files) of each distinct header among CSV files, found in one job.

    A header is the first line that is not blank; names are compared without case and white space around them.
    """
    meta = {"file": F.col("_metadata.file_path"), "block": F.col("_metadata.file_block_start"), "row": F.monotonically_increasing_id()}
    lines = spark.read.text(path).select("value", *[c.alias(name) for name, c in meta.items()])
    first = lines.filter((F.col("block") == 0) & ~is_blank("value")).groupBy("file").agg(F.min_by("value", "row").alias("header"))
    same = first.groupBy(F.lower("header").alias("_same")).agg(F.min("header").alias("header"), F.sort_array(F.collect_list("file")).alias("files"))
    found = same.orderBy("_same").collect()
    names = [[c.strip().lower() for c in next(csv.reader([r["header"].lstrip("\ufeff")]))] for r in found]
    return [(n, [unquote(f) for f in r["files"]]) for n, r in zip(names, found)]


def csv_by_header(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV files by the names in their headers, in any order; columns that are not there are null.

    Files of a folder or pattern may differ in their headers; those with the same are one scan.
    """
    frames = []
    for names, files in files_by_header(spark, path):
        columns = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
        found = spark.read.options(header=True, multiLine=True, escape='"').schema(columns).csv(files)
        have = {name: f"c{i}" for i, name in reversed(list(enumerate(names)))}
        picked = [(F.col(have[f.name]) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
        frames.append(found.select(*picked, file_order().alias("row_ord")))
    if not frames:
        return spark.createDataFrame([], StructType(schema.fields + [StructField("row_ord", S.ROW_ORD)]))
    return reduce(lambda a, b: a.unionByName(b), frames)


def read_pair_csv(spark: SparkSession, glob: str) -> DataFrame:
    """Curated CSV files with the unified columns, found by name."""
    return csv_by_header(spark, glob, S.UNIFIED)


def _files(spark: SparkSession, path: str) -> list[str]:
    """The files of a source. Only the listing is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    return sorted(r[0] for r in found.collect())


def _stem(path: str) -> str:
    return path.rsplit("/", 1)[-1].split(".", 1)[0]


_UNREADABLE = (AnalysisException, PySparkException, Py4JJavaError)


def _left_out(path: str, error: Exception) -> None:
    print(f"{path}: left out, {str(error).splitlines()[0][:200]}")


def _readable(spark: SparkSession, reader: Callable, files: list[str]) -> tuple[list[DataFrame], list[str]]:
    """Stored reads of the files that can be read, and the broken files.

    A set of files that fails is halved, so a broken file costs about twice the logarithm of their number in reads, and
    the good ones are a few scans of many files.
    """
    try:
        return [stored(reduce(lambda a, b: a.unionByName(b), [reader(spark, file) for file in files]))], []
    except _UNREADABLE as error:
        if len(files) == 1:
            _left_out(files[0], error)
            return [], files
    half = len(files) // 2
    (good, broken), (more, others) = _readable(spark, reader, files[:half]), _readable(spark, reader, files[half:])
    return good + more, broken + others


def read_or_fallback(
    spark: SparkSession,
    reader: Callable[[SparkSession, str], DataFrame],
    primary: str,
    fallback_csv: str | None = None,
) -> DataFrame:
    """The primary source, stored by one read of it; for files that cannot be read, local CSV files; else no rows.

    A broken file shows only when it is read. Then halves of the files are tried, down to the broken ones: the good ones
    stay, and each broken one is replaced by the CSV files of its name (up to the first dot) at `fallback_csv`, a folder
    or pattern. A fallback that is one file of another name stands for the whole source, if nothing of it can be read or
    it is not there.
    """
    try:
        return stored(reader(spark, primary))
    except _UNREADABLE as error:
        _left_out(primary, error)
    good, broken = [], []
    try:
        files = _files(spark, primary)
    except _UNREADABLE:
        files = []
    if len(files) > 1:
        half = len(files) // 2
        for part in (files[:half], files[half:]):
            frames, bad = _readable(spark, reader, part)
            good += frames
            broken += [_stem(file) for file in bad]
    if fallback_csv is not None:
        try:
            instead = read_pair_csv(spark, fallback_csv)
            if good:
                name = F.regexp_extract(F.col("row_ord.file"), r"([^/.]*)[^/]*$", 1)
                instead = instead.filter(name.isin(*broken))
            good.append(stored(instead))
        except _UNREADABLE as error:
            _left_out(fallback_csv, error)
    return reduce(lambda a, b: a.unionByName(b), good) if good else empty_unified(spark)


def synthetic_order(id_col: Column, sub: Column | None = None) -> Column:
    """row_ord for a table with a numeric id: 2^17 ids form one chunk."""
    return order_struct(block=F.shiftright(id_col.cast("bigint"), 17), row=id_col, sub=sub)
