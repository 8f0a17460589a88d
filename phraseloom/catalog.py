"""Queries over the driver tables, one per operator. Each reads its whole tables.

`lab` is documents joined with labels, the label being the quality; `pairs` is a user turn with the
assistant turn that follows; `idx` is the embeddings with the vector label as target language.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from phraseloom import hooks
from phraseloom.functions import arrays, fixed_values as V, language
from phraseloom.functions.text import clean_text, token_count
from phraseloom.operators import dedup, detector, encode, evaluate, filters, gate, metrics, profile, retrieval
from phraseloom.operators import sampling, splitting, translate
from phraseloom.plans import evaluation, index as index_plan, prepare, profile_report as report_plan, unify as unify_plan
from phraseloom.schemas import UNIFIED
from phraseloom.sinks.tables import index_manifest as manifest_of
from phraseloom.sources import landed
from phraseloom.storage import new_path, shared_folder, stored
from phraseloom.streaming.translate import translate_stream


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lab(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    quality = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return docs.join(quality, "doc_id").withColumn("idiom_string", F.lit(""))


def lab_unified(spark: SparkSession, sf: str) -> DataFrame:
    return lab(spark, sf).select(
        F.col("text").alias("source_idiom"),
        F.col("lang").alias("source_lang"),
        F.lit("").alias("target_idiom"),
        F.lit("").alias("target_lang"),
        "label",
        "idiom_string",
        F.lit("train").alias("split"),
        "source",
        landed.synthetic_order(F.col("doc_id")).alias("row_ord"),
    )


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    asked = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("source_idiom"))
    answered = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("target_idiom")
    )
    code = F.element_at(F.array(F.lit("hi"), F.lit("te"), F.lit("ml")), (F.col("conv_id") % 3 + 1).cast("int"))
    return asked.join(answered, ["conv_id", "turn"]).select(
        "conv_id", "turn", "source_idiom", F.lit("en").alias("source_lang"), "target_idiom", code.alias("target_lang")
    )


def pairs_unified(spark: SparkSession, sf: str) -> DataFrame:
    return pairs(spark, sf).select(
        "source_idiom",
        "source_lang",
        "target_idiom",
        "target_lang",
        F.lit(V.PARALLEL_LABEL).alias("label"),
        F.lit("").alias("idiom_string"),
        F.lit("train").alias("split"),
        F.lit("conversations").alias("source"),
        landed.order_struct(block=F.col("conv_id"), row=F.col("turn")).alias("row_ord"),
    )


def unified(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_unified(dedup.concat_sources([lab_unified(spark, sf), pairs_unified(spark, sf)]))


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.clean_detection(lab_unified(spark, sf))


def idx(spark: SparkSession, sf: str) -> DataFrame:
    vec_id = F.col("vec_id")
    return table(spark, sf, "embeddings").select(
        vec_id.alias("row_id"),
        F.concat(F.lit("s"), vec_id.cast("string")).alias("source_idiom"),
        F.lit("en").alias("source_lang"),
        F.concat(F.lit("t"), vec_id.cast("string")).alias("target_idiom"),
        F.col("label").cast("string").alias("target_lang"),
        F.lit("embeddings").alias("source"),
        "embedding",
    )


def vec_queries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding", "label")


def known_detections(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a quality and a vector; the quality is the detection."""
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    probabilities = F.array(1 - F.col("label") * 0.75, F.col("label") * 0.75)
    return (
        lab(spark, sf)
        .join(vectors, "doc_id")
        .select(
            F.col("doc_id").alias("query_id"),
            "text",
            "embedding",
            arrays.detection_struct(probabilities).alias("detection"),
        )
    )


def three_language_index(spark: SparkSession, sf: str) -> DataFrame:
    code = F.element_at(F.array(F.lit("hi"), F.lit("te"), F.lit("ml")), (F.col("row_id") % 3 + 1).cast("int"))
    return idx(spark, sf).withColumn("target_lang", code)


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """The known detections as requests for one of four languages; the fourth is unknown."""
    names = F.array(F.lit("hindi"), F.lit("Telugu"), F.lit("MALAYALAM"), F.lit("tamil"))
    chosen = F.element_at(names, (F.col("query_id") % 4 + 1).cast("int"))
    return known_detections(spark, sf).withColumn("target_language", chosen)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return lab(spark, sf).select(
        F.col("label").alias("actual"), (F.col("n_chars") > 500).cast("int").alias("predicted")
    )


def shortened(spark: SparkSession, sf: str) -> DataFrame:
    """Each document as a prediction, the same without its first word as the reference."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("pair_id"),
        F.col("text").alias("prediction"),
        F.regexp_replace("text", r"\A\S+\s*", "").alias("reference"),
    )


# ---------------------------------------------------------------------- queries


def q_clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", clean_text("text").alias("text"), token_count("text").alias("n"))


def q_labelled_sentences(spark, sf):
    records = lab(spark, sf).select(
        F.when(F.col("doc_id") % 2 == 0, F.col("text")).alias("sentence"),
        "text",
        F.when(F.col("label") == 1, "Idiomatic").when(F.col("doc_id") % 3 == 0, "1").otherwise("literal").alias("label"),
        F.col("source").alias("idiom"),
        F.col("lang").alias("split"),
        landed.synthetic_order(F.col("doc_id")).alias("row_ord"),
    )
    return landed.labelled_sentences(records).drop("row_ord")


def q_tagged_tokens(spark, sf):
    words = F.split("text", " ")
    records = table(spark, sf, "documents").select(
        F.when(F.col("doc_id") % 5 != 0, words).alias("tokens"),
        words.alias("words"),
        F.transform(words, lambda w: (F.length(w) > 24).cast("int")).alias("tags"),
        F.lit(None).cast("array<int>").alias("ner_tags"),
        F.col("text").alias("sentence"),
        F.col("source").alias("idiom"),
        F.col("lang").alias("split"),
        landed.synthetic_order(F.col("doc_id")).alias("row_ord"),
    )
    return landed.tagged_tokens(records).drop("row_ord")


def _part_languages() -> Column:
    def entry(c: Column) -> Column:
        return F.struct(c.alias("expression"))

    size = F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_size").cast("string"))
    return F.create_map(
        F.lit("te"), entry(F.col("p_name")), F.lit("en"), entry(size), F.lit("hi"), entry(F.col("p_brand")),
        F.lit("ml"), entry(F.col("p_type")),
    )


def q_pair_expand(spark, sf):
    records = table(spark, sf, "part").select(
        "p_partkey", _part_languages().alias("languages"), landed.synthetic_order(F.col("p_partkey")).alias("row_ord")
    )
    return landed.multilingual_map(records).select("*", F.col("row_ord.row").alias("entry")).drop("row_ord")


def q_parallel_corpus(spark, sf):
    # Every n-th pair in id order, then the blank filter.
    records = pairs(spark, sf).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.struct(F.col("source_idiom").alias("en"), F.col("target_idiom").alias("hi")).alias("translation"),
        landed.synthetic_order(F.col("conv_id")).alias("row_ord"),
    )
    return landed.parallel_corpus(sampling.systematic_sample(records, 100, "id")).drop("row_ord")


def _dictionary(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_name").alias("idiom"),
        F.lit(None).cast("string").alias("literal_meaning"),
        F.concat_ws(" ", "p_type", "p_brand").alias("figurative_meaning"),
        landed.synthetic_order(F.col("p_partkey")).alias("row_ord"),
    )


def q_bidirectional_pairs(spark, sf):
    return landed.idiom_dictionary(_dictionary(spark, sf), "ml").drop("row_ord")


def q_meaning_pairs(spark, sf):
    file = F.element_at(F.array(F.lit("/raw/hindi.json"), F.lit("/raw/telugu.json"), F.lit("/raw/other.json")), (F.col("row_ord.row") % 3 + 1).cast("int"))
    records = _dictionary(spark, sf).withColumn("row_ord", F.col("row_ord").withField("file", file))
    return landed.meaning_pairs(records).drop("row_ord")


def _landing(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one, where a query lands files that it reads back."""
    return new_path(spark, label)


def q_csv_by_header(spark, sf):
    """Pairs landed as CSV files of three headers: all columns, another order and case, and without the label."""
    base = _landing(spark, "csv")
    rows = pairs_unified(spark, sf).drop("row_ord")
    third = F.length("source_idiom") % 3
    orders = [list(UNIFIED.names), [c.upper() for c in reversed(UNIFIED.names)], ["source_idiom", "extra", "target_idiom", "source_lang", "target_lang"]]
    for i, names in enumerate(orders):
        part = rows.filter(third == i).withColumn("extra", F.lit("x, \"y\""))
        part.select(*[F.col(n.lower()).alias(n) for n in names]).repartition(2).write.options(header=True, escape='"').csv(f"{base}/part{i}")
    return landed.read_pair_csv(spark, f"{base}/part*").drop("row_ord")


def _rename(spark: SparkSession, pattern: str, name: Callable[[str], str]) -> None:
    """Give landed part files their names, which readers look at."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(pattern).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(hadoop.Path(pattern)):
        fs.rename(status.getPath(), hadoop.Path(name(status.getPath().toString())))


ROWS_PER_CSV = 10_000


def _land_json_lists(df: DataFrame, key: Column, folder: str) -> None:
    """One file per 500 keys, each a JSON list of records."""
    every = df.select(F.to_json(F.struct(*df.columns)).alias("j"), F.floor(key / 500).alias("g"))
    lists = every.groupBy("g").agg(F.concat(F.lit("["), F.array_join(F.collect_list("j"), ","), F.lit("]")).alias("value"))
    lists.write.partitionBy("g").text(folder)
    _rename(df.sparkSession, f"{folder}/g=*/part-*", lambda path: path.rsplit("/", 1)[0] + "/list.json")


def _sentences(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("label") == 1, "idiomatic").otherwise("literal").alias("label")
    return lab(spark, sf).select(F.col("text").alias("sentence"), label, F.col("source").alias("idiom"), F.lit("train").alias("split"))


def q_read_or_fallback(spark, sf):
    """Labelled sentences landed as JSON; one file is no valid gzip file and is replaced by the CSV files of its name."""
    base, records = _landing(spark, "fallback"), _sentences(spark, sf)
    even = F.length("sentence") % 2 == 0
    records.filter(even).write.json(f"{base}/good")
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/good/broken.json.gz")
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    out.write(bytearray(b"\x1f\x8b no gzip stream"))
    out.close()
    instead = records.filter(~even).withColumns({"text": F.lit(None), "row_ord": landed.synthetic_order(F.lit(0))})
    # One task reads a CSV file with line breaks in its texts, so files have bounded numbers of rows.
    sized = landed.labelled_sentences(instead).drop("row_ord").write.options(header=True, escape='"', maxRecordsPerFile=ROWS_PER_CSV)
    sized.csv(f"{base}/csv")
    _rename(spark, f"{base}/csv/part-*", lambda path: path.replace("/part-", "/broken."))
    return landed.read_or_fallback(spark, landed.read_labelled_sentences, f"{base}/good", f"{base}/csv/broken*.csv").drop("row_ord")


def _land_sources(spark: SparkSession, sf: str) -> str:
    """Raw source files from the driver tables: labelled sentences, multilingual entries, pairs and a dictionary."""
    raw, part = _landing(spark, "raw"), table(spark, sf, "part")
    _sentences(spark, sf).repartition(3).write.json(f"{raw}/labelled")
    _land_json_lists(part.select(_part_languages().alias("languages"), "p_partkey"), F.col("p_partkey"), f"{raw}/multilingual")
    both = F.struct(F.col("source_idiom").alias("en"), F.col("target_idiom").alias("hi")).alias("translation")
    pairs(spark, sf).select(both).repartition(4).write.json(f"{raw}/parallel")
    _land_json_lists(_dictionary(spark, sf).withColumn("n", F.col("row_ord.row")).drop("row_ord"), F.col("n"), f"{raw}/malayalam.json")
    return raw


def q_unify_job(spark, sf):
    """The job over landed files; per source, rows and distinct texts of the stored table."""
    raw, out = _land_sources(spark, sf), _landing(spark, "unified")
    unify_plan.build_unified_dataset(spark, raw, out, sample_n=None)
    rows = spark.read.parquet(f"{out}/unified_idioms")
    cross = spark.read.parquet(f"{out}/cross_lingual")
    whole = rows.groupBy("source", "label").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("source_idiom").alias("n_texts"))
    targets = cross.groupBy("source", "label").agg(F.count(F.lit(1)).alias("n_cross"))
    return whole.join(targets, ["source", "label"], "left").select("source", "label", "n", "n_texts", F.coalesce("n_cross", F.lit(0)).alias("n_cross"))


def q_prepare_job(spark, sf):
    """Cleaning and splitting as a job: the stored split table."""
    base = _landing(spark, "prepared")
    lab_unified(spark, sf).write.parquet(f"{base}/detection_only")
    prepare.run_preprocessing(spark, f"{base}/detection_only", base)
    return spark.read.parquet(f"{base}/splits").select("text", "label", "split")


def q_index_job(spark, sf):
    """The index as a job, read back from its folder."""
    base = _landing(spark, "index")
    rows = index_plan.build_index(spark, pairs_unified(spark, sf), base, "en", "te")
    return rows.select("row_id", "source_idiom", "target_idiom", "target_lang", F.size("embedding").alias("dim"))


def _tagging_translator():
    return lambda systems, prompts: [f" {len(s)}:{len(p)} " for s, p in zip(systems, prompts)]


def q_translator_hook(spark, sf):
    """A translator hook that tells the lengths of what it was given; literal rows never reach it."""
    answered = translate.translate_rows(requests(spark, sf), three_language_index(spark, sf), hooks.translator(_tagging_translator))
    return answered.select("query_id", "translated", "translation")


def q_unify_dedup(spark, sf):
    return unified(spark, sf).drop("row_ord")


def q_detection_subset(spark, sf):
    return filters.labelled_only(unified(spark, sf)).drop("row_ord")


def q_cross_lingual_subset(spark, sf):
    return filters.with_target(unified(spark, sf)).drop("row_ord")


def q_min_tokens(spark, sf):
    rows = filters.min_tokens(filters.nonempty_text(lab(spark, sf)))
    return filters.clean_column(rows).select("doc_id", "text", "label")


def q_dedup_clean(spark, sf):
    return cleaned(spark, sf).drop("row_ord")


def q_dropped_counts(spark, sf):
    return filters.dropped_counts(filters.clean_column(lab(spark, sf)))


def q_blank_rejected(spark, sf):
    half = lab(spark, sf).select("doc_id", F.when(F.col("n_chars") % 4 == 0, F.lit(" \t ")).otherwise(F.col("text")).alias("text"))
    return filters.split_blank(half)[1].select("doc_id", "error")


def q_index_pairs(spark, sf):
    both = dedup.concat_sources([pairs_unified(spark, sf), landed.idiom_dictionary(_dictionary(spark, sf), "ml")])
    return index_plan.index_pairs(both).select("source_idiom", "source_lang", "target_idiom", "target_lang", "source")


def q_index_row_ids(spark, sf):
    found = index_plan.index_pairs(landed.idiom_dictionary(_dictionary(spark, sf), "ml"))
    return index_plan.number_rows(found).select("row_id", *filters.PAIR_KEYS)


def q_exclude_source(spark, sf):
    half = unified(spark, sf).withColumn("source", F.when(F.col("source") == "src1", "KUNCHUKUTTAN").otherwise(F.col("source")))
    return filters.exclude_source(half).select("source_idiom", "source_lang", "label", "source")


def q_language_filter(spark, sf):
    return filters.language_filter(pairs(spark, sf), "en", "te")


def q_index_manifest(spark, sf):
    row = manifest_of(idx(spark, sf), "driver vectors")
    return row.withColumns({c: F.array_join(c, ",") for c in ("source_langs", "target_langs")})


def q_distinct_languages(spark, sf):
    row = profile.distinct_languages(unified(spark, sf))
    return row.select(*[F.array_join(c, ",").alias(c) for c in row.columns])


def q_row_counts(spark, sf):
    out = None
    for name in ("documents", "labels", "conversations", "embeddings"):
        one = profile.row_count(table(spark, sf, name)).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def q_label_distribution(spark, sf):
    return profile.label_distribution(filters.labelled_only(unified(spark, sf)))


def q_class_balance(spark, sf):
    return profile.class_balance(lab(spark, sf))


def q_imbalance(spark, sf):
    return profile.imbalance_check(cleaned(spark, sf))


def q_distinct_label_count(spark, sf):
    n = sampling.distinct_label_count(lab(spark, sf))
    return spark.range(1).select(F.lit(n).cast("bigint").alias("n_labels"))


def q_length_stats(spark, sf):
    return profile.token_length_stats(table(spark, sf, "documents"))


def q_length_histogram(spark, sf):
    return profile.token_length_histogram(table(spark, sf, "documents"))


def q_source_breakdown(spark, sf):
    return profile.source_breakdown(table(spark, sf, "documents"))


def q_language_counts(spark, sf):
    return profile.language_counts(unified(spark, sf))


def q_pair_coverage(spark, sf):
    return profile.pair_coverage(pairs(spark, sf))


def q_systematic_sample(spark, sf):
    return sampling.systematic_sample(table(spark, sf, "documents"), 300, "doc_id").select("doc_id", "lang", "n_chars")


def q_stratified_split(spark, sf):
    return splitting.stratified_split(stored(cleaned(spark, sf))).select("text", "label", "split")


def q_random_split(spark, sf):
    return splitting.random_split(table(spark, sf, "documents"), key="doc_id").select("doc_id", "split")


def q_split_stats(spark, sf):
    return profile.split_stats(splitting.stratified_split(stored(cleaned(spark, sf))))


def q_leakage(spark, sf):
    return profile.leakage_check(splitting.stratified_split(lab(spark, sf), key="doc_id"))


def q_sample_rows(spark, sf):
    return sampling.sample_rows(lab(spark, sf))


def q_head_per_language(spark, sf):
    return sampling.head_per_language(table(spark, sf, "documents"), 50, "doc_id", "lang").select("doc_id", "lang")


def q_profile_report(spark, sf):
    everything, kept = stored(unified(spark, sf)), stored(cleaned(spark, sf))
    return report_plan.profile_report(
        unified=everything,
        detection=kept,
        splits=stored(splitting.stratified_split(kept)),
        cross_lingual=filters.with_target(everything),
    )


def q_l2_normalize(spark, sf):
    scaled = F.transform("embedding", lambda x: (x * (F.col("vec_id") + 1)).cast("float"))
    unit = table(spark, sf, "embeddings").select("vec_id", F.posexplode(arrays.l2_normalize(scaled)).alias("pos", "x"))
    return unit.select("vec_id", "pos", F.round(F.col("x").cast("double"), 5).alias("x"))


def q_retrieve_topk(spark, sf):
    hits = retrieval.retrieve(vec_queries(spark, sf), idx(spark, sf), 5)
    return hits.select("query_id", "rank", "row_id", "source_idiom", "target_idiom", "target_lang", "score")


def q_retrieve_topk_filtered(spark, sf):
    hits = retrieval.retrieve(vec_queries(spark, sf), idx(spark, sf), 5, source_lang="en", target_lang="3")
    return hits.select("query_id", "rank", "row_id", "target_lang", "score")


def q_retrieve_topk_own_language(spark, sf):
    queries = vec_queries(spark, sf).withColumn("want_lang", F.col("label").cast("string"))
    return retrieval.retrieve(queries, idx(spark, sf), 5).select("query_id", "rank", "row_id", "target_lang", "score")


def q_retrieve_topk_blocks(spark, sf):
    """The form for two large sides, forced, in small blocks."""
    hits = retrieval.retrieve(vec_queries(spark, sf), idx(spark, sf), 5, form="blocks", block_rows=250)
    return hits.select("query_id", "rank", "row_id", "target_lang", "score")


def q_retrieve_topk_few_queries(spark, sf):
    """The form for few queries, forced, in as many parts as the queries need."""
    hits = retrieval.retrieve(vec_queries(spark, sf), idx(spark, sf), 5, form="few_queries", parts=True)
    return hits.select("query_id", "rank", "row_id", "target_lang", "score")


def q_gate_retrieve(spark, sf):
    rows = gate.gate_retrieve(known_detections(spark, sf), idx(spark, sf), 3)
    found = F.transform("retrieval", lambda h: h["target_idiom"])
    return rows.select(
        "query_id",
        F.col("detection.label").alias("label"),
        F.col("detection.confidence").alias("confidence"),
        F.array_join(found, ",").alias("found"),
        "message",
    )


def q_gate_without_detector(spark, sf):
    rows = gate.retrieve_without_detector(
        known_detections(spark, sf).drop("detection"), idx(spark, sf), OSError("model folder not found\nline 2"), 3
    )
    found = F.transform("retrieval", lambda h: h["target_idiom"])
    return rows.select(
        "query_id", F.col("detection.label").alias("label"), F.array_join(found, ",").alias("found"), "message"
    )


def _picky_scorer():
    """A scorer that fails on texts whose length is a multiple of five."""
    odd = _odd_length_scorer()

    def model(texts):
        if any(len(t) % 5 == 0 for t in texts):
            raise ValueError("no score for a text of this length\nline 2")
        return odd(texts)

    return model


def q_gate_scoring_failure(spark, sf):
    asked = known_detections(spark, sf).drop("detection")
    rows = gate.retrieve_with_detector(asked, idx(spark, sf), hooks.scorer(_picky_scorer), k=3)
    found = F.transform("retrieval", lambda h: h["target_idiom"])
    return rows.select(
        "query_id",
        F.col("detection.label").alias("label"),
        F.col("detection.confidence").alias("confidence"),
        F.array_join(found, ",").alias("found"),
        "message",
    )


def q_confusion(spark, sf):
    return metrics.confusion_matrix(scored(spark, sf))


def q_class_report(spark, sf):
    return metrics.classification_report(scored(spark, sf))


def q_macro_metrics(spark, sf):
    return metrics.macro_metrics(scored(spark, sf)).select(
        *[F.round(c, 9).alias(c) for c in ("accuracy", "f1", "precision", "recall")]
    )


def q_softmax_argmax(spark, sf):
    logits = F.transform(F.slice("embedding", 1, 2), lambda x: x.cast("double") * 10)
    return table(spark, sf, "embeddings").select(
        "vec_id",
        F.round(arrays.softmax(logits).getItem(0), 6).alias("p0"),
        F.round(arrays.softmax(logits).getItem(1), 6).alias("p1"),
        arrays.argmax(logits).alias("class_id"),
        arrays.detection_struct(arrays.softmax(logits)).getField("label").alias("label"),
    )


def q_language_names(spark, sf):
    return requests(spark, sf).select(
        "query_id",
        language.language_code("target_language").alias("code"),
        language.language_name(language.language_code("target_language")).alias("name"),
    )


def _hits(spark, sf):
    return retrieval.pack_hits(retrieval.retrieve(vec_queries(spark, sf), idx(spark, sf), 5, target_lang="3"))


def q_context_prompt(spark, sf):
    context = _hits(spark, sf).select("query_id", translate.context_string("hits").alias("context"))
    name = F.lit("hINDI")
    return context.select(
        "query_id",
        "context",
        translate.system_text(name).alias("system_text"),
        translate.prompt_text(F.concat(F.lit("s"), F.col("query_id").cast("string")), "context", name).alias("prompt"),
    )


def q_translate_batch(spark, sf):
    return translate.translate_detected(requests(spark, sf), three_language_index(spark, sf))


def q_api_response(spark, sf):
    asked = requests(spark, sf).withColumn("text", F.when(F.col("query_id") % 7 == 0, "").otherwise(F.col("text")))
    return translate.api_response(translate.translate_rows(asked, three_language_index(spark, sf)))


def q_literal_passthrough(spark, sf):
    answered = translate.translate_rows(requests(spark, sf), three_language_index(spark, sf))
    return translate.literal_passthrough(answered).select("query_id", "text", "prediction")


def q_exact_match(spark, sf):
    rows = shortened(spark, sf).withColumn("reference", F.when(F.col("pair_id") % 3 == 0, F.concat(F.lit(" "), F.col("prediction"))).otherwise(F.col("reference")))
    return evaluate.exact_match(rows)


def q_corpus_bleu(spark, sf):
    return evaluate.corpus_bleu(shortened(spark, sf)).withColumn("bleu", F.round("bleu", 6))


def q_greedy_token_f1(spark, sf):
    """Vectors in fives stand for the tokens of a text; the next five are its reference."""
    group = F.floor(F.col("vec_id") / 5)
    ordered = F.array_sort(F.collect_list(F.struct("vec_id", "embedding")))
    texts = table(spark, sf, "embeddings").groupBy(group.alias("pair_id")).agg(
        F.transform(ordered, lambda s: s["embedding"]).alias("vectors")
    )
    left = texts.select("pair_id", F.col("vectors").alias("prediction_vectors"))
    right = texts.select((F.col("pair_id") - 1).alias("pair_id"), F.col("vectors").alias("reference_vectors"))
    return evaluate.greedy_token_f1(left.join(right, "pair_id")).select(F.round("token_f1", 6).alias("token_f1"))


def q_encode_text(spark, sf):
    rows = encode.encode_text(table(spark, sf, "documents"), "text")
    long = rows.select("doc_id", F.posexplode("embedding").alias("pos", "x"))
    return long.filter(F.col("x") > 0).select("doc_id", "pos", F.round(F.col("x").cast("double"), 4).alias("x"))


def q_retrieve_text(spark, sf):
    """Benchmark texts against an index of the conversation pairs, both encoded from text."""
    found = index_plan.index_rows(index_plan.index_pairs(pairs_unified(spark, sf)))
    asked = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    hits = retrieval.retrieve(encode.encode_text(asked, "text"), found, 5, target_lang="hi")
    return hits.select("query_id", "rank", "source_idiom", "target_idiom", "score")


def _odd_length_scorer():
    """A stand-in for a detector model: texts of odd length are idiomatic."""
    return lambda texts: np.array([[0.0, 2.0] if len(t) % 2 else [2.0, 0.0] for t in texts])


def _text_requests(spark, sf):
    codes = F.array(F.lit("hi"), F.lit("te"), F.lit("ml"), F.lit("ta"))
    return table(spark, sf, "benchmark").select(
        F.col("item_id").cast("string").alias("request_id"),
        "text",
        F.element_at(codes, (F.col("item_id") % 4 + 1).cast("int")).alias("target_lang"),
    )


def q_translate_stream(spark, sf):
    """Benchmark texts landed as request files and answered by the stream."""
    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    _text_requests(spark, sf).repartition(3).write.json(f"{base}/requests")
    found = stored(index_plan.index_rows(index_plan.index_pairs(pairs_unified(spark, sf))))
    run = translate_stream(
        spark, f"{base}/requests", f"{base}/responses", f"{base}/state", found, hooks.scorer(_odd_length_scorer), max_files=2
    )
    run.awaitTermination()
    return spark.read.parquet(f"{base}/responses").drop("batch_id")


def q_translation_report(spark, sf):
    """The evaluation job over all pairs of one language, with a stored index and a stored test set."""
    base = f"{shared_folder(spark)}/report-{uuid.uuid4().hex}"
    test = pairs_unified(spark, sf).select(F.col("source_idiom").alias("input_text"), F.col("target_idiom").alias("target_text"), "target_lang")
    test.write.parquet(f"{base}/test")
    index_plan.build_index(spark, pairs_unified(spark, sf), base)
    report = evaluation.run_evaluation(spark, f"{base}/test", base, hooks.scorer(_odd_length_scorer), "telugu", fmt="parquet")
    return report.withColumns({c: F.round(c, 6) for c in ("bleu", "token_f1")})


def q_text_token_f1(spark, sf):
    """Each answer of a conversation against its question."""
    texts = pairs(spark, sf).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"),
        F.col("target_idiom").alias("prediction"),
        F.col("source_idiom").alias("reference"),
    )
    return evaluate.text_token_f1(texts).select("pair_id", F.round("f1", 4).alias("f1"))


def _fitted(spark, sf):
    split = stored(splitting.stratified_split(stored(cleaned(spark, sf))))
    train, val = (split.filter(F.col("split") == s) for s in ("train", "val"))
    return detector.fit_detector(train, val, grid=(0.01, 0.1), features=1 << 12)[0], split


def q_train_predict(spark, sf):
    model, split = _fitted(spark, sf)
    test = split.filter(F.col("split") == "test")
    rows = detector.predict(test, model)
    return rows.select("text", "label", "detection.confidence", F.col("detection.is_idiomatic").cast("int").alias("predicted"))


# Coefficients in 16ths, so that sums are exact in any order.
GIVEN = detector.GivenModel(tuple((7 * i % 13 - 6) / 16 for i in range(64)), 1 / 16)


def q_predict_given_model(spark, sf):
    rows = detector.detect(table(spark, sf, "documents").select("doc_id", "text"), GIVEN)
    return rows.select("doc_id", "detection.label", "detection.confidence", F.col("detection.is_idiomatic").cast("int").alias("predicted"))


def q_translate_text(spark, sf):
    """Detection, encoding, retrieval and translation from text alone."""
    # Numbering reads the pairs twice.
    found = index_plan.index_rows(stored(index_plan.index_pairs(pairs_unified(spark, sf))))
    asked = table(spark, sf, "documents").select(F.col("doc_id").alias("query_id"), "text")
    return translate.translate_batch(asked, found, GIVEN, "hindi")


def queries() -> dict:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
