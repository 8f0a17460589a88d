"""Composed jobs and the stream, end to end on landed fixtures, and the plans they run."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from phraseloom import hooks, schemas as S
from phraseloom.functions import fixed_values as V
from phraseloom.operators.translate import translate_batch
from phraseloom.plans import index as index_plan, prepare, profile_report, train, unify
from phraseloom.sources.tables import read_index, read_split, read_table
from phraseloom.streaming.translate import translate_stream
from test_sources import expr, write_json, write_lines

scorer = hooks.scorer(lambda: lambda texts: np.array([[0.0, 4.0] if "bucket" in t else [4.0, 0.0] for t in texts]))


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    idioms = ["kick the bucket", "spill the beans", "bite the bullet", "break the ice"]
    rows = [{"sentence": f"they {i} again number {n}", "label": "idiomatic", "idiom": i} for i in idioms for n in range(30)]
    rows += [{"sentence": f"the {w} car stops here {n}", "label": "literal", "idiom": w} for w in ("red", "old") for n in range(30)]
    rows += [{"sentence": "shared by two sources today", "label": "idiomatic", "idiom": "first"}]
    write_lines(root / "labelled" / "train.json", rows)
    tagged = [{"tokens": ["shared", "by", "two", "sources", "today"], "tags": [0, 1, 0, 0, 0], "idiom": "second"}]
    write_lines(root / "tagged" / "test.json", tagged + [{"tokens": ["a", "plain", "row", "of", "words"], "tags": [0] * 5}])
    write_json(root / "multilingual" / "x.json", [{"languages": {"en": expr("over the moon"), "de": expr("im siebten Himmel"), "fr": expr("aux anges")}}])
    write_lines(root / "parallel" / "a.json", [{"translation": {"en": f"pair {i}", "hi": f"जोड़ी {i}"}} for i in range(8)] + [{"translation": {"en": "pair 0", "hi": "दूसरा"}}])
    for name, code in (("malayalam", "ml"), ("telugu", "te"), ("hindi", "hi")):
        write_json(root / f"{name}.json", [{"idiom": f"{code} phrase for death", "figurative_meaning": "to kick the bucket"}, {"idiom": f"{code} only idiom here", "figurative_meaning": f"only in {code}"}])
    head = "source_idiom,source_lang,target_idiom,target_lang,label,idiom_string,split,source"
    (root / "telugu_idioms.csv").write_text(f"{head}\nపరీక్ష మాట ఒకటి,te,A phrase for a trial,en,1,x,train,Custom-Telugu\n", encoding="utf-8")
    return root


@pytest.fixture(scope="module")
def processed(spark, raw, tmp_path_factory):
    out = tmp_path_factory.mktemp("processed")
    labels = unify.build_unified_dataset(spark, str(raw), str(out))
    return out, {r["label_name"]: r["n"] for r in labels.collect()}


@pytest.fixture(scope="module")
def splits(spark, processed):
    out, _ = processed
    reports = prepare.run_preprocessing(spark, f"{out}/detection_only", str(out))
    return out, reports


@pytest.fixture(scope="module")
def index(spark, raw, processed):
    out, _ = processed
    pairs = index_plan.read_pairs(spark, str(out), str(raw))
    return index_plan.build_index(spark, pairs, str(out))


def test_unified_tables(spark, processed):
    out, labels = processed
    unified = read_table(spark, f"{out}/unified_idioms", S.UNIFIED_ORDERED)
    # 181 sentences; the tagged copy of the shared one is dropped; 3 map pairs (2 with "over the moon"
    # collapse to one); 8 of 9 parallel pairs; of three equal meanings one reverse row.
    by_source = {r["source"]: r["n"] for r in unified.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert by_source == {"MAGPIE": 181, "PIE-English": 1, "LIDIOMS": 2, "Kunchukuttan": 8, "Kaggle-Indian-Idioms": 6, "Kaggle-Indian-Idioms-Reverse": 4}
    assert unified.filter("source_idiom like 'shared%'").first()["idiom_string"] == "first"
    assert unified.filter("source_idiom = 'to kick the bucket'").first()["target_lang"] == "ml"
    assert labels == {"Literal": 61, "Idiomatic": 133}
    assert read_table(spark, f"{out}/hindi_pairs").count() == 9
    assert read_table(spark, f"{out}/detection_only").count() == 194
    cross = read_table(spark, f"{out}/cross_lingual", S.UNIFIED_ORDERED)
    assert cross.count() == 20 and set(S.UNIFIED.names) <= set(cross.columns)


def test_csv_output_and_missing_sources(spark, raw, tmp_path):
    write_json(tmp_path / "raw" / "telugu.json", [{"idiom": 'a, "b"', "figurative_meaning": "c"}])
    unify.build_unified_dataset(spark, str(tmp_path / "raw"), str(tmp_path / "out"), fmt="csv")
    back = read_table(spark, str(tmp_path / "out" / "cross_lingual"), S.UNIFIED, "csv")
    assert {r["source_idiom"] for r in back.collect()} == {'a, "b"', "c"}
    with pytest.raises(ValueError):
        unify.build_unified_dataset(spark, str(tmp_path / "nothing"), str(tmp_path / "out2"))


def test_a_failed_rebuild_leaves_the_tables(spark, raw, processed, index, tmp_path):
    out, _ = processed
    tables = ("unified_idioms", "hindi_pairs", "cross_lingual", "detection_only", "index")
    before = {t: read_table(spark, f"{out}/{t}").count() for t in tables}
    with pytest.raises(ValueError):
        unify.build_unified_dataset(spark, str(tmp_path / "nothing"), str(out))
    with pytest.raises(ValueError):
        index_plan.build_index(spark, index_plan.read_pairs(spark, str(out), str(raw)), str(out), target_lang="xx")
    assert {t: read_table(spark, f"{out}/{t}").count() for t in tables} == before


def test_all_parallel_rows(spark, raw):
    some = unify.read_sources(spark, str(raw), sample_n=4)["parallel"].count()
    assert some < unify.read_sources(spark, str(raw), sample_n=None)["parallel"].count() == 9


def test_index_from_one_given_file(spark, raw, processed):
    out, _ = processed
    pairs = index_plan.read_pairs(spark, str(out), str(raw), data_path=str(raw / "telugu_idioms.csv"))
    assert [r["target_idiom"] for r in pairs.collect()] == ["A phrase for a trial"]


def test_row_ids_without_order_are_fixed(spark):
    rows = [("a%d" % i, "en", "b%d" % i, "te") for i in range(300)]
    frames = [spark.createDataFrame(r, "source_idiom string, source_lang string, target_idiom string, target_lang string") for r in (rows, rows[::-1])]
    ids = [{r["source_idiom"]: r["row_id"] for r in index_plan.number_rows(index_plan.index_pairs(index_plan.concat_sources([f]))).collect()} for f in frames]
    assert ids[0] == ids[1] and sorted(ids[0].values()) == list(range(300))


def test_splits(spark, splits):
    out, reports = splits
    table = read_table(spark, f"{out}/splits")
    assert table.count() == table.select("text", "label").distinct().count()
    drops = reports["drops"].first()
    assert drops["rows_in"] == 194 and drops["rows_kept"] == table.count()
    assert not reports["imbalance"].first()["imbalanced"]
    assert {r["split"] for r in reports["split_stats"].collect()} == {"train", "val", "test"}
    plan = read_split(spark, f"{out}/splits", "val")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_profile(spark, splits, processed):
    out, _ = splits
    report = profile_report.profile_report(
        unified=read_table(spark, f"{out}/unified_idioms", S.UNIFIED_ORDERED),
        detection=read_table(spark, f"{out}/detection_only"),
        splits=read_table(spark, f"{out}/splits"),
        cross_lingual=read_table(spark, f"{out}/cross_lingual", S.UNIFIED_ORDERED),
    )
    got = {(r["table_name"], r["metric"], r["item"]): r["value"] for r in report.collect()}
    assert got["unified", "source", "MAGPIE"] == "181"
    assert got["detection", "class", "Literal"] == "61"
    assert got["splits", "clean", ""] == "true"
    assert got["cross_lingual", "pair", "en → hi"] == "9"
    assert ("train", "median_tokens", "") in got
    with pytest.raises(ValueError):
        profile_report.profile_report()


def test_training_job(spark, splits, tmp_path):
    out, _ = splits
    metrics = train.train_and_evaluate(spark, f"{out}/splits", str(tmp_path / "model"), str(tmp_path / "results")).first()
    assert metrics["accuracy"] > 0.8
    report = read_table(spark, str(tmp_path / "results" / "class_report"), fmt="json")
    assert {r["row_name"] for r in report.collect()} == {"Literal", "Idiomatic", "accuracy", "macro avg", "weighted avg"}
    matrix = read_table(spark, str(tmp_path / "results" / "confusion"), fmt="json")
    assert sum(r["literal"] + r["idiomatic"] for r in matrix.collect()) == read_split(spark, f"{out}/splits", "test").count()


def test_index_brings_back_shared_meanings(spark, index, processed):
    out, _ = processed
    rows = index.filter("source_idiom = 'to kick the bucket'").collect()
    assert sorted(r["target_lang"] for r in rows) == ["hi", "ml", "te"]
    assert index.filter("source = 'Kunchukuttan'").count() == 0
    ids = sorted(r["row_id"] for r in index.collect())
    assert ids == list(range(len(ids)))
    assert index.filter("source_lang = 'te' and target_idiom = 'A phrase for a trial'").count() == 1
    manifest = read_table(spark, f"{out}/manifest", fmt="json").first()
    assert manifest["rows_indexed"] == len(ids) and manifest["embedding_dim"] == 256
    assert manifest["target_langs"] == sorted(manifest["target_langs"])


def test_index_language_filter_and_errors(spark, raw, processed, tmp_path):
    out, _ = processed
    pairs = index_plan.read_pairs(spark, str(out), str(raw))
    only = index_plan.build_index(spark, pairs, str(tmp_path / "hi"), source_lang="en", target_lang="hi")
    assert {(r["source_lang"], r["target_lang"]) for r in only.collect()} == {("en", "hi")}
    with pytest.raises(ValueError):
        index_plan.build_index(spark, pairs, str(tmp_path / "xx"), target_lang="xx")
    with pytest.raises(FileNotFoundError):
        index_plan.read_pairs(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    with pytest.raises(FileNotFoundError):
        read_index(spark, str(tmp_path / "none"))


def test_translate_from_stored_index(spark, index, processed):
    out, _ = processed
    asked = spark.createDataFrame([("q", "to kick the bucket")], "query_id string, text string")
    row = translate_batch(asked, read_index(spark, f"{out}/index"), scorer, "telugu").first()
    assert row["translation"] == "te phrase for death"
    assert row["retrieved_context"].startswith("Related known idioms/meanings: 'te phrase for death', ")


def responses(spark, path):
    return {r["request_id"]: r for r in spark.read.parquet(path).collect()}


def test_stream_restart_gives_no_duplicates(spark, index, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    write_lines(tmp_path / "in" / "a.json", [{"request_id": "1", "text": "to kick the bucket", "target_lang": "te"}, {"request_id": "2", "text": "plain", "target_lang": "hi"}])

    def run():
        q = translate_stream(spark, src, out, ckpt, index, scorer, max_files=1)
        q.awaitTermination(120)
        assert q.exception() is None

    run()
    write_lines(tmp_path / "in" / "b.json", [{"request_id": "3", "text": "bucket of death"}, {"request_id": "4", "text": ""}])
    run()
    run()
    assert spark.read.parquet(out).count() == 4
    got = responses(spark, out)
    assert got["1"]["generated_translation"] == "te phrase for death"
    assert got["2"]["generated_translation"] == V.RESPONSE_LITERAL_TRANSLATION
    assert got["3"]["retrieved_context"].startswith("Related known") and got["4"]["error"] == V.RESPONSE_NO_TEXT


# ---------------------------------------------------------------------- physical plans


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


SF = "/root/testdata/sf0.001"


def test_no_query_uses_a_cross_join(spark):
    from phraseloom import catalog

    slow = {"train_predict", "translate_text"}
    for name, fn in catalog.queries().items():
        if name not in slow:
            plan = plan_of(fn(spark, SF))
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_columns_and_filters_reach_the_scan(spark):
    from phraseloom import catalog

    plan = plan_of(catalog.q_class_balance(spark, SF))
    assert "ReadSchema: struct<doc_id:bigint>" in plan and "struct<doc_id:bigint,quality:int>" in plan
    plan = plan_of(catalog.q_source_breakdown(spark, SF))
    assert "ReadSchema: struct<source:string>" in plan and "PushedFilters: [IsNotNull(source)]" in plan


def test_dedup_merges_copies_before_the_shuffle(spark):
    from phraseloom import catalog

    plan = plan_of(catalog.cleaned(spark, SF))
    assert "partial_min" in plan[plan.index("Exchange") :]


def test_leakage_has_one_shuffle_of_texts(spark):
    df = spark.createDataFrame([("a", "train")], "text string, split string")
    from phraseloom.operators.profile import leakage_check

    assert plan_of(leakage_check(df)).count("hashpartitioning") == 1


def test_split_assignment_does_not_shuffle_rows(spark, splits):
    from phraseloom.operators.splitting import stratified_split

    out, _ = splits
    df = read_table(spark, f"{out}/splits").drop("split")
    plan = plan_of(stratified_split(df))
    probe_side = plan[plan.index("BroadcastHashJoin") :].split("BroadcastExchange")[0]
    assert "Exchange" not in probe_side
