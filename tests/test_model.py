"""Metrics, detector, gate, translation and evaluation."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from phraseloom import hooks, schemas as S
from phraseloom.functions import fixed_values as V
from phraseloom.operators import detector, evaluate, gate, metrics, translate
from phraseloom.operators.encode import encode_text
from phraseloom.operators.retrieval import retrieve


def approx4(x):
    return pytest.approx(x, abs=6e-5)


# ---------------------------------------------------------------------- metrics


@pytest.fixture(scope="module")
def published(spark):
    rows = [(0, 0, 1357), (0, 1, 177), (1, 0, 252), (1, 1, 4819)]
    return spark.createDataFrame(rows, "actual int, predicted int, n bigint")


def test_published_numbers(published):
    m = metrics.macro_metrics(published, "n").first()
    assert (m["accuracy"], m["f1"], m["precision"], m["recall"]) == (approx4(0.93505), approx4(0.9104), approx4(0.9040), approx4(0.9175))
    got = {r["row_name"]: tuple(r)[1:] for r in metrics.classification_report(published, "n").collect()}
    assert got["Literal"] == (0.8434, 0.8846, 0.8635, 1534)
    assert got["Idiomatic"] == (0.9646, 0.9503, 0.9574, 5071)
    assert got["weighted avg"] == (0.9364, 0.9350, 0.9356, 6605)
    assert got["accuracy"][0] == 0.9350 or got["accuracy"][0] == 0.9351


def test_weighted_equals_expanded(spark, published):
    long = published.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).select("actual", "predicted")
    assert metrics.macro_metrics(long).first() == metrics.macro_metrics(published, "n").first()


def test_one_class_gives_a_full_matrix(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "actual int, predicted int")
    got = {r["actual"]: (r["literal"], r["idiomatic"]) for r in metrics.confusion_matrix(df).collect()}
    assert got == {"Literal": (0, 0), "Idiomatic": (0, 2)}
    assert tuple(metrics.macro_metrics(df).first()) == (1.0, 1.0, 1.0, 1.0)
    assert tuple(metrics.macro_metrics(df.limit(0)).first()) == (0.0, 0.0, 0.0, 0.0)
    df = spark.createDataFrame([(0, 1), (1, 1)], "actual int, predicted int")
    assert tuple(metrics.macro_metrics(df).first()) == (0.5, pytest.approx(1 / 3), 0.25, 0.5)


# ---------------------------------------------------------------------- detector


@pytest.fixture(scope="module")
def examples(spark):
    idiom = ["kick the bucket now", "spill the beans today", "break a leg tonight", "bite the bullet again"]
    plain = ["the red car stops", "we eat rice today", "she reads a book", "rain falls all day"]
    rows = [(f"{t} {w}", lab) for lab, texts in ((1, idiom), (0, plain)) for t in texts for w in "abcdefgh"]
    return spark.createDataFrame(rows, "text string, label int")


@pytest.fixture(scope="module")
def model(examples):
    fitted, tries = detector.fit_detector(examples, examples, grid=(0.01, 1.0), features=1 << 10)
    assert len(tries) == 2 and max(f for _, f in tries) == 1.0
    return fitted


def test_predict_and_reload(spark, model, examples, tmp_path):
    scored = detector.predict(examples, model)
    assert scored.columns == ["text", "label", "detection"]
    assert scored.schema["detection"].dataType == S.DETECTION or [f.name for f in scored.schema["detection"].dataType] == S.DETECTION.names
    assert scored.filter((F.col("label") == 1) != F.col("detection.is_idiomatic")).count() == 0
    detector.save_model(model, str(tmp_path / "m"))
    again = detector.predict(examples, detector.load_model(str(tmp_path / "m")))
    assert sorted(scored.collect()) == sorted(again.collect())
    assert detector.predict(spark.createDataFrame([(None,)], "text string"), model).first()["detection"]["confidence"] >= 0.5


def test_all_tokens_count(spark, model):
    pad = " ".join(["pad"] * 200)
    df = spark.createDataFrame([(0, pad), (1, pad + " kick the bucket now")], "i int, text string")
    a, b = (r["detection"] for r in detector.predict(df, model).orderBy("i").collect())
    assert a != b
    cut = detector.feature_stages(max_tokens=128)
    assert len(cut) == len(detector.feature_stages()) + 1


def test_models_load_once_per_process_and_must_answer_in_full(spark, tmp_path):
    from phraseloom import hooks

    log = str(tmp_path / "loads")

    def load():
        import os

        with open(log, "a") as file:
            file.write("x")
        return lambda texts: np.ones((len(texts), 2))

    df = spark.range(64).selectExpr("cast(id as string) as text").repartition(32)
    score = hooks.scorer(load)
    assert df.select(score(F.col("text")).alias("s")).filter("s[0] = 1").count() == 64
    loads = open(log).read().split()
    assert len(loads) == len(set(loads))
    short = hooks.scorer(lambda: lambda texts: np.ones((len(texts) - 1, 2)))
    with pytest.raises(Exception, match="one row per text"):
        df.select(short(F.col("text"))).collect()


def test_training_needs_both_classes(examples):
    with pytest.raises(ValueError):
        detector.fit_detector(examples.filter("label = 1"), examples)


# Lambdas, so that they travel with the task: executors cannot import this module.
bucket_scorer = lambda: lambda texts: np.array([[0.0, 4.0] if "bucket" in t else [4.0, 0.0] for t in texts])


def test_scorer_hook(spark):
    df = spark.createDataFrame([("kick the bucket",), ("plain",), (None,)], "text string")
    got = [tuple(r["detection"]) for r in detector.detect(df, hooks.scorer(bucket_scorer)).collect()]
    top = round(1 / (1 + math.exp(-4)), 4)
    assert got == [("Idiomatic", top, True), ("Literal", top, False), ("Literal", top, False)]


# ---------------------------------------------------------------------- gate


@pytest.fixture(scope="module")
def index(spark):
    rows = [(0, "kick the bucket", "en", "मर जाना", "hi", "x"), (1, "kick the bucket", "en", "చనిపోవు", "te", "x"), (2, "spill the beans", "en", "राज़ खोलना", "hi", "x")]
    df = spark.createDataFrame(rows, "row_id bigint, source_idiom string, source_lang string, target_idiom string, target_lang string, source string")
    return encode_text(df, "source_idiom")


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame([("a", "kick the bucket"), ("b", "plain words")], "query_id string, text string")


def test_gate_outcomes(spark, index, asked, tmp_path):
    score = hooks.scorer(bucket_scorer)
    got = {r["query_id"]: r for r in gate.retrieve_with_detector(asked, index, score, k=1, target_lang="hi").collect()}
    assert [h["target_idiom"] for h in got["a"]["retrieval"]] == ["मर जाना"] and got["a"]["message"] is None
    assert got["b"]["retrieval"] == [] and got["b"]["message"] == V.MESSAGE_LITERAL

    got = {r["query_id"]: r for r in gate.retrieve_with_detector(asked, None, score).collect()}
    assert got["a"]["message"] == V.MESSAGE_NO_INDEX and got["a"]["retrieval"] == []
    assert got["b"]["message"] == V.MESSAGE_LITERAL

    got = {r["query_id"]: r for r in gate.retrieve_with_detector(asked, index, model_path=str(tmp_path / "none"), k=2).collect()}
    assert all(len(r["retrieval"]) == 2 and r["detection"]["label"] == "Unavailable" for r in got.values())
    assert got["a"]["detection"]["confidence"] is None and got["a"]["detection"]["is_idiomatic"] is None
    assert got["a"]["message"].startswith("Detector model unavailable; retrieval executed directly. Details: ")
    got = gate.retrieve_with_detector(asked, None, model_path=str(tmp_path / "none")).collect()
    assert all(r["retrieval"] == [] for r in got)


def test_failure_detail():
    assert gate.failure_detail(OSError("x" * 300 + "\nmore")) == "x" * 240
    assert gate.failure_detail(ValueError("Unrecognized model in /m.\nmore")) == V.DETAIL_BAD_MODEL
    assert gate.failure_detail(ValueError()) == ""


def test_literal_rows_cost_no_encoding(spark, asked, index):
    calls = spark.sparkContext.accumulator(0)

    def load():
        def model(texts):
            calls.add(len(texts))
            return np.array([[1.0] + [0.0] * 255 for _ in texts])

        return model

    rows = gate.retrieve_with_detector(asked, index, hooks.scorer(bucket_scorer), k=1, encoder=hooks.encoder(load)).collect()
    assert len(rows) == 2 and calls.value == 1


# ---------------------------------------------------------------------- translation


def test_context_and_prompt(spark, asked, index):
    hits = retrieve(encode_text(asked.filter("query_id = 'a'"), "text"), index, 2)
    packed = hits.groupBy().agg(F.array_sort(F.collect_list(F.struct("rank", "target_idiom"))).alias("hits"))
    df = packed.select(translate.context_string("hits").alias("c"))
    df = df.select("c", translate.prompt_text(F.lit("it's"), "c", F.lit("hINDI")).alias("p"), translate.system_text(F.lit("hindi")).alias("s"))
    row = df.first()
    assert row["c"] == "Related known idioms/meanings: 'मर जाना', 'చనిపోవు'"
    assert row["p"] == f"English Idiom: 'it's'\nFigurative Meaning/Context: {row['c']}\nHindi Translation:"
    assert row["s"].count("Hindi") == 3 and "{" not in row["s"]
    empty = spark.range(1).select(translate.context_string(F.array().cast("array<struct<rank:int,target_idiom:string>>")).alias("c"))
    assert empty.select("c", translate.prompt_text(F.lit("x"), "c", F.lit("Telugu")).alias("p")).first() == ("", "English Idiom: 'x'\nTelugu Translation:")


def test_translate_batch(spark, index):
    df = spark.createDataFrame([("a", "kick the bucket"), ("b", "plain"), ("c", "  "), ("d", "bucket")], "query_id string, text string")
    score = hooks.scorer(bucket_scorer)
    got = {r["query_id"]: r for r in translate.translate_batch(df, index, score, "telugu").collect()}
    assert set(got) == {"a", "d"}
    assert got["a"]["translation"] == "చనిపోవు" and got["a"]["target_language"] == "Telugu"
    assert got["a"]["retrieved_context"] == "Related known idioms/meanings: 'చనిపోవు'"
    unknown = {r["query_id"]: r for r in translate.translate_batch(df, index, score, "tamil").collect()}
    assert unknown["a"]["retrieved_context"].count("'") == 6 and unknown["a"]["target_language"] == "Tamil"
    nothing = translate.translate_batch(df, index.filter("target_lang = 'xx'"), score, "telugu").filter("query_id = 'a'").first()
    assert nothing["retrieved_context"] == "" and nothing["translation"] == "kick the bucket"


def test_translator_hook_isolates_failures(spark, index):
    def failing_model():
        def call(systems, prompts):
            if any("beans" in p for p in prompts):
                raise RuntimeError("down")
            return [f" ok {len(systems)} "] * len(prompts)

        return call

    rows = [("a", "kick the bucket"), ("b", "beans in a bucket")]
    df = spark.createDataFrame(rows, "query_id string, text string").coalesce(1)
    out = translate.translate_batch(df, index, hooks.scorer(bucket_scorer), "hindi", hooks.translator(failing_model))
    got = {r["query_id"]: r["translation"] for r in out.collect()}
    assert got == {"a": "ok 1", "b": V.TRANSLATION_FAILED} or got == {"a": "ok 2", "b": V.TRANSLATION_FAILED}


def test_api_response(spark, index):
    rows = [("a", "kick the bucket", "te"), ("b", "plain", "hi"), ("c", "", None), ("d", None, "hi"), ("e", " ", "hi"), ("f", "a bucket", "ta")]
    requests = translate.requests_with_language(spark.createDataFrame(rows, "query_id string, text string, target_lang string"))
    names = {r["query_id"]: r["target_language"] for r in requests.collect()}
    assert names == {"a": "telugu", "b": "hindi", "c": "malayalam", "d": "hindi", "e": "hindi", "f": "malayalam"}
    detected = detector.detect(requests, hooks.scorer(bucket_scorer))
    answered = translate.translate_rows(detected, index)
    got = {r["query_id"]: tuple(r)[1:] for r in translate.api_response(answered).collect()}
    literal = (V.RESPONSE_LITERAL_CONTEXT, V.RESPONSE_LITERAL_TRANSLATION, None)
    assert got["a"][1] == "చనిపోవు" and got["b"] == literal and got["e"] == literal
    assert got["c"] == got["d"] == (None, None, V.RESPONSE_NO_TEXT)
    assert got["f"] == ("", "a bucket", None)
    gaps = answered.withColumn("retrieved_context", F.lit(None)).withColumn("translation", F.lit(None))
    got = {r["query_id"]: tuple(r)[1:] for r in translate.api_response(gaps).collect()}
    assert got["a"] == (V.RESPONSE_NO_CONTEXT, V.RESPONSE_NO_TRANSLATION, None)


def test_a_translator_makes_no_call_for_literal_rows(spark, index):
    calls = spark.sparkContext.accumulator(0)

    def load():
        def model(systems, prompts):
            calls.add(len(prompts))
            return [f"out {p[:3]}" for p in prompts]

        return model

    rows = [("a", "kick the bucket", "hindi"), ("b", "plain", "hindi"), ("c", " ", "hindi"), ("d", None, "hindi")]
    df = spark.createDataFrame(rows, "query_id string, text string, target_language string")
    answered = translate.translate_rows(detector.detect(df, hooks.scorer(bucket_scorer)), index, hooks.translator(load))
    got = {r["query_id"]: (r["translated"], r["translation"]) for r in answered.collect()}
    assert got == {"a": (True, "out Eng"), "b": (False, None), "c": (False, None), "d": (False, None)} and calls.value == 1
    plan = translate.api_response(answered)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


# ---------------------------------------------------------------------- evaluation


def pairs(spark, rows):
    return spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(rows)], "pair_id bigint, prediction string, reference string")


def test_exact_match(spark):
    row = evaluate.exact_match(pairs(spark, [(" a ", "a"), ("b", "c"), ("d", "d　")])).first()
    assert tuple(row)[:2] == (3, 2) and row["exact_match_pct"] == pytest.approx(200 / 3)
    assert tuple(evaluate.exact_match(pairs(spark, [("x", "y")]).limit(0)).first()) == (0, 0, 0.0)


def hand_bleu(match, total, sys_len, ref_len):
    zeros, logs = 0, 0.0
    for m, t in zip(match, total):
        if m == 0:
            zeros += 1
            logs += math.log(100 / (2**zeros * t))
        else:
            logs += math.log(100 * m / t)
    return (math.exp(1 - ref_len / sys_len) if sys_len < ref_len else 1) * math.exp(logs / 4)


@pytest.mark.parametrize(
    "rows,want",
    [
        ([("the cat sat on the mat", "the cat sat on the mat")], 100.0),
        # the x2 and cat clipped; no 3-gram and no 4-gram in common
        ([("the the cat mat now", "the cat is on the mat")], hand_bleu([4, 1, 0, 0], [5, 4, 3, 2], 5, 6)),
        ([("a b c d", "a b c d e f g h")], hand_bleu([4, 3, 2, 1], [4, 3, 2, 1], 4, 8)),
        ([("a b c d e", "a b c d e"), ("v w x y z", "q r s t u")], hand_bleu([5, 4, 3, 2], [10, 8, 6, 4], 10, 10)),
        ([("a b c", "a b c")], 0.0),
        ([("w x y z", "a b c d")], 0.0),
        ([("", "a b c d")], 0.0),
        ([("", "")], 0.0),
    ],
)
def test_bleu_by_hand(spark, rows, want):
    assert evaluate.corpus_bleu(pairs(spark, rows)).first()["bleu"] == pytest.approx(want)


@pytest.mark.parametrize(
    "text,want",
    [
        ("Hello, world!", "Hello , world !"),
        ("3.14 and 1,000.", "3.14 and 1,000 ."),
        ("a-b 5-6", "a-b 5 - 6"),
        ("&quot;x&quot; &amp; <y>", '" x " & < y >'),
        ("line-\nbreak\nnext", "linebreak next"),
        ("(a/b)", "( a / b )"),
        ("it's <skipped>ok", "it's ok"),
        ("नमस्ते।", "नमस्ते।"),
        ("$5 50%", "$ 5 50 %"),
    ],
)
def test_bleu_tokens(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert " ".join(df.select(evaluate.bleu_tokens("t")).first()[0]) == want


def test_bleu_moves_sums_only(spark):
    df = pairs(spark, [("a b", "a b")] * 3)
    plan = evaluate.bleu_statistics(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("Exchange SinglePartition") == 1 and "Generate" not in plan


def test_bleu_of_repeated_ids(spark):
    df = spark.createDataFrame([(1, "a b c d", "e f g h"), (1, "e f g h", "a b c d")], "pair_id int, prediction string, reference string")
    assert evaluate.corpus_bleu(df).first()["bleu"] == 0


def test_greedy_f1(spark):
    e = np.eye(3).tolist()
    rows = [(0, [e[0], e[1]], [e[0], e[1]]), (1, [e[0]], [e[0], e[2]]), (2, [], [e[0]]), (3, None, [e[0]]), (4, [e[0]], [e[1]])]
    df = spark.createDataFrame(rows, "pair_id bigint, prediction_vectors array<array<double>>, reference_vectors array<array<double>>")
    got = {r["pair_id"]: r["f1"] for r in evaluate.pair_token_f1(df).collect()}
    assert got == {0: 1.0, 1: pytest.approx(2 * 1 * 0.5 / 1.5), 2: 0.0, 3: 0.0, 4: 0.0}
    assert evaluate.greedy_token_f1(df).first()[0] == pytest.approx((1 + 2 / 3) / 5)


def test_token_vectors_of_equal_texts(spark):
    rows = [("one two", "two one"), ("", "x"), (None, "x"), ("a b", "a c")]
    got = {r["pair_id"]: r["f1"] for r in evaluate.text_token_f1(pairs(spark, rows)).collect()}
    assert got[0] == pytest.approx(1) and got[1] == got[2] == 0.0 and 0 < got[3] < 1


def test_token_model(spark):
    def load():
        return lambda words: np.array([[1.0, 0.0] if w < "m" else [0.0, 2.0] for w in words])

    got = [r["f1"] for r in evaluate.text_token_f1(pairs(spark, [("a z", "b"), ("a", "z")]), load).orderBy("pair_id").collect()]
    assert got == [pytest.approx(2 * 0.5 * 1 / 1.5), 0.0]


def test_f1_in_small_steps(monkeypatch):
    rng = np.random.default_rng(1)
    p, r = rng.normal(size=(17, 5)), rng.normal(size=(9, 5))
    whole = evaluate._greedy_f1(p, r)
    monkeypatch.setattr(evaluate, "SIMS_AT_ONCE", 20)
    assert evaluate._greedy_f1(p, r) == pytest.approx(whole)


def test_evaluation_report(spark, index, tmp_path):
    lines = ["input_text,target_text,target_lang", "kick the bucket,मर जाना,hi", "plain words here now, plain words here now ,hi", "x,y,te"]
    lines += [f"later bucket {i},z,hi" for i in range(5)]
    (tmp_path / "generator_test.csv").write_text("\n".join(lines), encoding="utf-8")
    from phraseloom.sources.tables import read_generator_test

    test = read_generator_test(spark, str(tmp_path / "generator_test.csv"))
    score = hooks.scorer(bucket_scorer)
    row = evaluate.evaluate_translations(test, index, score, "Hindi", n=2).first()
    assert (row["language"], row["pairs"], row["exact_matches"], row["failures"]) == ("Hindi", 2, 2, 0)
    assert row["token_f1"] == pytest.approx(1, abs=1e-6) and row["bleu"] > 0
    row = evaluate.evaluate_translations(test, index, score, "hindi", translator=hooks.translator(lambda: lambda s, p: 1 / 0)).first()
    assert (row["pairs"], row["failures"], row["exact_matches"]) == (7, 6, 1)
    with pytest.raises(ValueError):
        evaluate.evaluate_translations(test, index, score, "tamil")
