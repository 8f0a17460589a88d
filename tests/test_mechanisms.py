"""How the larger operators work: what they write, emit, scan and shuffle."""

import json
import pickle
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark import Broadcast
from pyspark.sql import functions as F

from phraseloom import catalog, hooks, storage
from phraseloom.functions import fixed_values as V
from phraseloom.operators import detector, evaluate, gate, ordering, retrieval, sampling, translate
from phraseloom.operators.encode import gram_counts
from phraseloom.plans import evaluation, index as index_plan, profile_report
from phraseloom.sources import landed
from test_retrieval import index_frame, unit


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------------- retrieval of two large sides


def test_floors_cut_what_blocks_emit(spark, monkeypatch):
    """64 blocks: about k times the root of their number leaves per query; the index is written once."""
    rng = np.random.default_rng(3)
    vectors, queries = unit(rng.normal(size=(3200, 12))), unit(rng.normal(size=(60, 12)))
    emitted, real = [], retrieval.stored

    def watched(df):
        out = real(df)
        if "raw_score" in out.columns and "rank" in out.columns and "place" in out.columns:
            emitted.append(out.count())
        return out

    monkeypatch.setattr(retrieval, "stored", watched)
    paths = len(storage._STORED)
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id bigint, embedding array<float>")
    got = retrieval.cosine_top_k(q, index_frame(spark, vectors, ["hi"] * 3200), 5, form="blocks", block_rows=50).collect()
    scores = np.round(queries.astype(np.float64) @ vectors.T.astype(np.float64), 10)
    for i in range(60):
        best = sorted(range(3200), key=lambda r: (-scores[i, r], r))[:5]
        assert [r["row_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == i] == best
    first, best_first, second, best_second, third = emitted
    assert first == best_first == best_second == 60 * 5
    assert first + second + third < 60 * 5 * 64 / 2.5  # a third of what 64 blocks of five would be
    written = [p for p in storage._STORED[paths:] if "phraseloom_blocks" in p]
    assert len(written) == 1 and spark.read.parquet(written[0]).count() <= 64
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("phraseloom_blocks")]


def test_more_queries_than_few_are_searched_in_parts(spark, monkeypatch):
    """The forced form takes any number of queries; every part fits the broadcast, and no query is lost."""
    rng = np.random.default_rng(5)
    vectors, queries = unit(rng.normal(size=(200, 8))), unit(rng.normal(size=(300, 8)))
    monkeypatch.setattr(retrieval, "FEW_QUERIES", 100)
    sent, real = [], retrieval._with_few_queries
    monkeypatch.setattr(retrieval, "_with_few_queries", lambda q, r, k: (sent.append(retrieval._Size(q, "lang", "query_id").bytes), real(q, r, k))[1])
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id bigint, embedding array<float>")
    index = index_frame(spark, vectors, ["hi"] * 200)
    scores = np.round(queries.astype(np.float64) @ vectors.T.astype(np.float64), 10)
    want = {(i, r) for i in range(300) for r in sorted(range(200), key=lambda r: (-scores[i, r], r))[:3]}
    for how in ({}, {"parts": True, "broadcast_bytes": 3000}):
        got = retrieval.cosine_top_k(q, index, 3, form="few_queries", **how).collect()
        assert {(r["query_id"], r["row_id"]) for r in got} == want and len(got) == 900
    assert len(sent) > 2 and max(sent[1:]) <= 3000


def test_visits_do_not_grow_with_the_square_of_the_rows(spark, monkeypatch):
    """A query moves once per block: small blocks grow, so four times the rows meet no more blocks."""
    visits, real = [], retrieval.stored

    def watched(df):
        out = real(df)
        if out.columns == ["chunk", "shelf", "round"]:
            visits.append(out.groupBy("chunk").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(retrieval, "stored", watched)
    rng = np.random.default_rng(9)
    for n in (400, 1600):
        vectors = unit(rng.normal(size=(n, 6)))
        q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "query_id bigint, embedding array<float>")
        got = retrieval.cosine_top_k(q, index_frame(spark, vectors, ["hi"] * n), 2, form="blocks", block_rows=10).collect()
        scores = np.round(vectors.astype(np.float64) @ vectors.T.astype(np.float64), 10)
        best = {(i, r) for i in range(n) for r in sorted(range(n), key=lambda r: (-scores[i, r], r))[:2]}
        assert {(r["query_id"], r["row_id"]) for r in got} == best
    assert max(visits) <= retrieval.MOST_BLOCKS


def test_blocks_without_an_index_or_a_known_language(spark):
    vectors = unit(np.eye(4))
    q = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0], "xx"), (2, [0.0, 1.0, 0.0, 0.0], None)], "query_id bigint, embedding array<float>, want_lang string")
    index = index_frame(spark, vectors, ["hi", "te", None, "hi"])
    got = retrieval.cosine_top_k(q, index, 2, form="blocks", block_rows=2).orderBy("rank").collect()
    assert [(r["query_id"], r["row_id"]) for r in got] == [(2, 1), (2, 0)]
    assert retrieval.cosine_top_k(q, index.limit(0), 2, form="blocks").isEmpty()


def test_only_user_code_counts_as_costly(spark):
    named = spark.range(3).select(F.col("id").alias("MapInArrow Python"), F.lit("PythonUDF").alias("x"))
    assert not retrieval._runs_code(named)
    assert retrieval._runs_code(spark.range(3).mapInArrow(lambda b: b, "id bigint"))
    assert retrieval._runs_code(spark.range(3).select(F.udf(lambda x: x, "bigint")("id").alias("y")))


# ---------------------------------------------------------------------- order and samples


def test_running_totals_have_two_levels(spark):
    rows = [(f"k{i % 7}", i, i % 5) for i in range(500)] + [(None, 3, 2)]
    df = spark.createDataFrame(rows, "a string, b int, n int")
    out = ordering.running_totals(df, ["a", "b"], "n", "before")
    for spec in re.findall(r"windowspecdefinition\((.*?)specifiedwindowframe", plan_of(out)):
        assert spec.startswith("_range")
    total = 0
    for r in sorted(out.collect(), key=lambda r: (r["a"] is not None, r["a"], r["b"])):
        assert r["before"] == total
        total += r["n"]
    assert "windowspecdefinition(_k" not in plan_of(ordering.dense_position(df, ["a"], ["b"]))


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_sample_in_file_order_writes_no_copy(spark, tmp_path, monkeypatch, fmt):
    for part in range(4):
        rows = spark.range(part * 250, part * 250 + 250).select("id", F.concat(F.lit("text "), F.col("id")).alias("t"))
        rows.coalesce(1).write.format(fmt).save(str(tmp_path / f"p{part}"))
    if fmt == "json":
        (tmp_path / "p4").mkdir()
        (tmp_path / "p4" / "blank.json").write_text('\n\n{"id": 1000, "t": "x"}\n\n{"id": 1001, "t": "y"}\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # several blocks per file
    try:
        records = landed.read_records(spark, str(tmp_path / "p*"), spark.read.format(fmt).load(str(tmp_path / "p0")).schema, fmt)
        written = []
        real = ordering.stored
        monkeypatch.setattr(ordering, "stored", lambda df: (out := real(df), written.append(out.count()))[0])
        got = [r["id"] for r in sampling.systematic_sample_by_row_ord(records, 100).collect()]
        order = [r["id"] for r in sorted(records.collect(), key=lambda r: (r["row_ord"]["file"], r["row_ord"]["block"], r["row_ord"]["row"]))]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    total = len(order)
    assert total == (1002 if fmt == "json" else 1000)
    step = total // 100
    assert sorted(got) == sorted(order[::step][:100])
    assert sum(written) < 60  # block counts only


def test_numbers_with_gaps_are_ranked(spark):
    rows = spark.range(100).select("id", landed.order_struct(block=F.floor(F.col("id") / 10), row=F.col("id") * 3).alias("row_ord"))
    assert ordering.block_position(rows) is None
    assert sorted(r["id"] for r in sampling.systematic_sample_by_row_ord(rows, 20).collect()) == list(range(0, 100, 5))


# ---------------------------------------------------------------------- readers


def test_many_csv_files_are_a_scan_per_header(spark, tmp_path):
    heads = ["source_idiom,source_lang,target_idiom,target_lang", "Target_Lang, source_idiom ,target_idiom,source_lang,extra", "﻿source_idiom,label"]
    for i in range(120):
        body = ["a{0},te,b{0},en", 'en,"a{0}","b{0}",te,"x, y"', "a{0},1"][i % 3].format(i)
        (tmp_path / f"f {i}_idioms.csv").write_text(f"{heads[i % 3]}\n{body}\n", encoding="utf-8")
    (tmp_path / "empty_idioms.csv").write_text("")
    df = landed.read_pair_csv(spark, str(tmp_path / "*_idioms.csv"))
    assert plan_of(df).count("Scan csv") == 3 and len(plan_of(df)) < 20_000
    rows = {r["source_idiom"]: r for r in df.collect()}
    assert set(rows) == {f"a{i}" for i in range(120)}
    assert all((rows[f"a{i}"]["target_lang"], rows[f"a{i}"]["source_lang"]) == (("en", "te") if i % 3 < 2 else (None, None)) for i in range(120))
    assert rows["a2"]["label"] == 1 and len({r["row_ord"]["file"] for r in rows.values()}) == 120


def test_each_broken_file_has_its_fallback_and_good_ones_are_read_once(spark, tmp_path):
    good, csv = tmp_path / "src", tmp_path / "csv"
    good.mkdir(), csv.mkdir()
    for name in ("a", "b"):
        (good / f"{name}.json").write_text(json.dumps({"sentence": f"from {name}", "label": "idiomatic"}))
        (csv / f"{name}.csv").write_text(f"source_idiom,source_lang\nfallback {name},en\n")
    reads = []

    def reader(s, path):
        reads.append(path)
        return landed.read_labelled_sentences(s, path)

    rows = landed.read_or_fallback(spark, reader, str(good), str(csv / "*.csv"))
    assert sorted(r["source_idiom"] for r in rows.collect()) == ["from a", "from b"]
    assert reads == [str(good)] and "Scan json" not in plan_of(rows)  # what is used is what was read
    (good / "b.json.gz").write_bytes(b"\x1f\x8bnothing")
    (good / "b.json").unlink()
    rows = landed.read_or_fallback(spark, reader, str(good), str(csv / "*.csv"))
    assert sorted(r["source_idiom"] for r in rows.collect()) == ["fallback b", "from a"]
    rows = landed.read_or_fallback(spark, reader, str(good))
    assert [r["source_idiom"] for r in rows.collect()] == ["from a"]


def test_a_broken_file_among_many_costs_a_few_reads(spark, tmp_path, monkeypatch):
    """Sets of files are halved down to the broken one; several CSV files stand for it."""
    good, csv = tmp_path / "src", tmp_path / "csv"
    good.mkdir(), csv.mkdir()
    for i in range(40):
        (good / f"f{i}.json").write_text(json.dumps({"sentence": f"from {i}", "label": "idiomatic"}))
    (good / "f17.json").unlink()
    (good / "f17.json.gz").write_bytes(b"\x1f\x8bnothing")
    for part in ("0", "1"):
        (csv / f"f17.{part}.csv").write_text(f"source_idiom,source_lang\nfallback {part},en\n")
    reads, real = [], landed.stored
    monkeypatch.setattr(landed, "stored", lambda df: (reads.append(1), real(df))[1])
    rows = landed.read_or_fallback(spark, landed.read_labelled_sentences, str(good), str(csv / "f*.csv")).collect()
    assert sorted(r["source_idiom"] for r in rows) == sorted([f"from {i}" for i in range(40) if i != 17] + ["fallback 0", "fallback 1"])
    assert len(reads) <= 14


def test_no_task_lands_or_reads_a_whole_source(spark, monkeypatch):
    """The landed files have bounded numbers of rows, and so has the task that reads one."""
    monkeypatch.setattr(catalog, "ROWS_PER_CSV", 5, raising=False)
    paths, real = [], catalog._landing
    monkeypatch.setattr(catalog, "_landing", lambda s, label: (paths.append(real(s, label)), paths[-1])[1])
    sf = "/root/testdata/sf0.001"
    rows = catalog.queries()["read_or_fallback"](spark, sf)
    assert rows.count() == catalog.lab(spark, sf).count()
    sizes = [r["count"] for r in spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{paths[0]}/csv/broken*.csv").groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 3 and max(sizes) <= 5


def test_jobs_leave_nothing_stored(spark):
    had = list(storage._STORED)
    with pytest.raises(RuntimeError), storage.stored_until_done(spark):
        kept = storage.stored(spark.range(5))
        path = storage._STORED[-1]
        assert kept.count() == 5
        raise RuntimeError
    assert storage._STORED == had
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


# ---------------------------------------------------------------------- BLEU scanner


def test_scanner_equals_the_rules(spark):
    rng = random.Random(11)
    parts = ["a", "Z", "1", "20", ".", ",", "-", "--", "!", "$", " ", "\t", "\n", "-\n", "&amp;", "&lt;", "<skipped>", "é", "日", "'", "..", ",,", "/", "~", "@", "\x1c", "\x85", " ", " ", "…"]
    texts = [None, "", " "] + ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 16))) for _ in range(4000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    want = {r["i"]: r["w"] for r in df.select("i", evaluate.bleu_tokens("t").alias("w")).collect()}
    plain = [r["p"] for r in df.select("i", evaluate._plain_text("t").alias("p")).orderBy("i").collect()]
    tokens, rows = evaluate.scan_tokens(pa.array(plain, pa.string()))
    got: dict[int, list[str]] = {i: [] for i in range(len(texts))}
    for token, row in zip(tokens.to_pylist(), rows.tolist()):
        got[row].append(token.decode())
    assert got == want


def test_token_vectors_are_held_for_a_few_rows(spark, monkeypatch):
    """However large a batch is, vectors of a bounded number of tokens are held at a time; scores stay the same."""
    rng = random.Random(4)
    texts = [(i, " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(0, 30))), None if i % 17 == 0 else f"w{i} w{i + 1} w5") for i in range(600)]
    texts.append((600, " ".join(f"long{i}" for i in range(2500)), "long1 long2"))
    df = spark.createDataFrame(texts, "pair_id int, prediction string, reference string").coalesce(1)
    calls = spark.sparkContext.accumulator(0)

    def load():
        def model(words):
            calls.add(len(words))
            return evaluate.gram_counts([f" {w.lower()} " for w in words])

        return model

    monkeypatch.setattr(evaluate, "TOKENS_AT_ONCE", 10**9)
    whole = {r["pair_id"]: r["f1"] for r in evaluate.text_token_f1(df, load).collect()}
    at_once = calls.value
    monkeypatch.setattr(evaluate, "TOKENS_AT_ONCE", 100)
    small = {r["pair_id"]: r["f1"] for r in evaluate.text_token_f1(df, load).collect()}
    assert small == pytest.approx(whole, abs=1e-12) and len(small) == 601
    assert calls.value - at_once > 2 * at_once - 2500  # words come again in later rows, since they are not kept


def test_grams_are_held_for_a_bounded_number_of_characters():
    """The same counts as text by text, with little beside them."""
    rng = random.Random(8)
    texts = ["".join(rng.choice("abc é日") for _ in range(rng.choice((0, 2, 40, 3000)))) for _ in range(1000)] + ["long text " * 40_000, "x"]
    tracemalloc.start()
    counts = gram_counts(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all((counts[i] == gram_counts([text])[0]).all() for i, text in enumerate(texts))
    assert peak < 50_000_000


def test_ngrams_are_scanned_for_bounded_bytes(spark, monkeypatch):
    """Long texts in one batch are scanned a megabyte at a time, or one by one, with the same sums."""
    rng = random.Random(6)
    texts = [(" ".join(f"w{rng.randrange(300)}" for _ in range(n)), " ".join(f"w{rng.randrange(300)}" for _ in range(3000))) for n in [4000] * 120 + [0, 400_000, 7]]
    df = spark.createDataFrame([*texts, (None, "a b c d")], "prediction string, reference string").coalesce(1)
    want = evaluate.bleu_statistics(df.repartition(124)).first()
    too_large, real = spark.sparkContext.accumulator(0), evaluate._clipped

    def watched(batch):
        too_large.add(int(len(batch) > 1 and batch.nbytes > (1 << 20) + 10_000))
        return real(batch)

    monkeypatch.setattr(evaluate, "_clipped", watched)
    assert evaluate.bleu_statistics(df).first() == want and want["total4"] > 300_000
    assert too_large.value == 0


def test_exact_scores_hold_bounded_bytes():
    """Ties make many candidates; their vectors are widened a few at a time, however many numbers a vector has."""
    rng = np.random.default_rng(2)
    queries, rows = unit(rng.normal(size=(300, 512))), unit(rng.normal(size=(400, 512)))
    at, col = rng.integers(0, 300, 60_000), rng.integers(0, 400, 60_000)
    tracemalloc.start()
    got = retrieval._exact_scores(queries, at, rows, col)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = (queries.astype(np.float64) @ rows.astype(np.float64).T)[at, col]
    assert np.abs(got - want).max() <= 1e-10
    assert peak < 80_000_000


# ---------------------------------------------------------------------- profile


def test_the_report_takes_few_jobs(spark):
    rows = spark.range(400).select(
        F.concat_ws(" ", F.lit("some words"), F.col("id")).alias("text"), (F.col("id") % 2).cast("int").alias("label"),
        F.element_at(F.array(F.lit("train"), F.lit("val"), F.lit("test")), (F.col("id") % 3 + 1).cast("int")).alias("split"),
        F.lit("src").alias("source"), F.lit("en").alias("source_lang"), F.lit("hi").alias("target_lang"),
    )
    rows = storage.stored(rows)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("report", "profile")
    try:
        out = profile_report.profile_report(rows, rows, rows, rows).collect()
        jobs = len(tracker.getJobIdsForGroup("report"))
    finally:
        spark.sparkContext.setJobGroup("other", "other")
    assert jobs <= 14
    got = {(r["table_name"], r["metric"], r["item"]): r["value"] for r in out}
    assert got[("unified", "n", "")] == "400" and got[("val", "class", V.LABEL_NAMES[1])] == "67" and got[("detection", "median_tokens", "")] == "3.0"
    assert got[("cross_lingual", "pair", "en → hi")] == "400" and got[("splits", "clean", "")] == "true"


def test_tables_without_rows_stay_in_the_report(spark):
    none = spark.createDataFrame([], "text string, label int, split string, source string, source_lang string, target_lang string")
    got = {(r["table_name"], r["metric"], r["item"]): r["value"] for r in profile_report.profile_report(none, none, none, none).collect()}
    assert all(got[(t, "n", "")] == "0" for t in ("unified", "detection", "train", "val", "test", "cross_lingual"))
    assert got[("detection", "min_tokens", "")] is None and got[("test", "length_from", "0")] == "0"
    assert not [k for k in got if k[1] in ("source", "language", "class", "pair")]


# ---------------------------------------------------------------------- scoring failures and given coefficients


def test_rows_that_fail_to_score_are_searched_with_a_message(spark):
    def fails_on_x():
        def model(texts):
            if any("x" in t for t in texts):
                raise ValueError("cannot score\nmore")
            return np.array([[0.0, 1.0] if "idiom" in t else [1.0, 0.0] for t in texts])

        return model

    index = index_frame(spark, unit(np.eye(3)), ["hi"] * 3)
    rows = [(1, "an idiom", [1.0, 0.0, 0.0]), (2, "plain", [0.0, 1.0, 0.0]), (3, "with x", [0.0, 0.0, 1.0])]
    asked = spark.createDataFrame(rows, "query_id int, text string, embedding array<float>").coalesce(1)
    out = {r["query_id"]: r for r in gate.retrieve_with_detector(asked, index, hooks.scorer(fails_on_x), k=1).collect()}
    assert (out[1]["detection"]["label"], out[1]["message"], len(out[1]["retrieval"])) == ("Idiomatic", None, 1)
    assert (out[2]["message"], out[2]["retrieval"]) == (V.MESSAGE_LITERAL, [])
    assert out[3]["message"] == V.MESSAGE_NO_DETECTOR.format(detail="cannot score") and out[3]["retrieval"][0]["target_idiom"] == "t2"
    assert out[3]["detection"]["label"] == V.LABEL_UNAVAILABLE and out[3]["detection"]["confidence"] is None

    def never():
        raise OSError(V.DETAIL_BAD_MODEL_MARK + " /models/none")

    out = gate.retrieve_with_detector(asked, index, hooks.scorer(never), k=1).collect()
    assert {r["message"] for r in out} == {V.MESSAGE_NO_DETECTOR.format(detail=V.DETAIL_BAD_MODEL)} and all(len(r["retrieval"]) == 1 for r in out)
    with pytest.raises(Exception, match="cannot score"):
        detector.detect(asked, hooks.scorer(fails_on_x)).collect()


def test_a_fit_is_spread_over_tasks_of_bounded_text(spark, monkeypatch):
    """However few parts the rows come in, a task counts, keeps and reads again a bounded number of bytes."""
    monkeypatch.setattr(detector, "TASK_BYTES", 4000, raising=False)
    sizes, real = [], detector.PipelineModel.transform

    def watched(model, df, *a):
        if "_tf" not in df.columns and not sizes:
            sizes.extend(r["s"] for r in df.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("text")).alias("s")).collect())
        return real(model, df, *a)

    monkeypatch.setattr(detector.PipelineModel, "transform", watched)
    text = F.when(F.col("id") % 2 == 0, "plain words stand here").otherwise("an idiom kicks the bucket")
    rows = spark.range(1000).select(F.concat(text, F.lit(" "), F.col("id")).alias("text"), (F.col("id") % 2).cast("int").alias("label")).coalesce(1)
    model, tries = detector.fit_detector(rows, rows, grid=(0.01,), features=256)
    assert tries[0][1] == 1.0 and detector.predict(rows, model).filter(F.col("detection.is_idiomatic") != (F.col("label") == 1)).isEmpty()
    assert sum(sizes) > 20_000 and max(sizes) < 8000


def test_given_coefficients(spark):
    model = detector.GivenModel((1.0, -2.0, 0.5, 0.25, 3.0), -0.5)

    def score(text):
        words = (text or "").lower().split()
        return -0.5 + sum(model.coefficients[(ord(w[0]) * 31 + ord(w[-1]) * 17 + len(w)) % 5] for w in words) / max(1, len(words))

    texts = ["Some words here", "", None, "é日 x", "kick THE bucket " * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in detector.detect(df, model).collect():
        s = score(r["text"])
        assert r["detection"]["is_idiomatic"] == (s > 0)
        assert r["detection"]["confidence"] == pytest.approx(1 / (1 + np.exp(-abs(s))), abs=1e-4)
    assert "Python" not in plan_of(detector.detect(df, model))


@pytest.mark.parametrize("rows_at_once,scores_at_once", [(8192, 4_000_000), (400, 10_000), (70, 1), (7, 50)])
def test_scores_of_few_rows_at_a_time_give_the_same_hits(monkeypatch, rows_at_once, scores_at_once):
    """With copies of vectors beyond k, in pieces of any size; a floor cuts nothing that reaches it."""
    rng = np.random.default_rng(5)
    vectors = unit(rng.normal(size=(900, 8))).astype(np.float32)
    vectors[100:400] = vectors[100 + np.arange(300) % 3]
    queries = np.vstack([vectors[95:105], unit(rng.normal(size=(30, 8)))]).astype(np.float32)
    side = lambda v: retrieval._Side(np.arange(len(v)), v, np.full(len(v), "", dtype=object), pa.int64())
    exact = np.round(queries.astype(np.float64) @ vectors.T.astype(np.float64), 10)
    order = np.argsort(-exact, axis=1, kind="stable")
    monkeypatch.setattr(retrieval, "ROWS_AT_ONCE", rows_at_once)
    monkeypatch.setattr(retrieval, "SCORES_AT_ONCE", scores_at_once)
    monkeypatch.setattr(retrieval, "PAIRS_AT_ONCE", scores_at_once // 8)
    for k in (1, 4, 1000):
        want = order[:, :k]
        scores, ids = retrieval._best(side(queries), side(vectors), k)
        assert (ids[:, :900] == want).all() and (scores[:, :900] == np.take_along_axis(exact, want, 1)).all()
        floors = exact[np.arange(len(queries)), order[:, min(k, 900) // 2]]
        scores, ids = retrieval._best(side(queries), side(vectors), k, floors)
        here = np.take_along_axis(exact, want, 1) >= floors[:, None]
        assert ((scores[:, :900] > -np.inf) == here).all() and (ids[:, :900][here] == want[here]).all()


def test_near_ties_are_held_for_a_bounded_number_of_pairs():
    """Where all rows come within the error of a float32 score, all pairs are scored exactly, some at a time."""
    rng = np.random.default_rng(7)
    rows, queries = (unit(1 + rng.normal(size=(n, 8)) * 1e-6).astype(np.float32) for n in (3000, 1300))
    side = lambda v: retrieval._Side(np.arange(len(v)), v, np.full(len(v), "", dtype=object), pa.int64())
    tracemalloc.start()
    scores, ids = retrieval._best(side(queries), side(rows), 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    exact = np.round(queries.astype(np.float64) @ rows.T.astype(np.float64), 10)
    order = np.argsort(-exact, axis=1, kind="stable")[:, :3]
    assert (ids == order).all() and peak < 150_000_000


def test_an_index_of_some_parts_needs_no_shuffle_and_no_store(spark, monkeypatch):
    rng = np.random.default_rng(6)
    vectors = unit(rng.normal(size=(400, 16)))
    vectors[50:150] = vectors[50]
    langs = [["hi", "te", None, "ml"][i % 4] for i in range(400)]
    wants = [None if i % 4 == 0 else ["hi", "te", "ml", "xx"][i % 4] for i in range(60)]
    rows = [(f"q{i}", "text" * (i % 3), vectors[i * 5].tolist() if i % 5 else None, w) for i, w in enumerate(wants)]
    q = spark.createDataFrame(rows, "query_id string, text string, embedding array<float>, want_lang string").repartition(3)
    index = index_frame(spark, vectors, langs)
    want = {r["query_id"]: r["hits"] for r in retrieval.attach_hits(q, index, 4, form="blocks").collect()}
    monkeypatch.setattr(retrieval, "ROWS_OUT", 7)
    monkeypatch.setattr(retrieval, "stored", None)
    got = retrieval.attach_hits(q, index, 4, broadcast_bytes=6000)
    assert "Exchange" not in plan_of(got).replace("Exchange RoundRobinPartitioning", "") and "Join" not in plan_of(got)
    assert {r["query_id"]: r["hits"] for r in got.collect()} == want and len(want) == 60
    assert len(retrieval.PreparedIndex(index, 4, 6000).shared) > 3
    assert retrieval.PreparedIndex(index, 4, 500).shared is None


def test_parts_of_an_index_are_not_kept(tmp_path):
    """A task holds the part that it reads; a lone part is read once."""
    (tmp_path / "part").write_bytes(pickle.dumps(list(range(5))))
    part = Broadcast(path=str(tmp_path / "part"))
    for _ in range(2):
        assert retrieval._read(part, False) == list(range(5)) and "_value" not in vars(part)
    assert retrieval._read(part, True) is retrieval._read(part, True)


def test_a_batch_in_one_language_meets_its_index_only(spark, monkeypatch):
    texts = spark.createDataFrame([("a", "kick the bucket"), ("b", " ")], "query_id string, text string")
    index = index_frame(spark, unit(np.eye(6)), ["hi", "te", "hi", "ml", None, "te"])
    met, real = [], gate.attach_hits

    def watched(df, index, *a, **how):
        met.append(sorted(str(r["target_lang"]) for r in index.collect()))
        return real(df, index, *a, **how)

    monkeypatch.setattr(gate, "attach_hits", watched)
    one = hooks.encoder(lambda: lambda texts: np.ones((len(texts), 6)))
    for language in ("Hindi", "tamil"):
        found = translate.translate_batch(texts, index, hooks.scorer(lambda: lambda texts: np.array([[0.0, 1.0]] * len(texts))), language, encoder=one)
        assert [r["query_id"] for r in found.collect()] == ["a"]
    assert met == [["hi", "hi"], ["None", "hi", "hi", "ml", "te", "te"]]


def test_given_coefficients_score_a_text_once(spark):
    """Texts are cut once per row, though the label, the confidence and a filter on the label all need the score."""
    df = spark.createDataFrame([(1, "Some words here"), (2, "")], "i int, text string")
    found = detector.detect(df, detector.GivenModel((1.0, -2.0, 0.5), -0.5)).filter("detection.is_idiomatic")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_evaluation_job_writes_its_report(spark, tmp_path):
    pairs = [("kick the bucket", "en", "मर जाना", "hi", "x"), ("spill the beans", "en", "राज़ खोलना", "hi", "x")]
    df = spark.createDataFrame(pairs, "source_idiom string, source_lang string, target_idiom string, target_lang string, source string")
    df = df.withColumn("row_ord", landed.synthetic_order(F.length("source_idiom")))
    index_plan.build_index(spark, df, str(tmp_path))
    (tmp_path / "test.csv").write_text("input_text,target_text,target_lang\nkick the bucket,मर जाना,hi\nspill the beans,other,hi\nx,y,te\n", encoding="utf-8")
    scorer = hooks.scorer(lambda: lambda texts: np.array([[0.0, 1.0]] * len(texts)))
    had = list(storage._STORED)
    report = evaluation.run_evaluation(spark, str(tmp_path / "test.csv"), str(tmp_path), scorer, "Hindi").first()
    assert (report["pairs"], report["exact_matches"], report["failures"]) == (2, 1, 0) and storage._STORED == had
    assert json.loads(next((tmp_path / "translation_report" / "hindi").glob("part-*.json")).read_text())["pairs"] == 2
