"""Deduplication, cleaning, samples, splits and profiles on small fixtures."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from phraseloom.operators import dedup, filters, ordering, profile, sampling, splitting
from phraseloom.plans.prepare import clean_detection
from phraseloom.sources.landed import synthetic_order


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def test_keep_first_over_copies(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("text"),
        F.lit(1).alias("label"),
        F.col("id").alias("kept"),
        synthetic_order(F.col("id")).alias("row_ord"),
    ).repartition(7)
    out = dedup.dedup_clean(df)
    assert out.count() == 20_001
    assert out.filter("text = 'hot'").first()["kept"] == 0


def test_unified_key_ignores_the_target(spark):
    rows = [("M", "en", t, lang, 1, i) for i, (t, lang) in enumerate([("a", "ml"), ("b", "te"), ("c", "hi")])]
    df = frame(spark, rows, "source_idiom string, source_lang string, target_idiom string, target_lang string, label int, i int")
    df = df.withColumn("row_ord", synthetic_order(F.col("i")))
    assert [r["target_lang"] for r in dedup.dedup_unified(df).collect()] == ["ml"]
    assert dedup.dedup_pairs(df).count() == 3


def test_detection_set_keeps_every_language_and_both_labels(spark):
    rows = [("one two three", "en", 0), ("one two three", "hi", 1), ("p q r", "te", -1), ("a b", "en", 1), ("a b c d", "en", 1), (" \t", "en", 1), (None, "en", 0)]
    df = frame(spark, rows, "source_idiom string, source_lang string, label int").withColumns(
        {"idiom_string": F.lit(""), "source": F.lit("s")}
    )
    got = sorted((r["text"], r["label"]) for r in clean_detection(filters.labelled_only(df)).collect())
    assert got == [("a b c d", 1), ("one two three", 0), ("one two three", 1)]


def test_na_words_are_text(spark):
    df = frame(spark, [("NA null nan", 1)], "source_idiom string, label int").withColumns({"idiom_string": F.lit(""), "source": F.lit("s")})
    assert clean_detection(df).first()["text"] == "na null nan"


def test_source_exclusion_keeps_null_source(spark):
    df = frame(spark, [("a", "KunchuKuttan"), ("b", None), ("c", "x")], "t string, source string")
    assert sorted(r["t"] for r in filters.exclude_source(df).collect()) == ["b", "c"]


def labelled(spark, counts):
    rows = [(f"text {label} {i}", label) for label, n in counts.items() for i in range(n)]
    return frame(spark, rows, "text string, label int")


def sizes(df):
    return Counter((r["label"], r["split"]) for r in df.collect())


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 70, 100])
def test_split_sizes(spark, n):
    got = sizes(splitting.stratified_split(labelled(spark, {0: n})))
    train, upto = n * 70 // 100, n * 85 // 100
    assert got == Counter({k: v for k, v in {(0, "train"): train, (0, "val"): upto - train, (0, "test"): n - upto}.items() if v})


def test_split_by_class_is_exact_and_ordered_by_hash(spark):
    df = labelled(spark, {0: 30, 1: 70, None: 20})
    out = splitting.stratified_split(df)
    got = sizes(out)
    assert [got[1, s] for s in ("train", "val", "test")] == [49, 10, 11]
    assert [got[0, s] for s in ("train", "val", "test")] == [21, 4, 5]
    assert sum(got.values()) == 120
    ones = {r["text"]: r["split"] for r in out.collect() if r["label"] == 1}
    by_hash = sorted(ones, key=lambda t: hashlib.md5(f"42:{t}".encode()).hexdigest())
    assert [ones[t] for t in by_hash] == ["train"] * 49 + ["val"] * 10 + ["test"] * 11


def test_split_with_more_rows_per_prefix(spark, monkeypatch):
    monkeypatch.setattr(splitting, "PREFIX_CHARS", 1)
    got = sizes(splitting.stratified_split(labelled(spark, {0: 997, 1: 1203})))
    assert got == Counter({(0, "train"): 697, (0, "val"): 150, (0, "test"): 150, (1, "train"): 842, (1, "val"): 180, (1, "test"): 181})


def test_copies_of_a_key_share_a_split(spark):
    df = labelled(spark, {0: 50}).unionAll(spark.range(40).select(F.lit("hot").alias("text"), F.lit(0).alias("label")))
    out = splitting.stratified_split(df)
    assert out.count() == 90
    assert out.filter("text = 'hot'").select("split").distinct().count() == 1


def test_one_class_falls_back_to_a_split_over_all(spark):
    got = sizes(splitting.split_by_class_or_random(labelled(spark, {1: 40})))
    assert got == Counter({(1, "train"): 28, (1, "val"): 6, (1, "test"): 6})


def test_too_few_rows(spark):
    with pytest.raises(ValueError):
        sampling.require_rows(spark.range(2))
    sampling.require_rows(spark.range(3))


@pytest.mark.parametrize("total,n,want", [(25, 10, list(range(0, 20, 2))), (5, 10, list(range(5))), (10, 10, list(range(10))), (19, 10, list(range(10)))])
def test_systematic_sample(spark, total, n, want):
    ids = [i * i * 1_000 - 500 for i in range(total)]
    df = spark.createDataFrame([(i,) for i in reversed(ids)], "id bigint").repartition(3)
    got = sorted(r["id"] for r in sampling.systematic_sample(df, n, "id").collect())
    assert got == [ids[p] for p in want]


def test_positions_of_skewed_ids(spark):
    ids = list(range(5_000)) + [10**15 + i for i in range(50)] + [-(10**12)]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(5)
    got = {r["id"]: r["position"] for r in ordering.position_by_id(df, "id", buckets=16).collect()}
    assert got == {v: p for p, v in enumerate(sorted(ids))}


def test_empty_sample(spark):
    assert sampling.systematic_sample(spark.range(0), 10, "id").count() == 0


def test_head_and_sample_rows(spark):
    df = frame(spark, [(i, "hi" if i % 2 else "te") for i in range(20)], "i int, target_lang string")
    assert sorted(r["i"] for r in sampling.head_per_language(df, 3, "i").collect()) == [0, 1, 2, 3, 4, 5]
    rows = frame(spark, [("  " + "x" * 100, 1), ("y", -1), ("z", 0)], "text string, label int")
    got = sampling.sample_rows(rows).collect()
    assert len(got) == 3 and {r["label_name"] for r in got} == {"Idiomatic", "Literal"}
    assert max(len(r["sample_text"]) for r in got) == 90


def test_length_buckets(spark):
    df = frame(spark, [(" ".join("w" * n),) for n in (4, 5, 49, 50, 998, 999)] + [(None,)], "text string")
    got = {r["lo"]: r["n"] for r in profile.token_length_histogram(df).collect()}
    assert got == {0: 1, 5: 1, 10: 0, 20: 0, 30: 1, 50: 2, 999: 1}
    stats = profile.token_length_stats(df).first()
    assert (stats["min_tokens"], stats["max_tokens"], stats["median_tokens"]) == (4, 999, 49.5)


def test_balance_reports(spark):
    df = labelled(spark, {0: 1, 1: 3})
    got = {r["label_name"]: (r["n"], r["pct"], r["bar"]) for r in profile.class_balance(df).collect()}
    assert got == {"Literal": (1, 25.0, "█" * 7), "Idiomatic": (3, 75.0, "█" * 22)}
    row = profile.imbalance_check(df).first()
    assert row["ratio"] == pytest.approx(1 / 3) and row["imbalanced"]
    row = profile.imbalance_check(df.limit(0)).first()
    assert (row["ratio"], row["imbalanced"]) == (0.0, False)


def test_pair_coverage_skips_missing_languages(spark):
    df = frame(spark, [("en", "hi"), ("en", "hi"), ("en", None), (None, "te"), ("te", "en")], "source_lang string, target_lang string")
    assert [tuple(r) for r in profile.pair_coverage(df).collect()] == [("en → hi", 2), ("te → en", 1)]


def test_leakage(spark):
    rows = [("a", "train"), ("a", "val"), ("b", "train"), ("b", "test"), ("c", "val"), ("c", "test"), ("c", "test"), ("d", "train")]
    got = profile.leakage_check(frame(spark, rows, "text string, split string")).first()
    assert tuple(got) == (1, 1, 1, False)
    assert profile.leakage_check(frame(spark, rows[:2], "text string, split string")).count() == 0
    clean = splitting.stratified_split(labelled(spark, {0: 40, 1: 60}))
    assert tuple(profile.leakage_check(clean).first()) == (0, 0, 0, True)


def test_label_conflict_is_kept_and_found(spark):
    df = labelled(spark, {0: 200}).unionAll(labelled(spark, {0: 200}).withColumn("label", F.lit(1)))
    df = df.unionAll(labelled(spark, {1: 37}))
    out = splitting.stratified_split(dedup.dedup_clean(df))
    row = profile.leakage_check(out).first()
    assert row["train_val"] + row["train_test"] + row["val_test"] > 0 and not row["clean"]
