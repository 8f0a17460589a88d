import json

import pytest
from pyspark.sql import functions as F

from phraseloom import schemas as S
from phraseloom.operators import dedup, filters
from phraseloom.sources import landed, tables


def write_lines(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows), encoding="utf-8")


def write_json(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False), encoding="utf-8")


def ordered(df, *cols):
    return [tuple(r) for r in df.orderBy("row_ord").select(*cols).collect()]


def test_labels_only_by_word(spark, tmp_path):
    labels = ["idiomatic", "Idiomatic", "literal", "1", None]
    write_lines(tmp_path / "m" / "train.json", [{"sentence": f"s{i}", "label": v, "idiom": "x"} for i, v in enumerate(labels)])
    df = landed.read_labelled_sentences(spark, str(tmp_path / "m"))
    assert df.columns == S.UNIFIED_ORDERED.names
    assert ordered(df, "source_idiom", "label", "split", "source", "target_idiom") == [
        (f"s{i}", want, "train", "MAGPIE", "") for i, want in enumerate([1, 1, 0, 0, 0])
    ]


def test_sentence_falls_back_to_text_and_integer_label(spark, tmp_path):
    write_lines(tmp_path / "split=test" / "a.json", [{"text": "t", "label": 1}, {"sentence": None, "text": "u", "label": "IDIOMATIC"}, {}])
    df = landed.read_labelled_sentences(spark, str(tmp_path))
    assert ordered(df, "source_idiom", "label", "split", "idiom_string") == [("t", 0, "test", ""), ("u", 1, "test", ""), ("", 0, "test", "")]


def test_tagged_tokens(spark, tmp_path):
    rows = [
        {"tokens": ["a", "b"], "tags": [0, 0], "idiom": "i"},
        {"tokens": ["a", "b"], "tags": [0, 2]},
        {"words": ["c", "d"], "ner_tags": [1]},
        {"tokens": [], "sentence": "whole", "tags": []},
        {"sentence": "only"},
    ]
    write_lines(tmp_path / "p" / "validation.json", rows)
    df = landed.read_tagged_tokens(spark, str(tmp_path / "p"))
    assert ordered(df, "source_idiom", "label", "split") == [
        ("a b", 0, "validation"),
        ("a b", 1, "validation"),
        ("c d", 1, "validation"),
        ("whole", 0, "validation"),
        ("only", 0, "validation"),
    ]


def expr(x):
    return {"expression": x}


def test_map_order_repeats_and_file_shapes(spark, tmp_path):
    write_json(tmp_path / "a" / "list.json", [{"languages": {"te": expr("T"), "en": expr("E"), "hi": expr("")}}, {"languages": {}}, {}])
    write_json(tmp_path / "b" / "one.json", {"languages": {"de": expr("D"), "en": expr("E2"), "fr": expr("F")}})
    write_json(tmp_path / "c" / "bad.json", '[{"languages": ')
    write_json(tmp_path / "d" / "twice.json", '[{"languages": {"te": {"expression": "old"}, "en": {"expression": "E3"}, "te": {"expression": "new"}}}]')
    write_json(tmp_path / "d" / "nulls.json", [{"languages": {"te": {}, "en": {"expression": None}, "hi": None, "fr": expr("x"), "de": expr("y")}}])
    got = ordered(landed.read_multilingual_map(spark, str(tmp_path)), "source_idiom", "source_lang", "target_idiom", "target_lang")
    assert got == [
        ("T", "te", "E", "en"),
        ("D", "de", "E2", "en"),
        ("D", "de", "F", "fr"),
        ("E2", "en", "F", "fr"),
        ("x", "fr", "y", "de"),
        ("new", "te", "E3", "en"),
    ]
    raw = landed.read_json_lists(spark, str(tmp_path), S.MULTILINGUAL_MAP)
    assert landed.corrupt_count(raw).first()[0] == 1


def test_parallel_corpus_samples_before_the_blank_filter(spark, tmp_path):
    rows = [{"translation": {"en": f" e{i} " if i != 4 else "  ", "hi": f"h{i}"}} for i in range(25)]
    write_lines(tmp_path / "k" / "a.json", rows)
    df = landed.read_parallel_corpus(spark, str(tmp_path / "k"), 10)
    assert ordered(df, "source_idiom", "label") == [(f"e{i}", -1) for i in range(0, 20, 2) if i != 4]
    assert landed.read_parallel_corpus(spark, str(tmp_path / "k"), 100).count() == 24


def test_parallel_corpus_over_many_files(spark, tmp_path):
    for f in range(7):
        write_lines(tmp_path / "k" / f"part{f}.json", [{"translation": {"en": f"e{f}-{i}", "hi": "h"}} for i in range(f + 1)])
    whole = [f"e{f}-{i}" for f in range(7) for i in range(f + 1)]
    df = landed.read_parallel_corpus(spark, str(tmp_path / "k"), 9)
    assert [r[0] for r in ordered(df, "source_idiom")] == whole[::3][:9]


DICT = [{"idiom": "N1", "literal_meaning": "l", "figurative_meaning": "M"}, {"idiom": "N2", "figurative_meaning": None}]


def test_dictionary_gives_both_directions(spark, tmp_path):
    write_json(tmp_path / "telugu.json", DICT)
    df = landed.read_idiom_json(spark, str(tmp_path / "telugu.json"), "te")
    cols = ["source_idiom", "source_lang", "target_idiom", "target_lang", "idiom_string", "source"]
    assert ordered(df, *cols) == [
        ("N1", "te", "M", "en", "N1", "Kaggle-Indian-Idioms"),
        ("M", "en", "N1", "te", "N1", "Kaggle-Indian-Idioms-Reverse"),
        ("N2", "te", "", "en", "N2", "Kaggle-Indian-Idioms"),
        ("", "en", "N2", "te", "N2", "Kaggle-Indian-Idioms-Reverse"),
    ]


def test_meaning_pairs_take_the_language_from_the_file(spark, tmp_path):
    for name in ("hindi.json", "telugu.json"):
        write_json(tmp_path / name, DICT)
    df = landed.read_meaning_json_pairs(spark, [str(tmp_path / "hindi.json"), str(tmp_path / "telugu.json")])
    got = {tuple(r) for r in df.select("source_idiom", "target_idiom", "target_lang", "source").collect()}
    assert got == {("M", "N1", "hi", "Raw-hindi.json"), ("M", "N1", "te", "Raw-telugu.json")}


MIXED = "சோதனை మాట കഥ"


def test_pair_csv_passes_text_through(spark, tmp_path):
    lines = [
        "source_idiom,source_lang,target_idiom,target_lang,label,idiom_string,split,source",
        f'{MIXED},ml,"Three scripts, one ""phrase""",en,1,{MIXED},train,Custom-Malayalam',
    ]
    (tmp_path / "malayalam_idioms.csv").write_text("\n".join(lines), encoding="utf-8")
    row = landed.read_pair_csv(spark, str(tmp_path / "*_idioms.csv")).first()
    assert (row["source_idiom"], row["target_idiom"], row["label"]) == (MIXED, 'Three scripts, one "phrase"', 1)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a_idioms.csv").write_text("source_idiom,target_idiom,source_lang,target_lang\nA,B,te,en\n")
    (tmp_path / "b_idioms.csv").write_text("target_lang,source_idiom,label,target_idiom,source_lang\nen,C,1,D,ml\n")
    rows = landed.read_pair_csv(spark, str(tmp_path / "*_idioms.csv")).collect()
    got = {(r["source_idiom"], r["source_lang"], r["target_idiom"], r["target_lang"], r["label"]) for r in rows}
    assert got == {("A", "te", "B", "en", None), ("C", "ml", "D", "en", 1)}


def test_broken_lines_give_no_rows(spark, tmp_path):
    (tmp_path / "train.json").write_text('{broken\n{"sentence": "good one", "label": "idiomatic"}\n')
    assert [r["source_idiom"] for r in landed.read_labelled_sentences(spark, str(tmp_path / "train.json")).collect()] == ["good one"]
    (tmp_path / "tags.json").write_text('{"tokens": [\n{"tokens": ["x"], "tags": [1]}\n')
    assert [r["source_idiom"] for r in landed.read_tagged_tokens(spark, str(tmp_path / "tags.json")).collect()] == ["x"]
    raw = landed.read_records(spark, str(tmp_path / "train.json"), landed.S.LABELLED_SENTENCE)
    assert landed.corrupt_count(raw).first()[0] == 1


def test_an_unreadable_file_falls_back(spark, tmp_path):
    (tmp_path / "broken.json.gz").write_bytes(b"no gzip at all")
    (tmp_path / "f.csv").write_text("source_idiom,source_lang\ns,en\n")
    df = landed.read_or_fallback(spark, landed.read_labelled_sentences, str(tmp_path / "broken.json.gz"), str(tmp_path / "f.csv"))
    assert [r["source_idiom"] for r in df.collect()] == ["s"]


def test_fallbacks(spark, tmp_path):
    missing = str(tmp_path / "nowhere")
    assert landed.read_or_fallback(spark, landed.read_labelled_sentences, missing).count() == 0
    (tmp_path / "f.csv").write_text("source_idiom,source_lang,target_idiom,target_lang,label,idiom_string,split,source\ns,en,,,1,i,train,X\n")
    df = landed.read_or_fallback(spark, landed.read_labelled_sentences, missing, str(tmp_path / "f.csv"))
    assert df.first()["source_idiom"] == "s"
    assert tables.read_if_exists(spark, missing) is None
    with pytest.raises(FileNotFoundError):
        tables.read_index(spark, missing)


def test_required_columns(spark):
    with pytest.raises(ValueError, match="target_lang"):
        filters.require_columns(spark.range(1).select(F.lit("a").alias("source_idiom")), filters.PAIR_KEYS)


def test_concat_fills_missing_columns_and_keeps_source_order(spark):
    a = spark.createDataFrame([("x", "en", 1)], "source_idiom string, source_lang string, label int")
    b = spark.createDataFrame([("x", "en", 1, "later")], "source_idiom string, source_lang string, label int, source string")
    both = dedup.concat_sources([a, b])
    assert both.count() == 2
    assert dedup.dedup_unified(both).select("source").first()[0] is None
    assert dedup.dedup_unified(dedup.concat_sources([b, a])).select("source").first()[0] == "later"
    with pytest.raises(ValueError):
        dedup.concat_sources([])
