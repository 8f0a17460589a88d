import pytest
from pyspark.sql import functions as F

from phraseloom.functions import arrays, language, text as T

SPACES = [" ", "\t", "\x1c", "　", "\x85", " ", "\n", " "]
SAMPLES = [
    None,
    "",
    " ",
    " 　\t",
    "Plain text here",
    "  A　B\x1cC \t\n D\x85",
    "zero​width stays",
    "ÉTÉ  Straße",
    "one two  three ",
    "a\n",
    "ആനപ്പുറത്ത്  ഇരിക്കുക",
    "x" + " \t" * 50 + "y",
]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, s string")
    return df.select(
        "i",
        T.clean_text("s").alias("clean"),
        T.strip("s").alias("strip"),
        T.normalize_text("s").alias("norm"),
        T.token_count("s").alias("n"),
        T.tokens("s").alias("toks"),
        T.is_blank("s").alias("blank"),
        T.capitalize("s").alias("cap"),
        T.cut("s", 5).alias("cut"),
    ).orderBy("i").collect()


def test_text_functions_match_python(rows):
    for s, r in zip(SAMPLES, rows):
        assert r["clean"] == (" ".join(s.split()).lower() if s is not None else "")
        assert r["norm"] == ((s or "").strip())
        assert r["blank"] == (not (s or "").strip())
        if s is None:
            assert r["strip"] is None and r["n"] is None
            continue
        assert r["strip"] == s.strip()
        assert r["n"] == len(s.split()) and r["toks"] == s.split()
        assert r["cap"] == s.capitalize()
        assert r["cut"] == s[:5]


def test_strip_of_long_inner_run_is_fast(spark):
    long_text = "a" + " " * 200_000 + "b"
    df = spark.createDataFrame([(long_text,)], "s string")
    assert df.select(T.strip("s")).first()[0] == long_text


def test_tags_and_joins(spark):
    df = spark.createDataFrame([([0, 0],), ([0, 2],), ([],), (None,)], "t array<int>")
    assert [r[0] for r in df.select(T.any_nonzero("t")).collect()] == [0, 1, 0, 0]


def test_json_helpers(spark):
    df = spark.createDataFrame([('{"a": 1}',)], "j string")
    row = df.select(T.parse_json("j", "a int").alias("p")).select("p.a", T.emit_json("p").alias("j")).first()
    assert row["a"] == 1 and row["j"] == '{"a":1}'


def test_languages(spark):
    df = spark.createDataFrame([("Hindi", "hi"), ("TELUGU", "te"), ("malayalam", "ml"), ("tamil", "ta"), (None, None)], "n string, c string")
    got = [tuple(r) for r in df.select(language.language_code("n"), language.language_name("c")).collect()]
    assert got == [("hi", "hindi"), ("te", "telugu"), ("ml", "malayalam"), (None, "malayalam"), (None, "malayalam")]
    assert language.require_language("HINDI") == "hi"
    with pytest.raises(ValueError):
        language.require_language("tamil")


def test_unit_vectors_and_argmax(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,)], "v array<float>")
    got = [r[0] for r in df.select(arrays.l2_normalize("v")).collect()]
    assert got[0] == pytest.approx([0.6, 0.8]) and got[1:] == [None, None]
    df = spark.createDataFrame([([2.0, 2.0],), ([1.0, 3.0],), ([1000.0, 0.0],)], "v array<double>")
    got = [tuple(r) for r in df.select(arrays.argmax("v"), arrays.softmax("v").getItem(0)).collect()]
    assert got[0] == (0, 0.5) and got[1][0] == 1 and got[2] == (0, 1.0)


def test_detection_struct(spark):
    df = spark.createDataFrame([([0.5, 0.5],), ([0.12344, 0.87656],)], "p array<double>")
    got = [tuple(r[0]) for r in df.select(arrays.detection_struct("p")).collect()]
    assert got == [("Literal", 0.5, False), ("Idiomatic", 0.8766, True)]


def test_label_names(spark):
    df = spark.createDataFrame([(0,), (1,), (-1,)], "l int")
    assert [r[0] for r in df.select(T.label_name("l")).collect()] == ["Literal", "Idiomatic", "-1"]
