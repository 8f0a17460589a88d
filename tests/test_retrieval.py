import numpy as np
import pytest
from pyspark.sql import functions as F

from phraseloom.operators import retrieval
from phraseloom.operators.encode import encode_text
from phraseloom.hooks import encoder

DDL = "row_id bigint, source_idiom string, source_lang string, target_idiom string, target_lang string, embedding array<float>"
FORMS = [("small_index", {}), ("few_queries", {}), ("blocks", {"block_rows": 25})]


def unit(m):
    return (m / np.linalg.norm(m, axis=1, keepdims=True)).astype(np.float32)


def index_frame(spark, vectors, langs, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(int(i), f"s{i}", "en" if i % 2 else "fr", f"t{i}", lang, v.tolist()) for i, v, lang in zip(ids, vectors, langs)]
    return spark.createDataFrame(rows, DDL).repartition(3)


def brute(queries, wants, vectors, langs, k):
    out = {}
    for q, want in zip(range(len(queries)), wants):
        s = np.round(vectors.astype(np.float64) @ queries[q].astype(np.float64), 10)
        rows = [i for i in range(len(vectors)) if want is None or langs[i] == want]
        out[q] = sorted(rows, key=lambda i: (-s[i], i))[:k]
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(5, 16))
    vectors = unit(np.vstack([centres[i % 5] + 0.2 * rng.normal(size=16) for i in range(240)]))
    # A third of the index is one vector, so one cell is hot and ties are many.
    vectors[::3] = vectors[0]
    langs = [["hi", "te", "ml"][i % 7 % 3] for i in range(240)]
    queries = unit(np.vstack([vectors[:20], rng.normal(size=(20, 16))]))
    wants = [None if i % 4 == 0 else ["hi", "te", "ml", "xx"][i % 4] for i in range(40)]
    return vectors, langs, queries, wants


@pytest.mark.parametrize("form,how", FORMS)
@pytest.mark.parametrize("filtered", [False, True])
def test_equals_brute_force(spark, data, form, how, filtered):
    vectors, langs, queries, wants = data
    wants = wants if filtered else [None] * len(queries)
    q = spark.createDataFrame([(i, v.tolist(), w) for i, (v, w) in enumerate(zip(queries, wants))], "query_id int, embedding array<float>, want_lang string")
    got = {}
    for r in retrieval.cosine_top_k(q, index_frame(spark, vectors, langs), 4, form=form, **how).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["row_id"])
    want = {k: v for k, v in brute(queries, wants, vectors, langs, 4).items() if v}
    assert got == want


def test_blocks_move_what_is_asked_for(spark, data):
    """Rows of the index are copied once per chunk that asks for their language, and to no other."""
    vectors, langs, queries, _ = data
    q = spark.createDataFrame([(i, v.tolist(), "hi") for i, v in enumerate(queries)], "query_id bigint, embedding array<float>, want_lang string")
    index = index_frame(spark, vectors, langs)
    got = retrieval.cosine_top_k(q, index, 3, form="blocks", block_rows=25)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert {r["row_id"] for r in got.collect()} <= {i for i, lang in enumerate(langs) if lang == "hi"}


def test_a_forced_form_is_checked_too(spark, data):
    vectors, langs, queries, _ = data
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id bigint, embedding array<float>")
    for form in ("small_index", "few_queries"):
        with pytest.raises(ValueError, match="too large"):
            retrieval.cosine_top_k(q, index_frame(spark, vectors, langs), 2, form=form, broadcast_bytes=100)


@pytest.mark.parametrize("form,how", FORMS)
def test_both_sides_are_encoded_once(spark, form, how):
    calls = spark.sparkContext.accumulator(0)

    def load():
        def model(texts):
            calls.add(len(texts))
            return np.array([[len(t), 1.0] for t in texts])

        return model

    texts = spark.createDataFrame([(i, "x" * (i + 1)) for i in range(30)], "row_id bigint, text string")
    index = encode_text(texts, "text", encoder(load)).select("row_id", F.lit("hi").alias("target_lang"), "embedding")
    q = encode_text(texts.limit(10), "text", encoder(load)).select(F.col("row_id").alias("query_id"), "embedding")
    retrieval.cosine_top_k(q, index, 2, form=form, **how).collect()
    assert calls.value == 40


def test_form_follows_size(spark, data, monkeypatch):
    vectors, langs, queries, _ = data
    used = []
    for name in ("_with_small_index", "_with_few_queries", "_with_blocks"):
        real = getattr(retrieval, name)
        monkeypatch.setattr(retrieval, name, lambda *a, _n=name, _r=real: (used.append(_n), _r(*a))[1])
    index = index_frame(spark, vectors, langs)
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id bigint, embedding array<float>")
    retrieval.cosine_top_k(q, index, 2)
    retrieval.cosine_top_k(q, index, 2, broadcast_bytes=16 * 4 * 100)
    retrieval.cosine_top_k(q, index, 2, broadcast_bytes=16 * 4 * 10)
    assert used == ["_with_small_index", "_with_few_queries", "_with_blocks"]


@pytest.mark.parametrize("form,how", FORMS)
def test_ties_and_short_languages(spark, form, how):
    vectors = np.array([[1, 0], [1, 0], [0, 1], [1, 0]], dtype=np.float32)
    index = index_frame(spark, vectors, ["hi", "hi", "te", "hi"])
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, embedding array<float>")
    hits = retrieval.retrieve(q, index, 2, form=form, **how).orderBy("rank").collect()
    assert [(r["row_id"], r["score"]) for r in hits] == [(0, 1.0), (1, 1.0)]
    hits = retrieval.retrieve(q, index, 3, target_lang="te", form=form, **how).collect()
    assert [r["row_id"] for r in hits] == [2]
    hits = retrieval.retrieve(q, index, 3, source_lang="en", form=form, **how).orderBy("rank").collect()
    assert [r["row_id"] for r in hits] == [1, 3]
    assert retrieval.retrieve(q, index, 3, target_lang="xx", form=form, **how).collect() == []


def test_k_must_be_positive(spark, data):
    with pytest.raises(ValueError):
        retrieval.cosine_top_k(spark.createDataFrame([], "query_id int, embedding array<float>"), index_frame(spark, data[0], data[1]), 0)


def test_pack_hits_in_rank_order(spark, data):
    vectors, langs, queries, _ = data
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id bigint, embedding array<float>")
    for r in retrieval.pack_hits(retrieval.retrieve(q, index_frame(spark, vectors, langs), 3)).collect():
        assert [h["rank"] for h in r["hits"]] == [1, 2, 3]


def test_language_filter_is_below_the_scoring(spark, data, tmp_path):
    vectors, langs, queries, _ = data
    index_frame(spark, vectors, langs).write.partitionBy("target_lang").parquet(str(tmp_path / "i"))
    index = spark.read.parquet(str(tmp_path / "i"))
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id bigint, embedding array<float>")
    plan = retrieval.retrieve(q, index, 2, target_lang="te", form="few_queries")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(target_lang" in plan
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("WindowGroupLimit") < plan.index("MapInArrow") < plan.index("FileScan")


def test_builtin_encoder(spark):
    df = spark.createDataFrame([(1, "kick the bucket"), (2, " Kick the  bucket"), (3, "zzz"), (4, ""), (5, None)], "i int, t string")
    got = {r["i"]: r["embedding"] for r in encode_text(df, "t").collect()}
    assert np.linalg.norm(got[1]) == pytest.approx(1, abs=1e-5)
    assert np.dot(got[1], got[2]) > 0.9 > np.dot(got[1], got[3])
    assert got[4] is None and got[5] is None


def test_encoder_hook(spark):
    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([("abc",), (None,)], "t string")
    got = [r[0] for r in encode_text(df, "t", encoder(load, batch=1)).select("embedding").collect()]
    assert got[0] == pytest.approx([3 / 10**0.5, 1 / 10**0.5]) and got[1] == [0.0, 1.0]


@pytest.mark.parametrize("how", [{}, {"form": "few_queries"}, {"form": "blocks", "block_rows": 25}, {"broadcast_bytes": 4000}])
def test_attach_hits_equals_packed_hits(spark, data, how):
    vectors, langs, queries, wants = data
    index = index_frame(spark, vectors, langs)
    rows = [(f"q{i}", "text" * (i % 3), v.tolist() if i % 5 else None, w) for i, (v, w) in enumerate(zip(queries, wants))]
    q = spark.createDataFrame(rows, "query_id string, text string, embedding array<float>, want_lang string").repartition(3)
    got = retrieval.attach_hits(q, index, 4, **how)
    assert got.columns == ["query_id", "text", "want_lang", "hits"]
    packed = {r["query_id"]: r["hits"] for r in retrieval.pack_hits(retrieval.retrieve(q, index, 4)).collect()}
    assert got.count() == 40
    for r in got.collect():
        assert r["hits"] == packed.get(r["query_id"], [])


def test_small_index_needs_no_shuffle(spark, data):
    vectors, langs, queries, _ = data
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id bigint, embedding array<float>")
    plan = retrieval.attach_hits(q, index_frame(spark, vectors, langs), 4)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_a_model_meets_each_row_once(spark, data):
    calls = spark.sparkContext.accumulator(0)

    def load():
        def model(texts):
            calls.add(len(texts))
            return np.array([[len(t), 1.0] for t in texts])

        return model

    vectors, langs, _, _ = data
    df = spark.createDataFrame([(i, "x" * (i + 1)) for i in range(10)], "query_id bigint, text string")
    encoded = encode_text(df, "text", encoder(load), only=F.col("query_id") < 7)
    two = index_frame(spark, vectors[:, :2], langs)
    rows = retrieval.attach_hits(encoded, two, 2).filter(F.size("hits") > 0).collect()
    assert len(rows) == 7 and calls.value == 7


def test_spare_copies():
    v = np.array([[1, 0], [0, 1], [1, 0], [1, 0], [0, 1], [1, 0]], dtype=np.float32)
    langs = np.array(["a", "a", "a", "b", "a", "a"], dtype=object)
    assert retrieval._first_copies(v, langs, 2).tolist() == [True, True, True, True, True, False]
    assert retrieval._first_copies(v, langs, 1).tolist() == [True, True, False, True, False, False]
    assert retrieval._first_copies(v[:0], langs[:0], 1).tolist() == []
