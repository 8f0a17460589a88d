"""Operators of the training-data pipeline against plain versions, on awkward rows and on the driver tables."""

from __future__ import annotations

import shutil
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute
import __spark_entry__ as entry
from compare import connect, compare
from phraseloom.llm import catalog, components, exact_dedup, jaccard_join, kd_search, license_scan, mixing, piece_fst, quality
from phraseloom.llm import labelled, substring_dedup, token_files, toxicity, words
from phraseloom.llm.scratch import Scratch

SF = "/root/testdata/sf0.001"
ROWS = brute.awkward()
PAIRS = [(r[0], r[1]) for r in ROWS]
WORD_BPE, PIECES = catalog.tokenizer_path("word_bpe_49k.json"), catalog.tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, brute.SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], brute.SCHEMA)


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


def real(con) -> list[tuple]:
    return con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def as_set(rows) -> Counter:
    return Counter(tuple(r) for r in rows)


# ------------------------------------------------------------------ 1


def expected_ids(pairs):
    from tokenizers import Tokenizer

    library, start, out = Tokenizer.from_file(WORD_BPE), 0, []
    for i, t in sorted(pairs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files(spark, duck):
    got = entry.queries()["op1_token_files"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert as_set(got.collect()) == as_set(expected_ids(real(duck)))


def test_token_files_of_awkward_rows(spark, docs, tmp_path):
    token_files.write_token_files(docs, f"{tmp_path}/t", WORD_BPE, end_id=1)
    got = token_files.with_crc32(token_files.read_token_files(spark, f"{tmp_path}/t"))
    want = expected_ids(PAIRS)
    assert as_set(r[0::2] + r[3:] for r in map(tuple, got.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == as_set(
        w[0::2] + w[3:] for w in want
    )
    few = token_files.read_token_files(spark, f"{tmp_path}/t", [3, 27, 10**9]).collect()
    assert {r["doc_id"] for r in few} == {3, 27} and all(len(r["ids"]) == 4 * r["n_tokens"] for r in few)
    starts = {r["doc_id"]: r["start"] for r in got.collect()}
    assert all(r["start"] == starts[r["doc_id"]] for r in few if r["doc_id"] == 3)


def test_packs_of_another_dictionary_are_refused(spark, docs, tmp_path):
    token_files.write_token_files(docs, f"{tmp_path}/t", WORD_BPE, end_id=1)
    forged = spark.createDataFrame([("0" * 64, b"", "<u2")], "sha256 string, dict binary, width string")
    forged.write.mode("overwrite").parquet(f"{tmp_path}/t/dict")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read_token_files(spark, f"{tmp_path}/t").collect()


def test_dictionary_sees_the_ends_of_long_texts(spark, monkeypatch):
    seen: list[bytes] = []
    monkeypatch.setattr(token_files.zstandard, "train_dictionary", lambda size, samples: (seen.extend(samples), token_files.zstandard.ZstdCompressionDict(b""))[1])
    long = "river " * 8000 + "mountain " * 50 + "river " * 40_000 + "harbour " * 100
    frame = spark.createDataFrame([(1, long), (2, "short text"), (3, None)], "doc_id bigint, text string")
    token_files.train_dictionary(frame, WORD_BPE, 1)
    enc = token_files.encoder(WORD_BPE)
    end, harbour = np.array([1], enc.width).tobytes(), enc.encode_many(["harbour"])[0]
    assert any(s.endswith(harbour * 10 + end) for s in seen)
    assert {end, enc.encode_many(["short text"])[0] + end} <= set(seen) and sum(s.endswith(end) for s in seen) == 3
    assert sum(map(len, seen)) <= token_files.DICT_PIECES * token_files.PIECE_CHARS * np.dtype(enc.width).itemsize


def test_no_documents_make_no_packs(spark, empty, tmp_path):
    token_files.write_token_files(empty, f"{tmp_path}/t", WORD_BPE, end_id=1)
    assert token_files.read_token_files(spark, f"{tmp_path}/t").count() == 0


def test_words_are_encoded_as_in_whole_texts():
    enc = token_files.WordEncoder(WORD_BPE)
    texts = ["a<|endoftext|>b", "É ́x", " a b\x1cc", "İstanbul ΣΑΣ don't I'LL 'S", "a\rb\x0bc", "straße ŒUVRE ǅ ªº", "12ab3 ½x²", "é,, (ok..!)"]
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, enc.width).tolist() for b in enc.encode_many(texts)] == want


# ------------------------------------------------------------------ 2


def test_pieces_equal_the_library(spark, docs, duck):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for frame, pairs in ((docs, PAIRS), (catalog.table(spark, SF, "documents"), real(duck))):
        got = piece_fst.encode_pieces(frame, PIECES).collect()
        assert all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in got)
        assert as_set((r["doc_id"], tuple(r["ids"])) for r in got) == as_set((i, tuple(library.encode(t or ""))) for i, t in pairs)


def test_decoding_gives_the_texts(spark, docs):
    back = piece_fst.decode_pieces(piece_fst.encode_pieces(docs, PIECES), PIECES)
    assert as_set(back.collect()) == as_set((i, t or "") for i, t in PAIRS)


def test_shortest_path_of_a_unigram_model():
    model = piece_fst.PieceModel(PIECES)
    model.kind = piece_fst.UNIGRAM
    fst = piece_fst.Transducer(model)
    cost = {p: (-s, i) for i, (p, s, k) in enumerate(zip(model.pieces, model.scores, model.kinds)) if k == piece_fst.NORMAL}
    cells = ["▁the", "tionality", "日本x\t", "aaaaaaaaaaa", "▁▁▁a"]
    for cell, raw in zip(cells, fst.shortest(cells)):
        ids = np.frombuffer(raw, "<i4").tolist()
        best = [0.0] + [np.inf] * len(cell)
        for j in range(1, len(cell) + 1):
            best[j] = min([best[i] + cost[cell[i:j]][0] for i in range(j) if cell[i:j] in cost] + [best[j - 1] + fst.fallback])
        chars = [c for c in cell if len(c.encode()) and c not in cost]
        total = sum(-model.scores[i] for i in ids if model.kinds[i] == piece_fst.NORMAL) + fst.fallback * len(chars)
        assert total == pytest.approx(best[-1])


def test_no_documents_have_no_pieces(empty):
    assert piece_fst.encode_pieces(empty, PIECES).count() == 0


# ------------------------------------------------------------------ 3 and 8


@pytest.mark.parametrize("name, label, held", [("op3_quality", "quality", lambda c: c % 3 == 1), ("op8_toxicity", "toxic", lambda c: c % 5 == 0)])
def test_held_out_accuracy(spark, name, label, held):
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in entry.queries()[name](spark, sf).collect()}
    known = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert all(r["held_out"] == held(zlib.crc32(str(i).encode())) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    tested = [r for r in known if got[r["doc_id"]]["held_out"]]
    for value in (0, 1):
        own = [got[r["doc_id"]]["predicted"] == value for r in tested if r[label] == value]
        assert np.mean(own) > 0.85, (value, np.mean(own), len(own))


def test_scores_of_awkward_rows(spark, docs, empty):
    labels = spark.createDataFrame([(i, int(i % 2 == 0), int(i % 4 == 0)) for i in range(0, 90, 3)] + [(None, 1, 1), (3, 1, 0), (9, None, None)], "doc_id bigint, quality int, toxic int")
    for make in (quality.quality_table, toxicity.toxicity_table):
        got = make(docs, labels).collect()
        assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
        by_text = {}
        for r in got:
            by_text.setdefault(r["doc_id"], set()).add(r["score"])
        assert all(len(s) == 1 for i, s in by_text.items() if i is not None)
        assert by_text[0] == by_text[3]
        assert [r for r in got if r["doc_id"] is None][0]["held_out"] is False
        assert make(empty, labels).count() == 0
        assert all(r["score"] == pytest.approx(0.5) for r in make(docs, labels.limit(0)).collect())


def test_repeated_labelled_rows_stay_off_the_driver(spark, monkeypatch):
    texts = [f"text {k:03}" for k in range(500)]
    docs = spark.createDataFrame([(7, t) for t in texts] + [(8, "other")], "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id bigint, quality int")
    held: list[int] = []
    collect = type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda self: (got := collect(self), held.append(len(got)))[0])
    got = labelled.labelled_sample(docs, labels, "quality", F.lit(True), 10)
    assert held == [10]
    first = spark.range(7, 9).orderBy(F.xxhash64("id")).first()[0]
    both = [(b"other", 0)], [(t.encode(), 1) for t in texts]
    assert got == ((both[1] if first == 7 else both[0] + both[1])[:10])


def test_held_out_labels_change_nothing(spark, docs):
    base = spark.createDataFrame([(i, int(i % 2 == 0), int(i % 2)) for i in range(0, 90, 3)], "doc_id bigint, quality int, toxic int")
    for module, make, label in ((quality, quality.quality_table, "quality"), (toxicity, toxicity.toxicity_table, "toxic")):
        flipped = base.withColumn(label, F.when(module.held_out(F.col("doc_id")), 1 - F.col(label)).otherwise(F.col(label)))
        a, b = (sorted((r["doc_id"], r["score"]) for r in make(docs.filter("doc_id IS NOT NULL"), x).collect()) for x in (base, flipped))
        assert a == b


# ------------------------------------------------------------------ 4


def test_substring_dedup(spark, docs, empty, duck):
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert as_set(entry.queries()["op4_substring_dedup"](spark, SF).select(columns).collect()) == as_set(brute.cut(real(duck)))
    assert as_set(substring_dedup.substring_dedup(docs).select(columns).collect()) == as_set(brute.cut(PAIRS))
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_sliding_extremes():
    values = np.random.default_rng(0).integers(0, 100, 50)
    for width in (1, 2, 5, 13):
        want = [values[i : i + width].min() for i in range(50 - width + 1)]
        assert substring_dedup.slide(values, width, np.minimum).tolist() == want


# ------------------------------------------------------------------ 5


def test_exact_dedup(spark, duck):
    assert compare(entry.queries()["op5_exact_dedup"](spark, SF), duck, catalog.oracle_sql()["op5_exact_dedup"]) == []


def test_exact_dedup_of_awkward_rows(spark, docs, empty):
    rows = {tuple(r) for r in exact_dedup.exact_dedup(docs, exact_dedup.DigestIndex(spark, "awkward")).collect()}
    groups: dict[bytes, list] = {}
    for i, t in PAIRS:
        groups.setdefault(brute.BLANK.sub(b" ", (t or "").encode()), []).append(i)
    want = set()
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want |= {(i, keep, len(ids), i is not None and i == keep, __import__("hashlib").sha256(text).hexdigest()) for i in ids}
    assert rows == want
    assert exact_dedup.exact_dedup(empty, exact_dedup.DigestIndex(spark, "nothing")).count() == 0


def test_index_outlives_a_batch(spark, docs):
    index = exact_dedup.DigestIndex(spark, "kept_index", buckets=3)
    exact_dedup.exact_dedup(docs, index).count()
    size = index.read().count()
    later = docs.withColumn("doc_id", F.col("doc_id") - 1000)
    again = exact_dedup.exact_dedup(later, exact_dedup.DigestIndex(spark, "kept_index"))
    assert again.filter("kept").count() == 0 and index.read().count() == size
    described = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED kept_index").collect()}
    assert described["Num Buckets"] == "3" and "digest" in described["Sort Columns"]


def test_exact_dedup_runs_no_python(spark):
    index = exact_dedup.DigestIndex(spark, "plan_index")
    plan = exact_dedup.exact_dedup(catalog.table(spark, SF, "documents"), index)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ------------------------------------------------------------------ 6


def test_mixing(spark, duck):
    docs = catalog.table(spark, SF, "documents")
    sizes = {i: (s or "", len(brute.words_of(t))) for i, s, t in duck.execute("SELECT doc_id, source, text FROM documents").fetchall()}
    sizes = {i: v for i, v in sizes.items() if v[1]}
    keys = {r[0]: (r[1], r[2]) for r in docs.select("doc_id", F.xxhash64("doc_id", F.lit(1)), F.lit(0)).collect()}
    total = sum(n for _, n in sizes.values())
    counts = Counter(s for s, _ in sizes.values())

    def order(source):
        cuts = -(-counts[source] // mixing.BLOCK_ROWS)
        own = [i for i, (s, _) in sizes.items() if s == source]
        return sorted(own, key=lambda i: ((keys[i][0] >> 20) % cuts, keys[i][0]))

    for share, repeats, budget in ((0.5, 4.0, total), (0.9, 1.3, 2 * total), (0.0, 4.0, total / 3), (1.0, 9.0, 3 * total)):
        if budget > repeats * total:
            repeats = 2.0
        got = mixing.mix(docs, budget, share, repeats).collect()
        want = brute.mixture(sizes, share, repeats, budget, order)
        have = Counter(r["doc_id"] for r in got)
        assert sum(abs(have[i] - want[i]) for i in sizes) <= 0.01 * len(sizes) + 2
        assert len({(r["block"], r["slot"]) for r in got}) == len(got)
        assert {r["epoch"] for r in got if r["doc_id"] == got[0]["doc_id"]} == set(range(have[got[0]["doc_id"]]))


def test_mixing_awkward_rows(spark, docs, empty):
    got = mixing.mix(docs).collect()
    assert {r["source"] for r in got} <= {"", "a", "b"} and all(r["doc_id"] is not None and r["n_tokens"] > 0 for r in got)
    assert mixing.mix(empty).count() == 0 and mixing.mix(docs.filter("text IS NULL")).count() == 0
    one = mixing.mix(docs.withColumn("source", F.lit("only")))
    assert one.groupBy("doc_id").count().filter("count <> 1").count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns


# ------------------------------------------------------------------ 7


def test_jaccard_join(spark, docs, empty, duck):
    columns = ["doc_id", "n_shingles", "component_id"]
    assert as_set(entry.queries()["op7_jaccard_join"](spark, SF).select(columns).collect()) == as_set(brute.linked(real(duck)))
    named = [r for r in brute.linked(PAIRS) if r[0] is not None]
    got = jaccard_join.jaccard_components(docs).select(columns).filter("doc_id IS NOT NULL")
    assert as_set(got.collect()) == as_set(named)
    assert jaccard_join.jaccard_components(empty).count() == 0


def test_jaccard_threshold_is_exact(spark):
    base = [f"t{i}" for i in range(39)]  # 35 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:32])), (3, " ".join(base[:30])), (4, " ".join(base + ["more"])), (5, " ".join(w.upper() for w in base))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = jaccard_join.jaccard_components(frame).select("doc_id", "n_shingles", "component_id").collect()
    assert as_set(got) == as_set(brute.linked(rows))


def test_groups_of_copies_and_a_common_passage(spark, monkeypatch):
    rng = np.random.default_rng(4)
    text = lambda n: [f"v{x}" for x in rng.integers(0, 5000, n)]
    passage, body = text(60), text(200)
    rows = [(i, " ".join(passage + text(int(rng.integers(20, 200))))) for i in range(120)]
    for i in range(120, 260):
        own = list(body)
        own[int(rng.integers(0, 200))] = f"u{i}"
        rows.append((i, " ".join(own + text(int(rng.integers(0, 12))))))
    for i in range(260, 300):
        rows.append((i, " ".join(passage + text(int(rng.integers(2, 16))))))
    monkeypatch.setattr(jaccard_join, "LEAF", 16)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = jaccard_join.jaccard_components(frame).select("doc_id", "n_shingles", "component_id").collect()
    assert as_set(got) == as_set(brute.linked(rows))


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (102, 101)]
    frame = spark.createDataFrame(edges, "u bigint, v bigint")
    got = {r[0]: r[1] for r in components.components(frame, Scratch(spark, "test"), "c").collect()}
    assert {got.get(i, i) for i in range(41)} == {0} and {got.get(i, i) for i in (100, 101, 102)} == {100}


# ------------------------------------------------------------------ 9


def test_license_scan(spark, docs, empty, duck):
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    assert as_set(entry.queries()["op9_license_scan"](spark, SF).select(columns).collect()) == as_set(brute.licensed(real(duck)))
    assert as_set(license_scan.license_scan(docs).select(columns).collect()) == as_set(brute.licensed(PAIRS))
    assert license_scan.license_scan(empty).count() == 0


def test_notices_with_changes_are_found(spark):
    notice = "This program is free software: you can redistribute it and/or modify it under the strict terms of the GNU General Public License"
    rows = [(1, "before " * 7 + notice + " after"), (2, "this program is free"), (3, "you can modify the public terms")]
    got = {r["doc_id"]: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1]["labels"] == "gpl,gpl-notice" and got[1]["base_labels"] == "gpl" and got[1]["score"] == 1.0
    span = [s for s in got[1]["spans"] if s["label"] == "gpl-notice"][0]
    assert span["low"] == 7 and span["share"] < 1
    assert got[2]["labels"] == "" and got[2]["score"] == 0 and got[3]["labels"] == ""


# ------------------------------------------------------------------ 10


def test_similar_notices_are_told_apart(spark):
    rows = [(1, "Licensed under CC BY-NC 4.0."), (2, "licensed under cc by 4.0"), (3, "This work is licensed under the GNU General Public License, version 3.")]
    got = {r["doc_id"]: r["labels"] for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: "cc-by-nc-4.0", 2: "cc-by-4.0", 3: "gpl,gpl-3.0"}


def test_kd_search_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    got: dict[int, list] = {}
    for r in entry.queries()["op10_kd_search"](spark, sf).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    asked = np.flatnonzero(ids % 20 == 0)
    assert sorted(got) == ids[asked].tolist()
    found = 0
    for q in asked:
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        own = sorted(got[ids[q]])
        assert [r for r, _, _ in own] == list(range(1, 21))
        assert [(-s, v) for _, v, s in own] == sorted((-s, v) for _, v, s in own)
        assert all(s == pytest.approx(scores[np.searchsorted(ids, v)], abs=1e-12) for _, v, s in own)
        found += len({v for _, v, _ in own} & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
    assert found / (20 * len(asked)) >= 0.9


def test_kd_search_meets_its_recall_where_boxes_are_points(monkeypatch):
    monkeypatch.setattr(kd_search, "LEAF", 1)  # nothing but the stopping test then helps a neighbour in
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(4000, 64))
    vectors /= np.sqrt((vectors**2).sum(1))[:, None]
    ids, n = np.arange(len(vectors)), 40
    row, found, _, _ = kd_search.search(ids, vectors, ids[:n], vectors[:n], np.full(n, -np.inf), 1.0, 20)
    scores = vectors[:n] @ vectors.T
    scores[ids[:n], ids[:n]] = -np.inf
    true = np.argsort(-scores, axis=1)[:, :20]
    assert sum(len({*found[row == q]} & {*true[q]}) for q in range(n)) / (20 * n) >= 0.95


def test_kd_search_of_awkward_vectors(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist(), "x") for i in range(400)]
    rows += [(1000 + i, [1.0] * 8, "x") for i in range(200)]
    rows += [(2000, None, "x"), (2020, [0.0] * 8, "x"), (2040, [float("nan")] + [1.0] * 7, "x"), (2060, [float("inf")] * 8, "x")]
    rows += [(2080, [None] + [1.0] * 7, "x"), (None, [1.0] * 8, "x"), (2100, [1.0, 2.0], "x")]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, cell string")
    monkeypatch.setattr(kd_search, "SHARD_ROWS", 64)
    monkeypatch.setattr(kd_search, "QUERY_BLOCK", 100)
    monkeypatch.setattr(kd_search, "STOP", 1.1)  # never stop early: exact
    got: dict[int, list] = {}
    for r in kd_search.nearest(frame, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    good = rows[:600]
    ids, vectors = np.array([r[0] for r in good]), np.array([r[1] for r in good])
    assert sorted(got) == [i for i in ids.tolist() if i % 20 == 0]
    for q, found in got.items():
        scores = (vectors * vectors[np.searchsorted(ids, q)]).sum(1)
        scores[ids == q] = -np.inf
        assert [v for _, v in sorted(found)] == ids[np.lexsort((ids, -scores))[:20]].tolist()


def test_few_or_no_vectors(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<double>")
    got = kd_search.nearest(frame, F.col("vec_id") == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(0, 1, 1), (0, 2, 2)]
    assert kd_search.nearest(frame.limit(0), F.col("vec_id") == 0).count() == 0
    assert kd_search.nearest(frame, F.lit(False)).count() == 0


# ------------------------------------------------------------------ shared parts and the pipeline


def test_words_as_by_regular_expression():
    texts = [(t or "").encode() for _, t in PAIRS] + [b"\x00a\x1fb", b" x"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    for split, pattern, lower in ((words.BLANKS, None, False), (words.NOT_ALNUM, brute.ALNUM, True)):
        got = words.Words(data, offsets, split, lower)
        for k, t in enumerate(texts):
            own = [bytes(got.data[a:b]) for a, b in zip(got.start[got.first[k] : got.first[k + 1]], got.end[got.first[k] : got.first[k + 1]])]
            assert own == (t.split() if pattern is None else pattern.findall(t.lower()))


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = catalog.table(spark, SF, "documents")
    scratch = Scratch(spark, "stages")
    labels = {r["doc_id"]: r["quality"] for r in catalog.table(spark, SF, "labels").collect()}
    tables = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        tables.append(scratch.write(stage(spark, tables[-1], SF), f"s{k}"))
    rows = [[tuple(r) for r in t.select("doc_id", "text").collect()] for t in tables[:-1]]
    assert all(t.columns == docs.columns for t in tables[:-1])
    kept = {i for i, _ in rows[1]}
    assert np.mean([(i in kept) == bool(q) for i, q in labels.items()]) > 0.95
    first: dict[bytes, int] = {}
    for i, t in sorted(rows[1]):
        first.setdefault(brute.BLANK.sub(b" ", t.encode()), i)
    assert {i for i, _ in rows[2]} == set(first.values())
    assert {i for i, _ in rows[3]} == {c for _, _, c in brute.linked(rows[2])}
    assert {i for i, _ in rows[4]} <= {i for i, _ in rows[3]}
    last = tables[-1].collect()
    assert len(last) == len(rows[4]) and all(r["round_trip"] for r in last)


def test_pipeline_stages_of_awkward_rows(spark, docs, monkeypatch):
    import corpus_pipeline

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    alone = [(3, "only here " * 5, "en", "b", 0), (None, "a clean text without an id " * 3, "en", "a", 0), (None, "a  clean text without an id " * 3, "en", "a", 0)]
    body = next(t for _, t in PAIRS if t and t.count(" ") == 119)
    clash = [(9, "changed " + body, "en", "a", 0), (9, "the same id, another text " * 4, "en", "b", 0)]
    table = docs.select(columns).unionByName(spark.createDataFrame(alone + clash, docs.select(columns).schema)).repartition(4)
    monkeypatch.setattr(corpus_pipeline.quality, "fit_quality", lambda *a: None)
    monkeypatch.setattr(corpus_pipeline.quality, "keep_good", lambda docs, model: docs)
    scratch, tables = Scratch(spark, "awkward_stages"), [table]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        tables.append(scratch.write(stage(spark, tables[-1], SF), f"s{k}"))
    rows = [[tuple(r) for r in t.select("doc_id", "text").collect()] for t in tables[:-1]]
    assert as_set(rows[1]) == as_set(rows[0])
    # One row a text, under the smallest id.
    order = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    first: dict[bytes, int | None] = {}
    for i, t in sorted(rows[1], key=order):
        first.setdefault(brute.BLANK.sub(b" ", (t or "").encode()), i)
    assert as_set((brute.BLANK.sub(b" ", (t or "").encode()), i) for i, t in rows[2]) == as_set(first.items())
    # One row a component, of rows under numbers of their own in the order of their ids.
    own = sorted(rows[2], key=order)
    parts = {c for _, _, c in brute.linked([(k, t) for k, (_, t) in enumerate(own)])}
    assert as_set((i, t) for i, t in rows[3]) == as_set(own[k] for k in parts)
    texts = {t for _, t in rows[3]}
    assert {alone[0][1], clash[1][1]} <= texts and any(i is None and "without" in t for i, t in rows[3] if t)
    # The rows of a source are read as often as each other, but for the last, partial reading.
    sources, read = {(r["doc_id"], r["text"]): r["source"] for r in tables[3].collect()}, as_set(rows[4])
    assert set(read) <= set(rows[3])
    for source in set(sources.values()):
        times = [read[r] for r in rows[3] if sources[r] == source and brute.words_of(r[1])]
        assert not times or max(times) - min(times) <= 1
    assert tables[-1].count() == len(rows[4])


def test_rest_works_without_this_subpackage(tmp_path):
    """On a copy without both folders and the pipeline: the entry file, and some tests of the rest."""
    root = Path(entry.__file__).parent
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", "corpus_pipeline.py"))
    code = "import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n.startswith('op') or n == 'pipeline'])"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and done.stdout.strip().endswith("[]"), done.stderr[-1000:]
    tests = ["tests/test_text.py", "tests/test_corpus.py"]
    done = subprocess.run([sys.executable, "-m", "pytest", "-q", "-x", *tests], cwd=copy, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stdout[-1000:]
