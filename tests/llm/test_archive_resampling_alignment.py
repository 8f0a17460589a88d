"""Operators 11 to 13 against plain versions, awkward tables and the libraries."""

from __future__ import annotations

import gzip
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from brute import ALNUM, CLASHES, SCHEMA, awkward
from phraseloom.llm import resampling, token_alignment, web_archive
from phraseloom.llm.catalog import tokenizer_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPECIAL = ["<|endoftext|>", "<|ENDOFTEXT|>", "<s>", "</s>", "<unk>", "<0x41>", "▁", "�", "\x00", "\x85", " ", " ", "👩‍👩‍👧", "ﬁ", "é", "अनुच्छेद", "ภาษา", "العربية", "日本語", "한국어", "Ωμέγα", "'ll", "\r\n", "\t\t", "   ", "𝔘", "ᏣᎳᎩ", "1234567", "²½Ⅷ"]


def fuzz(n: int, seed: int = 5) -> list[str]:
    rng = random.Random(seed)
    parts = SPECIAL + ["the", " of", "ing", "Haus", "über", "niño", ".", ",", "!", " ", "\n"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(n)]
    chars = ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x250, 0xD800), rng.randrange(0x10000, 0x1F700)])) for _ in range(12)) for _ in range(n // 2)]
    return made + chars


def test_ranks_give_the_library_ids():
    pair = token_alignment.tokenizer_pair(tokenizer_path(A), tokenizer_path(B))
    for text in fuzz(3000):
        if token_alignment.SETTLED.fullmatch(text):
            assert pair.ranks.encode(" " + text, disallowed_special=()) == pair.library.encode(" " + text, add_special_tokens=False).ids


def aligned(rows: list[tuple]) -> list[tuple]:
    """The contract of operator 13, with sets and loops."""
    from tokenizers import Tokenizer
    from sentencepiece import SentencePieceProcessor

    a, b = Tokenizer.from_file(tokenizer_path(A)), SentencePieceProcessor(model_file=tokenizer_path(B))
    a.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(c): c for c in printable} | {chr(256 + k): c for k, c in enumerate(sorted(set(range(256)) - set(printable)))}
    docs, holders = [], defaultdict(set)
    for row, (doc_id, text) in enumerate(rows):
        groups: list[tuple[list[int], list[int]]] = []
        enc = a.encode(" " + (text or ""), add_special_tokens=False)
        ids_b = b.encode(text or "")
        bytes_a = [bytes(byte[c] for c in t) for t in enc.tokens]
        pieces = [b.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(p[1:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
        data = (" " + (text or "")).encode()
        if text and b"".join(bytes_a) == data and b"".join(bytes_b) == data:
            ends_a, ends_b = np.cumsum([*map(len, bytes_a)]).tolist(), np.cumsum([*map(len, bytes_b)]).tolist()
            for cut in sorted(set(ends_a) & set(ends_b)):
                done_a, done_b = sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups)
                groups.append((enc.ids[done_a : ends_a.index(cut) + 1], ids_b[done_b : ends_b.index(cut) + 1]))
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        for link in links:
            holders[link].add(row)
        docs.append((doc_id, groups, links))
    best: dict[int, int] = defaultdict(int)
    for (x, _), who in holders.items():
        best[x] = max(best[x], len(who))
    out = []
    for doc_id, groups, links in docs:
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        counts = [len(holders[link]) for link in links]
        n_best = sum(n == best[link[0]] for link, n in zip(links, counts))
        sizes = sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links)
        out.append((doc_id, *sizes, n_best, sum(counts), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def key(row) -> tuple:
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("small", [False, True])
def test_alignment(spark, monkeypatch, small):
    if small:  # many runs, several merge rounds, dealt bodies, groups counted by distinct ids
        for name, value in [("RUN_LINKS", 300), ("FAN_IN", 2), ("DEAL_BYTES", 500), ("LINKS_AT_ONCE", 2), ("LOT_ROWS", 3)]:
            monkeypatch.setattr(token_alignment, name, value)
    rows = [r[:2] for r in awkward() if r[1] is None or len(r[1]) < 20_000]
    rows += [(1000 + i, t) for i, t in enumerate(fuzz(40 if small else 300))] + [(5000, "ab" * 4000), (5001, "あก" * 700)]
    docs = spark.createDataFrame([(*r, *["x"] * (3 + len(CLASHES) - 1), 0)[:2] for r in rows], "doc_id bigint, text string").repartition(3)
    docs = docs.selectExpr("doc_id", "text", *[f"'c' AS `{c}`" for c in ("part", "run", "radix", "row", "salt")])
    out, pairs = token_alignment.align(docs, tokenizer_path(A), tokenizer_path(B))
    got = [tuple(r) for r in out.select(COLUMNS).collect()]
    want = aligned(rows)
    assert sorted(got, key=key) == sorted(want, key=key)
    top = pairs.filter("is_best").groupBy("id_a").count().count()
    assert top == pairs.select("id_a").distinct().count() and pairs.filter("n_docs < 1").isEmpty()


def test_alignment_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    out, pairs = token_alignment.align(empty, tokenizer_path(A), tokenizer_path(B))
    assert out.columns == COLUMNS and out.isEmpty() and pairs.isEmpty()
    blank = spark.createDataFrame([(1, None), (None, "")], "doc_id bigint, text string")
    assert sorted(map(tuple, token_alignment.align(blank, tokenizer_path(A), tokenizer_path(B))[0].collect()), key=key) == [(1, *[0] * 6, ""), (None, *[0] * 6, "")]


def resampled(rows: list[tuple], target: list[str | None], longest: int = 1, percent: int = 10) -> dict:
    def features(text: str | None) -> Counter:
        w = ALNUM.findall("".join(c.lower() if c.isascii() else c for c in text or "").encode())
        return Counter(zlib.crc32(b" ".join(w[k : k + n])) % 10000 for n in range(1, longest + 1) for k in range(len(w) - n + 1))

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000)))) for b in range(10000)]
    out = []
    for doc_id, text in rows:
        f = features(text)
        weight = sum(gain[b] * n for b, n in f.items()) // f.total() if f else 0
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        words = len(ALNUM.findall((text or "").lower().encode())) if text is None or text.isascii() else len(ALNUM.findall(text.encode()))
        out.append([doc_id, f.total(), weight, score, words])
    able = sorted((r for r in out if r[4] >= 20 and r[0] is not None), key=lambda r: (-r[3], r[0]))
    drawn = able[: percent * len(able) // 100]
    return out, [(r[0], r[3]) for r in drawn]


@pytest.mark.parametrize(("longest", "piece"), [(1, 1 << 20), (3, 1 << 20), (3, 50)])
def test_resampling(spark, monkeypatch, longest, piece):
    monkeypatch.setattr(resampling, "PIECE_BYTES", piece)
    rows = [r[:2] for r in awkward()] + [(900 + i, f"alpha beta {i} " + "gamma Delta " * (8 + i % 7)) for i in range(80)]
    target = ["Gamma delta alpha", None, "w1 w2 w3", "delta  gamma-delta"]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).selectExpr("*", "'x' AS row", "'y' AS score", "'z' AS bucket")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = [tuple(r) for r in resampling.resample(docs, goal, longest=longest).collect()]
    want, drawn = resampled(rows, target, longest)
    assert sorted((r[:4] for r in got), key=key) == sorted((tuple(r[:4]) for r in want), key=key)
    ranked = sorted((r for r in got if r[4] is not None), key=lambda r: r[4])
    assert [r[4] for r in ranked] == list(range(1, len(drawn) + 1)) and [(r[0], r[3]) for r in ranked] == drawn


def test_resampling_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert resampling.resample(empty, empty).isEmpty()
    one = spark.createDataFrame([(1, "a " * 40)], "doc_id bigint, text string")
    assert resampling.resample(one, empty, percent=100).first()["rank"] == 1


def pages(spark):
    shared, near = "<p>" + "copy " * 40, "x" * 99
    rows = [(5, "http://a/1", shared), (2, "http://a/2", shared), (9, None, shared), (None, "u", shared), (2, "http://again", shared)]
    rows += [(20, "http://b\r\nX-Page-ID: 7", near), (21, "http://b", near), (22, "c", None), (23, "c", ""), (24, "ü", "Grüße " * 30), (25, "d", "\r\n\r\n" * 40 + "WARC/1.1\r\n")]
    rows += [(100 + i, "hot", "hot " * 50) for i in range(60)] + [(400, "long", "abc" * 400_000)]
    return rows, spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3).selectExpr("*", "'x' AS digest", "'y' AS size", "1 AS row")


def test_archive_of_pages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(web_archive, "COPIES_A_TASK", 7)
    rows, table = pages(spark)
    web_archive.archive_pages(table, str(tmp_path / "a"))
    got = [tuple(r) for r in web_archive.archived_pages(spark, str(tmp_path / "a")).collect()]
    least: dict[bytes, int] = {}
    for i, _, h in rows:
        data = (h or "").encode()
        if i is not None:
            least[data] = min(i, least.get(data, i))
    assert len(got) == len(rows)
    assert sorted((r[0] is None, r[0], r[1], r[2]) for r in got if r[0] is not None) == sorted((False, i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in rows if i is not None)
    by_digest = defaultdict(list)
    for r in got:
        by_digest[r[2]].append(r)
    for data, first in least.items():
        own = by_digest[hashlib.sha256(data).hexdigest()]
        if len(data) < 100:
            assert all(r[3:] == ("response", None) for r in own)
        else:
            assert [r[0] for r in own if r[3] == "response"] == [first]
            assert all(r[4] == first for r in own if r[3] == "revisit")
    stored = spark.read.parquet(str(tmp_path / "a" / "payloads"))
    assert stored.count() == len({(h or "") for _, _, h in rows})
    # As bytes, the archive is a WARC file: taken in again, it gives the same bytes.
    records = web_archive.record_bytes(spark, str(tmp_path / "a")).orderBy("place").collect()
    whole = b"".join(bytes(r["record"]) for r in records)
    assert len(list(web_archive.split_records(whole))) == len(rows)


def test_archive_of_files(spark, tmp_path):
    _, table = pages(spark)
    web_archive.archive_pages(table, str(tmp_path / "a"))
    records = [bytes(r["record"]) for r in web_archive.record_bytes(spark, str(tmp_path / "a")).orderBy("place").collect()]
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.warc").write_bytes(b"".join(records[:40]) + info + info)
    (tmp_path / "in" / "two.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records[40:]))
    web_archive.archive_files(spark, str(tmp_path / "in" / "*"), str(tmp_path / "b"))
    back = web_archive.record_bytes(spark, str(tmp_path / "b")).orderBy("file", "place").collect()
    one = b"".join(bytes(r["record"]) for r in back if r["file"].endswith("one.warc"))
    two = b"".join(bytes(r["record"]) for r in back if r["file"].endswith(".gz"))
    assert one == b"".join(records[:40]) + info + info and two == b"".join(records[40:])
    zipped = web_archive.record_bytes(spark, str(tmp_path / "b"), gzipped=True).filter("file LIKE '%one.warc'").orderBy("place").collect()
    assert gzip.decompress(b"".join(bytes(r["record"]) for r in zipped)) == one


def test_archive_refuses_wrong_payloads(spark, tmp_path):
    _, table = pages(spark)
    web_archive.archive_pages(table.limit(4), str(tmp_path / "a"))
    spark.read.parquet(str(tmp_path / "a" / "payloads")).selectExpr("digest", "CAST('other' AS BINARY) AS payload", "copies").write.parquet(str(tmp_path / "c" / "payloads"))
    spark.read.parquet(str(tmp_path / "a" / "records")).write.parquet(str(tmp_path / "c" / "records"))
    with pytest.raises(Exception, match="another digest"):
        web_archive.archived_pages(spark, str(tmp_path / "c")).collect()
    with pytest.raises(ValueError, match="cut off"):
        list(web_archive.split_records(b"WARC/1.0\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))


def test_archive_of_nothing(spark, tmp_path):
    web_archive.archive_pages(spark.createDataFrame([], "page_id bigint, url string, html string"), str(tmp_path / "a"))
    assert web_archive.archived_pages(spark, str(tmp_path / "a")).isEmpty()


def test_shared_sizes(monkeypatch):
    from phraseloom.llm import jaccard_join

    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 80, rng.integers(1, 60)).astype(np.uint64)) for _ in range(17)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    for size in (7, 23, 1 << 16):
        monkeypatch.setattr(jaccard_join, "ELEMENTS_AT_ONCE", size)
        got = jaccard_join.shared_sizes(sets)
        assert all(got[i, j] == want[i][j] for i in range(17) for j in range(17) if i != j)


def test_group_with_a_common_body_that_does_not_link(spark, monkeypatch):
    """Similarity about 0.65 within the group: a bounded number of rows per class, and few links."""
    from brute import linked
    from phraseloom.llm import jaccard_join
    from phraseloom.llm.scratch import Scratch

    rng = np.random.default_rng(8)
    text = lambda n: [f"v{x}" for x in rng.integers(0, 50_000, n)]
    body = text(150)
    named = []
    real = Scratch.write

    def write(self, df, name):
        out = real(self, df, name)
        if name == "named":
            named.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "write", write)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 10**9)  # as if the sample had not met the body
    counts = []
    for group in (75, 150, 300):
        rows = [(i, " ".join(body + text(36))) for i in range(group)] + [(10_000 + i, " ".join(body + text(36))) for i in range(2)]
        rows += [(20_000, rows[0][1] + " more"), (20_001, rows[1][1] + " words here")]
        named.clear()
        frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
        got = jaccard_join.jaccard_components(frame).select("doc_id", "n_shingles", "component_id").collect()
        assert sorted(map(tuple, got)) == sorted(linked(rows))
        counts.append(named[0])
    # A leaf holds up to 256 classes. A class is named once for each of a few sets of classes that keys hold, not per pair.
    assert counts[0] <= 10 * 79 and counts[1] <= 2.6 * counts[0] and counts[2] <= 8 * counts[0]


# ------------------------------------------------------------------ scales, repeated ids and special marks


@pytest.mark.parametrize("scale", [1e-6, 1e6, 1e-150, 1e150])
def test_kd_search_at_any_scale(spark, scale):
    from pyspark.sql import functions as F

    from phraseloom.llm import kd_search

    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(900, 16)) * scale
    vectors[:5] *= 1e-9  # short queries beside long vectors
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    got: dict[int, list] = {}
    for r in kd_search.nearest(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    found = 0
    unit = vectors / scale
    for q in range(0, 900, 20):
        scores = unit @ unit[q]
        scores[q] = -np.inf
        found += len({v for v, _ in got[q]} & set(np.argsort(-scores)[:20].tolist()))
        with np.errstate(over="ignore", under="ignore"):
            want = [float((vectors[q] * vectors[v]).sum()) for v, _ in got[q]]
        assert [s for _, s in got[q]] == pytest.approx(want, rel=1e-12, abs=0)
    assert found >= 0.95 * 20 * 45


def test_queries_that_share_an_id_have_lists_of_their_own(spark):
    from pyspark.sql import functions as F

    from phraseloom.llm import kd_search

    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.9, 0.1]), (2, [0.1, 0.9])]
    got = kd_search.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") == 0, k=2).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(0, 1, 1), (0, 1, 2), (0, 2, 1), (0, 2, 2)]


def test_substring_dedup_where_one_id_has_several_texts(spark):
    from brute import cut
    from phraseloom.llm import substring_dedup

    w = lambda letter, n: " ".join(f"{letter}{i}" for i in range(n))
    rows = [(1, w("w", 60)), (2, w("w", 60)), (2, "short one"), (2, w("z", 70)), (2, w("w", 60)), (3, w("z", 40)), (4, None), (4, w("z", 30))]
    for part in (rows, rows[:3], [rows[0], rows[1], rows[3]]):
        got = substring_dedup.substring_dedup(spark.createDataFrame(part, "doc_id bigint, text string")).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
        assert sorted(map(tuple, got)) == sorted(cut(part))


def test_special_marks_in_any_case_are_the_library_s():
    from tokenizers import Tokenizer

    from phraseloom.llm import token_files

    path = tokenizer_path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), token_files.encoder(path)
    rng = random.Random(9)
    parts = ["<|ENDOFTEXT|>", "<|endoftext|>", "<|StartOfText|>", "<|startoftext|>", "<|", "|>", "ENDOFTEXT", "word", "Word", " ", "\n", "é", "É", "K", "ſ", ".", "x" * 300]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(5000)]
    for start in range(0, 5000, 500):
        got = own.encode_many(texts[start : start + 500])
        want = library.encode_batch(texts[start : start + 500], add_special_tokens=False)
        assert [np.frombuffer(g, own.width).tolist() for g in got] == [e.ids for e in want]
    assert max(map(len, own.memo)) <= token_files.MEMO_CHARS
