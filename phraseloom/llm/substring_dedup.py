"""4. Substring dedup by de Bruijn compaction.

The k-mers are windows of 20 words; each is an edge of the de Bruijn graph, and a text is a walk over edges. Every edge
is assigned to an anchor, the smallest hashed 8-gram in the window. Anchors depend on content only, so equal windows
have equal anchors at equal distances, and an anchor that occurs once owns no repeated window: one count by anchor hash
drops most of the text. Consecutive edges of one anchor form a path; a join with the anchor's summary tells whether all
its occurrences have the same words. If so the path does not branch and is compacted to one edge with one first
occurrence; if not it is taken apart into its single windows. Source coordinates (document, first word) then decide:
whatever is not the first occurrence of its path or window is repeated, and the words it covers are cut.

Anchors and windows are 64-bit hashes, and windows are compared only under one anchor. Counts and first occurrences are
aggregates with a map-side step; the joins that hand them back read two written tables, so adaptive execution can split
a hot anchor. Lists are gathered by document only, so they are no longer than a text.

Defined results: null and empty texts have no words and the digest of the empty string; texts under 20 words keep all;
whole texts count, however long; a row without id is neither searched nor cut; rows that share an id are one document:
their windows at the same place count as one place, and each row is cut by its own windows; an empty table gives no rows;
other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from phraseloom.llm.scratch import Scratch
from phraseloom.llm.words import BLANKS, Words, mix, text_slices

WINDOW = 20
GRAM = 8


def slide(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over every `width` consecutive values, in log(width) steps."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


class Anchors:
    """The anchor of every window of some texts. `own`: for each valid window, the index of its anchor's first word."""

    def __init__(self, words: Words, window: int = WINDOW, gram: int = GRAM):
        self.words, self.window = words, window
        n = len(words) - window + 1
        self.at = self.window_start = self.own = np.zeros(0, np.int64)
        self.gram = np.zeros(0, np.uint64)
        if n <= 0:
            return
        self.gram, _ = words.rolling(gram)
        self.gram |= np.uint64(1)
        span = window - gram + 1
        text = words.text
        valid = text[:n] == text[window - 1 :]
        least = slide(self.gram, span, np.minimum)
        self.window_start = np.flatnonzero(valid)
        # An index is an anchor if it holds the smallest gram of a window around it; a window's own is the first such.
        least = np.where(valid, least, np.uint64(0))
        most = slide(np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)]), span, np.maximum)
        self.at = np.flatnonzero((most == self.gram) & (most > 0))
        following = np.searchsorted(self.at, self.window_start)
        own = self.at[np.minimum(following, len(self.at) - 1)]
        # Anchors of other windows may stand before the smallest one; step on until the gram is the window's least.
        want = least[self.window_start]
        while len(wrong := np.flatnonzero(self.gram[own] != want)):
            following[wrong] += 1
            own[wrong] = self.at[following[wrong]]
        self.own = own


def kept_digest(text: bytes, removed: np.ndarray | None = None) -> str:
    words = text.split()
    if removed is not None:
        words = [w for w, gone in zip(words, removed.tolist()) if not gone]
    return hashlib.sha256(b" ".join(words)).hexdigest()


def anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, to, data, offsets in text_slices(batch):
            words = Words(data, offsets, BLANKS, lower=False)
            anchors = Anchors(words)
            text = words.text[anchors.at]
            ids, keys = (batch.column(c).slice(row, to - row).take(pa.array(text)) for c in ("doc_id", "row"))
            out = pa.RecordBatch.from_arrays(
                [pa.array(anchors.gram[anchors.at].view(np.int64)), ids, keys, pa.array((anchors.at - words.first[text]).astype(np.int32))],
                ["anchor", "doc_id", "row", "at"],
            )
            yield out.filter(ids.is_valid())


PATHS = "doc_id bigint, row bigint, text string, n_words bigint, kept_sha256 string, anchor bigint, content bigint, start int, n int, windows binary"


def path_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A text without repeated anchors gives its result at once; another gives its paths and a row with its text."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    names = [f.split()[0] for f in PATHS.split(", ")]

    def rows(columns: dict[str, object], n: int) -> pa.RecordBatch:
        arrays = [pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind) for name, kind in zip(names, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        ids, keys, lists = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), batch.column("ats")
        for row, to, data, offsets in text_slices(batch):
            words = Words(data, offsets, BLANKS, lower=False)
            marked = [np.asarray(lists[i].values) + words.first[i - row] if lists[i].is_valid else np.zeros(0, np.int64) for i in range(row, to)]
            hit = np.array([len(m) > 0 for m in marked])
            raw = data.tobytes()
            texts = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
            counts = words.counts
            free = np.flatnonzero(~hit)
            yield rows({"doc_id": [ids[row + i] for i in free], "n_words": counts[free], "kept_sha256": [kept_digest(texts[i]) for i in free]}, len(free))
            if len(free) == to - row:
                continue
            busy = np.flatnonzero(hit)
            own_key = {"doc_id": [ids[row + i] for i in busy], "row": [keys[row + i] for i in busy]}
            yield rows({**own_key, "n_words": counts[busy], "text": [texts[i].decode() for i in busy]}, len(busy))
            anchors = Anchors(words)
            flag = np.zeros(len(words), bool)
            flag[np.concatenate(marked)] = True
            use = flag[anchors.own]
            start, own = anchors.window_start[use], anchors.own[use]
            if not len(start):
                continue
            # Windows of one anchor stand side by side: each run is a path.
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            size = np.diff(np.append(first, len(start)))
            begin, at = start[first], own[first]
            window = mix(words.between(start, start + WINDOW)).view(np.int64)
            shape = (size + 64 * (at - begin)).astype(np.uint64)
            content = mix(mix(words.between(begin, begin + size + WINDOW - 1)) + shape).view(np.int64)
            text = words.text[begin]
            raw_windows = window.tobytes()
            yield rows(
                {
                    "doc_id": [ids[row + i] for i in text],
                    "row": [keys[row + i] for i in text],
                    "anchor": anchors.gram[at].view(np.int64),
                    "content": content,
                    "start": (begin - words.first[text]).astype(np.int32),
                    "n": size.astype(np.int32),
                    "windows": [raw_windows[8 * a : 8 * (a + n)] for a, n in zip(first, size)],
                },
                len(first),
            )


def single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.column("n").to_numpy()
        row = np.repeat(np.arange(len(n)), n)
        within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        window = np.frombuffer(b"".join(batch.column("windows").to_pylist()), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("anchor").take(pa.array(row)),
                pa.array(window),
                batch.column("doc_id").take(pa.array(row)),
                batch.column("row").take(pa.array(row)),
                pa.array((batch.column("start").to_numpy()[row] + within).astype(np.int32)),
            ],
            ["anchor", "window", "doc_id", "row", "start"],
        )


def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words = batch.column("n_words").to_pylist()
        removed, digests = [], []
        for text, n, starts, sizes in zip(batch.column("text"), n_words, batch.column("starts"), batch.column("sizes")):
            step = np.zeros(n + 1, np.int64)
            if starts.is_valid:
                a = np.asarray(starts.values)
                np.add.at(step, a, 1)
                np.add.at(step, a + np.asarray(sizes.values) + WINDOW - 1, -1)
            gone = np.cumsum(step)[:n] > 0
            removed.append(int(gone.sum()))
            digests.append(kept_digest(text.as_py().encode(), gone))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def keyed_rows(docs: DataFrame) -> DataFrame:
    """doc_id, row and text. (doc_id, row) names a row, or equal rows: `row` is a hash of the text where ids repeat."""
    again = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    row = F.lit(0).cast("bigint") if again.isEmpty() else F.xxhash64("text")
    return docs.select("doc_id", row.alias("row"), "text")


def repeated_spans(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(spans of repeated windows as doc_id, row, start, n; one row per document with its text or its finished result)."""
    texts = keyed_rows(docs)
    anchors = scratch.write(texts.mapInArrow(anchor_rows, "anchor bigint, doc_id bigint, row bigint, at int"), "anchors")
    repeated = scratch.write(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("anchor"), "repeated")
    lists = scratch.write(anchors.join(repeated, "anchor").groupBy("doc_id", "row").agg(F.collect_set("at").alias("ats")), "lists")
    scratch.drop("anchors", "repeated")
    walked = scratch.write(texts.join(lists, ["doc_id", "row"], "left").mapInArrow(path_rows, PATHS), "walked")
    scratch.drop("lists")

    paths = walked.filter("anchor IS NOT NULL").select("anchor", "content", "doc_id", "row", "start", "n", "windows")
    place = F.struct("doc_id", "start")
    summary = scratch.write(
        paths.groupBy("anchor").agg(F.min("content").alias("_low"), F.max("content").alias("_high"), F.min(place).alias("_first")), "summary"
    )
    known = paths.join(summary, "anchor")
    one = F.col("_low") == F.col("_high")
    whole = known.filter(one & (place != F.col("_first"))).select("doc_id", "row", "start", "n")
    branching = known.filter(~one).select("anchor", "doc_id", "row", "start", "n", "windows")
    single = scratch.write(branching.mapInArrow(single_windows, "anchor bigint, window bigint, doc_id bigint, row bigint, start int"), "single")
    first = scratch.write(single.groupBy("anchor", "window").agg(F.min(place).alias("_first")), "first")
    later = single.join(first, ["anchor", "window"]).filter(place != F.col("_first"))
    spans = scratch.write(whole.unionByName(later.select("doc_id", "row", "start", F.lit(1).alias("n"))), "spans")
    scratch.drop("summary", "single", "first")
    return spans, walked.filter("n_words IS NOT NULL").select("doc_id", "row", "text", "n_words", "kept_sha256")


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of docs."""
    spans, rows = repeated_spans(docs, Scratch(docs.sparkSession, "substring_dedup"))
    done = rows.filter("text IS NULL").select("doc_id", "n_words", F.lit(0).cast("bigint").alias("n_removed"), "kept_sha256")
    cuts = spans.groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "n")).alias("_cuts"))
    cuts = cuts.select("doc_id", "row", F.col("_cuts.start").alias("starts"), F.col("_cuts.n").alias("sizes"))
    open_ = rows.filter("text IS NOT NULL").select("doc_id", "row", "text", "n_words").join(cuts, ["doc_id", "row"], "left")
    return done.unionByName(open_.mapInArrow(cut_rows, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"))
