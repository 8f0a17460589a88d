"""13. Cross-tokenizer alignment: groups of two tokenizers' tokens, and how many documents hold an id pair linked.

Tokens. A byte-level BPE (A) encodes a space and the text, a SentencePiece model (B) the text; both cover the same
bytes. Offsets where tokens of both end cut the tokens into groups, and in a group every A token is linked with every B
token. Ids of A come from the rank form of the same vocabulary where a text has only characters that every Unicode
version classes alike, and from the tokenizers library otherwise.

Counting, with external runs. A task turns its documents into records (A id, B id, document, occurrences), sorts lots of
them and writes each lot as zstd runs, one per radix of the A id. A run is a directory (its pairs in A-major order and
how many of its documents hold each) and a body (those documents). Directories of a radix meet in a k-way heap merge,
which adds up the counts of a pair; as it goes by A id, an id's highest count is known when it moves on. At most FAN_IN
directories are merged at once, in as many rounds as are needed. Then the runs are read once more beside the counts of
their radix, and each streams back, for its documents, the sum of counts and the number of best links.

Records are counted inside a run before anything is merged, so an id or pair that is everywhere costs the merge one entry
a run, and the bodies of a radix are dealt over tasks by their bytes. A group of more than LINKS_AT_ONCE links is counted
by its distinct ids.

Defined results: a null or empty text, or one whose tokens do not give its bytes back (U+2581 in it), has no tokens,
zeros and an empty groups_sha256; rows count each, also where they share an id or have none; an empty table gives no
rows; other columns are not read, whatever their names. A task's memory goes with its longest text.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from phraseloom.llm.scratch import Scratch, partitions, process_cache
from phraseloom.llm.token_files import BYTE_LEVEL, PRINTABLE, lots

RUN_LINKS = 6_000_000
RUN_DOCS = 50_000
LOT_ROWS = 500
LINKS_AT_ONCE = 256
FAN_IN = 64
LEAST_RADIXES = 16
DEAL_BYTES = 8 << 20
RANK_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Blocks assigned and classed alike since long before any of the libraries.
SETTLED = re.compile("[\x00-ɏΑ-ΡΣ-ώЀ-ҁ‐-‧‰-⁞€ぁ-ゖァ-ヺ一-龥가-힣]*")

RUNS = "part int, run int, radix int, directory binary, body binary"
COUNTS = "radix int, lot int, directory binary"
SHARES = "part int, run int, shares binary"
DOCUMENTS = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
HEAD = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids below `size` in decimal, as rows of bytes with room for a separator after them, and their lengths."""
    text = np.char.mod("%d", np.arange(size)).astype(f"S{len(str(size)) + 1}")
    return text.view(np.uint8).reshape(size, -1), np.char.str_len(text).astype(np.int64)


class Pair:
    """Both tokenizers, the bytes of their tokens and their ids in decimal."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path_a)
        self.library.encode_special_tokens = True
        byte_of = {chr(b): b for b in PRINTABLE} | {chr(c): b for b, c in BYTE_LEVEL.items()}
        added = {t.content for t in self.library.get_added_tokens_decoder().values()}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in self.library.get_vocab().items() if t not in added}
        self.ranks = tiktoken.Encoding("a", pat_str=RANK_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.size_a, self.size_b = self.library.get_vocab_size(), self.pieces.get_piece_size()
        self.bytes_a = [b""] * self.size_a
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.bytes_b = []
        for i in range(self.size_b):
            piece = self.pieces.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[1:-1], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode())
        self.length_a, self.length_b = (np.array([len(t) for t in table]) for table in (self.bytes_a, self.bytes_b))
        self.digits_a, self.digits_b = _digits(self.size_a), _digits(self.size_b)
        self.bits_b = (self.size_b - 1).bit_length()
        self.bits_doc = 64 - self.bits_b - (self.size_a - 1).bit_length()
        if 1 << self.bits_doc < RUN_DOCS:
            raise ValueError("vocabularies too large for a record of 64 bits")

    def encode(self, text: str) -> tuple[np.ndarray, list[int]] | None:
        """Ids of a space and the text by A and of the text by B; None if either does not give the bytes back."""
        if not text:
            return None
        spaced = " " + text
        if SETTLED.fullmatch(text):
            a = self.ranks.encode_to_numpy(spaced, disallowed_special=())
        else:
            a = np.array(self.library.encode(spaced, add_special_tokens=False).ids, np.uint32)
        b = self.pieces.encode(text)
        data = spaced.encode()
        whole = b"".join(map(self.bytes_a.__getitem__, a.tolist())) == data and b"".join(map(self.bytes_b.__getitem__, b)) == data
        return (a, b) if whole else None


def tokenizer_pair(path_a: str, path_b: str) -> Pair:
    cache = process_cache()
    if ("pair", path_a, path_b) not in cache:
        cache[("pair", path_a, path_b)] = Pair(path_a, path_b)
    return cache[("pair", path_a, path_b)]


def _before(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


class Lot:
    """Tokens of some texts side by side, and their groups. `hit_a`, `hit_b`: tokens that end a group."""

    def __init__(self, pair: Pair, texts: list[str]):
        self.pair = pair
        coded = [pair.encode(t) for t in texts]
        self.n_a = np.array([len(c[0]) if c else 0 for c in coded])
        self.n_b = np.array([len(c[1]) if c else 0 for c in coded])
        self.a = np.concatenate([c[0] for c in coded if c] or [np.zeros(0)]).astype(np.int64)
        self.b = np.fromiter((i for c in coded if c for i in c[1]), np.int64, int(self.n_b.sum()))
        ends_a, ends_b = np.cumsum(pair.length_a[self.a]), np.cumsum(pair.length_b[self.b])
        at = np.searchsorted(ends_b, ends_a)
        self.hit_a = ends_b[at] == ends_a if len(at) else np.zeros(0, bool)
        self.hit_b = np.zeros(len(self.b), bool)
        self.hit_b[at[self.hit_a]] = True
        self.group_a, self.group_b = _before(self.hit_a.astype(np.int64)), _before(self.hit_b.astype(np.int64))
        groups = int(self.hit_a.sum())
        self.in_a, self.in_b = np.bincount(self.group_a, minlength=groups), np.bincount(self.group_b, minlength=groups)
        self.doc_a = np.repeat(np.arange(len(texts)), self.n_a)
        self.doc = self.doc_a[self.hit_a]
        self.links = self.in_a * self.in_b
        self.n_groups = np.bincount(self.doc, minlength=len(texts))
        self.n_links = np.zeros(len(texts), np.int64)
        np.add.at(self.n_links, self.doc, self.links)

    def digests(self) -> list[str]:
        """SHA-256 of every text's groups, `a1,a2|b1;a3|b2,b3`; empty without tokens."""
        (rows_a, size_a), (rows_b, size_b) = self.pair.digits_a, self.pair.digits_b
        width = max(rows_a.shape[1], rows_b.shape[1])
        at_a = np.arange(len(self.a)) + _before(self.in_b)[self.group_a]
        at_b = np.arange(len(self.b)) + np.cumsum(self.in_a)[self.group_b]
        out = np.zeros((len(self.a) + len(self.b), width), np.uint8)
        out[at_a, : rows_a.shape[1]] = rows_a[self.a]
        out[at_b, : rows_b.shape[1]] = rows_b[self.b]
        out[at_a, size_a[self.a]] = np.where(self.hit_a, ord("|"), ord(","))
        out[at_b, size_b[self.b]] = np.where(self.hit_b, ord(";"), ord(","))
        lengths = np.zeros(len(self.n_a), np.int64)
        np.add.at(lengths, self.doc_a, size_a[self.a] + 1)
        np.add.at(lengths, np.repeat(np.arange(len(self.n_b)), self.n_b), size_b[self.b] + 1)
        flat = memoryview(out.reshape(-1)[out.reshape(-1) != 0])
        to = np.cumsum(lengths)
        return [hashlib.sha256(flat[t - n : t - 1]).hexdigest() if n else "" for n, t in zip(lengths.tolist(), to.tolist())]

    def records(self, first_doc: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(A id, B id, document from first_doc) in 64 bits, and how often, of all links; records may repeat."""
        low, high = np.uint64(self.pair.bits_doc), np.uint64(self.pair.bits_doc + self.pair.bits_b)
        start_a, start_b = _before(self.in_a), _before(self.in_b)
        few = np.where(self.links <= LINKS_AT_ONCE, self.in_b, 0)[self.group_a]
        i = np.repeat(np.arange(len(self.a)), few)
        j = start_b[self.group_a[i]] + np.arange(len(i)) - np.repeat(_before(few), few)
        keys = self.a[i].astype(np.uint64) << high | self.b[j].astype(np.uint64) << low | (first_doc + self.doc_a[i]).astype(np.uint64)
        yield keys, np.ones(len(keys), np.int64)
        for g in np.flatnonzero(self.links > LINKS_AT_ONCE).tolist():
            a, many_a = np.unique(self.a[start_a[g] : start_a[g] + self.in_a[g]], return_counts=True)
            b, many_b = np.unique(self.b[start_b[g] : start_b[g] + self.in_b[g]], return_counts=True)
            keys = (a.astype(np.uint64) << high)[:, None] | (b.astype(np.uint64) << low)[None, :] | np.uint64(first_doc + self.doc[g])
            yield keys.ravel(), (many_a[:, None] * many_b[None, :]).ravel()


def squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as one zstd frame, byte planes of 32- or 64-bit integers one after the other."""
    planes = b"".join(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes() for x in arrays)
    return zstandard.ZstdCompressor(level=1).compress(len(arrays[0]).to_bytes(8, "little") + planes)


def unsqueezed(frame: bytes, *kinds: str) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), np.uint8)
    n, at, out = int.from_bytes(data[:8].tobytes(), "little"), 8, []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(data[at : at + n * size].reshape(size, n).T).view(kind).reshape(n))
        at += n * size
    return out


def delta(sorted_: np.ndarray) -> np.ndarray:
    return np.diff(sorted_, prepend=sorted_[:0].dtype.type(0))


class Runs:
    """Records of one task, written out as runs whenever RUN_LINKS or RUN_DOCS of them are held."""

    def __init__(self, pair: Pair, part: int, radixes: int):
        self.pair, self.part, self.radixes, self.run = pair, part, radixes, 0
        self._empty()

    def _empty(self) -> None:
        self.keys, self.many, self.held, self.heads, self.docs = [], [], 0, [], 0

    def add(self, ids: pa.Array, lot: Lot) -> None:
        for keys, many in lot.records(self.docs):
            self.keys.append(keys)
            self.many.append(many)
            self.held += len(keys)
        columns = [ids, *(pa.array(x.astype(np.int64)) for x in (lot.n_a, lot.n_b, lot.n_groups, lot.n_links)), pa.array(lot.digests(), pa.string())]
        self.heads.append(pa.RecordBatch.from_arrays(columns, HEAD))
        self.docs += len(ids)

    def full(self) -> bool:
        return self.held >= RUN_LINKS or self.docs >= RUN_DOCS

    def flush(self) -> Iterator[pa.RecordBatch]:
        """A row with the documents (radix -1), and one per radix that has records."""
        if not self.docs:
            return
        with pa.BufferOutputStream() as sink:
            with pa.ipc.new_stream(sink, self.heads[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for head in self.heads:
                    out.write_batch(head)
            heads = sink.getvalue().to_pybytes()
        rows = [(self.part, self.run, -1, None, heads)]
        keys, many = np.concatenate(self.keys), np.concatenate(self.many)
        if (many == 1).all():
            keys, many = np.unique(keys, return_counts=True)
        else:
            keys, place = np.unique(keys, return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, place, many)
            many = total
        doc_bits = np.uint64(self.pair.bits_doc)
        radix = (keys >> (doc_bits + np.uint64(self.pair.bits_b))) % np.uint64(self.radixes)
        for r in np.unique(radix).tolist():
            own = radix == r
            pairs, times = keys[own] >> doc_bits, many[own]
            docs = (keys[own] & np.uint64((1 << self.pair.bits_doc) - 1)).astype(np.uint32)
            first = np.flatnonzero(np.diff(pairs, prepend=pairs[:1] + np.uint64(1)))
            counts = np.diff(first, append=len(pairs))
            step = delta(docs)  # modulo 2**32, where a new pair begins too
            rows.append((self.part, self.run, r, squeezed(delta(pairs[first]), counts), squeezed(step, times)))
        self.run += 1
        self._empty()
        kinds = [pa.int32()] * 3 + [pa.binary()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in RUNS.split(", ")])


def write_runs(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, radixes: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    pair = tokenizer_pair(path_a, path_b)
    runs = Runs(pair, TaskContext.get().partitionId(), radixes)
    for batch in batches:
        for k in range(0, len(batch), LOT_ROWS):
            part = batch.slice(k, LOT_ROWS)
            row = 0
            for texts in lots([t or "" for t in part.column("text").to_pylist()]):
                runs.add(part.column("doc_id").slice(row, len(texts)), Lot(pair, texts))
                row += len(texts)
                if runs.full():
                    yield from runs.flush()
    yield from runs.flush()


def heap_merge(directories: list[bytes], bits_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs in order, the sum of their counts, and the highest count of any pair with the same A id."""
    sides = []
    for frame in directories:
        steps, counts = unsqueezed(frame, "<u8", "<i8")
        sides.append((np.cumsum(steps, dtype=np.uint64), counts))
    cuts, heap = [], []
    for k, (pairs, _) in enumerate(sides):
        a = pairs >> np.uint64(bits_b)
        cut = np.flatnonzero(np.diff(a, prepend=a[:1] + np.uint64(1), append=a[-1:] + np.uint64(1)))
        cuts.append((cut.tolist(), a[cut[:-1]].tolist()))
        heap.append((cuts[k][1][0], k, 0))
    heapq.heapify(heap)
    out_pairs, out_counts, out_best = [], [], []
    while heap:
        a, pairs, counts = heap[0][0], [], []
        while heap and heap[0][0] == a:
            _, k, i = heap[0]
            x, y = cuts[k][0][i], cuts[k][0][i + 1]
            pairs.append(sides[k][0][x:y])
            counts.append(sides[k][1][x:y])
            if i + 1 < len(cuts[k][1]):
                heapq.heapreplace(heap, (cuts[k][1][i + 1], k, i + 1))
            else:
                heapq.heappop(heap)
        if len(pairs) == 1:
            merged, total = pairs[0], counts[0]
        else:
            merged, place = np.unique(np.concatenate(pairs), return_inverse=True)
            total = np.zeros(len(merged), np.int64)
            np.add.at(total, place, np.concatenate(counts))
        out_pairs.append(merged)
        out_counts.append(total)
        out_best.append(np.full(len(merged), total.max()))
    return np.concatenate(out_pairs), np.concatenate(out_counts), np.concatenate(out_best)


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Neighbouring rows with equal keys, one row at a time."""
    def rows() -> Iterator[dict]:
        for batch in batches:
            for k in range(len(batch)):
                yield batch.slice(k, 1).to_pylist()[0]

    return itertools.groupby(rows(), key=lambda row: tuple(row[k] for k in keys))


def merge_directories(batches: Iterator[pa.RecordBatch], bits_b: int) -> Iterator[pa.RecordBatch]:
    """One directory per (radix, lot): pairs, counts and the highest count of the A id."""
    for (radix, lot), rows in runs_of(batches, ["radix", "lot"]):
        pairs, counts, best = heap_merge([row["directory"] for row in rows], bits_b)
        merged = squeezed(delta(pairs), counts, best)
        yield pa.RecordBatch.from_arrays([pa.array([radix], pa.int32()), pa.array([lot], pa.int32()), pa.array([merged], pa.binary())], ["radix", "lot", "directory"])


def give_back(batches: Iterator[pa.RecordBatch], bits_b: int) -> Iterator[pa.RecordBatch]:
    """For every run beside the counts of its radix, what its documents get. The counts are the first row of a group."""
    for _, rows in runs_of(batches, ["radix", "salt"]):
        every = None
        for row in rows:
            if row["body"] is None:
                steps, total, best = unsqueezed(row["directory"], "<u8", "<i8", "<i8")
                every = np.cumsum(steps, dtype=np.uint64)
                continue
            steps, counts = unsqueezed(row["directory"], "<u8", "<i8")
            at = np.searchsorted(every, np.cumsum(steps, dtype=np.uint64))
            docs, times = unsqueezed(row["body"], "<u4", "<i8")
            docs = np.cumsum(docs, dtype=np.uint32)
            sums, hits = np.zeros(int(docs.max()) + 1, np.int64), np.zeros(int(docs.max()) + 1, np.int64)
            np.add.at(sums, docs, np.repeat(total[at], counts) * times)
            np.add.at(hits, docs, np.repeat(total[at] == best[at], counts) * times)
            columns = [pa.array([row["part"]], pa.int32()), pa.array([row["run"]], pa.int32()), pa.array([squeezed(sums, hits)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "run", "shares"])


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of a run with the sums of what they got. The documents are the first row of a group."""
    names = [f.split()[0] for f in DOCUMENTS.split(", ")]
    for _, rows in runs_of(batches, ["part", "run"]):
        head = sums = hits = None
        for row in rows:
            if head is None:
                head = pa.ipc.open_stream(row["heads"]).read_all()
                sums, hits = np.zeros(len(head), np.int64), np.zeros(len(head), np.int64)
                continue
            more, best = unsqueezed(row["shares"], "<i8", "<i8")
            sums[: len(more)] += more
            hits[: len(best)] += best
        out = head.append_column("n_best", pa.array(hits)).append_column("count_sum", pa.array(sums)).select(names)
        yield from out.to_batches(max_chunksize=10_000)


def pair_counts(counts: DataFrame, bits_b: int) -> DataFrame:
    """id_a, id_b, n_docs and is_best of all linked pairs, from the counts that `align` has written."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs_of(batches, ["radix", "lot"]):
            for row in rows:
                steps, total, best = unsqueezed(row["directory"], "<u8", "<i8", "<i8")
                pair = np.cumsum(steps, dtype=np.uint64)
                a, b = (pair >> np.uint64(bits_b)).astype(np.int64), (pair & np.uint64((1 << bits_b) - 1)).astype(np.int64)
                whole = pa.Table.from_arrays([pa.array(a), pa.array(b), pa.array(total), pa.array(total == best)], ["id_a", "id_b", "n_docs", "is_best"])
                yield from whole.to_batches(max_chunksize=10_000)

    return counts.mapInArrow(pairs, "id_a bigint, id_b bigint, n_docs bigint, is_best boolean")


def align(docs: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """(DOCUMENTS of every row of docs, id_a, id_b, n_docs, is_best of every linked pair)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "token_alignment")
    parts = partitions(spark)
    radixes = max(LEAST_RADIXES, parts)
    bits_b = tokenizer_pair(path_a, path_b).bits_b
    runs = scratch.write(docs.select("doc_id", "text").mapInArrow(lambda batches: write_runs(batches, path_a, path_b, radixes), RUNS), "runs")

    sized = runs.filter("radix >= 0").groupBy("radix").agg(F.count(F.lit(1)).alias("_runs"), F.sum(F.octet_length("body")).alias("_bytes"))
    sized = scratch.write(sized, "sizes")
    most = sized.agg(F.max("_runs")).first()[0] or 0
    counts = runs.filter("radix >= 0").select("radix", F.xxhash64("part", "run").alias("_h"), "directory")
    for round_ in range(64):
        lots_ = -(-most // FAN_IN)
        dealt = counts.select("radix", F.pmod("_h", F.lit(max(1, lots_))).cast("int").alias("lot"), "directory")
        dealt = dealt.repartition(parts, "radix", "lot").sortWithinPartitions("radix", "lot")
        counts = scratch.write(dealt.mapInArrow(lambda batches: merge_directories(batches, bits_b), COUNTS), f"counts{round_}")
        if lots_ <= 1:
            break
        most, counts = lots_, counts.select("radix", F.xxhash64("lot").alias("_h"), "directory")

    # Bodies of a radix are dealt over as many tasks as their bytes ask for; each gets the counts of the radix.
    sized = sized.select("radix", F.ceil(F.col("_bytes") / DEAL_BYTES).cast("int").alias("_salts"))
    bodies = runs.filter("radix >= 0").join(sized, "radix")
    bodies = bodies.select("radix", F.pmod(F.xxhash64("part", "run"), F.col("_salts")).cast("int").alias("salt"), "part", "run", "directory", "body")
    nothing = F.lit(None)
    beside = counts.join(sized, "radix").select(
        "radix", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("salt"), nothing.cast("int").alias("part"), nothing.cast("int").alias("run"), "directory", nothing.cast("binary").alias("body")
    )
    both = beside.unionByName(bodies).repartition(parts, "radix", "salt").sortWithinPartitions("radix", "salt", F.col("part").asc_nulls_first())
    shares = both.mapInArrow(lambda batches: give_back(batches, bits_b), SHARES)
    heads = runs.filter("radix < 0").select("part", "run", F.col("body").alias("heads"), nothing.cast("binary").alias("shares"))
    every = heads.unionByName(shares.select("part", "run", nothing.cast("binary").alias("heads"), "shares"))
    every = every.repartition(parts, "part", "run").sortWithinPartitions("part", "run", F.col("shares").isNotNull())
    return every.mapInArrow(add_up, DOCUMENTS), pair_counts(counts, bits_b)
