"""1. Token-ID output: packs of token ids, every document compressed on its own with one shared dictionary.

A dataset is a Parquet folder of packs. A pack holds the zstandard frames of some documents, one after the other, and
an index of (doc_id, offset of the frame, number of ids). All frames use a dictionary trained on serialised id arrays
of a bounded sample of documents; its bytes are stored once beside the packs, and its SHA-256 in every pack, so a
reader refuses packs of another dictionary. A short document is read by its pack's id range and its offset alone.

Defined results: a null or empty text has the end id only; documents stand in ascending doc_id order, null ids first;
rows that share an id each get an entry, in an order that is not defined; long texts make long frames and packs of
one document; an empty table makes a dataset without packs; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator

from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from phraseloom.llm.scratch import Scratch, partitions, process_cache

DICT_DOCUMENTS = 512
DICT_PIECES, PIECE_CHARS = 8, 2500  # of a document
DICT_BYTES = 64 << 10
PACK_BYTES = 4 << 20
MEMO_CHUNKS, MEMO_CHARS = 150_000, 256
PART_BYTES = 64 << 20
LOT_BYTES = 1 << 20
LOT_ROWS = 1000
LATIN_END = "\u0250"
ASCII_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

PACKS = (
    "part int, seq int, first_doc bigint, last_doc bigint, docs int, tokens bigint, dict_sha256 string, "
    "doc_ids binary, offsets binary, counts binary, frames binary"
)


# The byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 up.
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LEVEL = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - PRINTABLE))}


class WordEncoder:
    """Ids of a text by the tokenizers library, one white-space chunk at a time, with a bounded memo of chunks.

    Holds for tokenizers whose pre-tokenizer drops white space, so that no token spans a blank: the ids of a text are
    those of its chunks. ASCII letters are lowered first where the tokenizer lowers, and marks at the end of a chunk
    are looked up on their own. Chunks of Latin letters, which normalisation and pre-tokenization leave as one piece,
    go straight to the library's model.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        short = self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16
        self.width, self.code = ("<u2", "H") if short else ("<u4", "I")
        spec = json.loads(self.tokenizer.to_str())
        self.by_word = '"invert": true' in json.dumps(spec.get("pre_tokenizer")) and all(x in json.dumps(spec) for x in ('"Lowercase"', '"ByteLevel"', '"BPE"'))
        # In any case: a chunk is lowered, which could make an added token of other letters.
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)", re.IGNORECASE)
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}  # the memo before it was last full; what is still used moves on

    def _library(self, texts: list[str]) -> list[bytes]:
        return [self.pack(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pack(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _learn(self, chunks: Iterable[str]) -> None:
        """Put all the chunks into the memo."""
        memo, pack, tokenize = self.memo, self.pack, self.tokenizer.model.tokenize
        hard, split = [], []
        for chunk in chunks:
            if chunk.isalpha():
                if chunk.isascii():
                    memo[chunk] = pack([t.id for t in tokenize(chunk)])
                elif max(chunk) < LATIN_END and chunk == chunk.lower() and is_normalized("NFC", chunk):
                    memo[chunk] = pack([t.id for t in tokenize(chunk.encode().decode("latin-1").translate(BYTE_LEVEL))])
                else:
                    hard.append(chunk)
                continue
            core = chunk.rstrip(ASCII_MARKS)
            if core != chunk and core.isascii() and core.isalpha():
                split.append((chunk, core, chunk[len(core) :]))
            else:
                hard.append(chunk)
        for _, core, tail in split:
            if core not in memo:
                memo[core] = pack([t.id for t in tokenize(core)])
            if tail not in memo:
                memo[tail] = self._library([tail])[0]
        memo.update(zip(hard, self._library(hard)))
        for chunk, core, tail in split:
            memo[chunk] = memo[core] + memo[tail]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, as little-endian integers of `width`."""
        if not self.by_word:
            return self._library(texts)
        lists = [t.encode().lower().decode().replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        if len(self.memo) > MEMO_CHUNKS:
            self.memo, self.old = {}, self.memo
        seen, new = set().union(*lists), []
        for chunk in seen.difference(self.memo):
            if (ids := self.old.get(chunk)) is None:
                new.append(chunk)
            else:
                self.memo[chunk] = ids
        self._learn(new)
        get = self.memo.__getitem__
        marked = self.special.search
        out = [self._library([t])[0] if marked(t) else b"".join(map(get, chunks)) for t, chunks in zip(texts, lists)]
        if any(len(chunk) > MEMO_CHARS for chunk in new):  # long ones go, so that the memo is bounded in bytes too
            for chunk in [c for c in self.memo if len(c) > MEMO_CHARS]:
                del self.memo[chunk]
        return out


def encoder(path: str) -> WordEncoder:
    cache = process_cache()
    if ("encoder", path) not in cache:
        cache[("encoder", path)] = WordEncoder(path)
    return cache[("encoder", path)]


def lots(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in lots of about LOT_BYTES characters."""
    lot, size = [], 0
    for text in texts:
        lot.append(text)
        size += len(text)
        if size >= LOT_BYTES:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int) -> bytes:
    """A zstandard dictionary from the id arrays of DICT_DOCUMENTS documents, those with the smallest hashed ids.

    Of a text of more than DICT_PIECES * PIECE_CHARS characters, as many pieces are used, evenly spread from its
    beginning to its end; of others, all. With rows that share ids, twice as many rows at most: the driver holds no more
    than 20,480,000 characters, of four bytes at most.

    Empty if there is too little to train on; frames are then compressed without one.
    """
    place = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = docs.select("doc_id").filter("doc_id IS NOT NULL").orderBy(*place).limit(DICT_DOCUMENTS)
    ids = sorted({r[0] for r in picked.collect()})
    size = F.length("text")
    spread = [F.substring("text", (1 + F.floor((size - PIECE_CHARS) * k / (DICT_PIECES - 1))).cast("int"), F.lit(PIECE_CHARS)) for k in range(DICT_PIECES)]
    pieces = F.when(size > DICT_PIECES * PIECE_CHARS, F.array(*spread)).otherwise(F.array(F.coalesce("text", F.lit(""))))
    texts = docs.filter(F.col("doc_id").isin(ids)).select(pieces.alias("_pieces"), place[0].alias("_h"), "doc_id", F.xxhash64("text").alias("_t"))
    texts = texts.orderBy("_h", "doc_id", "_t").limit(2 * DICT_DOCUMENTS).select("_pieces")
    enc = encoder(tokenizer)
    end = np.array([end_id], enc.width).tobytes()
    lists = [r[0] for r in texts.collect()]
    last = [k == len(own) - 1 for own in lists for k in range(len(own))]
    samples = sorted(ids + end if at_end else ids for ids, at_end in zip(enc.encode_many([t for own in lists for t in own]), last))
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, files: int | None = None) -> None:
    """Encode every text, append the end id and write the packs to `path`/packs and the dictionary to `path`/dict."""
    spark = docs.sparkSession
    trained = train_dictionary(docs, tokenizer, end_id)
    digest = hashlib.sha256(trained).hexdigest()
    width = encoder(tokenizer).width
    spark.createDataFrame([(digest, trained, width)], "sha256 string, dict binary, width string").coalesce(1).write.parquet(f"{path}/dict")

    def compressor() -> zstandard.ZstdCompressor:
        given = {"dict_data": zstandard.ZstdCompressionDict(trained)} if trained else {}
        return zstandard.ZstdCompressor(level=3, write_content_size=True, **given)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, zip_ = encoder(tokenizer), compressor()
        end = np.array([end_id], enc.width).tobytes()
        size = np.dtype(enc.width).itemsize
        for batch in (whole.slice(k, LOT_ROWS) for whole in batches for k in range(0, len(whole), LOT_ROWS)):
            counts, out = [], []
            for lot in lots([t or "" for t in batch.column("text").to_pylist()]):
                for ids in enc.encode_many(lot):
                    ids += end
                    counts.append(len(ids) // size)
                    out.append(zip_.compress(ids))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "n", "frame"])

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        names = [f.split()[0] for f in PACKS.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), *[pa.binary()] * 4]
        seq, ids, counts, held, held_bytes = 0, [], [], [], 0

        def pack() -> pa.RecordBatch:
            known = [i for i in ids if i is not None]
            offsets = np.cumsum([0] + [len(x) for x in held[:-1]]).astype("<i8")
            null_free = np.array([-(1 << 63) if i is None else i for i in ids], "<i8")
            row = [part, seq, min(known, default=None), max(known, default=None), len(ids), int(sum(counts)), digest]
            row += [null_free.tobytes(), offsets.tobytes(), np.array(counts, "<i8").tobytes(), b"".join(held)]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for i, n, frame in zip(batch.column("doc_id").to_pylist(), batch.column("n").to_pylist(), batch.column("frame").to_pylist()):
                if held and held_bytes + len(frame) > PACK_BYTES:
                    yield pack()
                    seq, ids, counts, held, held_bytes = seq + 1, [], [], [], 0
                ids.append(i)
                counts.append(n)
                held.append(frame)
                held_bytes += len(frame)
        if held:
            yield pack()

    # Written once: dealing out by range looks at the ids first, which would encode every text twice.
    scratch = Scratch(spark, "token_files")
    compressed = scratch.write(docs.select("doc_id", "text").mapInArrow(frames, "doc_id bigint, n bigint, frame binary"), "frames")
    if files is None:
        total = compressed.agg(F.coalesce(F.sum(F.octet_length("frame")), F.lit(0))).first()[0]
        files = max(partitions(spark), -(-total // PART_BYTES))
    # Rows of one id, or of none, may stand in any order; the second column deals many of them over several parts.
    order = ["doc_id", F.xxhash64("frame")]
    ordered = compressed.repartitionByRange(files, *order).sortWithinPartitions(*order)
    ordered.mapInArrow(packs, PACKS).write.parquet(f"{path}/packs")
    scratch.drop("frames")


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of all documents, or of a few given ones.

    `start` is the number of ids in all documents before. Given ids read only the packs whose range holds them, and of
    those packs only the frames asked for.
    """
    head = spark.read.parquet(f"{path}/dict").first()
    digest, trained, width = head["sha256"], bytes(head["dict"]), head["width"]
    stored = spark.read.parquet(f"{path}/packs")
    # Packs before a pack in its part, and parts before a part: two small sums over the packs' own columns.
    light = stored.select("part", "seq", "tokens")
    parts = light.groupBy("part").agg(F.sum("tokens").alias("_all"))
    parts = parts.select(F.col("part"), (F.sum("_all").over(Window.orderBy("part")) - F.col("_all")).alias("_base"))
    within = F.sum("tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("tokens")
    starts = light.withColumn("_within", within).join(parts, "part").select("part", "seq", (F.col("_base") + F.col("_within")).alias("start"))
    wanted = None
    if doc_ids is not None:
        wanted = np.array(sorted(doc_ids), np.int64)
        hit = F.lit(False)
        for i in doc_ids:
            hit = hit | ((F.col("first_doc") <= i) & (F.col("last_doc") >= i))
        stored = stored.filter(hit)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = {"dict_data": zstandard.ZstdCompressionDict(trained)} if trained else {}
        unzip = zstandard.ZstdDecompressor(**given)
        for batch in batches:
            for pack in batch.to_pylist():
                if pack["dict_sha256"] != digest:
                    raise ValueError("a pack was written with another dictionary")
                ids, offsets, counts = (np.frombuffer(pack[c], "<i8") for c in ("doc_ids", "offsets", "counts"))
                starts = pack["start"] + np.cumsum(counts) - counts
                ends = np.append(offsets[1:], len(pack["frames"]))
                use = np.arange(len(ids)) if wanted is None else np.flatnonzero(np.isin(ids, wanted))
                for lot in np.array_split(use, max(1, len(use) // 512)):
                    out = [np.frombuffer(unzip.decompress(pack["frames"][offsets[k] : ends[k]]), width).astype("<u4").tobytes() for k in lot]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([None if i == -(1 << 63) else int(i) for i in ids[lot]], pa.int64()), pa.array(starts[lot]), pa.array(counts[lot]), pa.array(out, pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    columns = ["part", "seq", "dict_sha256", "doc_ids", "offsets", "counts", "frames"]
    return stored.select(*columns).join(starts, ["part", "seq"]).mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def with_crc32(ids: DataFrame) -> DataFrame:
    """Replace `ids` by `ids_crc32`, the unsigned crc32 of its bytes."""
    return ids.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
