"""11. WARC: a content-addressed archive of web records.

An archive is a folder with two Parquet tables. `payloads` holds every payload once under its SHA-256, `records` the exact
bytes of every record's header block (WARC fields, and HTTP fields where there are any) with the digest of its payload.
A record is given back by a join on the digest: header, payload, end mark, byte for byte. A digest is verified when it is
written (all payloads under it must agree in a second, independent digest and in size) and when it is read (the
digest of the stored bytes is taken again).

Pages are archived as response records. Of those with equal payloads of at least LEAST_SHARED bytes, the one with the
smallest page_id is a response and the others are revisit records: HTTP fields without payload, naming the response.
Records of WARC files, plain or gzipped, can be taken in too, and any archive can be written out as record bytes.

A payload that a third of all pages share is stored once, with their number; it is dealt over tasks in as many copies as
COPIES_A_TASK asks for when its records are given back. The copies of a payload shrink to one in each task before it is
shuffled to be stored; the records are made from digests alone.

Defined results: null html is an empty payload, null url an empty one (line breaks in it stand as %0D and %0A); rows
that share a page_id, or have none, are records of their own; null ids come last when the response is chosen, and of
equal ids any may be it; an empty table makes an empty archive; other columns are not read, whatever their names.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from phraseloom.llm.scratch import Scratch

LEAST_SHARED = 100
COPIES_A_TASK = 2000
END = b"\r\n\r\n"
PAGE_FIELD = "X-Page-ID"
REFERS_FIELD = "X-Refers-To-Page-ID"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

TAKEN_IN = "file string, place bigint, head binary, payload binary"
PAGES = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _payload() -> Column:
    return F.coalesce("html", F.lit("")).cast("binary")


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _record_id(row: Column) -> Column:
    """A record id from the row's number in the archive."""
    h = F.md5(row.cast("string"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _page_heads(date: str) -> Column:
    """The header block of a page's record; `_first`, `_first_id` are the row and page_id of the response it revisits."""
    revisit = F.col("_first").isNotNull()
    none = F.lit("")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), _field("Content-Type", F.lit("text/html; charset=utf-8")), _field("Content-Length", F.col("size").cast("string")), F.lit("\r\n"))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    url = F.replace(F.replace(F.coalesce("url", none), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    refers = F.concat(
        _field("WARC-Refers-To", _record_id(F.col("_first"))),
        F.coalesce(_field(REFERS_FIELD, F.col("_first_id").cast("string")), none),
        _field("WARC-Profile", F.lit(PROFILE)),
    )
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _record_id(F.col("row"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", url),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.coalesce(_field(PAGE_FIELD, F.col("page_id").cast("string")), none),
        F.when(revisit, refers).otherwise(none),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", length.cast("string")),
        F.lit("\r\n"),
        http,
    ).cast("binary")


def _verified_sizes(facts: DataFrame) -> DataFrame:
    """digest, copies and the first row of every payload; fails if two payloads share a digest."""
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")
    same = (F.min("check") == F.max("check")) & (F.min("size") == F.max("size"))
    groups = facts.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("_place"), same.alias("_same"), F.min("size").alias("_size"))
    wrong = F.raise_error(F.concat(F.lit("two payloads with the digest "), F.col("digest")))
    return groups.select("digest", F.when(F.col("_same"), F.col("copies")).otherwise(wrong.cast("bigint")).alias("copies"), "_place", "_size")


def _store_payloads(payloads: DataFrame, path: str) -> None:
    """Write (digest, payload) once per digest, and how many records share it."""
    payloads.groupBy("digest").agg(F.first("payload").alias("payload"), F.count(F.lit(1)).alias("copies")).write.option("compression", "zstd").parquet(f"{path}/payloads")


def archive_pages(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record for every row of (page_id, url, html) to a new archive at `path`."""
    scratch = Scratch(pages.sparkSession, "web_archive")
    digest = F.sha2(_payload(), 256)
    facts = pages.select(
        F.monotonically_increasing_id().alias("row"), "page_id", "url", digest.alias("digest"), F.octet_length(_payload()).cast("bigint").alias("size"), F.xxhash64(_payload()).alias("check")
    )
    facts = scratch.write(facts, "facts")
    groups = scratch.write(_verified_sizes(facts), "groups")
    # Only shared payloads meet their groups again; all other records are responses with one copy.
    shared = groups.filter("copies > 1").select("digest", "copies", "_size", F.col("_place.page_id").alias("_first_id"), F.col("_place.row").alias("_first"))
    joined = facts.join(shared, "digest", "left")
    own = (F.col("row") == F.col("_first")) | (F.col("_size") < LEAST_SHARED)
    first = F.when(~own, F.col("_first"))
    joined = joined.select("row", "page_id", "url", "digest", "size", F.coalesce("copies", F.lit(1)).alias("copies"), F.when(first.isNotNull(), F.col("_first_id")).alias("_first_id"), first.alias("_first"))
    records = joined.select(F.col("row").alias("place"), F.lit("pages").alias("file"), _page_heads(date).alias("head"), F.col("_first").isNull().alias("with_payload"), "digest", "copies")
    records.write.option("compression", "zstd").parquet(f"{path}/records")
    _store_payloads(pages.select(digest.alias("digest"), _payload().alias("payload")), path)
    scratch.drop("facts", "groups")


def split_records(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(header block, payload) of the records of a WARC file; of HTTP records the HTTP fields belong to the header."""
    at = 0
    while at < len(data):
        end = data.find(END, at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no record at byte {at}")
        end += len(END)
        fields = header_fields(data[at:end])
        length = int(fields[b"content-length"])
        block = data[end : end + length]
        if len(block) < length or data[end + length : end + length + 4] != END:
            raise ValueError(f"record at byte {at} is cut off")
        http = block.find(END) + len(END) if fields.get(b"content-type", b"").startswith(b"application/http") and END in block else 0
        yield data[at : end + http], block[http:]
        at = end + length + len(END)


def header_fields(head: bytes) -> dict[bytes, bytes]:
    """WARC fields by lower-case name."""
    lines = head.partition(END)[0].split(b"\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(b":") for line in lines)}


def plain(data: bytes) -> bytes:
    """The bytes of a file of gzip members, or the bytes themselves."""
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def archive_files(spark: SparkSession, files: str, path: str) -> None:
    """Take in the records of WARC files (a path or pattern), in order of file and place."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                for place, (head, payload) in enumerate(split_records(plain(content))):
                    columns = [pa.array([file]), pa.array([place], pa.int64()), pa.array([head], pa.binary()), pa.array([payload], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["file", "place", "head", "payload"])

    scratch = Scratch(spark, "web_archive")
    taken = scratch.write(spark.read.format("binaryFile").load(files).select("path", "content").mapInArrow(records, TAKEN_IN), "taken")
    digest = F.sha2("payload", 256)
    facts = taken.select("file", "place", "head", digest.alias("digest"), F.octet_length("payload").cast("bigint").alias("size"), F.xxhash64("payload").alias("check"))
    groups = _verified_sizes(facts.select(F.lit(None).cast("bigint").alias("page_id"), F.col("place").alias("row"), "digest", "size", "check"))
    records_ = facts.join(groups.select("digest", "copies"), "digest").select("place", "file", "head", F.lit(True).alias("with_payload"), "digest", "copies")
    records_.write.option("compression", "zstd").parquet(f"{path}/records")
    _store_payloads(taken.select(digest.alias("digest"), "payload"), path)
    scratch.drop("taken")


def with_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Every record of an archive beside its payload: file, place, head, with_payload, digest and payload."""
    records = spark.read.parquet(f"{path}/records")
    payloads = spark.read.parquet(f"{path}/payloads")
    salts = F.ceil(F.col("copies") / COPIES_A_TASK).cast("int")
    records = records.withColumn("salt", F.pmod(F.xxhash64("file", "place"), salts).cast("int"))
    # Payloads that are asked for often go to several tasks; the others, nearly all, have the one salt 0.
    dealt = payloads.select("digest", "payload", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    both = records.join(dealt, ["digest", "salt"])
    return both.select("file", "place", "head", "with_payload", "digest", "payload")


def _checked(digest: str, payload: bytes) -> bytes:
    if hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"the payload stored under {digest} has another digest")
    return payload


def restored(head: bytes, payload: bytes, with_payload: bool) -> bytes:
    return head + (payload if with_payload else b"") + END


def record_bytes(spark: SparkSession, path: str, gzipped: bool = False) -> DataFrame:
    """file, place and the exact bytes of every record; joined in order of place they are the WARC file."""

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1).to_pylist()[0]
                record = restored(row["head"], _checked(row["digest"], row["payload"]), row["with_payload"])
                record = gzip.compress(record, mtime=0) if gzipped else record
                columns = [pa.array([row["file"]]), pa.array([row["place"]], pa.int64()), pa.array([record], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["file", "place", "record"])

    return with_payloads(spark, path).mapInArrow(give, "file string, place bigint, record binary")


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """PAGES: what the records of an archive of pages say, read from the records' bytes and held against the payloads."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = (batch.column(c) for c in ("head", "payload", "with_payload", "digest"))
            for head, payload, with_payload, digest in zip(*columns):
                payload, with_payload = _checked(digest.as_py(), payload.as_py()), with_payload.as_py()
                (head, block), *more = split_records(restored(head.as_py(), payload, with_payload))
                fields = header_fields(head)
                if more or block != (payload if with_payload else b"") or fields[b"warc-payload-digest"] != b"sha256:" + digest.as_py().encode():
                    raise ValueError(f"the record under {digest} does not hold its payload")
                page, refers = (fields.get(name.lower().encode()) for name in (PAGE_FIELD, REFERS_FIELD))
                out.append((page and int(page), len(payload), digest.as_py(), fields[b"warc-type"].decode(), refers and int(refers)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in PAGES.split(", ")])

    return with_payloads(spark, path).mapInArrow(read, PAGES)
