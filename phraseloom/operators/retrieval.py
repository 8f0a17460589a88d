"""Exact top-k cosine retrieval.

Three physical forms give the same hits. Which one runs depends on sizes found by one aggregate:

* the index is small: it goes to every task, and queries are scored where they are read;
* the queries are few: they go to every task, and the index is scanned once, each task keeping k;
* both are large: the index is cut by language, the only filter that always prunes, and by hash into blocks of
  bounded bytes, each one row of a table that is stored once, bucketed by block. Queries are packed into chunks of
  bounded bytes and go to the blocks of their language, which are read where they are stored. A query moves once per
  block, so blocks grow with the index and their number does not, up to MOST_BLOCKS blocks of BLOCK_BYTES. A chunk visits its
  blocks in three rounds: one block, about the root of their number, the rest. After a round, the k-th score found so
  far is the floor of a query, and later blocks emit only what reaches it; so about k times the root of the number of
  blocks leave per query, and not k times the number.

Where hits become a column of the rows that ask (attach_hits), the first form also serves an index of a bounded number
of such parts: a task reads them one after another, and the score that a row has reached is its floor in the next.

No form emits all pairs. Ranking uses the score to 10 places, ties go to the lower row_id. An input whose plan runs
Python, such as an encoder, is stored once before it is read by several jobs.
"""

from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from phraseloom.operators.filters import language_filter
from phraseloom.operators.ordering import running_totals
from phraseloom.schemas import HIT
from phraseloom.storage import new_path, stored

# Largest side that is sent to every executor, as bytes of float32 vectors.
BROADCAST_BYTES = 64 * 1024 * 1024
# Every index task emits k rows per query, so this form is chosen for a moderate number of queries.
FEW_QUERIES = 10_000
# Share of the broadcast bytes that parts of a larger side fill on average.
PART_FILL = 0.8
# Parts of an index, with its texts, that are sent to every executor for one pass over the rows that get hits; a task
# holds one at a time.
MOST_PARTS = 20
# Rows with their hits that leave a task at a time.
ROWS_OUT = 2_048
# Vectors in one block of the index, and in one chunk of the queries.
BLOCK_BYTES = 32 * 1024 * 1024
CHUNK_BYTES = 16 * 1024 * 1024
# A query moves once per block of its language: smaller blocks than BLOCK_BYTES grow until the index has this many.
MOST_BLOCKS = 16
# Chunks of the queries, and tasks that meet blocks, that keep executors busy.
CHUNKS = 64
MEETING_TASKS = 32
SCORES_AT_ONCE = 4_000_000
# Pairs that are looked into and scored exactly at a time, about; near ties can make many.
PAIRS_AT_ONCE = 250_000
GROUP_ROWS = 32
# Bytes of the float64 vectors of one side of the pairs that are scored exactly at a time.
EXACT_BYTES = 16 * 1024 * 1024
ROWS_AT_ONCE = 8_192
_RANK_DIGITS = 10
_ANY = ""


# ---------------------------------------------------------------------- numpy inside one task


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """List column of equally long float vectors -> 2-d array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.zeros((0, 0), dtype=np.float32)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _strings(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.array(column.fill_null(_ANY).to_pylist(), dtype=object)


class _Side:
    """Ids, vectors and languages of some rows; the language of a query is the one it asks for."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, langs: np.ndarray, id_type: pa.DataType):
        self.ids, self.vectors, self.langs, self.id_type = ids, vectors, langs, id_type

    @classmethod
    def of(cls, data: pa.Table | pa.RecordBatch, id_name: str) -> "_Side":
        ids = data.column(id_name)
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.combine_chunks()
        return cls(
            ids.to_numpy(zero_copy_only=False), _matrix(data.column("embedding")), _strings(data.column("lang")), ids.type
        )

    def parts(self) -> tuple:
        return self.ids, self.vectors, self.langs, self.id_type

    def take(self, where: np.ndarray) -> "_Side":
        return _Side(self.ids[where], self.vectors[where], self.langs[where], self.id_type)

    def by_id(self) -> "_Side":
        return self.take(np.argsort(self.ids, kind="stable"))

    def useful(self, k: int) -> "_Side":
        """In id order, without rows that cannot be a hit."""
        rows = self.by_id()
        keep = _first_copies(rows.vectors, rows.langs, k)
        return rows if keep.all() else rows.take(keep)


def _first_copies(vectors: np.ndarray, langs: np.ndarray, k: int) -> np.ndarray:
    """Mask of the first k rows of every (vector, language).

    Equal vectors tie for every query and ties go to the lower id, so with rows in id order the other
    copies are never hits. This is what keeps a vector with a third of all rows cheap.
    """
    keep = np.ones(len(vectors), dtype=bool)
    if len(vectors) <= k:
        return keep
    words = np.ascontiguousarray(vectors, dtype=np.float32).view(np.uint32)
    mix = np.random.default_rng(0).integers(1, 2**63, size=words.shape[1], dtype=np.uint64) | np.uint64(1)
    # A hash finds the few vectors that may repeat; only these are compared as a whole.
    hashes = np.concatenate([words[i : i + ROWS_AT_ONCE].astype(np.uint64) @ mix for i in range(0, len(words), ROWS_AT_ONCE)])
    _, group, size = np.unique(hashes, return_inverse=True, return_counts=True)
    often = np.flatnonzero(size[group] > k)
    seen: dict[tuple, int] = {}
    for i in often:
        copy = (vectors[i].tobytes(), langs[i])
        seen[copy] = seen.get(copy, 0) + 1
        keep[i] = seen[copy] <= k
    return keep


def _longest(vectors: np.ndarray) -> float:
    """Length of the longest vector."""
    return max(float(np.linalg.norm(vectors[i : i + ROWS_AT_ONCE], axis=1).max()) for i in range(0, len(vectors), ROWS_AT_ONCE))


def _candidates(
    queries: np.ndarray, rows: np.ndarray, k: int, longest: float, floors: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, row) numbers that include the k best rows of every query, and few others; none below its floor.

    Scores are float32 here, of ROWS_AT_ONCE rows at a time. The k-th largest of the maxima of row groups so far is a
    lower bound for the k-th best score, found without sorting, and only groups that reach it are looked into; the
    slack covers the float32 error of a dot product. Pairs come at the end, or earlier if there are many.
    """
    slack = 4 * queries.shape[1] * np.finfo(np.float32).eps * _longest(queries) * longest + 10.0**-_RANK_DIGITS
    best, step = np.full((len(queries), k), -np.inf, dtype=np.float32), max(1, PAIRS_AT_ONCE // GROUP_ROWS)
    found: list[tuple[np.ndarray, ...]] = []

    def reached() -> tuple[np.ndarray, np.ndarray]:
        at, col, score = (np.concatenate(c) for c in zip(*found))
        found.clear()
        keep = score >= bound[at]
        return at[keep], col[keep]

    for start in range(0, len(rows), ROWS_AT_ONCE):
        scores = queries @ rows[start : start + ROWS_AT_ONCE].T
        n = scores.shape[1]
        groups = n // GROUP_ROWS if n // GROUP_ROWS >= k else 0
        grouped = groups * GROUP_ROWS
        # A group is every so many-th row, so that maxima are taken of whole lines; the rows left over stand alone.
        heads = scores[:, :grouped].reshape(len(scores), GROUP_ROWS, groups).max(axis=1)
        heads = np.hstack([heads, scores[:, grouped:]])
        best = np.partition(np.hstack([best, heads]), heads.shape[1], axis=1)[:, heads.shape[1] :]
        at_least = best[:, 0] if floors is None else np.maximum(best[:, 0], floors)
        bound = (at_least - slack).astype(np.float32)
        at, head = np.nonzero(heads >= bound[:, None])
        alone = head >= groups
        found.append((at[alone], start + grouped + head[alone] - groups, heads[at[alone], head[alone]]))
        at, head = at[~alone], head[~alone]
        for i in range(0, len(at), step):
            here = at[i : i + step, None]
            col = head[i : i + step, None] + groups * np.arange(GROUP_ROWS)
            inside = scores[here, col]
            row, place = np.nonzero(inside >= bound[here])
            found.append((here[row, 0], start + col[row, place], inside[row, place]))
            if sum(len(one) for one, *_ in found) >= PAIRS_AT_ONCE:
                yield reached()
    if found:
        yield reached()


def _exact_scores(queries: np.ndarray, at: np.ndarray, rows: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Dot products of the given pairs in float64, in pieces, since copies can make many candidates."""
    out = np.empty(len(at))
    step = max(1, EXACT_BYTES // (8 * max(1, queries.shape[1])))
    for i in range(0, len(at), step):
        s = slice(i, i + step)
        left, right = queries[at[s]].astype(np.float64), rows[col[s]].astype(np.float64)
        out[s] = np.einsum("ij,ij->i", left, right)
    return np.round(out, _RANK_DIGITS)


def _best(queries: _Side, rows: _Side, k: int, floors: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the k best rows per query in rank order, padded with -inf; `rows` is sorted by id.

    With `floors`, one score per query, only rows that reach it."""
    scores = np.full((len(queries.ids), k), -np.inf)
    ids = np.full((len(queries.ids), k), np.iinfo(np.int64).max)
    for lang in np.unique(queries.langs):
        mine = np.nonzero(queries.langs == lang)[0]
        asked = np.ones(len(rows.ids), dtype=bool) if lang == _ANY else rows.langs == lang
        r = rows if asked.all() else rows.take(asked)
        if len(r.ids) == 0:
            continue
        m, longest = min(k, len(r.ids)), _longest(r.vectors)
        step = max(1, SCORES_AT_ONCE // min(len(r.ids), ROWS_AT_ONCE))
        for i in range(0, len(mine), step):
            part = mine[i : i + step]
            for at, col in _candidates(queries.vectors[part], r.vectors, m, longest, None if floors is None else floors[part]):
                exact = _exact_scores(queries.vectors, part[at], r.vectors, col)
                order = np.lexsort((col, -exact, at))
                at, col, exact = at[order], col[order], exact[order]
                rank = np.arange(len(at)) - np.searchsorted(at, at)
                keep = rank < m
                if floors is not None:
                    keep &= exact >= floors[part[at]]
                here = np.full((len(part), k), -np.inf), np.full((len(part), k), np.iinfo(np.int64).max)
                here[0][at[keep], rank[keep]] = exact[keep]
                here[1][at[keep], rank[keep]] = r.ids[col[keep]]
                scores[part], ids[part] = _merged((scores[part], ids[part]), here, k)
    return scores, ids


def _merged(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the k best of both per row, in rank order."""
    scores, ids = (np.hstack(both) for both in zip(one, other))
    order = np.lexsort((ids, -scores), axis=-1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _emit(queries: _Side, scores: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """Long form; `rank` is the rank among the rows this task has seen."""
    at, col = np.nonzero(scores > -np.inf)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(queries.ids[at], type=queries.id_type),
            pa.array(ids[at, col]),
            pa.array(scores[at, col]),
            pa.array((col + 1).astype(np.int32)),
        ],
        names=["query_id", "row_id", "raw_score", "rank"],
    )


# ---------------------------------------------------------------------- the three forms


def _slim(df: DataFrame, id_col: str, lang: Column) -> DataFrame:
    rows = df.filter(F.col("embedding").isNotNull())
    return rows.select(id_col, "embedding", lang.alias("lang"))


def _id_type(queries: DataFrame) -> str:
    return queries.schema["query_id"].dataType.simpleString()


def _candidate_ddl(queries: DataFrame) -> str:
    return f"query_id {_id_type(queries)}, row_id bigint, raw_score double, rank int"


# Classes of plan nodes and expressions that are costly to run twice: Python, and the functions of fitted models.
_COSTLY = re.compile(r"\.(Python\w*|ArrowEval\w*|MapIn\w+|FlatMap\w+In\w+|ScalaUDF)$")


def _runs_code(df: DataFrame) -> bool:
    """Whether the plan has user code: by the classes of its parts, so that names and literals do not count."""
    try:
        nodes = json.loads(df._jdf.queryExecution().optimizedPlan().toJSON())
    except (Py4JJavaError, ValueError):
        return True  # a plan that cannot be looked into may hold anything

    def classes(part) -> Iterator[str]:
        if isinstance(part, dict):
            if isinstance(part.get("class"), str):
                yield part["class"]
            part = list(part.values())
        if isinstance(part, list):
            for one in part:
                yield from classes(one)

    return any(_COSTLY.search(name) for name in classes(nodes))


def _once(df: DataFrame) -> DataFrame:
    """The same rows; stored if their plan runs user code, since several jobs read them."""
    return stored(df) if _runs_code(df) else df


class _Size:
    """Rows and bytes of one side, from one aggregate with a map-side step."""

    def __init__(self, df: DataFrame, *texts: str):
        width = 4 * F.size("embedding") + sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in texts), F.lit(0))
        rows, total, vectors = df.agg(F.count(F.lit(1)), F.sum(width.cast("bigint")), F.max(F.size("embedding"))).first()
        self.rows, self.bytes, self.vector_bytes = rows, total or 0, 4 * max(1, vectors or 1)


def _with_small_index(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    small = queries.sparkSession.sparkContext.broadcast(_Side.of(index.toArrow(), "row_id").useful(k).parts())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Side(*small.value)
        for batch in batches:
            queries_here = _Side.of(batch, "query_id")
            yield _emit(queries_here, *_best(queries_here, rows, k))

    return queries.mapInArrow(scan, _candidate_ddl(queries))


def _with_few_queries(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    few = queries.sparkSession.sparkContext.broadcast(_Side.of(queries.toArrow(), "query_id").parts())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, best = _Side(*few.value), None
        for batch in batches:
            here = _best(asked, _Side.of(batch, "row_id").useful(k), k)
            best = here if best is None else _merged(best, here, k)
        if best is not None:
            yield _emit(asked, *best)

    return index.mapInArrow(scan, _candidate_ddl(queries))


PACKED = "number int, lang string, data binary"


def _cuts(side: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """Per language, the first number (`_offset`) and the number (`_size`) of its blocks, and that of all blocks."""
    sizes = side.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / rows).alias("_size"))
    cuts = running_totals(sizes, ["lang"])
    return cuts, cuts.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]


def _packed(side: DataFrame, id_col: str, cuts: DataFrame, finish: Callable[[_Side], _Side]) -> DataFrame:
    """One row per block: its number, language and its rows as one Arrow stream."""
    block = F.col("_offset") + F.pmod(F.xxhash64(id_col), F.col("_size"))
    rows = side.join(cuts, "lang").select(id_col, "embedding", "lang", block.cast("int").alias("number"))
    parts = int(side.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block_of() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held)
            held.clear()
            number, lang = whole.column("number")[0].as_py(), whole.column("lang")[0].as_py()
            kept = finish(_Side.of(whole, id_col))
            vectors = pa.FixedSizeListArray.from_arrays(pa.array(kept.vectors.reshape(-1)), kept.vectors.shape[1])
            data = pa.RecordBatch.from_arrays([pa.array(kept.ids, type=kept.id_type), vectors], names=["id", "embedding"])
            with pa.BufferOutputStream() as sink:
                with pa.ipc.new_stream(sink, data.schema) as out:
                    out.write_batch(data)
                packed = sink.getvalue()
            ends = pa.py_buffer(np.array([0, packed.size], np.int32))
            one = pa.BinaryArray.from_buffers(pa.binary(), 1, [None, ends, packed])
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([lang]), one], names=["number", "lang", "data"])

        for batch in batches:
            numbers = batch.column("number").to_numpy()
            cut = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(batch)]
            for a, b in zip(cut, cut[1:]):
                if held and b > a and held[-1].column("number")[0] != batch.column("number")[a]:
                    yield block_of()
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield block_of()

    return rows.repartition(parts, "number").sortWithinPartitions("number").mapInArrow(pack, PACKED)


def _unpacked(data: pa.Buffer, lang: str) -> _Side:
    rows = pa.ipc.open_stream(data).read_all()
    ids = rows.column("id").combine_chunks()
    vectors = rows.column("embedding").combine_chunks()
    matrix = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
    return _Side(ids.to_numpy(zero_copy_only=False), matrix, np.full(len(ids), lang, dtype=object), ids.type)


def _block_rows(rows: int, vector_bytes: int, least: int | None) -> int:
    """Rows of an index block: as many as fit, or `least` if that does not make more than MOST_BLOCKS blocks."""
    fit = max(1, BLOCK_BYTES // vector_bytes)
    return fit if least is None else max(least, min(fit, math.ceil(rows / MOST_BLOCKS)))


def _chunk_rows(rows: int, vector_bytes: int, least: int | None) -> int:
    """Rows of a query chunk: enough chunks for all tasks, of bounded bytes."""
    return max(least or 1, min(max(1, CHUNK_BYTES // vector_bytes), math.ceil(rows / CHUNKS)))


def _visits(chunks: DataFrame, cuts: DataFrame, n_blocks: int) -> DataFrame:
    """(chunk, block, round) of all visits. A chunk goes round its blocks from one that its number picks."""
    wide = F.col("lang") == _ANY
    reach = chunks.select(F.col("number").alias("chunk"), "lang").join(cuts.withColumn("_known", F.lit(True)), "lang", "left")
    reach = reach.filter(wide | F.col("_known")).select(
        "chunk", F.when(wide, 0).otherwise(F.col("_offset")).alias("first"), F.when(wide, n_blocks).otherwise(F.col("_size")).alias("n")
    )
    steps = reach.filter("n > 0").withColumn("step", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    block = F.col("first") + F.pmod(F.pmod(F.xxhash64("chunk"), F.col("n")) + F.col("step"), F.col("n"))
    round_ = F.when(F.col("step") == 0, 0).when(F.col("step") <= F.ceil(F.sqrt("n")), 1).otherwise(2)
    return steps.select("chunk", block.cast("int").alias("block"), round_.alias("round"))


def _with_blocks(queries: DataFrame, index: DataFrame, k: int, block_rows: int | None) -> DataFrame:
    """Blocks of the index by language and hash against chunks of the queries, in rounds with rising floors."""
    spark = queries.sparkSession
    asked, rows = _Size(queries), _Size(index)
    cuts, n_blocks = _cuts(index, _block_rows(rows.rows, rows.vector_bytes, block_rows))
    kind = f"query_id {_id_type(queries)}, row_id bigint, raw_score double, rank int, chunk int, place int"
    if n_blocks == 0:
        return spark.createDataFrame([], kind)
    name = f"phraseloom_blocks_{uuid.uuid4().hex}"
    # A block lies on several shelves if there are few blocks, and a chunk goes to one of them.
    copies = math.ceil(MEETING_TASKS / n_blocks)
    shelves = F.explode(F.sequence(F.col("number") * copies, (F.col("number") + 1) * copies - 1)).alias("shelf")
    blocks = _packed(index, "row_id", cuts, lambda rows: rows.useful(k)).select(shelves, F.col("data").alias("rows"))
    buckets = max(1, min(2 * n_blocks * copies, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    blocks = blocks.repartition(buckets, "shelf").write.bucketBy(buckets, "shelf").sortBy("shelf")
    blocks.option("path", new_path(spark, name)).saveAsTable(name)
    try:
        chunk_cuts = _cuts(queries, _chunk_rows(asked.rows, asked.vector_bytes, block_rows))[0]
        chunks = stored(_packed(queries, "query_id", chunk_cuts, _Side.by_id))
        shelf = F.col("block") * copies + F.pmod("chunk", F.lit(copies))
        visits = stored(_visits(chunks, cuts, n_blocks).select("chunk", shelf.alias("shelf"), "round"))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(batch)):
                    row = {c: batch.column(c)[i] for c in batch.schema.names}
                    # A chunk only meets blocks of its language.
                    asked, rows = _unpacked(row["data"].as_buffer(), _ANY), _unpacked(row["rows"].as_buffer(), _ANY)
                    floors = None
                    if row["floors"].is_valid:
                        known = row["floors"].values
                        floors = np.full(len(asked.ids), -np.inf)
                        floors[known.field("place").to_numpy()] = known.field("floor").to_numpy()
                    scores, ids = _best(asked, rows, k, floors)
                    out = _emit(asked, scores, ids)
                    place = np.nonzero(scores > -np.inf)[0].astype(np.int32)
                    out = out.append_column("chunk", pa.array(np.full(len(place), row["chunk"].as_py(), np.int32)))
                    yield out.append_column("place", pa.array(place))

        found, floors = None, spark.createDataFrame([], "chunk int, floors array<struct<place: int, floor: double>>")
        for round_ in range(3):
            asked = visits.filter(F.col("round") == round_).join(chunks.withColumnRenamed("number", "chunk"), "chunk").join(floors, "chunk", "left")
            met = asked.join(spark.table(name).hint("merge"), "shelf").select("chunk", "data", "floors", "rows")
            new = stored(met.mapInArrow(score, kind))
            # Only k rows per query go on: those of the rounds before are the best so far.
            found = new if found is None else found.unionByName(new)
            if round_ < 2:
                found = stored(top_k(found, k))
                kth = found.filter(F.col("rank") == k).select("chunk", F.struct("place", F.col("raw_score").alias("floor")).alias("_f"))
                # A chunk holds a bounded number of queries, so its floors are one small list.
                floors = kth.groupBy("chunk").agg(F.collect_list("_f").alias("floors"))
        return found
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def top_k(candidates: DataFrame, k: int) -> DataFrame:
    """First k of each query by score, then row_id; a task keeps at most k per query before the shuffle."""
    w = Window.partitionBy("query_id").orderBy(F.desc("raw_score"), "row_id")
    return candidates.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _in_parts(side: DataFrame, id_col: str, size: _Size, broadcast_bytes: int) -> list[DataFrame]:
    """The rows, cut by hash into parts that may each be sent to every task; one part if all of them may."""
    n = math.ceil(size.bytes / (PART_FILL * broadcast_bytes)) if size.bytes > broadcast_bytes else 1
    part = F.pmod(F.xxhash64(id_col, F.lit("part")), F.lit(n))
    return [side.filter(part == i) for i in range(n)] if n > 1 else [side]


def cosine_top_k(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    *,
    form: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    block_rows: int | None = None,
    parts: bool = False,
) -> DataFrame:
    """(query_id, rank, row_id, raw_score) of the k nearest rows of each query.

    `queries` has a unique query_id of any type and embedding, and want_lang if each query asks for its
    own target language (null: any). All vectors have unit length; a null vector has no hits. `form`
    forces one of "small_index", "few_queries", "blocks"; the bytes that are then sent to all tasks must still fit. With
    `parts`, forced "few_queries" takes any number of queries, in parts that fit; each part scans the index once.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    want = F.col("want_lang") if "want_lang" in queries.columns else F.lit(None)
    q = _once(_slim(queries, "query_id", F.coalesce(want.cast("string"), F.lit(_ANY))))
    r = _once(_slim(index, "row_id", F.coalesce(F.col("target_lang").cast("string"), F.lit(_ANY))))
    asked = None
    if form is None:
        form = "blocks"
        if _Size(r, "lang").bytes <= broadcast_bytes:
            form = "small_index"
        elif (asked := _Size(q, "lang", "query_id")).bytes <= broadcast_bytes and asked.rows <= FEW_QUERIES:
            form = "few_queries"
    elif form in ("small_index", "few_queries"):
        # How many rows tasks emit is the caller's choice here; what every task holds is not.
        asked = _Size(r, "lang") if form == "small_index" else _Size(q, "lang", "query_id")
        if asked.bytes > broadcast_bytes and not (parts and form == "few_queries"):
            raise ValueError(f"{form}: this side is too large to be sent to every task")
    columns = ["query_id", "rank", "row_id", "raw_score"]
    if form == "small_index":
        # Each query has met the whole index in one task, so its ranks are final: no shuffle.
        return _with_small_index(q, r, k).select(*columns)
    if form == "few_queries":
        found = reduce(DataFrame.unionByName, [_with_few_queries(part, r, k) for part in _in_parts(q, "query_id", asked, broadcast_bytes)])
    elif form == "blocks":
        found = _with_blocks(q, r, k, block_rows)
    else:
        raise ValueError(f"unknown form {form!r}")
    return top_k(found, k).select(*columns)


def retrieve(
    queries: DataFrame,
    index: DataFrame,
    k: int = 5,
    *,
    source_lang: str | None = None,
    target_lang: str | None = None,
    **how,
) -> DataFrame:
    """Hits of each query with the index columns, rank and the score rounded to 4 places.

    The language filters apply to the index before any scoring.
    """
    rows = language_filter(index, source_lang, target_lang)
    found = cosine_top_k(queries, rows, k, **how)
    meta = rows.select("row_id", "source_idiom", "source_lang", "target_idiom", "target_lang")
    return found.join(meta, "row_id").select(
        "query_id",
        "rank",
        "row_id",
        "source_idiom",
        "source_lang",
        "target_idiom",
        "target_lang",
        F.round("raw_score", 4).alias("score"),
    )


def pack_hits(hits: DataFrame) -> DataFrame:
    """One row per query with its at most k hits as a list in rank order."""
    hit = F.struct("rank", "source_idiom", "source_lang", "target_idiom", "target_lang", "score")
    return hits.groupBy("query_id").agg(F.array_sort(F.collect_list(hit)).alias("hits"))


# ---------------------------------------------------------------------- hits as a column

_META = ["source_idiom", "source_lang", "target_idiom", "target_lang"]


class _Part:
    """Some rows of an index, sent out: ids, vectors and languages, and apart from them their texts."""

    def __init__(self, rows: DataFrame, k: int):
        data = rows.select("row_id", "embedding", "lang", *_META).toArrow().sort_by("row_id")
        data = data.filter(pa.array(_first_copies(_matrix(data.column("embedding")), _strings(data.column("lang")), k)))
        side, send = _Side.of(data, "row_id"), rows.sparkSession.sparkContext.broadcast
        self.side, self.texts = send(side.parts()), send((side.ids, [data.column(c).combine_chunks() for c in _META]))


class PreparedIndex:
    """An index made ready once for many calls of attach_hits(): stored if computed, and sent out in parts of at most
    `broadcast_bytes` each unless it needs more than MOST_PARTS of them."""

    def __init__(self, index: DataFrame, k: int, broadcast_bytes: int = BROADCAST_BYTES):
        self.rows, self.k, self.shared = _once(index), k, None
        size = _Size(self.rows, *_META)
        if size.bytes <= MOST_PARTS * PART_FILL * broadcast_bytes:
            rows = self.rows.filter(F.col("embedding").isNotNull()).withColumn("lang", F.coalesce("target_lang", F.lit(_ANY)))
            self.shared = [_Part(part, k) for part in _in_parts(rows, "row_id", size, broadcast_bytes)]


def _read(shared: Broadcast, keep: bool):
    """The value of a broadcast. Unless it is kept, the next call reads it from its file again."""
    value = shared.value
    if not keep and hasattr(shared, "_path"):
        vars(shared).pop("_value", None)
    return value


def _texts_of(ids: np.ndarray, parts: list[_Part]) -> tuple[list[pa.Array], np.ndarray]:
    """The text columns of index rows, each row once, and where each id stands in them; a task holds the texts of one
    part at a time."""
    ids, of = np.unique(ids, return_inverse=True)
    places, found = [], [[] for _ in _META]
    for part in parts:
        known, texts = _read(part.texts, len(parts) == 1)
        at = np.searchsorted(known, ids)
        mine = np.flatnonzero(known[np.minimum(at, len(known) - 1)] == ids) if len(known) else np.zeros(0, np.int64)
        places.append(mine)
        for column, all_texts in zip(found, texts):
            column.append(all_texts.take(pa.array(at[mine])))
        del known, texts, all_texts
    where = np.empty(len(ids), np.int64)
    where[np.concatenate(places)] = np.arange(len(ids))
    return [pa.concat_arrays(found.pop(0)) for _ in _META], where[of]


def _attach_in_one_pass(df: DataFrame, shared: list[_Part], k: int) -> DataFrame:
    out = T.StructType([f for f in df.schema.fields if f.name != "embedding"] + [T.StructField("hits", T.ArrayType(HIT))])
    kept = [f.name for f in out.fields[:-1]]
    has_want = "want_lang" in df.columns

    def searched(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores and ids of the hits of the rows with a vector, and the numbers of these rows."""
        asked = np.flatnonzero(batch.column("embedding").is_valid().to_numpy(zero_copy_only=False))
        langs = _strings(batch.column("want_lang"))[asked] if has_want else np.full(len(asked), _ANY, dtype=object)
        queries, best = _Side(asked, _matrix(batch.column("embedding").drop_null()), langs, pa.int64()), None
        for part in shared:
            rows = _Side(*_read(part.side, len(shared) == 1))
            # The k-th score so far is the floor of a query.
            here = _best(queries, rows, k, None if best is None else best[0][:, -1])
            best = here if best is None else _merged(best, here, k)
            del rows
        return *best, asked

    def attached(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        scores, ids, asked = searched(batch)
        at, rank = np.nonzero(scores > -np.inf)
        texts, where = _texts_of(ids[at, rank], shared)
        ends = np.concatenate([[0], np.cumsum(np.bincount(asked[at], minlength=len(batch)))]).astype(np.int32)
        for a in range(0, len(batch), ROWS_OUT):
            here = batch.slice(a, ROWS_OUT)
            mine = slice(ends[a], ends[a + len(here)])
            numbers, shown = (rank[mine] + 1).astype(np.int32), np.round(scores[at[mine], rank[mine]], 4)
            columns = [pa.array(numbers), *[c.take(pa.array(where[mine])) for c in texts], pa.array(shown)]
            hits = pa.ListArray.from_arrays(pa.array(ends[a : a + len(here) + 1] - ends[a]), pa.StructArray.from_arrays(columns, names=HIT.names))
            yield pa.RecordBatch.from_arrays([*[here.column(c) for c in kept], hits], names=[*kept, "hits"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from attached(batch)
            # Else the pool keeps what a batch took.
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(scan, out)


def attach_hits(
    df: DataFrame,
    index: DataFrame | PreparedIndex,
    k: int,
    *,
    source_lang: str | None = None,
    target_lang: str | None = None,
    form: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    **how,
) -> DataFrame:
    """Replace `embedding` by `hits`, the list of the k best rows in rank order; no vector, no hits.

    With an index of up to MOST_PARTS parts this is one pass over `df` without a shuffle. Otherwise the search and the
    join back both read `df`, so it is stored first if its plan runs user code.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if isinstance(index, PreparedIndex) and (source_lang or target_lang or k > index.k or form is not None):
        index = index.rows
    if not isinstance(index, PreparedIndex):
        rows = language_filter(index, source_lang, target_lang)
        index = PreparedIndex(rows, k, broadcast_bytes if form in (None, "small_index") else -1)
    if index.shared is not None:
        return _attach_in_one_pass(df, index.shared, k)
    kept, rows = _once(df), index.rows
    hits = pack_hits(retrieve(kept, rows, k, form=form, broadcast_bytes=broadcast_bytes, **how))
    joined = kept.drop("embedding").join(hits, "query_id", "left")
    return joined.withColumn("hits", F.coalesce("hits", F.array().cast(T.ArrayType(HIT))))
