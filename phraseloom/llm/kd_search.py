"""10. Approximate nearest neighbours: stable projections in a kd-tree, with a chi-square stopping test.

Vectors are projected on a few Gaussian directions. For two vectors at distance d, the squared distance of their
projections over d**2 follows a chi-square distribution with as many degrees of freedom as there are directions. A
query visits the leaves of a kd-tree over the projections from the nearest on and verifies their vectors exactly. It
stops when a vector nearer than its k-th best so far would, with probability STOP or more, have a projection nearer
than the next leaf.

STOP is the recall target, whatever the number of rows. The k-th best so far is never nearer than the true k-th, so a
true neighbour at distance d is left out, by a leaf or by a whole cell, only if its squared projection is STOP's
chi-square quantile times d**2 or more. Over the directions that has a chance of 1 - STOP at most, and both cuts are
the same event. Most neighbours fare better, as their box is nearer than they are.

The measure is the inner product. It becomes a distance by one more coordinate that lifts every vector to the largest
norm M; the query is scaled to M: d**2 = 2 * M * (M - <q, x> / |q|).

On the cluster, the top of the kd-tree is fitted on a bounded sample and cuts the projected space into cells; every row
goes to the cell of its projection, and cells with more rows than a shard holds (equal vectors, for one) are dealt over
several shards. A query first searches one shard of its own cell and then, with the k-th best found there, those shards
whose box passes the test. Queries travel in blocks, so a task holds one shard and one block; the best k of a shard are
merged by a ranked window, of which Spark keeps k rows per query before the shuffle.

Scores are compared as exact products of doubles. The search works on copies scaled by powers of two, one for the table
and one for each query, so that neither squares nor products leave the range of doubles, and bounds on the error of
matrix products are relative to the lengths of the vectors.

Defined results: null or zero vectors and those that hold a null or non-finite component take no part, as query or
candidate; nor do null ids or vectors of another length than the most common one; rows that share an id count each,
as queries with a list of their own and as candidates, but never as neighbours of their id; ties go to the smaller id;
fewer candidates than k give fewer rows; no queries or an empty table give no rows; other columns are not read, whatever
their names. A component smaller than the longest vector by a factor of 2**500 may count as 0 in the search.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from phraseloom.llm.scratch import Scratch

DIRECTIONS = 6
RECALL = 0.95  # expected, at least
STOP = RECALL
LEAF = 256
SHARD_ROWS = 16_384
QUERY_BLOCK = 4096
SAMPLE_ROWS, MOST_SAMPLE_ROWS = 32_768, 1 << 21  # projections, of a few numbers each
SAMPLE_PER_CELL = 32
LAST = np.iinfo(np.int64).max
EPS = float(np.finfo(np.float64).eps)


def directions(dimension: int, m: int = DIRECTIONS, seed: int = 5) -> np.ndarray:
    """Gaussian directions for lifted vectors; the last row belongs to the lift."""
    return np.random.default_rng(seed).normal(size=(dimension + 1, m))


def chi_square_cdf(x: np.ndarray, m: int) -> np.ndarray:
    """Of m degrees of freedom, for even m."""
    half = np.minimum(x / 2, 700.0)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, m // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def lifted(vectors: np.ndarray, norm: float) -> np.ndarray:
    """Projections of index vectors."""
    rest = np.sqrt(np.maximum(norm**2 - (vectors**2).sum(1), 0))
    return np.column_stack([vectors, rest]) @ directions(vectors.shape[1])


def scaled(queries: np.ndarray, norm: float) -> np.ndarray:
    """Projections of queries, scaled to the norm and with no lift."""
    return (queries * (norm / np.sqrt((queries**2).sum(1)))[:, None]) @ directions(queries.shape[1])[:-1]


def split_points(points: np.ndarray, size: int, rows: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Leaves of a kd-tree as row numbers: halve at the median of the widest coordinate until `size` rows are left."""
    todo = [np.arange(len(points)) if rows is None else rows]
    while todo:
        own = todo.pop()
        if len(own) <= size:
            yield own
            continue
        axis = int(np.argmax(np.ptp(points[own], axis=0)))
        half = len(own) // 2
        order = own[np.argpartition(points[own, axis], half)]
        todo += [order[half:], order[:half]]


@dataclass
class Cells:
    """The top of the tree: (axis, value, left, right) per node; a negative child is the cell ~child."""

    nodes: list[tuple[int, float, int, int]]

    @staticmethod
    def fit(points: np.ndarray, depth: int) -> Cells:
        nodes: list[tuple[int, float, int, int]] = []
        cells = 0

        def grow(own: np.ndarray, left: int) -> int:
            nonlocal cells
            if left == 0 or len(own) < 4:
                cells += 1
                return ~(cells - 1)
            axis = int(np.argmax(np.ptp(points[own], axis=0)))
            value = float(np.median(points[own, axis]))
            at = len(nodes)
            nodes.append((axis, value, 0, 0))
            low = points[own, axis] < value
            nodes[at] = (axis, value, grow(own[low], left - 1), grow(own[~low], left - 1))
            return at

        grow(np.arange(len(points)), depth)
        return Cells(nodes)

    def of(self, points: np.ndarray) -> np.ndarray:
        if not self.nodes:
            return np.zeros(len(points), np.int64)
        out = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, own = todo.pop()
            if node < 0:
                out[own] = ~node
                continue
            axis, value, left, right = self.nodes[node]
            low = points[own, axis] < value
            todo += [(left, own[low]), (right, own[~low])]
        return out


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    out = np.zeros((len(points), len(low)))
    for j in range(points.shape[1]):
        p = points[:, j, None]
        out += np.maximum(np.maximum(low[:, j] - p, p - high[:, j]), 0) ** 2
    return out


def search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, known: np.ndarray, norm: float, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row of the query, vec_id, score) of the k best of one shard per query, and the number of verified pairs.

    `known`: a score of which k others of the index are at least as good; -inf if there is none yet.
    """
    points = lifted(vectors, norm)
    order = list(split_points(points, LEAF))
    low, high = (np.array([f(points[o], axis=0) for o in order]) for f in (np.min, np.max))
    length = np.sqrt((queries**2).sum(1))
    part_of = np.zeros(len(vectors), np.int64)
    for number, own in enumerate(order):
        part_of[own] = number
    sizes = np.sqrt((vectors**2).sum(1))
    longest = np.array([sizes[own].max() for own in order])
    far = box_distance(scaled(queries, norm), low, high)
    turn = np.argsort(far, axis=1, kind="stable")
    best = np.full((len(queries), k), -np.inf)
    rows = np.full((len(queries), k), -1)
    active, verified = np.arange(len(queries)), 0
    for step in range(len(order)):
        leaf = turn[active, step]
        worst = np.maximum(best[active, -1], known[active])
        reach = 2 * norm * np.maximum(norm - worst / length[active], 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(np.isfinite(reach), far[active, leaf] / reach, 0.0)
        ratio = np.where(np.isnan(ratio), 0.0, ratio)
        go = chi_square_cdf(ratio, DIRECTIONS) < STOP
        active, leaf = active[go], leaf[go]
        if not len(active):
            break
        by = np.argsort(leaf, kind="stable")
        for part in np.split(by, np.flatnonzero(np.diff(leaf[by])) + 1):
            own, at = active[part], order[leaf[part[0]]]
            scores = queries[own] @ vectors[at].T
            scores[query_ids[own][:, None] == ids[at][None, :]] = -np.inf
            verified += scores.size
            slack = 4 * vectors.shape[1] * EPS * length[own] * longest[part_of[at[0]]]
            hit = np.flatnonzero(scores.max(1) >= best[own, -1] - slack)
            if not len(hit):
                continue
            own, scores, slack = own[hit], scores[hit], slack[hit]
            # All that may be among the best k, by the product of matrices and its error; their exact products decide.
            enough = best[own, -1]
            if len(at) > k:
                enough = np.maximum(enough, np.partition(scores, len(at) - k, axis=1)[:, len(at) - k])
            who, col = np.nonzero((scores >= (enough - slack)[:, None]) & np.isfinite(scores))
            exact = np.einsum("ij,ij->i", queries[own[who]], vectors[at[col]])
            have, place = np.nonzero(rows[own] >= 0)
            who, exact = np.concatenate([have, who]), np.concatenate([best[own][have, place], exact])
            found = np.concatenate([rows[own][have, place], at[col]])
            order_ = np.lexsort((ids[found], -exact, who))
            who, exact, found = who[order_], exact[order_], found[order_]
            rank = np.arange(len(who)) - np.searchsorted(who, who)
            keep = rank < k
            best[own[who[keep]], rank[keep]] = exact[keep]
            rows[own[who[keep]], rank[keep]] = found[keep]
    q, j = np.nonzero(rows >= 0)
    return q, ids[rows[q, j]], best[q, j], verified


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long lists as rows of a matrix, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 1))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def list_array(points: np.ndarray) -> pa.Array:
    """Rows of a matrix as a list column."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(points) + 1, dtype=np.int32) * points.shape[1]), pa.array(points.ravel()))


def power_of_two(vectors: np.ndarray, shift: int | np.ndarray) -> np.ndarray:
    """Rows times 2**shift."""
    return np.ldexp(vectors, shift if isinstance(shift, int) else shift[:, None])


def own_shift(vectors: np.ndarray) -> np.ndarray:
    """The power that brings the largest component of every row to between 1/2 and 1."""
    return -np.frexp(np.abs(vectors).max(1))[1]


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """vec_id, `v`, an array of doubles, and `asks` of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select("vec_id", v.alias("v"), F.col("_asks").alias("asks")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad)
    return rows.filter(F.exists("v", lambda x: x != 0))


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for every row of `vectors` for which `is_query` holds."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "kd_search")
    rows = usable(vectors.withColumn("_asks", F.coalesce(is_query, F.lit(False))), vector)
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    length = largest * F.sqrt(F.aggregate(F.transform("v", lambda x: x / largest), F.lit(0.0), lambda a, x: a + x * x))
    shapes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(largest).alias("m"), F.max(length).alias("l"), F.count_if("asks").alias("q"))
    shape = shapes.orderBy(F.desc("n"), "d").first()
    out = "row bigint, query_id bigint, vec_id bigint, score double, unit int"
    if shape is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dimension, total = shape["d"], shape["n"]
    # Copies in the search are shorter than 1: components lie below 2**-shift, which is no more than 1 / sqrt(dimension).
    shift = -math.frexp(float(shape["m"]))[1] - math.ceil(math.log2(dimension) / 2)
    norm = min(1.0, math.ldexp(float(shape["l"]), shift)) if math.isfinite(shape["l"]) else 1.0
    rows = rows.filter(F.size("v") == dimension)
    rows = scratch.write(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v", "asks"), "rows")

    depth = max(0, math.ceil(math.log2(total / SHARD_ROWS)))
    wanted = min(max(SAMPLE_ROWS, SAMPLE_PER_CELL << depth), MOST_SAMPLE_ROWS)
    some = rows.filter(F.pmod(F.xxhash64("row", F.lit(9)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, wanted / total))).select("v").limit(2 * wanted)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([list_array(lifted(power_of_two(matrix(batch.column("v")), shift), norm))], ["point"])

    sample = matrix(some.mapInArrow(projected, "point array<double>").toArrow().column("point"))
    cells = Cells.fit(sample, min(depth, max(0, int(math.log2(max(1, len(sample)))) - 4)))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                own = matrix(batch.column("v"))
                points = lifted(power_of_two(own, shift), norm)
                # A query stands at its scaled projection, which for most is close to its own cell.
                at = scaled(power_of_two(own, own_shift(own)), norm)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("row", "vec_id", "v", "asks")), pa.array(cells.of(points)), pa.array(cells.of(at)), list_array(points)],
                    ["row", "vec_id", "v", "asks", "cell", "home", "point"],
                )

    kinds = "row bigint, vec_id bigint, v array<double>, asks boolean, cell bigint, home bigint, point array<double>"
    index = scratch.write(rows.mapInArrow(placed, kinds), "index")
    scratch.drop("rows")

    # Shards of bounded size: cells with too many rows are dealt by hash. One row per cell, far fewer than vectors.
    sizes = index.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).alias("parts"))
    coordinates = [f(F.element_at("point", j + 1)).alias(f"{n}{j}") for n, f in (("low", F.min), ("high", F.max)) for j in range(DIRECTIONS)]
    boxes = index.groupBy("cell").agg(*coordinates).join(sizes, "cell").orderBy("cell").toArrow()
    low, high = (np.column_stack([boxes.column(f"{n}{j}").to_numpy() for j in range(DIRECTIONS)]) for n in ("low", "high"))
    cell_ids, parts = boxes.column("cell").to_numpy(), boxes.column("parts").to_numpy().astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(parts)])
    table = spark.createDataFrame([(int(c), int(o), int(p)) for c, o, p in zip(cell_ids, offsets, parts)], "cell bigint, base bigint, parts bigint")
    shard = (F.col("base") + F.pmod(F.xxhash64("row"), F.col("parts"))).alias("shard")
    shards = index.join(table, "cell").select("vec_id", "v", shard)

    n_blocks = max(1, math.ceil(shape["q"] / QUERY_BLOCK))
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(n_blocks)).alias("block")
    home = F.coalesce("base", F.lit(0)) + F.pmod(F.xxhash64("row", F.lit(2)), F.coalesce("parts", F.lit(1)))
    queries = index.filter("asks").join(table.withColumnRenamed("cell", "home"), "home", "left")
    queries = scratch.write(queries.select("row", "vec_id", "v", block, home.alias("home")), "queries")

    def found(shard_rows: pa.Table, query_rows: pa.Table) -> pa.Table:
        names, kinds_ = ["row", "query_id", "vec_id", "score", "unit"], (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32())
        if len(shard_rows) == 0 or len(query_rows) == 0:
            return pa.table([pa.array([], t) for t in kinds_], names)
        ids, query_ids = (t.column("vec_id").to_numpy() for t in (shard_rows, query_rows))
        known, own = query_rows.column("known").to_numpy(), matrix(query_rows.column("v"))
        up = own_shift(own)
        q, vec, score, _ = search(ids, power_of_two(matrix(shard_rows.column("v")), shift), query_ids, power_of_two(own, up), known, norm, k)
        units = pa.array((-up - shift)[q].astype(np.int32))
        return pa.table([pa.array(query_rows.column("row").to_numpy()[q]), pa.array(query_ids[q]), pa.array(vec), pa.array(score), units], names)

    def searched(asked: DataFrame, name: str) -> DataFrame:
        """`asked`: row, vec_id, v, block, shard, known. Shards are copied to the blocks that visit them."""
        pairs = scratch.write(asked.select("shard", "block").distinct(), name)
        left = shards.join(pairs, "shard").groupBy("shard", "block")
        return left.cogroup(asked.groupBy("shard", "block")).applyInArrow(found, out)

    nothing = F.lit(float("-inf")).alias("known")
    first = scratch.write(searched(queries.select("row", "vec_id", "v", "block", F.col("home").alias("shard"), nothing), "home_pairs"), "first")
    best = first.groupBy("row").agg(F.min("score").alias("_worst"), F.count(F.lit(1)).alias("_n"))
    known = F.when(F.col("_n") >= k, F.col("_worst")).otherwise(float("-inf")).alias("known")
    again = queries.join(best, "row", "left").select("row", "vec_id", "v", "block", "home", F.coalesce(known, nothing).alias("known"))

    def targets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            own, worst = matrix(batch.column("v")), batch.column("known").to_numpy()
            own = power_of_two(own, own_shift(own))
            size = np.sqrt((own**2).sum(1))
            reach = 2 * norm * np.maximum(norm - worst / size, 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = box_distance(scaled(own, norm), low, high) / reach[:, None]
            go = chi_square_cdf(np.where(np.isnan(ratio), 0.0, ratio), DIRECTIONS) < STOP
            home_ = batch.column("home").to_numpy()
            lists = [[s for c in np.flatnonzero(g) for s in range(offsets[c], offsets[c + 1]) if s != h] for g, h in zip(go, home_)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "vec_id", "v", "block", "known")), pa.array(lists, pa.list_(pa.int64()))],
                ["row", "vec_id", "v", "block", "known", "shards"],
            )

    routed = again.mapInArrow(targets, "row bigint, vec_id bigint, v array<double>, block bigint, known double, shards array<bigint>")
    routed = scratch.write(routed.select("row", "vec_id", "v", "block", F.explode("shards").alias("shard"), "known"), "routed")
    second = searched(routed, "other_pairs")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    ranked = first.unionByName(second).withColumn("rank", rank).filter(F.col("rank") <= k)

    # Scaling by powers of two changes no digit of a product, so it is taken back. In two steps, as a power may be too large.
    half = F.floor(F.col("unit") / 2)
    score = F.col("score") * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), F.col("unit") - half)
    return ranked.select("query_id", "rank", "vec_id", score.alias("score"))
