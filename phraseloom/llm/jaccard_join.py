"""7. N-gram Jaccard join: documents as sets of 5-word shingles, linked at a Jaccard similarity of 0.75 or more.

Sets. Equal sets are one class from the start; the class stands under its smallest id.

Index. A class is a point: its shingles are hashed into groups, about one per two shingles and 128 at least, and the
coordinates are the group counts; a point with more groups folds onto one with fewer. Two sets
share at most the sum of their coordinate minima, and a box of points (a node of the R-tree) bounds a query by its
upper corner. Top levels of the tree are equi-join keys: classes that can link share one of their keys, and lie in the
same or in neighbouring size bands (sizes differ by 4/3 at most). Below the keys are leaves of at most 256 points, filled
by components found so far and split by hash; a leaf pair is opened only if the boxes can hold a linked pair.

Keys. Shingles are ordered by hash, with those that are frequent in a bounded sample of documents last; any order gives
right results, this one keeps passages that many documents share out of the keys. A set of n shingles has its first
n/4 + 1 as keys, the exact prefix bound; but if n >= 128 and at least half are not frequent, the first 32 do. For such
sets the join is probabilistic: nothing finds a linked pair that has no common key. If both sets are capped, 32 draws
must all fall outside the intersection, each with a chance of at most 4/9 (equal sizes, all differences rare, half of
each set frequent): 5.4e-12 per pair at a similarity of just 0.75. If only the larger is, as its part in the smaller
is mostly frequent, at most 1/2: 2.4e-10. Without frequent shingles it is 1/4, and far less above 0.75. Which sets are
capped depends on the sample.

Steps. (a) Every class is tested against the smallest and the largest class of each of its keys, and links make first
components; a large group of near copies becomes one component with a few tests per class. (b) Keys that still hold more
than one component go through leaves; of keys that hold the same classes one is enough. In an opened leaf pair, the
classes that have a possible partner in another component are named, at most two leaves of them; their full sets meet in
one task, which verifies the pairs and emits a spanning forest of their links. So a group whose members share a body but
do not link costs a row per class and leaf pair, and never a row per pair; no group is gathered.

Defined results: null or empty texts have no shingles, link with nothing and are their own component; texts of one to
four words have one shingle; whole texts count; rows that share an id share a component, each with its own n_shingles;
rows without an id have no component; an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from phraseloom.llm.components import components
from phraseloom.llm.scratch import Scratch, partitions
from phraseloom.llm.words import BLANKS, Words, mix, text_slices

SHINGLE = 5
NUMERATOR, DENOMINATOR = 75, 100
KEYS = 32
GROUPS, MOST_GROUPS = 128, 1 << 20
LEAF = 256
ELEMENTS_AT_ONCE = 1 << 16
SAMPLE_ROWS = 8000
FREQUENT = 5  # documents of the sample
FINE = 0xFFFF

SETS = "doc_id bigint, n bigint, c1 bigint, c2 bigint, counts binary, key bigint"


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct hashed shingles of every text."""
    words = Words(data, offsets, BLANKS, lower=True)
    rolled, _ = words.rolling(SHINGLE)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= SHINGLE:
            yield np.unique(rolled[a : b - SHINGLE + 1])
        elif b > a:
            yield mix(words.between(np.array([a]), np.array([b])) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Sorted shingles of at least FREQUENT of SAMPLE_ROWS documents, those with the smallest hashed ids.

    At most SAMPLE_ROWS / FREQUENT times the shingles of a text. They change the work, and which sets have KEYS keys only.
    """
    picked = docs.select("doc_id").filter("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_slices(batch):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(list(shingle_sets(data, offsets))).view(np.int64))], ["shingle"])

    every = docs.select("doc_id", "text").join(picked, "doc_id").mapInArrow(shingles, "shingle bigint")
    hot = every.groupBy("shingle").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= FREQUENT).select("shingle").toArrow()
    return np.sort(hot.column(0).to_numpy().view(np.uint64))


def keys_of(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The keys of a sorted set."""
    common = np.zeros(len(s), bool)
    if len(frequent):
        common = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
    rare = s[~common]
    most = KEYS if len(s) >= 4 * KEYS and 2 * len(rare) >= len(s) else len(s) // 4 + 1
    return np.concatenate([rare, s[common]])[:most]


def point_of(s: np.ndarray) -> np.ndarray:
    """Group counts of a set; the number of groups is a power of two."""
    groups = GROUPS
    while groups * 3 < len(s) and groups < MOST_GROUPS:
        groups *= 2
    return np.bincount((s & np.uint64(groups - 1)).astype(np.int64), minlength=groups).astype("u1")


def folded(points: list[bytes], kind: str = "u1") -> np.ndarray:
    """Points as rows of a matrix, folded to the smallest number of groups among them."""
    arrays = [np.frombuffer(p, kind) for p in points]
    groups = min(map(len, arrays))
    return np.stack([a.reshape(-1, groups).sum(0, dtype=np.int32) for a in arrays])


def set_rows(batches: Iterator[pa.RecordBatch], frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per text with its size, digest and group counts, and a row per key."""
    names = [f.split()[0] for f in SETS.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.binary(), pa.int64()]
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for row, _, data, offsets in text_slices(batch):
            head, keys, owners = [], [], []
            for i, s in enumerate(shingle_sets(data, offsets), row):
                n = len(s)
                counts = point_of(s).tobytes() if n else None
                c1, c2 = (int(mix(s + np.uint64(salt)).sum().view(np.int64)) if n else 0 for salt in (1, 7))
                own = keys_of(s, frequent).view(np.int64)
                head.append((ids[i], n, c1, c2, counts, None))
                if n and ids[i] is not None:
                    keys.append(own)
                    owners += [ids[i]] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*head), kinds)], names)
            if keys:
                m = len(owners)
                empty = [pa.nulls(m, k) for k in kinds[1:5]]
                yield pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), *empty, pa.array(np.concatenate(keys))], names)


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, to, data, offsets in text_slices(batch):
            sets = list(shingle_sets(data, offsets))
            fine = [np.sort((s >> np.uint64(8) & np.uint64(FINE)).astype(np.uint16)).tobytes() for s in sets]
            columns = [batch.column("doc_id").slice(row, to - row), pa.array(fine, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fine", "shingles"])


def reach(shared: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Whether `shared` of two sets with `total` elements in sum can be, or is, enough for a link."""
    return DENOMINATOR * shared >= NUMERATOR * (total - shared)


def views(column: pa.Array) -> list[pa.Buffer]:
    """The binary values of a column where they lie, without copies."""
    return [value.as_buffer() for value in column]


def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v) whose group counts allow a link."""
    for batch in batches:
        if len(batch):
            keep = []
            for pair in zip(views(batch.column("a")), views(batch.column("b"))):
                both = folded(list(pair))
                keep.append(bool(reach(both.min(0).sum(), both.sum())))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(keep))


def closely_bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v) whose counts in 65,536 groups, kept as sorted lists of group numbers, allow a link."""
    for batch in batches:
        keep = []
        for a, b in zip(views(batch.column("a")), views(batch.column("b"))):
            x, y = np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16)
            groups = np.bincount(x, minlength=FINE + 1) if len(x) > 4096 else None
            if groups is not None:
                shared = np.minimum(groups, np.bincount(y, minlength=FINE + 1)).sum()
            else:
                first = np.searchsorted(x, x)  # the r-th of equal numbers in x meets the r-th in y
                at = np.searchsorted(y, x) + np.arange(len(x)) - first
                shared = (y[np.minimum(at, len(y) - 1)] == x)[at < len(y)].sum() if len(y) else 0
            keep.append(bool(reach(shared, len(x) + len(y))))
        yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v) whose sets reach the threshold."""
    for batch in batches:
        keep = []
        for a, b in zip(views(batch.column("a")), views(batch.column("b"))):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            keep.append(bool(reach(np.intersect1d(x, y, assume_unique=True).size, len(x) + len(y))))
        yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))


def with_sides(pairs: DataFrame, side: DataFrame, column: str) -> DataFrame:
    """Pairs (u, v) with `column` of the first as `a` and of the second as `b`."""
    a = side.select(F.col("doc_id").alias("u"), F.col(column).alias("a"))
    b = side.select(F.col("doc_id").alias("v"), F.col(column).alias("b"))
    return pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b")


def links_of(pairs: DataFrame, docs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The pairs that link: first by the closer bound, then on the full sets, which are made for their documents only."""
    ids = pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct()
    ids = scratch.write(ids, f"{name}-ids")
    sets = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    sets = scratch.write(sets.mapInArrow(full_sets, "doc_id bigint, fine binary, shingles binary"), f"{name}-sets")
    near = scratch.write(with_sides(pairs, sets, "fine").mapInArrow(closely_bounded, "u bigint, v bigint"), f"{name}-near")
    links = scratch.write(with_sides(near, sets, "shingles").mapInArrow(verified, "u bigint, v bigint"), name)
    scratch.drop(f"{name}-ids", f"{name}-sets", f"{name}-near")
    return links


def group_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Runs of equal `key` in a sorted stream. A run is one leaf pair, so it is small."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
        if len(table) == 0:
            continue
        values = table.column(key).to_numpy()
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        whole = table.to_batches()[0]
        for a, b in zip(np.concatenate([[0], cuts[:-1]]).astype(int), cuts):
            yield whole.slice(a, b - a)
        rest = whole.slice(int(cuts[-1]) if len(cuts) else 0)
    if rest is not None and len(rest):
        yield rest


NAMED = "pair bigint, doc_id bigint, component bigint"


def leaf_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes of a leaf pair, or of one leaf, that have a partner in another component as far as counts tell."""
    for run in group_runs(batches, "pair"):
        comp, left = (run.column(c).to_numpy(zero_copy_only=False) for c in ("component", "left"))
        points = folded(run.column("counts").to_pylist())
        total = points.sum(1)
        lone = left.all()
        rows = np.flatnonzero(left)
        others = rows if lone else np.flatnonzero(~left)
        if len(others) == 0:
            continue
        top, top_total = points[others].max(0), total[others].min()
        named = np.zeros(len(run), bool)
        for i in rows:
            if not reach(np.minimum(points[i], top).sum(), total[i] + top_total):
                continue
            near = others[(others > i) if lone else slice(None)]
            near = near[comp[near] != comp[i]]
            near = near[reach(np.minimum(points[near], points[i]).sum(1), total[near] + total[i])]
            if len(near):
                named[near] = named[i] = True
        if named.any():
            yield run.select(["pair", "doc_id", "component"]).filter(pa.array(named))


def shared_sizes(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of some sorted sets, a block of their elements at a time."""
    element, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    code = np.cumsum(np.concatenate([[False], element[1:] != element[:-1]]))
    often = np.bincount(code)[code] > 1  # an element of one set alone is shared with none
    code, owner = code[often], owner[often]
    out = np.zeros((len(sets), len(sets)), np.int64)
    for start in range(0, len(code), ELEMENTS_AT_ONCE):
        part = slice(start, start + ELEMENTS_AT_ONCE)
        columns, at = np.unique(code[part], return_inverse=True)
        has = np.zeros((len(sets), len(columns)), np.float32)
        has[owner[part], at] = 1
        out += (has @ has.T).astype(np.int64)
        # An element cut by the end of a block meets its rest there.
        if start + ELEMENTS_AT_ONCE < len(code) and code[start + ELEMENTS_AT_ONCE - 1] == code[start + ELEMENTS_AT_ONCE]:
            cut = code[start + ELEMENTS_AT_ONCE]
            before = owner[part][code[part] == cut]
            after = owner[start + ELEMENTS_AT_ONCE :][code[start + ELEMENTS_AT_ONCE :] == cut]
            out[np.ix_(before, after)] += 1
            out[np.ix_(after, before)] += 1
    return out


def leaf_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest, over the known components, of the links among the classes of each leaf pair."""
    for run in group_runs(batches, "pair"):
        ids, comp = run.column("doc_id").to_numpy(), run.column("component").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in views(run.column("shingles"))]
        sizes = np.array([len(s) for s in sets])
        linked = np.triu(reach(shared_sizes(sets), sizes[:, None] + sizes[None, :]) & (comp[:, None] != comp[None, :]), 1)
        _, up = np.unique(comp, return_inverse=True)
        forest = []
        for i, j in zip(*np.nonzero(linked)):
            if up[i] != up[j]:
                up[up == up[j]] = up[i]
                forest.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        if forest:
            u, v = zip(*forest)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def box_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaf pairs whose boxes can hold a linked pair: `a`, `b` are upper corners, `na`, `nb` the smallest sizes."""
    for batch in batches:
        if len(batch):
            shared = [folded(list(pair), "<u4").min(0).sum() for pair in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())]
            keep = reach(np.array(shared), batch.column("na").to_numpy() + batch.column("nb").to_numpy())
            yield batch.select(["la", "lb"]).filter(pa.array(keep))


BOXES = "key bigint, band bigint, leaf bigint, least bigint, corner binary, only bigint"


def leaf_boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The box of every leaf; `only` is its component, null if it holds more than one."""
    names, kinds, out = [f.split()[0] for f in BOXES.split(", ")], [pa.int64()] * 4 + [pa.binary(), pa.int64()], []
    for run in group_runs(batches, "leaf"):
        points = folded(run.column("counts").to_pylist())
        comp = run.column("component").to_numpy()
        one = [run.column(c)[0].as_py() for c in ("key", "band", "leaf")]
        out.append((*one, int(points.sum(1).min()), points.max(0).astype("<u4").tobytes(), int(comp[0]) if (comp == comp[0]).all() else None))
        if len(out) >= 2000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def across_components(keyed: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (u, v) between components that share a key, enough of them to join all components that link.

    `keyed`: key, doc_id, n, counts, component.
    """
    spark = keyed.sparkSession
    h = F.xxhash64("doc_id")
    held = [F.count(F.lit(1)).alias("_n"), F.bit_xor(h).alias("_x"), F.sum(F.shiftright(h, 32)).alias("_s"), F.min("doc_id").alias("_low"), F.max("doc_id").alias("_high")]
    mixed = keyed.groupBy("key").agg(F.min("component").alias("_a"), F.max("component").alias("_b"), *held).filter("_a <> _b")
    mixed = scratch.write(mixed.groupBy("_n", "_x", "_s", "_low", "_high").agg(F.min("key").alias("key")).select("key"), "mixed")
    band = F.floor(F.log("n") / math.log(DENOMINATOR / NUMERATOR) + 1e-9).cast("bigint")
    rows = scratch.write(keyed.join(mixed, "key").withColumn("band", band), "mixed_rows")
    # Small components share leaves, each whole; a large one has leaves of its own, split by hash.
    own = scratch.write(rows.groupBy("key", "band", "component").agg(F.count(F.lit(1)).alias("_own")), "own")
    small = own.groupBy("key", "band").agg(F.sum(F.when(F.col("_own") <= LEAF, F.col("_own")).otherwise(0)).alias("_block"))
    sizes = scratch.write(own.join(small, ["key", "band"]), "sizes")
    by_component = F.pmod(F.xxhash64("component"), F.greatest(F.ceil(F.col("_block") / LEAF), F.lit(1)))
    by_row = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.ceil(F.col("_own") / LEAF))
    large = F.col("_own") > LEAF
    leaf = F.xxhash64("key", "band", F.when(~large, by_component), F.when(large, F.struct("component", by_row)))
    rows = scratch.write(rows.join(sizes, ["key", "band", "component"]).withColumn("leaf", leaf), "leaves")
    scratch.drop("mixed", "mixed_rows", "own", "sizes")

    parts = partitions(spark)
    boxes = rows.select("key", "band", "leaf", "component", "counts").repartition(parts, "leaf").sortWithinPartitions("leaf")
    boxes = scratch.write(boxes.mapInArrow(leaf_boxes, BOXES), "boxes")
    a = boxes.select("key", "band", F.col("leaf").alias("la"), F.col("least").alias("na"), F.col("corner").alias("a"), F.col("only").alias("ca"))
    b = boxes.select("key", F.col("band").alias("_to"), F.col("leaf").alias("lb"), F.col("least").alias("nb"), F.col("corner").alias("b"), F.col("only").alias("cb"))
    reachable = a.withColumn("_to", F.explode(F.array("band", F.col("band") + 1))).join(b, ["key", "_to"])
    reachable = reachable.filter((F.col("la") < F.col("lb")) | (F.col("_to") > F.col("band")))
    reachable = reachable.filter("ca IS NULL OR cb IS NULL OR ca <> cb")  # else all is known to be linked
    opened = reachable.select("la", "lb", "na", "nb", "a", "b").mapInArrow(box_pairs, "la bigint, lb bigint")
    opened = opened.unionByName(boxes.filter("only IS NULL").select(F.col("leaf").alias("la"), F.col("leaf").alias("lb")))
    opened = opened.withColumn("pair", F.xxhash64("la", "lb"))
    sides = opened.select("pair", F.col("la").alias("leaf"), F.lit(True).alias("left")).unionByName(
        opened.filter("la <> lb").select("pair", F.col("lb").alias("leaf"), F.lit(False).alias("left"))
    )
    sides = scratch.write(sides, "sides")
    dealt = rows.select("leaf", "doc_id", "component", "counts").join(sides, "leaf").drop("leaf")
    named = scratch.write(dealt.repartition(parts, "pair").sortWithinPartitions("pair").mapInArrow(leaf_pairs, NAMED), "named")
    ids = scratch.write(named.select("doc_id").distinct(), "named_ids")
    sets = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi").mapInArrow(full_sets, "doc_id bigint, fine binary, shingles binary")
    sets = scratch.write(sets.select("doc_id", "shingles"), "named_sets")
    met = named.join(sets, "doc_id").repartition(parts, "pair").sortWithinPartitions("pair")
    return met.select("pair", "doc_id", "component", "shingles").mapInArrow(leaf_links, "u bigint, v bigint")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of docs."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard_join")
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs))
    rows = docs.select("doc_id", "text").mapInArrow(lambda batches: set_rows(batches, frequent.value), SETS)
    rows = scratch.write(rows, "sets")
    points = rows.filter("n IS NOT NULL")
    digest = ["n", "c1", "c2"]
    classes = points.filter("n > 0 AND doc_id IS NOT NULL").groupBy(*digest).agg(F.min("doc_id").alias("rep"), F.first("counts").alias("counts"))
    classes = scratch.write(classes, "classes")
    reps = classes.select(F.col("rep").alias("doc_id"), "n", "counts")

    keys = rows.filter("key IS NOT NULL").select("key", "doc_id").join(reps.select("doc_id"), "doc_id", "left_semi")
    keys = scratch.write(keys.select("key", "doc_id").distinct(), "keys")
    leaders = keys.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    keys = scratch.write(keys.join(scratch.write(leaders, "leaders"), "key"), "shared")
    scratch.drop("keys", "leaders")

    star = keys.select(F.explode(F.array("low", "high")).alias("u"), F.col("doc_id").alias("v")).filter("u <> v")
    star = star.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    star = scratch.write(with_sides(star, reps, "counts").mapInArrow(bounded, "u bigint, v bigint"), "star-pairs")
    star = links_of(star, docs, scratch, "star")
    first = scratch.write(components(star, scratch, "first"), "first_components")

    comp = F.coalesce("component", "doc_id").alias("component")
    keyed = keys.select("key", "doc_id").join(reps, "doc_id").join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    keyed = scratch.write(keyed.select("key", "doc_id", "n", "counts", comp), "keyed")
    scratch.drop("shared", "star-pairs")
    more = scratch.write(across_components(keyed, docs, scratch), "more")
    scratch.drop("keyed", "leaves", "boxes", "sides", "named", "named_ids", "named_sets")
    links = star.unionByName(more)
    final = scratch.write(components(links, scratch, "final"), "final_components")

    members = points.join(classes.select(*digest, "rep"), digest, "left").withColumnRenamed("rep", "node").join(final, "node", "left")
    return members.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "node", "doc_id").alias("component_id"))
