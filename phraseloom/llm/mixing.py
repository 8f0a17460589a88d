"""6. Mixing sources to target weights by temperature.

Token shares p of the sources are raised to an exponent and normalised: w = p**a / sum(p**a). The exponent is bisected
(in steps of 64 at once, each step one aggregate over the sources, so no list of sources reaches the driver) to the
largest that meets a target entropy, and is then raised as far as a repetition limit asks: no source may be read more
than `most_repeats` times. Each source has a budget of w times the wanted tokens.

Budgets are realised by block permutations. A source's documents are permuted by hash and cut into small hash blocks; a
sum over block totals and one inside blocks give every document its place in tokens, however large the source is. A
source with a budget of r times its tokens is read floor(r) times whole and once more up to the rest. Place over budget
gives the output block, so every output block holds all sources at their weights; inside a block the order is a
permutation again.

Defined results: texts without words (null, empty) carry no tokens and take no part; a null source is the source '';
rows that share an id are one document with their tokens together and the smallest source; rows without id take no
part; one source keeps weight 1; an empty table gives no rows; other columns are not read, whatever their names. A
document is taken in the last, partial reading if its first token lies within the budget.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from phraseloom.llm.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
STEPS = 64
PASSES = 4
BLOCK_ROWS = 4096
BLOCK_TOKENS = 1 << 20


def token_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and n_tokens (words) of every document that has words."""
    sized = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint").alias("n_tokens"))
    one = sized.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("source").alias("source"), F.sum("n_tokens").alias("n_tokens"))
    return one.filter("n_tokens > 0")


def _bisect(low: float, high: float, good) -> float:
    """The largest exponent in [low, high] for which `good`, true up to some point, holds at the points of a grid."""
    for _ in range(PASSES):
        grid = [low + (high - low) * i / STEPS for i in range(STEPS + 1)]
        holds = good(grid)
        at = max((i for i, ok in enumerate(holds) if ok), default=0)
        low, high = grid[at], grid[min(at + 1, STEPS)]
    return low


def fit_exponent(sources: DataFrame, total: int, budget: float, entropy_share: float, most_repeats: float) -> float:
    """The exponent for `sources` (source, tokens). 1 keeps the shares, 0 makes all sources equal.

    `entropy_share`: where the entropy of the weights lies between that of the shares (0) and the largest (1).
    """
    log_p = F.log(F.col("tokens") / F.lit(float(total)))
    head = sources.agg(F.count(F.lit(1)), F.min(log_p), F.sum(-F.exp(log_p) * log_p)).first()
    count, least, own = head[0], head[1], head[2]
    target = own + entropy_share * (math.log(count) - own)

    def moments(grid: list[float]) -> list[tuple[float, float]]:
        sums = [F.sum(F.exp(log_p * a)).alias(f"z{i}") for i, a in enumerate(grid)]
        sums += [F.sum(F.exp(log_p * a) * log_p).alias(f"s{i}") for i, a in enumerate(grid)]
        row = sources.agg(*sums).first()
        return [(row[f"z{i}"], row[f"s{i}"]) for i in range(len(grid))]

    def rich(grid: list[float]) -> list[bool]:
        return [math.log(z) - a * s / z >= target - 1e-12 for a, (z, s) in zip(grid, moments(grid))]

    def repeats(grid: list[float]) -> list[bool]:
        """Whether the smallest source, the one repeated most, is over the limit."""
        return [math.exp(a * least) / z * budget > most_repeats * math.exp(least) * total for a, (z, _) in zip(grid, moments(grid))]

    exponent = _bisect(0.0, 1.0, rich)
    if repeats([exponent])[0]:
        exponent = min(1.0, _bisect(exponent, 1.0, repeats) + (1.0 - exponent) / STEPS**PASSES)
    return exponent


def mix(docs: DataFrame, budget_tokens: float | None = None, entropy_share: float = 0.5, most_repeats: float = 4.0, seed: int = 1) -> DataFrame:
    """doc_id, source, epoch (from 0), n_tokens, block and slot of every reading of a document in the mixture.

    Read in order of (block, slot). `budget_tokens`: wanted tokens, by default those of the input.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    sizes = scratch.write(token_sizes(docs), "sizes")
    sources = scratch.write(sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")), "sources")
    total = sources.agg(F.sum("tokens")).first()[0]
    if not total:
        return spark.createDataFrame([], "doc_id bigint, source string, epoch int, n_tokens bigint, block bigint, slot int")
    budget = float(budget_tokens or total)
    a = fit_exponent(sources, total, budget, entropy_share, most_repeats)
    power = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(a))
    weights = sources.crossJoin(F.broadcast(sources.agg(F.sum(power).alias("_z")))).select(
        "source", "tokens", (power / F.col("_z") * budget).alias("budget"), F.ceil(F.col("rows") / BLOCK_ROWS).alias("cuts")
    )
    weights = scratch.write(weights, "weights")

    h = F.xxhash64("doc_id", F.lit(seed))
    rows = sizes.join(weights, "source").withColumn("h", h).withColumn("cut", F.pmod(F.shiftright("h", 20), F.col("cuts")))
    rows = scratch.write(rows, "rows")
    cuts = rows.groupBy("source", "cut").agg(F.sum("n_tokens").alias("_all"))
    before = F.sum("_all").over(Window.partitionBy("source").orderBy("cut")) - F.col("_all")
    cuts = scratch.write(cuts.select("source", "cut", before.alias("_base")), "cuts")
    inside = F.sum("n_tokens").over(Window.partitionBy("source", "cut").orderBy("h", "doc_id")) - F.col("n_tokens")
    placed = rows.withColumn("_in", inside).join(cuts, ["source", "cut"]).withColumn("place", F.col("_base") + F.col("_in"))

    # Readings: epochs whose first token of this document lies within the budget.
    readings = F.ceil((F.col("budget") - F.col("place")) / F.col("tokens")).cast("int")
    n_blocks = max(1, math.ceil(budget / BLOCK_TOKENS))
    copies = placed.withColumn("_readings", readings).filter("_readings > 0")
    copies = copies.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_readings") - 1)))
    at = (F.col("epoch") * F.col("tokens") + F.col("place")) / F.col("budget")
    copies = copies.withColumn("block", F.least(F.floor(at * n_blocks), F.lit(n_blocks - 1)).cast("bigint"))
    slot = F.row_number().over(Window.partitionBy("block").orderBy(F.xxhash64("doc_id", "epoch", F.lit(seed)), "doc_id", "epoch"))
    return copies.select("doc_id", "source", "epoch", "n_tokens", "block", slot.alias("slot"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, each as often as the mixture reads it."""
    readings = mix(docs, **options).groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("_readings"))
    again = docs.join(readings, "doc_id").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_readings"))))
    return again.select(*[docs[c] for c in docs.columns])
