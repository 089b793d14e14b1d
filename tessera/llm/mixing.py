"""Temperature mixing of sources, realised as budgeted block permutations.

A source's weight is its token share to the power of an exponent between 0
(all alike) and 1 (as they are), normalised. The exponent is bisected: as low
as the target entropy asks, but no lower than the repetition limit allows. A
source's budget (weight times token budget) is met by whole epochs and a part
of one more. An epoch is a seeded permutation of the source's blocks, a block
being the documents that share a hash slot; the part takes blocks in that order
and, in the block where the budget ends, documents in hash order. So all that a
document needs is its source's row of the plan: no text is shuffled.

Nulls, empties, ties: a null source is the source "". Documents of a source
without tokens are taken once. Rows with the same doc_id and source have the
same place and are taken together. An empty table gives no rows. Columns of
the input pass through; the operator's own replace those of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm import common

#: Levels of the bisection that one pass over the sources decides, and passes.
LEVELS, PASSES = 5, 6
SALTS = 16
CELLS = 1024


def words(text: Column) -> Column:
    """Tokens of a text as this module counts them: runs of non-space characters."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) by hash."""
    return F.xxhash64(*parts).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))


def bisect_exponent(sources: DataFrame, target_entropy: float, max_repeats: float,
                    budget_tokens: int | None) -> dict:
    """The exponent, and the sums that weights need, for ``sources`` (one row each, tokens > 0).

    ``target_entropy`` is a share of the entropy of equal weights. Each pass
    evaluates the midpoints of the next LEVELS bisections in one aggregation,
    so only a few sums reach the driver however many sources there are.
    """
    total, least, most, n = sources.agg(F.sum("tokens"), F.min("tokens"), F.max("tokens"), F.count(F.lit(1))).first()
    if not n:
        return {"exponent": 1.0, "z": 1.0, "total": 1, "budget": 0.0}
    if budget_tokens is not None and budget_tokens > max_repeats * total * (1 + 1e-9):
        raise ValueError("the budget asks for more repeats than the limit allows")
    share = F.col("tokens") / F.lit(float(total))
    target = target_entropy * math.log(n)

    def sums(exponents: list[float]) -> list[tuple[float, float]]:
        cells = [f(F.pow(share, F.lit(a))) for a in exponents
                 for f in (F.sum, lambda x: F.sum(x * F.log(share)))]
        got = sources.agg(*[c.alias(f"c{i}") for i, c in enumerate(cells)]).first()
        return list(zip(got[::2], got[1::2]))

    def budget(a: float, z: float) -> float:
        """Without a given budget: the largest source just once, every other at least once."""
        return float(budget_tokens) if budget_tokens is not None else z * total * (most / total) ** (1 - a)

    def rises(a: float, z: float, zl: float) -> bool:
        """Whether the exponent may or must be higher than ``a``."""
        entropy = math.log(z) - a * zl / z
        repeats = (least / total) ** (a - 1) / z * budget(a, z) / total
        return entropy >= target or repeats > max_repeats * (1 + 1e-12)

    low, high = 0.0, 1.0
    if rises(1.0, *sums([1.0])[0]):
        low = 1.0
    for _ in range(PASSES if low < 1 else 0):
        steps = 1 << LEVELS
        points = [low + (high - low) * i / steps for i in range(1, steps)]
        up = [rises(a, *s) for a, s in zip(points, sums(points))]
        i = 0
        for bit in reversed(range(LEVELS)):  # the bisection itself
            if up[i + (1 << bit) - 1]:
                i += 1 << bit
        low, high = low + (high - low) * i / steps, low + (high - low) * (i + 1) / steps
    exponent = round(high if low < 1 else 1.0, 9)
    z = sums([exponent])[0][0]
    return {"exponent": exponent, "z": z, "total": total, "budget": budget(exponent, z)}


def _located(rows: DataFrame, seed: int, block_tokens: int) -> DataFrame:
    """With n_blocks known: the block of a row and its order inside the block."""
    return rows.withColumns({
        "block": F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.lit("block")), F.col("n_blocks")),
        "in_block": _unit(F.lit(seed), F.col("doc_id"), F.lit("order"))})


def _turn(seed: int) -> Column:
    """Where the block comes in the permutation of the epoch."""
    return _unit(F.lit(seed), F.col("epoch"), F.col("source_key"), F.col("block"))


def plan_sources(slim: DataFrame, target_entropy: float, max_repeats: float, budget_tokens: int | None,
                 block_tokens: int, seed: int) -> DataFrame:
    """A row per source: weight, epochs, whole epochs, and where the part of the last one ends.

    ``slim`` has doc_id, source_key and tokens.
    """
    sources = common.materialise(slim.groupBy("source_key").agg(F.sum("tokens").alias("tokens")), "mix-sources")
    with_tokens = sources.filter("tokens > 0")
    found = bisect_exponent(with_tokens, target_entropy, max_repeats, budget_tokens)
    weight = F.pow(F.col("tokens") / F.lit(float(found["total"])), F.lit(found["exponent"])) / F.lit(found["z"])
    has = F.col("tokens") > 0
    plan = sources.withColumns({
        "weight": F.when(has, weight).otherwise(0.0), "exponent": F.lit(found["exponent"]),
        "n_blocks": F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(block_tokens))).cast("long")})
    # To the millionth, so that a budget of whole epochs is not missed by a rounding error.
    plan = plan.withColumn("epochs", F.when(has, F.round(F.col("weight") * F.lit(found["budget"]) / F.col("tokens"), 6))
                           .otherwise(1.0))
    plan = plan.withColumn("whole", F.floor("epochs").cast("long")).withColumn(
        "rest", F.ceil((F.col("epochs") - F.col("whole")) * F.col("tokens")).cast("long"))
    plan = common.materialise(plan, "mix-plan")
    part = plan.filter("rest > 0").select("source_key", "n_blocks", F.col("whole").alias("epoch"), "rest")
    docs = _located(_joined(slim, part), seed, block_tokens)
    blocks = (docs.groupBy("source_key", "block", "epoch", "rest").agg(F.sum("tokens").alias("tokens"))
              .withColumn("turn", _turn(seed)))
    # Running sums in two steps, over cells of the permutation and inside a cell: no source is one window.
    blocks = blocks.withColumn("cell", F.floor(F.col("turn") * CELLS).cast("int"))
    cells = blocks.groupBy("source_key", "cell").agg(F.sum("tokens").alias("in_cell"))
    earlier = W.partitionBy("source_key").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select("source_key", "cell", F.coalesce(F.sum("in_cell").over(earlier), F.lit(0)).alias("cells_before"))
    inside = W.partitionBy("source_key", "cell").orderBy("turn", "block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.join(cells, ["source_key", "cell"]).withColumn(
        "before", F.col("cells_before") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    cut = blocks.filter("before < rest and before + tokens >= rest").select(
        "source_key", "block", "turn", (F.col("rest") - F.col("before")).alias("left"))
    cut = common.materialise(cut, "mix-cut")
    by_hash = W.partitionBy("source_key").orderBy("in_block").rangeBetween(W.unboundedPreceding, W.currentRow)
    last = (docs.join(cut, ["source_key", "block"])  # one block a source
            .withColumn("upto", F.sum("tokens").over(by_hash)).filter("upto >= left")
            .groupBy("source_key").agg(F.min("in_block").alias("cut_in_block")))
    return plan.join(cut.select("source_key", F.col("turn").alias("cut_turn")), "source_key", "left").join(
        last, "source_key", "left")


def _joined(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Each row with its source's plan; a source that holds much of the rows is dealt to SALTS tasks."""
    salted = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    docs = docs.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return docs.join(salted, ["source_key", "_salt"]).drop("_salt")


def mix_sources(docs: DataFrame, target_entropy: float = 0.95, max_repeats: float = 4.0,
                budget_tokens: int | None = None, block_tokens: int = 1 << 16, seed: int = 0) -> DataFrame:
    """``docs`` (doc_id, source, text, ...) as often as their source's weight asks for.

    Adds tokens of the source (source_tokens), exponent, weight, epoch, block
    and ``place`` in [0, 1): reading rows by place gives every source its
    weight at any point of the stream. ``budget_tokens`` None: as many tokens
    as keep every document at least once.
    """
    common.prepare(docs.sparkSession)
    key = F.coalesce("source", F.lit(""))
    slim = common.materialise(docs.select("doc_id", key.alias("source_key"), words(F.col("text")).alias("tokens")),
                              "mix-tokens")
    plan = common.materialise(
        plan_sources(slim, target_entropy, max_repeats, budget_tokens, block_tokens, seed), "mix-final")
    own = ["source_tokens", "exponent", "weight", "epoch", "block", "place"]
    kept = [c for c in docs.columns if c not in own]
    # Under one name, so that no column of the input is in the way of the plan's.
    rows = docs.select(F.struct(*kept).alias("_row"), "doc_id", key.alias("source_key"))
    rows = _located(_joined(rows, plan.withColumnRenamed("tokens", "source_tokens")), seed, block_tokens)
    rows = rows.withColumn("epoch", F.explode(F.expr("sequence(0L, if(rest > 0, whole, greatest(whole, 1L) - 1))")))
    rows = rows.withColumn("_turn", _turn(seed))
    taken = (F.col("epoch") < F.col("whole")) | (F.col("source_tokens") == 0) | (F.col("_turn") < F.col("cut_turn")) | (
        (F.col("_turn") == F.col("cut_turn")) & (F.col("in_block") <= F.col("cut_in_block")))
    place = F.least((F.col("epoch") + F.col("_turn")) / F.col("epochs"), F.lit(1 - 1e-12))
    return rows.filter(taken).withColumn("place", place).select("_row.*", *own)
